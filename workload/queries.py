"""Every operator on the test tables. Inputs are whole tables; filters are part of the query.

Dates, times and decimals are returned as text so that both engines print them alike, and
floating aggregates are rounded, as the order of a sum changes its last digits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions import local_date, slash_timestamp
from starloom.functions.columns import Band
from starloom.operators import dedupe as D, frequent, profile as P, quality as G, shape as C, stats as S
from starloom.operators.correlation import correlations, cramers_v
from starloom.operators.joins import DimSpec, denormalise, join_audit, unmatched
from starloom.operators.sampling import sample_by_key
from starloom.operators.sql import sql_steps
from starloom.plans import batch, tickets
from starloom.plans.profile_report import profile_report, report_rows
from starloom.plans.profile_state import date_states, united_profile
from starloom.schemas import Profile
from starloom.session import prepared, scratch_path
from starloom.sinks import buckets_for, ensure_table, layout, replace_partition, replace_table, write_csv
from starloom.sources import parse_failures, parse_json_col, read_csv, read_json, read_table
from workload import standins

PROCESS_DATE = "2024-01-01"
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, less the underscore that avoids an import's name."""
    REGISTRY[fn.__name__.removesuffix("_")] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def nulled(column: str, value) -> Column:
    """The column with one of its values turned into null."""
    return F.nullif(F.col(column), F.lit(value)).alias(column)


def line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def line_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line(spark, sf_dir).select(nulled("l_returnflag", "N"), nulled("l_linenumber", 7))


def positive_suppliers(spark: SparkSession, sf_dir: str) -> DimSpec:
    supplier = read_table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return DimSpec(supplier, "l_suppkey", "s_suppkey", {"s_name": "s_name"})


# Whole jobs


@query
def tickets_wide(spark, sf_dir):
    return tickets.tickets_wide(
        standins.fact(spark, sf_dir),
        standins.airlines(spark, sf_dir),
        standins.airports(spark, sf_dir),
        PROCESS_DATE,
        origin="A",
    )


@query
def tickets_explore(spark, sf_dir):
    wide = tickets.tickets_explore(
        standins.fact(spark, sf_dir),
        standins.airlines(spark, sf_dir),
        standins.airports(spark, sf_dir),
    )
    return as_text(wide, "found_at", "depart_date", "search_date")


@query
def explore_description(spark, sf_dir):
    wide = tickets.joined_explore(
        standins.fact(spark, sf_dir),
        standins.airlines(spark, sf_dir),
        standins.airports(spark, sf_dir),
    )
    named = C.drop_nulls(wide, "airport_name")
    return rounded(S.describe_columns(named), 4, "mean", "stddev")


@query
def batch_result(spark, sf_dir):
    wide = C.where_lt(tickets_wide(spark, sf_dir), "number_of_changes", 4)
    table = f"batch_{uuid.uuid4().hex}"
    location = scratch_path(spark, table)
    batch.run_batch(wide, table, PROCESS_DATE, location=location).close()
    return as_text(spark.table(table), "value", "airport_latitude", "airport_longitude")


@query
def batch_sampled(spark, sf_dir):
    """The job as a whole: sample by key, CSV and back, gate on the sampled rows, load."""
    wide = C.where_lt(tickets_wide(spark, sf_dir), "number_of_changes", 4)
    table = f"batch_{uuid.uuid4().hex}"
    result = batch.run_batch(
        wide,
        table,
        PROCESS_DATE,
        location=scratch_path(spark, table),
        sample=batch.LOAD_SAMPLE,
        csv_dir=scratch_path(spark, "csv"),
    )
    back = read_csv(spark, result.csv_path, result.staged.schema)
    same = back.groupBy("found_at").agg(F.count("*").alias("n_csv"))
    loaded = spark.table(table).groupBy("found_at").agg(
        F.count("*").alias("n"), F.sum("value").cast("double").alias("value")
    )
    return rounded(loaded.join(same, "found_at"), 2, "value")


@query
def key_report(spark, sf_dir):
    inputs = (standins.fact(spark, sf_dir), standins.airlines(spark, sf_dir), standins.airports(spark, sf_dir))
    return tickets.key_report(*inputs)


@query
def profile_job(spark, sf_dir):
    """The profile of the wide table's rows as one job, its per-column sections as rows."""
    numbers = line(spark, sf_dir).select(
        "l_quantity", nulled("l_linenumber", 7), nulled("l_returnflag", "N"), "l_linestatus"
    )
    report = profile_report(numbers, order=["l_linenumber"], approx=False)
    return rounded(report_rows(report), 3, "value")


@query
def batch_blocked(spark, sf_dir):
    table = f"batch_{uuid.uuid4().hex}"
    result = batch.run_batch(tickets_wide(spark, sf_dir), table, PROCESS_DATE)
    return result.alerts


# Sources and sinks


@query
def json_struct_scan(spark, sf_dir):
    path = scratch_path(spark, "airports")
    airports = standins.all_airports(spark, sf_dir)
    airports.write.json(path)
    back = read_json(spark, path, airports.schema)
    return C.flatten_struct(back).drop("city_code")


@query
def json_array_scan(spark, sf_dir):
    """Files that hold one indented array each, of up to a hundred objects."""
    path = scratch_path(spark, "arrays")
    airports = standins.all_airports(spark, sf_dir)
    objects = F.to_json(F.struct(*airports.columns))
    arrays = airports.groupBy(F.floor(F.col("code").cast("long") / 100)).agg(
        F.concat(F.lit("[\n  "), F.array_join(F.collect_list(objects), ",\n  "), F.lit("\n]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    back = read_json(spark, path, airports.schema, multiline=True)
    return C.flatten_struct(back).drop("city_code")


@query
def json_parse_failures(spark, sf_dir):
    props = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)"))
    props = props.when(F.col("event_id") % 7 == 1, F.lit('{"k": "no number"}')).when(F.col("event_id") % 7 == 2, None)
    events = read_table(spark, sf_dir, "events").withColumn("props", props.otherwise(F.col("props")))
    return parse_failures(events, "props", "k int")


@query
def json_field_extract(spark, sf_dir):
    events = parse_json_col(read_table(spark, sf_dir, "events"), "props", "k int")
    return C.flatten_struct(events.select("event_id", "props"))


@query
def flatten_struct(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    coords = F.struct(
        F.struct(F.col("p_retailprice").alias("lat")).alias("point"), F.col("p_size").alias("size")
    )
    nested = part.select(
        "p_partkey",
        F.struct(F.col("p_name").alias("en")).alias("names"),
        F.when(F.col("p_size") > 25, coords).alias("coords"),
    )
    return C.flatten_struct(nested)


@query
def csv_roundtrip(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", nulled("event_type", "error"), "value", "props"
    )
    path = write_csv(events, scratch_path(spark, "csv"), PROCESS_DATE, "events")
    return as_text(read_csv(spark, path, events.schema), "ts")


@query
def csv_text_roundtrip(spark, sf_dir):
    """Texts with line breaks keep their rows."""
    documents = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("text", F.lit("\\n\\\n\r"), "source").alias("text")
    )
    path = write_csv(documents, scratch_path(spark, "csv"), PROCESS_DATE, "documents")
    return read_csv(spark, path, documents.schema)


@query
def partition_replace(spark, sf_dir):
    profile = Profile(
        (("o_orderkey", "bigint"), ("o_totalprice", "decimal(10,2)"), ("process_date", "varchar(12)")),
        sort_by="o_orderkey",
        partition_by="process_date",
    )
    table = f"orders_{uuid.uuid4().hex}"
    ensure_table(spark, table, profile, scratch_path(spark, table))
    orders = read_table(spark, sf_dir, "orders")
    for status, day in (("F", "2024-01-01"), ("O", "2024-01-02"), ("P", "2024-01-01")):
        loaded = C.with_batch_date(C.where_eq(orders, "o_orderstatus", status), day)
        replace_partition(layout(C.conform(loaded, profile), profile.sort_by), table, day)
    return as_text(spark.table(table), "o_totalprice")


@query
def bucketed_join(spark, sf_dir):
    """Two tables kept by the same key: neither the join nor the grouping shuffles."""
    kept = {}
    buckets = buckets_for(*[read_table(spark, sf_dir, name) for name in ("orders", "lineitem")], least=8)
    for name, columns in (
        ("orders", (("o_orderkey", "bigint"), ("o_orderstatus", "varchar(1)"), ("o_custkey", "bigint"))),
        ("lineitem", (("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_suppkey", "bigint"))),
    ):
        key = columns[0][0]
        profile = Profile(columns, sort_by=key, distribute_by=key, buckets=buckets)
        kept[name] = f"{name}_{uuid.uuid4().hex}"
        replace_table(C.conform(read_table(spark, sf_dir, name), profile), kept[name], profile, scratch_path(spark, name))
    joined = spark.table(kept["orders"]).join(spark.table(kept["lineitem"]), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderstatus", "o_custkey").agg(
        F.count("*").alias("n_lines"), F.sum("l_suppkey").alias("suppliers"), F.max("l_linenumber").alias("last_line")
    )


@query
def sql_steps_(spark, sf_dir):
    read_table(spark, sf_dir, "customer").createOrReplaceTempView("steps_customer")
    return sql_steps(
        spark,
        [
            "CREATE OR REPLACE TEMP VIEW steps_solvent AS "
            "SELECT * FROM steps_customer WHERE c_acctbal > 0",
            "SELECT c_mktsegment, count(*) AS n FROM steps_solvent GROUP BY c_mktsegment",
        ],
    )


# Projections, casts, filters


@query
def replace_literals(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rules = [("text", "'", " "), ("text", "-", "/"), ("source", "src", "s/"), ("source", "/", "-")]
    return C.replace_literals(documents, rules)


@query
def slash_dates(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", slash_timestamp(F.col("ts")).alias("found_at"))


@query
def cast_columns(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.floor("value").cast("double").alias("v_int"),
        F.col("ts").cast("string").alias("day"),
        F.col("event_type").alias("bad_int"),
    )
    cast = C.cast_columns(events, {"v_int": "int", "day": "date", "bad_int": "int"})
    return as_text(cast, "day")


@query
def cast_failures(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return C.cast_failures(
        orders,
        {"o_totalprice": "decimal(7,2)", "o_orderpriority": "varchar(8)", "o_orderstatus": "int"},
    )


@query
def conform_schema(spark, sf_dir):
    profile = Profile(
        (
            ("o_orderkey", "bigint"),
            ("o_totalprice", "decimal(7,2)"),
            ("o_orderpriority", "varchar(8)"),
        ),
        sort_by="o_orderkey",
    )
    orders = read_table(spark, sf_dir, "orders")
    return as_text(C.conform(orders, profile, strict=False), "o_totalprice")


@query
def project_rename_drop(spark, sf_dir):
    airports = C.flatten_struct(standins.all_airports(spark, sf_dir))
    kept = C.drop(airports, "city_code", "no_such_column")
    named = C.rename(kept, {"name_translations.en": "english", "coordinates.lat": "latitude"})
    return C.project(named, ["latitude", "code", "english"])


@query
def price_band(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    priced = orders.select("o_orderkey", price.alias("value"))
    banded = C.band(priced, "value", "class", tickets.PRICE_BANDS, tickets.CHEAPEST)
    return C.band(banded, "value", "half", [Band("low", lt=250000)], "high")


@query
def batch_date_column(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return C.with_batch_date(orders, PROCESS_DATE)


@query
def filter_eq(spark, sf_dir):
    kept = C.where_eq(line(spark, sf_dir), "l_returnflag", "A")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query
def filter_lt(spark, sf_dir):
    kept = C.where_lt(line(spark, sf_dir), "l_linenumber", 5)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query
def drop_nulls(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").select(
        "c_custkey", nulled("c_mktsegment", "MACHINERY"), nulled("c_nationkey", 3)
    )
    return C.drop_nulls(customers, ["c_mktsegment", "c_nationkey"])


@query
def local_batch_date(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", local_date(F.col("ts")).alias("process_date"))


# Joins


@query
def join_dim_inner(spark, sf_dir):
    joined = denormalise(line(spark, sf_dir), [positive_suppliers(spark, sf_dir)])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query
def star_join(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").filter("p_size <= 25")
    specs = [
        positive_suppliers(spark, sf_dir),
        DimSpec(part, "l_partkey", "p_partkey", {"p_name": "p_name"}),
    ]
    joined = denormalise(line(spark, sf_dir), specs)
    return joined.select("l_orderkey", "l_linenumber", "s_name", "p_name")


@query
def star_join_orders(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    nation = read_table(spark, sf_dir, "nation").filter("n_regionkey <> 2")
    specs = [
        DimSpec(
            customer, "o_custkey", "c_custkey", {"c_name": "name", "c_nationkey": "c_nationkey"}
        ),
        DimSpec(nation, "c_nationkey", "n_nationkey", {"n_name": "nation"}),
    ]
    joined = denormalise(read_table(spark, sf_dir, "orders"), specs)
    return joined.select("o_orderkey", "o_totalprice", "name", "nation")


@query
def join_audit_keys(spark, sf_dir):
    """Orders that no customer of positive balance, or several rows of one, would meet."""
    customers = read_table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    doubled = customers.unionAll(customers.filter("c_mktsegment = 'BUILDING'"))
    spec = DimSpec(doubled, fact_key="o_custkey", dim_key="c_custkey", columns={})
    return join_audit(read_table(spark, sf_dir, "orders"), spec)


@query
def unmatched_keys(spark, sf_dir):
    return unmatched(line(spark, sf_dir), positive_suppliers(spark, sf_dir))


# Duplicates, counts, statistics


@query
def dedupe_rows(spark, sf_dir):
    return D.dedupe(line(spark, sf_dir).select("l_orderkey", "l_linenumber"))


@query
def dedupe_subset(spark, sf_dir):
    kept = line(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return D.dedupe(kept, ["l_orderkey", "l_linenumber"])


@query
def duplicate_report(spark, sf_dir):
    return D.duplicate_report(line(spark, sf_dir).select("l_orderkey", "l_linenumber"))


@query
def distinct_values(spark, sf_dir):
    return D.distinct_values(line(spark, sf_dir), "l_returnflag", "l_linestatus", "l_linenumber")


@query
def duplicate_keys(spark, sf_dir):
    return D.duplicate_keys(line(spark, sf_dir), "l_orderkey")


@query
def duplicate_rows(spark, sf_dir):
    return D.duplicate_rows(line(spark, sf_dir).select("l_orderkey", "l_linenumber"), 20)


@query
def value_counts(spark, sf_dir):
    facts = standins.fact(spark, sf_dir).withColumn("origin", nulled("origin", "N"))
    return S.value_counts(facts, tickets.FREQUENCY_COLUMNS)


WIDE_COLUMNS = 70


@query
def value_counts_wide(spark, sf_dir):
    wide = line(spark, sf_dir).select(
        *[((F.col("l_linenumber") * (i + 1) + F.col("l_partkey")) % 5).alias(f"c{i}") for i in range(WIDE_COLUMNS)]
    )
    return S.value_counts(wide, wide.columns)


@query
def null_flag_counts(spark, sf_dir):
    return S.null_counts(line_with_nulls(spark, sf_dir))


@query
def shape(spark, sf_dir):
    return S.shape(line(spark, sf_dir))


@query
def describe_columns(spark, sf_dir):
    kept = line(spark, sf_dir).select(
        "l_extendedprice", "l_quantity", nulled("l_linenumber", 7), nulled("l_returnflag", "A")
    )
    return rounded(S.describe_columns(kept), 4, "mean", "stddev")


# Sampling


@query
def cluster_sample(spark, sf_dir):
    days = line(spark, sf_dir).withColumn("day", F.col("l_shipdate").cast("date"))
    sample = sample_by_key(days, "day", 100)
    return sample.select("l_orderkey", "l_linenumber", "l_partkey")


@query
def profile_sample(spark, sf_dir):
    sample = sample_by_key(standins.fact(spark, sf_dir), "found_at", 500, seed=7)
    columns = P.profile_moments(sample, ["value", "number_of_changes"])
    return rounded(columns.select("column", "n", "mean", "sum"), 2, "mean", "sum")


# Quality gate

RULES = (
    G.Rule("changes", "l_linenumber", ">=", 4),
    G.Rule("quantity", "l_quantity", ">=", 51),
    G.Rule("discount", "l_discount", ">", 0.09),
)


@query
def threshold_violations(spark, sf_dir):
    found = G.violations(line(spark, sf_dir), RULES)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "message")


@query
def gate_report(spark, sf_dir):
    return G.gate_report(line(spark, sf_dir), RULES)


@query
def alert_rows(spark, sf_dir):
    return G.alert_rows(G.gate_report(line(spark, sf_dir), RULES))


# Profile


@query
def profile_overview(spark, sf_dir):
    overview = P.profile_overview(line_with_nulls(spark, sf_dir))
    return rounded(overview, 6, "missing_share", "duplicate_share")


@query
def profile_types(spark, sf_dir):
    kept = line(spark, sf_dir).select(
        "l_orderkey", "l_linestatus", "l_returnflag", "l_shipdate", "l_tax"
    )
    return P.profile_types(kept, approx=False).select("column", "kind", "n_distinct")


@query
def profile_columns(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").select(
        "c_acctbal", nulled("c_nationkey", 3), "c_mktsegment"
    )
    return P.profile_columns(customer, approx=False)


@query
def profile_quantiles(spark, sf_dir):
    found = P.profile_quantiles(
        line(spark, sf_dir), ["l_extendedprice", "l_quantity"], approx=False
    )
    return rounded(found, 4, *[c for c in found.columns if c != "column"])


@query
def profile_moments(spark, sf_dir):
    found = P.profile_moments(line(spark, sf_dir), ["l_extendedprice", "l_quantity"])
    found = rounded(found, 2, "variance", "sum")
    return rounded(found, 4, "mean", "stddev", "skewness", "kurtosis")


@query
def profile_states(spark, sf_dir):
    """The profile of all rows, united from a state per month."""
    rows = line(spark, sf_dir).withColumn("process_date", F.date_format("l_shipdate", "yyyy-MM-01"))
    found = united_profile(date_states(rows, ["l_extendedprice", "l_quantity"])).select(
        "column", "n_rows", "n", "n_missing", "min", "max", "mean", "stddev", "variance", "sum", "skewness", "kurtosis"
    )
    found = rounded(found, 2, "min", "max", "variance", "sum")
    return rounded(found, 4, "mean", "stddev", "skewness", "kurtosis")


@query
def profile_histogram(spark, sf_dir):
    found = P.profile_histograms(line(spark, sf_dir), ["l_quantity", "l_linenumber"], 10)
    return rounded(found.drop("n_out"), 4, "bin_start", "bin_end")


@query
def profile_histogram_bounded(spark, sf_dir):
    found = P.profile_histograms(line(spark, sf_dir), ["l_quantity"], 4, bounds=(10.0, 30.0))
    return found.select("column", "bin", "n", "n_out")


@query
def top_values(spark, sf_dir):
    return P.top_values(line(spark, sf_dir), "l_partkey", 10)


@query
def frequent_values(spark, sf_dir):
    """The most frequent kinds of lines."""
    lines = line(spark, sf_dir).select(F.concat_ws("/", "l_returnflag", "l_linestatus", "l_linenumber").alias("v"))
    return frequent.frequent_values(lines, "v", 10)


@query
def frequent_values_tied(spark, sf_dir):
    """Values of which none stands out are grouped whole."""
    return frequent.frequent_values(line(spark, sf_dir), "l_partkey", 10, capacity=64)


@query
def top_values_by_column(spark, sf_dir):
    columns = ["l_returnflag", "l_partkey", "l_linenumber"]
    return P.top_values_by_column(line(spark, sf_dir), columns, 5)


@query
def extreme_values(spark, sf_dir):
    return P.extreme_values(line(spark, sf_dir), "l_extendedprice", 5)


@query
def extreme_values_by_column(spark, sf_dir):
    columns = ["l_extendedprice", "l_quantity"]
    return P.extreme_values_by_column(line(spark, sf_dir), columns, 5)


@query
def profile_text_lengths(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return rounded(P.profile_text_lengths(documents), 4, "mean_len")


@query
def corr_pearson(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_linenumber"]
    return rounded(correlations(line(spark, sf_dir), columns), 6, "r")


@query
def corr_spearman(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_linenumber"]
    return rounded(correlations(line(spark, sf_dir), columns, "spearman"), 6, "r")


@query
def corr_spearman_approx(spark, sf_dir):
    """To one decimal place: the sketches' error is some 0.1 % of a rank."""
    columns = ["l_quantity", "l_extendedprice", "l_linenumber"]
    found = correlations(line(spark, sf_dir), columns, "spearman_approx")
    # Adding zero turns a negative zero into zero.
    return rounded(found, 1, "r").withColumn("r", F.col("r") + F.lit(0.0))


@query
def cramers_v_(spark, sf_dir):
    found = cramers_v(line(spark, sf_dir), ["l_returnflag", "l_shipdate", "l_linenumber"])
    return rounded(found, 6, "v", "v_corrected")


@query
def missing_patterns(spark, sf_dir):
    return P.missing_patterns(line_with_nulls(spark, sf_dir))


@query
def profile_alerts(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        nulled("o_orderstatus", "F"),
        F.lit("x").alias("fixed"),
        (F.col("o_totalprice") * 2 + 1).alias("twice"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    return rounded(P.profile_alerts(orders, approx=False), 4, "value")


@query
def head_rows(spark, sf_dir):
    return P.head_rows(
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 10, ["o_orderkey"]
    )


@query
def tail_rows(spark, sf_dir):
    return P.tail_rows(
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 10, ["o_orderkey"]
    )
