"""The physical plans: what reaches the scan, what is shuffled, what never happens."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from starloom.operators.joins import DimSpec, denormalise
from starloom.operators.correlation import correlations
from workload import queries as Q
from workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_any_plan(spark, name):
    text = plan(REGISTRY[name](spark, SF_DIR))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_origin_filter_and_columns_reach_the_scan(spark):
    text = plan(Q.tickets_wide(spark, SF_DIR))
    fact = next(line for line in text.splitlines() if "l_returnflag" in line and "FileScan" in line)
    assert "EqualTo(l_returnflag,A)" in text
    assert "l_comment" not in fact and "l_tax" not in fact and "l_quantity" not in fact
    assert text.count("BroadcastHashJoin") == 2, "small dimensions are broadcast"


def test_large_dimensions_are_not_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        text = plan(Q.tickets_wide(spark, SF_DIR))
        assert text.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in text
        again = Q.tickets_wide(spark, SF_DIR).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert again == Q.tickets_wide(spark, SF_DIR).count()


def test_hot_fact_key_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id"))
        fact = spark.range(0, 200_000, 1, 8).select(
            key.alias("key"), F.md5(F.col("id").cast("string")).alias("payload")
        )
        dim = spark.range(200_000).select("id", F.md5(F.lit("x")).alias("name"))
        joined = denormalise(fact, [DimSpec(dim, "key", "id", {"name": "name"})])
        assert joined.count() == 200_000
        text = final_plan(joined.select("payload", "name"))
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(text):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange ", text))


@pytest.mark.parametrize(
    "name, most",
    [("value_counts", 1), ("null_flag_counts", 1), ("shape", 1), ("duplicate_report", 2),
     ("gate_report", 1), ("describe_columns", 1), ("profile_overview", 2), ("corr_pearson", 1),
     ("filter_eq", 0), ("replace_literals", 0), ("star_join", 0), ("threshold_violations", 0)],
)
def test_one_scan_and_few_shuffles(spark, name, most):
    text = plan(REGISTRY[name](spark, SF_DIR))
    assert exchanges(text) <= most, text
    assert len(re.findall(r"FileScan parquet.*lineitem|FileScan parquet.*documents", text)) == 1


def test_repeated_aggregates_are_computed_once(spark):
    text = final_plan(REGISTRY["cramers_v"](spark, SF_DIR))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_rank_correlation_has_one_plan_for_any_number_of_columns(spark):
    columns = ["l_quantity", "l_extendedprice", "l_linenumber", "l_tax", "l_discount", "l_partkey"]
    line = Q.line(spark, SF_DIR)
    gaps = line.select(*[F.when(F.col("l_orderkey") % (i + 2) > 0, F.col(c)).alias(c) for i, c in enumerate(columns)])
    few, many, apart = (
        exchanges(plan(correlations(df, columns[:k], "spearman"))) for df, k in ((line, 3), (line, 6), (gaps, 6))
    )
    assert few == many == apart, "shuffles grow with columns or patterns of missing values"
    assert "hint" not in inspect.getsource(correlations) and exchanges(
        plan(correlations(line, columns, "spearman_approx"))
    ) <= 2


def test_no_global_sort(spark):
    for name in ("cluster_sample", "top_values", "extreme_values", "head_rows", "duplicate_rows"):
        text = plan(REGISTRY[name](spark, SF_DIR))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_top_values_are_cut_before_the_shuffle(spark):
    text = plan(Q.top_values_by_column(spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_partition_pruning(spark):
    table = Q.partition_replace(spark, SF_DIR)
    text = plan(table.filter("process_date = '2024-01-02'"))
    assert re.search(r"PartitionFilters: \[.*process_date", text)


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = final_plan(Q.bucketed_join(spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in text and "Exchange" not in text
    assert re.search(r"SelectedBucketsCount: 8 out of 8", text)


def test_entry_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 18


def test_library_reads_nothing_whole_on_the_driver():
    import pathlib

    import starloom

    source = "\n".join(
        p.read_text() for p in pathlib.Path(inspect.getfile(starloom)).parent.rglob("*.py")
    )
    assert not re.search(r"toPandas|localCheckpoint|\bcrossJoin\(|\budf\(", source)
