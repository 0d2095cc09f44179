"""Profiles kept per batch date: states of fixed size that unite over dates without reading rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.columns import col, is_floating, is_missing, present
from starloom.operators.profile import QUANTILES, SKETCH_SIZE
from starloom.schemas import Profile
from starloom.sinks import check_date, ensure_table, replace_partition

# Size of a quantile sketch: a rank error of about 0.8 %.
RANK_SIZE = 400

#: A row per batch date and column. ``m2`` to ``m4`` are sums of powers of the distance to the date's mean.
STATE = (
    ("column", "string"),
    ("n_rows", "bigint"),
    ("n_missing", "bigint"),
    ("n_zero", "bigint"),
    ("n_negative", "bigint"),
    ("n_infinite", "bigint"),
    ("least", "double"),
    ("greatest", "double"),
    ("total", "double"),
    ("mean", "double"),
    ("m2", "double"),
    ("m3", "double"),
    ("m4", "double"),
    ("values", "binary"),
    ("ranks", "binary"),
)


def _state(df: DataFrame, name: str) -> Column:
    value = present(df, name)
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    v = value.cast("double") if numeric else F.lit(None).cast("double")
    n, spread = F.count(v), F.var_pop(v)
    # A date whose values are all the same has no skewness; its powers are 0.
    power = lambda c: F.when(n > 0, F.when(spread == 0, 0.0).otherwise(c))
    infinite = F.abs(v) == F.lit(float("inf"))
    parts = {
        "column": F.lit(name),
        "n_rows": F.count("*"),
        "n_missing": F.count_if(is_missing(df, name)),
        "n_zero": F.count_if(v == 0),
        "n_negative": F.count_if(v < 0),
        "n_infinite": F.count_if(infinite) if is_floating(df, name) else F.lit(0).cast("long"),
        "least": F.min(v),
        "greatest": F.max(v),
        "total": F.sum(v),
        "mean": F.avg(v),
        "m2": spread * n,
        "m3": power(F.skewness(v) * F.pow(spread, F.lit(1.5)) * n),
        "m4": power((F.kurtosis(v) + 3) * spread * spread * n),
        "values": F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), SKETCH_SIZE),
        "ranks": F.kll_sketch_agg_double(v, F.lit(RANK_SIZE)) if numeric else F.lit(None).cast("binary"),
    }
    return F.struct(*[parts[c].cast(kind).alias(c) for c, kind in STATE])


def date_states(
    df: DataFrame, columns: Sequence[str] | None = None, date: str = "process_date"
) -> DataFrame:
    """Rows (date, column, state) of every batch date in ``df``, from one pass with map-side combine.

    NaN counts as missing. Columns that are not numbers have counts and distinct values alone.
    """
    names = list(columns or [c for c in df.columns if c != date])
    states = df.groupBy(col(date).alias(date)).agg(F.array(*[_state(df, c) for c in names]).alias("__states"))
    return states.select(col(date), F.inline("__states"))


def keep_states(
    df: DataFrame,
    table: str,
    process_date: str,
    columns: Sequence[str] | None = None,
    date: str = "process_date",
    location: str | None = None,
) -> None:
    """Make the states of the batch those of its date in ``table``; nothing but the batch is read.

    A repeated load changes nothing, a corrected batch takes the old one's place, an empty one
    clears its date. Columns may come and go from date to date.
    """
    check_date(process_date)
    spark = df.sparkSession
    ensure_table(spark, table, Profile((*STATE, (date, "string")), "column", date), location)
    found = date_states(df, columns, date).collect()
    # A row per column of the batch, each of a fixed size.
    kept = spark.createDataFrame(found, f"`{date}` string, " + ", ".join(f"`{c}` {kind}" for c, kind in STATE))
    replace_partition(kept, table, process_date, date)


def united_profile(states: DataFrame, probs: Sequence[float] = QUANTILES) -> DataFrame:
    """Rows (column, n_rows, n, n_missing, n_zero, n_negative, n_infinite, n_distinct, min, max, sum,
    mean, variance, stddev, skewness, kurtosis, quantiles) over all dates of ``states``.

    Counts, extremes, sums and moments are those of the whole table, up to the order in which
    doubles are added; distinct counts are off by some 0.8 %, quantiles by as much in rank.
    Reads a row per date and column, no data. A column that no date has a value of has nulls.
    """
    n = F.col("n_rows") - F.col("n_missing")
    rows = states.withColumn("__n", F.when(F.col("mean").isNotNull(), n).otherwise(0))
    weighted = F.when(F.col("__n") > 0, F.col("mean") * F.col("__n"))
    means = rows.groupBy("column").agg((F.sum(weighted) / F.sum("__n")).alias("__mean"))
    # A row per column joins the states of that column.
    d = F.col("mean") - F.col("__mean")
    m2, m3, m4 = (F.col(c) for c in ("m2", "m3", "m4"))
    total = rows.join(means, "column").groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_missing", "n_zero", "n_negative", "n_infinite")],
        F.sum(n).alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
        F.min("least").alias("min"),
        F.max("greatest").alias("max"),
        F.sum("total").alias("sum"),
        F.first("__mean").alias("mean"),
        F.sum("__n").alias("__n"),
        F.sum(m2 + F.col("__n") * d * d).alias("__m2"),
        F.sum(m3 + 3 * d * m2 + F.col("__n") * d * d * d).alias("__m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + F.col("__n") * F.pow(d, F.lit(4))).alias("__m4"),
        F.kll_merge_agg_double("ranks").alias("__ranks"),
    )
    k, variance = F.col("__n"), F.try_divide(F.col("__m2"), F.col("__n") - 1)
    flat = F.col("__m2") == 0
    return total.select(
        "column",
        *["n_rows", "n", "n_missing", "n_zero", "n_negative", "n_infinite", "n_distinct", "min", "max", "sum", "mean"],
        variance.alias("variance"),
        F.sqrt(variance).alias("stddev"),
        F.when(~flat, F.sqrt(k) * F.col("__m3") / F.pow(F.col("__m2"), F.lit(1.5))).alias("skewness"),
        F.when(~flat, k * F.col("__m4") / (F.col("__m2") * F.col("__m2")) - 3).alias("kurtosis"),
        F.when(
            k > 0, F.kll_sketch_get_quantile_double("__ranks", F.array(*[F.lit(float(p)) for p in probs]))
        ).alias("quantiles"),
    )
