"""The sections of a data-quality report, as DataFrames.

Approximate forms (fixed-size sketches) are the default; exact ones are for small data and for
checking. NaN counts as missing here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.functions.columns import col, is_floating, is_missing, numeric_columns, present
from starloom.operators.correlation import correlations
from starloom.operators.dedupe import row_digest
from starloom.operators.ranks import quantiles_and_mad
from starloom.operators.stats import rows_of, value_counts

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


# Registers of a distinct-count sketch, as a power of two: a standard error of 0.8 %.
SKETCH_SIZE = 14


def _n_distinct(df: DataFrame, name: str, approx: bool) -> Column:
    """Distinct values, exact or from a sketch of their hashes.

    The sketch is one binary buffer; ``approx_count_distinct`` at this precision keeps its
    registers in some 1,600 buffer columns per column, which makes wide tables slow to plan.
    """
    value = present(df, name)
    if not approx:
        return F.count_distinct(value)
    hashes = F.when(value.isNotNull(), F.xxhash64(value))
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(hashes, SKETCH_SIZE)), F.lit(0))


def _count_where(df: DataFrame, name: str, test) -> Column:
    """Count of numbers that pass a test; 0 for columns that are not numeric."""
    if not isinstance(df.schema[name].dataType, T.NumericType):
        return F.lit(0).cast("long")
    return F.count_if(test(present(df, name)))


def profile_overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells and duplicate rows with their shares. One job, in which
    digests of rows are shuffled."""
    missing = reduce(lambda a, b: a + b, [is_missing(df, c).cast("long") for c in df.columns])
    groups = df.groupBy(*row_digest(df)).agg(F.count("*").alias("__n"), F.sum(missing).alias("__missing"))
    n = F.coalesce(F.sum("__n"), F.lit(0))
    cells = n * len(df.columns)
    n_missing = F.coalesce(F.sum("__missing"), F.lit(0))
    n_duplicates = n - F.count("*")
    return groups.agg(
        n.alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        n_missing.alias("missing_cells"),
        F.try_divide(n_missing.cast("double"), cells).alias("missing_share"),
        n_duplicates.alias("duplicate_rows"),
        F.try_divide(n_duplicates.cast("double"), n).alias("duplicate_share"),
    )


def _kind(data_type: T.DataType) -> str:
    kinds = (
        (T.BooleanType, "boolean"),
        (T.NumericType, "numeric"),
        ((T.DateType, T.TimestampType, T.TimestampNTZType), "datetime"),
        (T.StringType, "text"),
    )
    return next((kind for types, kind in kinds if isinstance(data_type, types)), "other")


def profile_types(
    df: DataFrame, approx: bool = True, categorical_at_most: int = 50
) -> DataFrame:
    """Rows (column, type, kind, n_distinct). Columns of at most two values are ``boolean``,
    text columns of few values ``categorical``."""
    rows = rows_of(
        df,
        [
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(_kind(f.dataType)).alias("kind"),
                _n_distinct(df, f.name, approx).alias("n_distinct"),
            )
            for f in df.schema.fields
        ],
    )
    few = (F.col("kind") == "text") & (F.col("n_distinct") <= categorical_at_most)
    kind = F.when(F.col("n_distinct").between(1, 2), "boolean").when(few, "categorical")
    return rows.withColumn("kind", kind.otherwise(F.col("kind")))


def profile_columns(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = True
) -> DataFrame:
    """Rows (column, n_distinct, n_missing, n_zero, n_negative, n_infinite)."""

    def infinite(v: Column) -> Column:
        return F.abs(v) == F.lit(float("inf"))

    return rows_of(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                _n_distinct(df, c, approx).alias("n_distinct"),
                F.count_if(is_missing(df, c)).alias("n_missing"),
                _count_where(df, c, lambda v: v == 0).alias("n_zero"),
                _count_where(df, c, lambda v: v < 0).alias("n_negative"),
                (
                    _count_where(df, c, infinite) if is_floating(df, c) else F.lit(0).cast("long")
                ).alias("n_infinite"),
            )
            for c in columns or df.columns
        ],
    )


def profile_quantiles(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Rows (column, min, q05, q25, q50, q75, q95, max, range, iqr, cv, mad).

    The approximate form does all columns in two passes, the second for the median absolute
    deviation. The exact form interpolates; it runs its jobs when called, all columns together.
    """
    names = list(columns or numeric_columns(df))
    values = df.select(*[present(df, c).cast("double").alias(c) for c in names])
    build = _approx_quantiles if approx else _exact_quantiles
    found = build(values, names, accuracy)
    labelled = [F.col("q")[i].alias(f"q{round(p * 100):02d}") for i, p in enumerate(QUANTILES)]
    return found.select(
        "column",
        "min",
        *labelled,
        "max",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("q")[3] - F.col("q")[1]).alias("iqr"),
        "cv",
        "mad",
    )


def _spread(c: str) -> list[Column]:
    return [
        F.min(col(c)).alias("min"),
        F.max(col(c)).alias("max"),
        F.try_divide(F.stddev_samp(col(c)), F.avg(col(c))).alias("cv"),
    ]


def _approx_quantiles(values: DataFrame, names: Sequence[str], accuracy: int) -> DataFrame:
    first = rows_of(
        values,
        [
            F.struct(
                F.lit(c).alias("column"),
                *_spread(c),
                F.percentile_approx(col(c), list(QUANTILES), accuracy).alias("q"),
            )
            for c in names
        ],
    )
    medians = values.agg(
        *[F.percentile_approx(col(c), 0.5, accuracy).alias(f"m{i}") for i, c in enumerate(names)]
    )
    deviations = rows_of(
        values,
        [
            F.struct(
                F.lit(c).alias("__column"),
                F.percentile_approx(
                    F.abs(col(c) - medians.select(f"m{i}").scalar()), 0.5, accuracy
                ).alias("mad"),
            )
            for i, c in enumerate(names)
        ],
    )
    return first.join(deviations, F.col("column") == F.col("__column"))


def _exact_quantiles(values: DataFrame, names: Sequence[str], accuracy: int) -> DataFrame:
    rows = [
        (c, quantiles, mad)
        for c, (quantiles, mad) in zip(names, quantiles_and_mad(values, names, QUANTILES))
    ]
    found = values.sparkSession.createDataFrame(
        rows, "__column string, q array<double>, mad double"
    )
    spread = rows_of(values, [F.struct(F.lit(c).alias("column"), *_spread(c)) for c in names])
    return spread.join(found, F.col("column") == F.col("__column"))


def profile_moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, n, mean, stddev, variance, sum, skewness, kurtosis). Skewness and excess
    kurtosis are the population forms."""
    structs = []
    for c in columns or numeric_columns(df):
        v = present(df, c).cast("double")
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("stddev"),
                F.var_samp(v).alias("variance"),
                F.sum(v).alias("sum"),
                F.skewness(v).alias("skewness"),
                F.kurtosis(v).alias("kurtosis"),
            )
        )
    return rows_of(df, structs)


def profile_histograms(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 10,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Rows (column, bin, bin_start, bin_end, n): equal bins per column, the last one closed,
    empty bins too. Two passes for all columns together.

    The bounds are the least and greatest finite value of the column unless given. Infinities
    and values outside given bounds are in no bin; every row says how many there are as ``n_out``. A
    column whose values are all infinite has one row, its bin and edges null.
    """
    names = list(columns or numeric_columns(df))
    cells = [
        F.struct(F.lit(c).alias("column"), present(df, c).cast("double").alias("v"))
        for c in names
    ]
    every_value = df.select(F.inline(F.array(*cells))).filter(F.col("v").isNotNull())
    inside = F.abs("v") != F.lit(float("inf"))
    if bounds:
        inside = inside & F.col("v").between(*bounds)
        low, high = (F.lit(float(b)) for b in bounds)
    else:
        low, high = (f(F.when(inside, F.col("v"))) for f in (F.min, F.max))
    values = every_value.filter(inside)
    # One row per column.
    ends = every_value.groupBy("column").agg(
        low.alias("low"), high.alias("high"), F.count_if(~inside).alias("n_out")
    )
    # No bucket if all values are equal: they go to the first bin. The greatest value has a
    # bucket of its own after the last bin, which it closes.
    bucket = F.width_bucket("v", F.col("low"), F.col("high"), F.lit(bins))
    counts = (
        values.join(F.broadcast(ends.drop("n_out")), "column")
        .groupBy("column", F.least(F.coalesce(bucket, F.lit(1)), F.lit(bins)).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("high") - F.col("low")) / bins
    numbers = F.when(F.col("low").isNotNull(), F.sequence(F.lit(1), F.lit(bins))).otherwise(F.array(F.lit(None)))
    every = ends.withColumn("bin", F.explode(numbers.cast("array<long>")))
    return every.join(counts, ["column", "bin"], "left").select(
        "column",
        F.col("bin").cast("int").alias("bin"),
        (F.col("low") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("low") + width * F.col("bin")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "n_out",
    )


def profile_histogram(
    df: DataFrame, column: str, bins: int = 10, bounds: tuple[float, float] | None = None
) -> DataFrame:
    """The histogram of one column as (bin, bin_start, bin_end, n, n_out)."""
    return profile_histograms(df, [column], bins, bounds).drop("column")


def _first_per_column(counts: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each column. Spark cuts to ``n`` rows per column in every task
    before the shuffle, so a column with many values is never brought together."""
    place = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    return counts.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")


def top_values_by_column(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most frequent values of every column as (column, value, n), values as text;
    ties go to the smaller text. One job."""
    return _first_per_column(value_counts(df, columns), n, F.desc("n"), F.asc("value"))


def extreme_values_by_column(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` smallest and greatest distinct numbers of every column as (side, column, value,
    n).

    A first job finds each column's ``n``-th smallest and greatest distinct value, from at most
    ``2 n`` values of every task; then only values from there on outwards are counted.
    """
    values = df.select(*[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    limits = _outermost(values, n)
    cells = [
        F.when(
            (F.col(f"v{i}") <= F.lit(low)) | (F.col(f"v{i}") >= F.lit(high)),
            F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("value")),
        )
        for i, (c, (low, high)) in enumerate(zip(columns, limits))
        if low is not None
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "side string, column string, value double, n long")
    counts = (
        values.select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    smallest = _first_per_column(counts, n, F.asc("value")).withColumn("side", F.lit("min"))
    greatest = _first_per_column(counts, n, F.desc("value")).withColumn("side", F.lit("max"))
    return smallest.unionByName(greatest).select("side", "column", "value", "n")


def _outermost(values: DataFrame, n: int) -> list[tuple[float | None, float | None]]:
    """Per column its n-th smallest and n-th greatest distinct value, or the last if there are fewer."""
    k = len(values.columns)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.array([]) for _ in range(2 * k)]
        for batch in batches:
            for i in range(k):
                x = np.unique(batch.column(i).drop_null().to_numpy(zero_copy_only=False))
                kept[i] = np.unique(np.concatenate([kept[i], x]))[:n]
                kept[k + i] = np.unique(np.concatenate([kept[k + i], x]))[-n:]
        sides = np.repeat(np.arange(2 * k, dtype=np.int32), [len(x) for x in kept])
        yield pa.record_batch([pa.array(sides), pa.array(np.concatenate(kept))], ["c", "value"])

    found = values.mapInArrow(ends, "c int, value double").distinct()
    least = F.when(F.col("c") < k, F.col("value")).otherwise(-F.col("value"))
    place = F.row_number().over(Window.partitionBy("c").orderBy(least))
    rows = found.withColumn("place", place).filter(F.col("place") <= n).groupBy("c").agg(
        F.max_by("value", "place").alias("value")
    )
    last = {row["c"]: row["value"] for row in rows.collect()}
    return [(last.get(i), last.get(k + i)) for i in range(k)]


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values as (value, n); ties go to the smaller value."""
    counts = df.groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(n)


def extreme_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` smallest and ``n`` greatest distinct values as (side, value, n)."""
    counts = (
        df.filter(~is_missing(df, column))
        .groupBy(col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    sides = [
        counts.orderBy(order).limit(n).select(F.lit(side).alias("side"), "value", "n")
        for side, order in (("min", F.asc("value")), ("max", F.desc("value")))
    ]
    return sides[0].unionAll(sides[1])


def profile_text_lengths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, min_len, mean_len, max_len), in characters."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return rows_of(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.min(F.char_length(col(c))).alias("min_len"),
                F.avg(F.char_length(col(c))).alias("mean_len"),
                F.max(F.char_length(col(c))).alias("max_len"),
            )
            for c in columns or texts
        ],
    )


def missing_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Which columns are missing together: one row per combination of ``<column>_missing``."""
    flags = [is_missing(df, c).alias(f"{c}_missing") for c in columns or df.columns]
    return df.groupBy(*flags).agg(F.count("*").alias("n"))


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def tail_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows in the given order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


@dataclass(frozen=True)
class AlertThresholds:
    """When a column is worth an alert; shares are of all rows."""

    missing_share: float = 0.05
    zero_share: float = 0.1
    cardinality: int = 50
    skewness: float = 20.0
    correlation: float = 0.9


def profile_alerts(
    df: DataFrame,
    thresholds: AlertThresholds = AlertThresholds(),
    approx: bool = True,
) -> DataFrame:
    """Rows (column, other, alert, value): constant, unique, high_cardinality (texts), missing,
    zeros, skewed, and correlated pairs.

    One pass gives a row of figures per column, another the correlations. With ``approx`` distinct
    values are estimates; a column whose estimate is near its number of values is counted exactly
    to tell if it is unique. Runs jobs when called.
    """
    numbers = numeric_columns(df)
    limits = thresholds
    figures = []
    for f in df.schema.fields:
        v = present(df, f.name)
        number = v.cast("double") if f.name in numbers else F.lit(None).cast("double")
        figures.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(isinstance(f.dataType, T.StringType)).alias("text"),
                F.lit(f.name in numbers).alias("number"),
                F.count("*").alias("total"),
                F.count(v).alias("present"),
                _n_distinct(df, f.name, approx).alias("distinct"),
                F.count_if(number == 0).alias("zeros"),
                F.skewness(number).alias("skewness"),
            )
        )
    rows = rows_of(df, figures).collect()
    unique = {row["column"]: row["distinct"] for row in rows if row["distinct"] == row["present"] > 1}
    if approx:
        near = [r["column"] for r in rows if r["present"] > 1 and r["distinct"] > NEAR * r["present"]]
        unique = _unique_columns(df, near, {r["column"]: r["present"] for r in rows})
    found: list[tuple[str, str | None, str, float]] = []
    for row in rows:
        c, total, distinct = row["column"], row["total"], unique.get(row["column"], row["distinct"])
        missing = (total - row["present"]) / total if total else 0.0
        zeros = row["zeros"] / total if total else 0.0
        skewness = row["skewness"]
        checks = (
            ("constant", distinct, distinct == 1),
            ("missing", missing, missing > limits.missing_share),
            ("unique", distinct, c in unique),
            ("high_cardinality", distinct, row["text"] and distinct > limits.cardinality),
            ("zeros", zeros, zeros > limits.zero_share),
            ("skewed", skewness, skewness is not None and abs(skewness) > limits.skewness),
        )
        found += [(c, None, alert, float(value)) for alert, value, fires in checks if fires]
    spark = df.sparkSession
    alerts = spark.createDataFrame(found, "column string, other string, alert string, value double")
    if len(numbers) < 2:
        return alerts
    pairs = correlations(df, numbers).filter(F.abs("r") > limits.correlation)
    return alerts.unionByName(
        pairs.select(
            F.col("column_x").alias("column"),
            F.col("column_y").alias("other"),
            F.lit("correlated").alias("alert"),
            F.col("r").alias("value"),
        )
    )


# Estimated share of distinct values from which a column is counted exactly.
NEAR = 0.9


def _unique_columns(df: DataFrame, columns: Sequence[str], n_present: dict[str, int]) -> dict[str, int]:
    """Of the columns those whose values are all distinct, with their number."""
    if not columns:
        return {}
    cells = [
        F.struct(F.lit(c).alias("column"), present(df, c).cast("string").alias("value")) for c in columns
    ]
    values = df.select(F.inline(F.array(*cells))).filter("value IS NOT NULL")
    distinct = values.distinct().groupBy("column").count().collect()
    return {row["column"]: row["count"] for row in distinct if row["count"] == n_present[row["column"]]}
