"""Dependence between columns. Every method does all pairs of columns in one job."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.columns import col, numeric_columns
from starloom.operators.ranks import approximate_ranks, pearson, spearman

Pairs = Sequence[tuple[str, str]]


def correlations(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson"
) -> DataFrame:
    """Rows (column_x, column_y, r) for every pair of columns.

    ``pearson``, ``spearman`` and ``spearman_approx`` are for numbers, ``cramers_v`` is for
    categories. Each pair uses the rows where both values are present; a pair without such rows
    has a null.
    """
    names = list(columns or numeric_columns(df))
    pairs = list(combinations(names, 2))
    if not pairs:
        raise ValueError("a correlation needs two columns or more")
    if method == "pearson":
        return _named(pearson(df, names), pairs, "r")
    if method == "spearman":
        return _named(spearman(df, names), pairs, "r")
    if method == "spearman_approx":
        return _named(pearson(approximate_ranks(df, names), names), pairs, "r")
    if method == "cramers_v":
        return _named(cramers_v_pairs(df, pairs).withColumnRenamed("v", "r"), pairs, "r")
    raise ValueError(f"unknown method {method!r}")


def _named(by_number: DataFrame, pairs: Pairs, *values: str) -> DataFrame:
    """A row for each pair, names in place of numbers; null where a pair has no row."""
    spark = by_number.sparkSession
    every = spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(pairs)], "__pair int, column_x string, column_y string"
    )
    # As many rows as pairs of columns.
    joined = every.join(by_number, F.col("__pair") == F.col("pair"), "left")
    return joined.select("column_x", "column_y", *values)


def cramers_v_pairs(df: DataFrame, pairs: Pairs) -> DataFrame:
    """Rows (pair, v, v_corrected): Cramer's V of categories, plain and bias-corrected, per pair
    number.

    Chi squared over n equals the sum of c^2 / (row total * column total) over the cells that
    occur, minus 1, so empty cells are never made. Marginals are joined on, as a window over a
    frequent category would put all its cells in one task.
    """
    both = [
        F.when(
            col(x).isNotNull() & col(y).isNotNull(),
            F.struct(
                F.lit(number).alias("pair"),
                col(x).cast("string").alias("x"),
                col(y).cast("string").alias("y"),
            ),
        )
        for number, (x, y) in enumerate(pairs)
    ]
    cells = (
        df.select(F.inline(F.array(*both)))
        # All join keys, so that every use of the cells has the same plan and one shuffle.
        .filter("pair IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
        .groupBy("pair", "x", "y")
        .agg(F.count("*").cast("double").alias("c"))
    )
    by_x = cells.groupBy("pair", "x").agg(F.sum("c").alias("x_total"))
    by_y = cells.groupBy("pair", "y").agg(F.sum("c").alias("y_total"))
    c, xt, yt = F.col("c"), F.col("x_total"), F.col("y_total")
    sums = (
        cells.join(by_x, ["pair", "x"])
        .join(by_y, ["pair", "y"])
        .groupBy("pair")
        .agg(
            F.greatest(F.sum(c * c / (xt * yt)) - 1, F.lit(0.0)).alias("phi2"),
            F.sum(c).alias("n"),
            # Each category's shares add up to one, so the sum counts the categories.
            F.round(F.sum(c / xt)).alias("kx"),
            F.round(F.sum(c / yt)).alias("ky"),
        )
    )
    phi2, n, kx, ky = (F.col(name) for name in ("phi2", "n", "kx", "ky"))
    corrected = F.greatest(phi2 - F.try_divide((kx - 1) * (ky - 1), n - 1), F.lit(0.0))
    fx = kx - F.try_divide((kx - 1) * (kx - 1), n - 1)
    fy = ky - F.try_divide((ky - 1) * (ky - 1), n - 1)
    return sums.select(
        "pair",
        F.sqrt(F.try_divide(phi2, F.least(kx, ky) - 1)).alias("v"),
        F.sqrt(F.try_divide(corrected, F.least(fx, fy) - 1)).alias("v_corrected"),
    )


def cramers_v(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column_x, column_y, v, v_corrected) for every pair of the columns."""
    pairs = list(combinations(columns, 2))
    return _named(cramers_v_pairs(df, pairs), pairs, "v", "v_corrected")
