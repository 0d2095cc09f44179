"""Duplicates. Every operator groups with map-side combine, so copies collapse before the
shuffle and a row that occurs very often does not end up as many rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.columns import col


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove equal rows, or keep one row per ``subset``: the least by the other columns, so
    that a recomputed task keeps the same one."""
    rest = [c for c in df.columns if subset is not None and c not in subset]
    if not rest:
        return df.dropDuplicates()
    kept = df.groupBy(*[col(c) for c in subset]).agg(
        F.min(F.struct(*[col(c) for c in rest])).alias("__rest")
    )
    return kept.select(
        *[
            F.col("__rest").getField(c).alias(c) if c in rest else col(c)
            for c in df.columns
        ]
    )


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits that stand for a row, as two hashes: rows that a grouping calls equal share them.

    Hashing skips nulls, so which columns are null is hashed along. Unequal rows share a digest with a
    chance of 2^-128 per pair.
    """
    cells = [col(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    return [F.xxhash64(F.lit(seed), nulls, *cells).alias(f"__digest{seed}") for seed in (1, 2)]


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_distinct, n_duplicates), from one job. Digests of rows are shuffled, so
    the bytes do not depend on how wide the rows are."""
    groups = df.groupBy(*row_digest(df)).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct")
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[col(c) for c in columns]).distinct()


def duplicate_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """The rows that occur more than once, with their count ``n`` (``n_copies`` for a table that
    has a column n); the ``n`` most frequent if given.

    Reads the input twice: digests of all rows tell which occur again, and only such rows are
    grouped whole.
    """
    names = df.columns
    count = "n_copies" if "n" in names else "n"
    digests = [f"__digest{seed}" for seed in (1, 2)]
    again = df.groupBy(*row_digest(df)).agg(F.count("*").alias("__n")).filter("__n > 1")
    rows = df.select("*", *row_digest(df)).join(again.select(*digests), digests, "left_semi")
    groups = rows.groupBy(*[col(c) for c in names]).agg(F.count("*").alias(count)).filter(col(count) > 1)
    if n is None:
        return groups
    return groups.orderBy(F.desc(count), *[col(c) for c in names]).limit(n)


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Rows (key, n): dimension keys that would multiply facts in a join."""
    return dim.groupBy(col(key).alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
