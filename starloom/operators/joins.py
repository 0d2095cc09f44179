"""Joining a fact to its dimensions.

No join carries a hint. A dimension is broadcast only when Spark knows that it is below
``spark.sql.autoBroadcastJoinThreshold``; a larger one is sort-merged, and adaptive execution
splits the partitions of a key that holds a large part of the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starloom.functions.columns import col


@dataclass(frozen=True)
class DimSpec:
    """A dimension: which fact column finds it, and which of its columns to add as what."""

    df: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str]


def denormalise(fact: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """Inner-join the fact to every dimension.

    Facts without a match are dropped (``unmatched`` shows them). Dimension columns get their
    final names before the join, so equal names in two dimensions never meet.
    """
    for i, spec in enumerate(specs):
        clash = set(spec.columns.values()) & set(fact.columns)
        if clash:
            raise ValueError(f"dimension columns clash with the fact: {sorted(clash)}")
        key = f"__key_{i}"
        dim = spec.df.select(
            col(spec.dim_key).alias(key), *[col(src).alias(out) for src, out in spec.columns.items()]
        )
        fact = fact.join(dim, col(spec.fact_key) == col(key), "inner").drop(key)
    return fact


def join_audit(fact: DataFrame, spec: DimSpec) -> DataFrame:
    """Rows (key, n_facts, n_dimension, n_lost, n_added) of the keys that change the number of rows in
    an inner join: how many facts a key loses, and how many it adds beyond one per fact.

    Both sides are counted in one grouping, which combines copies before its only shuffle. A null
    key matches nothing: its facts are lost. It and other keys that occur twice in the dimension
    are listed even if no fact has them. The key has the wider of both sides' types.
    """
    one, none = F.lit(1), F.lit(0)
    sides = fact.select(col(spec.fact_key).alias("key"), one.alias("f"), none.alias("d")).unionAll(
        spec.df.select(col(spec.dim_key).alias("key"), none, one)
    )
    counts = sides.groupBy("key").agg(F.sum("f").alias("n_facts"), F.sum("d").alias("n_dimension"))
    matched = F.col("key").isNotNull() & (F.col("n_dimension") > 0)
    return counts.select(
        "*",
        F.when(matched, 0).otherwise(F.col("n_facts")).alias("n_lost"),
        F.when(matched, F.col("n_facts") * (F.col("n_dimension") - 1)).otherwise(0).alias("n_added"),
    ).filter("n_lost > 0 OR n_dimension > 1")


def unmatched(fact: DataFrame, spec: DimSpec) -> DataFrame:
    """Rows (key, n): fact keys missing from the dimension and how many facts each one loses.

    Keys are counted first, so the anti join sees one row per key however often it occurs. A
    null key never matches and is listed too.
    """
    counts = fact.groupBy(col(spec.fact_key).alias("key")).agg(F.count("*").alias("n"))
    dim = spec.df.select(col(spec.dim_key).alias("__key"))
    return counts.join(dim, counts["key"] == dim["__key"], "left_anti")
