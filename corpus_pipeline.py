"""The corpus pipeline: quality, near duplicates, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import stored
from starloom.llm.decontaminate import contamination
from starloom.llm.jaccard import jaccard_components, keep_first
from starloom.llm.mixing import apply_mix, mix_documents, row_hash
from starloom.llm.quality import classify_quality
from starloom.llm.sharding import shard_documents
from starloom.session import prepared


def shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but doc_id, text and source under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(_shield(c, i)) for i, c in enumerate(docs.columns)])


def _shield(name: str, place: int) -> str:
    return name if name in ("doc_id", "text", "source") else f"user_column_{place}"


def unshielded(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of a shielded table with the columns of ``docs`` alone."""
    return rows.select(*[F.col(_shield(c, i)).alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts, with their columns as they are.

    A null or empty text is scored as one without words; repeated rows and null ids are judged like
    any others; without usable labels all rows share one score; an empty table stays empty.
    """
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classify_quality(shielded(docs), labels)
    return unshielded(scored.filter("predicted = 1"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicate texts: that with the least doc_id.

    Rows link by their texts: unlike texts under one doc_id are apart, and rows equal in id and text
    become one. Null, empty and blank texts and rows without an id have no component and stay.
    """
    prepared(spark)
    return keep_first(docs, jaccard_components(docs, by_id=False))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without an occurrence of a benchmark window, with their columns as they are.

    A null or empty text holds no window; a null item text has none; repeated rows and null ids are
    judged like any others; without benchmark texts all rows stay.
    """
    prepared(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(shielded(docs), benchmark)
    return unshielded(found.filter("n_hit = 0"), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets take them, with their columns as they are.

    Texts without words take nothing; a null source is a source of its own; rows that differ in any
    column have turns of their own, rows equal in all columns have theirs added up; an empty table
    stays empty.
    """
    prepared(spark)
    return apply_mix(docs, mix_documents(docs, row=row_hash(docs)))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix; nulls and repeated rows are ordinary rows."""
    prepared(spark)
    return shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
#: Classifier, near-duplicate components and label propagation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from the documents; each result is written and read again."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
