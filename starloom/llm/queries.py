"""The training-data operators on the test tables, with their production parameters.

Every query reads its whole tables and whole texts; filters are those of the query's definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import prepared

from .credentials import scan_credentials
from .decontaminate import contamination
from .hnsw import nearest_neighbours
from .infill import fill_in_middle, restore_texts
from .jaccard import jaccard_components
from .katz import score_texts
from .licenses import scan_licenses
from .mixing import mix_documents
from .periodic import longest, periodic_runs, with_periodic_tails
from .quality import classify_quality, held_out
from .sharding import shard_documents
from .toxicity import classify_toxicity
from .warc import archive_pages, read_bundles

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op1_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10, slack=2)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
        "near_ids",
    )


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(embeddings, embeddings.filter("vec_id % 20 = 0"), k=20)


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(table(spark, sf_dir, "documents"), (5, 2, 1), share=1.5, most=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept_out = held_out(F.col("doc_id"), 5, 1)
    scores, _ = score_texts(table(spark, sf_dir, "documents"), ~kept_out)
    return scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages"))
    return read_bundles(index, payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify_quality(documents, table(spark, sf_dir, "labels"), least=0.3)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify_toxicity(documents, table(spark, sf_dir, "labels"), least=0.7)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_credentials(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


@query
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = restore_texts(fill_in_middle(table(spark, sf_dir, "documents"), seed=42, rate=50, suffix_first=80))
    return changed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


@query
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    best = longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
