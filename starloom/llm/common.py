"""Helpers shared by the training-data operators: shared scratch, words, distributed running totals."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import drop_scratch, scratch_path

#: Separators (fixed values): ASCII white space; every ASCII character but letters and digits.
BLANKS = "[\\x20\\x09-\\x0D]+"
NOT_ALNUM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Bytes of letters and digits in lower case, other ASCII as a blank; bytes above 127 stay.
FOLD_ALNUM = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to shared scratch and read from there: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that no later step reads."""
    drop_scratch(spark, *{file.rpartition("/")[0] for table in tables for file in table.inputFiles()})


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, so that shuffle files that no table needs are removed."""
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it is seen to hold at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes up to which a table may be broadcast.
LIGHT_BYTES = 32 << 20


def light(df: DataFrame, most_bytes: int = LIGHT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its values are measured to take at most ``most_bytes``, else as it is.

    Measuring runs a job, so ``df`` should be a stored table or cheap.
    """

    def width(name: str, kind: str) -> Column:
        if kind == "string":
            return F.octet_length(name) + 16
        if kind == "array<string>":
            return F.octet_length(F.array_join(name, "")) + 16 * F.size(name) + 16
        return F.lit(16)

    row = sum((F.coalesce(width(*c), F.lit(8)) for c in df.dtypes), F.lit(16))
    found = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if found <= most_bytes else df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for further columns, made longer until ``df`` has no column of the name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def bounded_slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """In a task: the batches in slices of some ``most_bytes`` of a binary column; a longer value is alone.

    Every slice is a copy with arrays that begin at their first row, as some kernels need.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.take(pa.array(np.arange(start, stop)))
            start = stop


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """In a task: the words of all texts, A-Z in lower case, one after the other, and each text's number of them.

    White space is ASCII white space; at a text's ends it leaves empty words. Null has none.
    """
    if texts.offset:  # the kernels misread some slices, so they get a copy
        texts = texts.take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    return lists.flatten(), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column, separators: str) -> Column:
    """The words between separators; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def n_words(text: Column, separators: str) -> Column:
    """The number of words between separators, 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), separators)
    edge = lambda at: F.when(F.element_at(parts, at) == "", 1).otherwise(0)
    both = F.when(F.size(parts) == 1, edge(1)).otherwise(edge(1) + edge(-1))
    return (F.size(parts) - both).cast("long")


def random_key(seed: str, *values: Column) -> Column:
    """32 evenly spread hexadecimal digits that depend on the seed and the row's values alone."""
    parts = [F.coalesce(v.cast("string"), F.lit("\x00")) for v in values]
    return F.md5(F.concat_ws("\x1f", F.lit(seed), *parts).cast("binary"))


def running_totals(
    df: DataFrame, group: str, key: str, value: str, out: str, rows_per_bucket: int = 20_000
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that stand before by ``key``.

    ``key`` holds evenly spread hexadecimal digits, so its first digits are an exact range
    partitioning: no group, however large, meets in one task. Sums per range are added up over the
    ranges, sums within a range over its rows. Rows of one key stand in any order. ``df`` is read
    twice and should be a stored table; ``group`` may be null.
    """
    n = df.count()
    digits = max(0, math.ceil(math.log(max(1, n / rows_per_bucket), 16)))
    ranged = df.withColumn("_g", F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))).withColumn(
        "_range", F.substring(key, 1, digits) if digits else F.lit("")
    )
    sums = ranged.groupBy("_g", "_range").agg(F.sum(value).alias("_in_range"))
    earlier = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_g", "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_g", "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(offsets, ["_g", "_range"])
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_g", "_range", "_offset")
    )


def global_rank(df: DataFrame, out: str, *order: Column) -> DataFrame:
    """Add ``out``, the row's place from 0 in the whole order, without one task that sees all rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row for each partition of the shuffle, so this window is bounded by a setting.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_offset") + place - 1).drop(
        "_part", "_offset"
    )
