"""Most frequent values in bounded memory: summaries per task, then an exact count of few candidates.

A task keeps a summary of at most ``capacity`` values of its rows. When it is full, one and the
same number is taken off every count and values at zero go (the merge of frequent-item summaries by
Agarwal and others), so a value's count is at least what summaries hold of it and at most that plus
what each task has taken off. Candidates are counted exactly; the result is whole if the last of
them beats every bound of the others. Else all values are grouped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from starloom.functions.columns import col
from starloom.operators.profile import top_values

def plain(kind: T.DataType) -> bool:
    """Whether equal values are equal in Arrow, and pass the driver unchanged."""
    exact = (T.BinaryType, T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampNTZType)
    return kind == T.StringType() or isinstance(kind, exact)


def summaries(df: DataFrame, column: str, capacity: int) -> DataFrame:
    """Rows (value, n, taken, present): each task's summary, and one row a task, without a value, that
    holds what the task took off."""
    values = df.select(col(column).alias("value"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, taken = None, 0
        for batch in batches:
            counted = pc.value_counts(batch.column(0))
            counts = pa.table({"value": counted.field(0), "n": counted.field(1).cast(pa.int64())})
            if held is not None:
                counts = pa.concat_tables([held, counts]).group_by("value").aggregate([("n", "sum")])
                counts = counts.select(["value", "n_sum"]).rename_columns(["value", "n"])
            if counts.num_rows > capacity:
                n = counts["n"].to_numpy()
                off = int(np.partition(n, len(n) - capacity - 1)[len(n) - capacity - 1])
                taken += off
                counts = counts.set_column(1, "n", pc.subtract(counts["n"], pa.scalar(off, pa.int64())))
                counts = counts.filter(pc.greater(counts["n"], 0))
            held = counts
        if held is None:
            return
        held = held.append_column("taken", pa.array(np.zeros(held.num_rows, np.int64)))
        held = held.append_column("present", pa.array(np.ones(held.num_rows, bool)))
        yield from held.combine_chunks().to_batches(max_chunksize=10_000)
        kind = held.schema.field("value").type
        last = [pa.nulls(1, kind), pa.array([0], pa.int64()), pa.array([taken], pa.int64()), pa.array([False])]
        yield pa.record_batch(last, held.schema.names)

    kind = values.schema["value"].dataType
    fields = [("value", kind), ("n", T.LongType()), ("taken", T.LongType()), ("present", T.BooleanType())]
    return values.mapInArrow(summarise, T.StructType([T.StructField(*f) for f in fields]))


def frequent_values(df: DataFrame, column: str, n: int, capacity: int = 4096) -> DataFrame:
    """The ``n`` most frequent values as (value, n), null among them; ties go to the smaller value.

    The rows are those of ``top_values``. What is shuffled follows ``capacity`` and the number of
    tasks, not the number of distinct values, as long as some ``n`` values stand out: the n-th must
    occur more often than rows divided by ``capacity``. Where none do, as in a key, all values are
    grouped. Reads the input twice and runs jobs when called; of a summary's values the driver
    takes ``8 n``. Values of floating-point, collated, instant and nested types
    are always grouped.
    """
    kind = df.schema[column].dataType
    if not plain(kind):
        return top_values(df, column, n)
    spark = df.sparkSession
    wide = max(capacity, 16 * n)
    merged = summaries(df, column, wide).groupBy("present", "value").agg(
        F.sum("n").alias("n"), F.sum("taken").alias("taken")
    )
    most = merged.orderBy(F.col("present"), F.desc("n"), "value").limit(8 * n + 2).collect()
    taken = sum(row["taken"] for row in most if not row["present"])
    held = [row for row in most if row["present"]]
    if not held:
        return top_values(df, column, n)
    chosen, rest = held[: 8 * n], held[8 * n :]
    # No other value occurs more often: one that summaries hold has its count there and what was
    # taken off; one in none of them has at most what was taken off.
    bound = taken + (rest[0]["n"] if rest else 0)
    few = spark.createDataFrame([(row["value"],) for row in chosen], T.StructType([T.StructField("wanted", kind)]))
    # A broadcast of 8 n rows at most.
    wanted = F.col("value").eqNullSafe(F.col("wanted"))
    rows = df.select(col(column).alias("value")).join(F.broadcast(few), wanted, "left_semi")
    exact = rows.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n).collect()
    complete = not rest and not taken
    if complete or (len(exact) == n and exact[-1]["n"] > bound):
        schema = T.StructType([T.StructField("value", kind), T.StructField("n", T.LongType())])
        return spark.createDataFrame(exact, schema)
    return top_values(df, column, n)
