"""Counts and summary statistics. One job each, however many columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.columns import col, is_floating


def rows_of(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Compute aggregate structs in one pass and return them as rows."""
    return df.agg(F.array(*structs).alias("__rows")).select(F.inline("__rows"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value, n) for every value of every column, null included; values as text.

    Any number of columns: each task counts the values of a batch column by column, so what Spark
    groups are distinct values per batch, not cells. Numbers and dates become text when counted.
    """
    columns = list(dict.fromkeys(columns))
    values, kinds = [], []
    for i, c in enumerate(columns):
        value, kind = col(c), df.schema[c].dataType
        if is_floating(df, c):
            value = F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)  # of either sign
        if isinstance(kind, T.IntegralType):
            value, kind = value.cast("long"), T.LongType()
        elif not isinstance(kind, (T.FloatType, T.DoubleType, T.BooleanType, T.DateType)):
            value, kind = value.cast("string"), T.StringType()
        values.append(value.alias(f"v{i}"))
        kinds.append(kind)
    types = list(dict.fromkeys(kinds))  # a column of values for each type
    homes = [types.index(kind) for kind in kinds]
    fields = [T.StructField(f"t{k}", kind) for k, kind in enumerate(types)]
    schema = T.StructType([T.StructField("c", T.IntegerType()), *fields, T.StructField("n", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for c, home in enumerate(homes):
                found = pc.value_counts(batch.column(c))
                value, n = found.field("values"), found.field("counts").cast(pa.int64())
                nothing = [pa.nulls(len(n), batch.column(homes.index(k)).type) for k in range(len(types))]
                row = [pa.array([c] * len(n), pa.int32()), *nothing, n]
                row[1 + home] = value
                parts.append(pa.record_batch(row, schema.names))
            yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if batch.num_rows else parts[0]

    cells = df.select(*values).mapInArrow(counted, schema).groupBy("c", *[f.name for f in fields]).agg(F.sum("n").alias("n"))
    text = F.coalesce(*[F.col(f.name).cast("string") for f in fields])
    return cells.select(F.get(F.lit(columns), F.col("c")).alias("column"), text.alias("value"), "n")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, n_null, n_not_null)."""
    return rows_of(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(col(c).isNull()).alias("n_null"),
                F.count(col(c)).alias("n_not_null"),
            )
            for c in columns or df.columns
        ],
    )


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, n, mean, stddev, min, max, min_text, max_text) for numbers and texts.

    Columns of other types are left out. NaN counts as a value, as in ``DataFrame.describe``.
    """
    structs = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        number = isinstance(f.dataType, T.NumericType)
        if not number and not isinstance(f.dataType, T.StringType):
            continue
        c, none = col(f.name), F.lit(None)
        structs.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.count(c).alias("n"),
                (F.avg(c) if number else none).cast("double").alias("mean"),
                (F.stddev_samp(c) if number else none).cast("double").alias("stddev"),
                (F.min(c) if number else none).cast("double").alias("min"),
                (F.max(c) if number else none).cast("double").alias("max"),
                (none if number else F.min(c)).cast("string").alias("min_text"),
                (none if number else F.max(c)).cast("string").alias("max_text"),
            )
        )
    return rows_of(df, structs)
