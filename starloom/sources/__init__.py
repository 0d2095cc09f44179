"""Readers. Each returns a lazy DataFrame; nothing is loaded on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.functions import col
from starloom.sources.arrays import array_records, parse_records

# One set of options for writing and reading CSV. The null marker keeps null, the empty string
# and the text NA apart; the timestamp patterns keep microseconds.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A Parquet table of the directory."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multiline: bool = False,
    permissive: bool = False,
) -> DataFrame:
    """JSON objects, one per line (or an array per line); ``multiline``: one array per file.

    A malformed record or a value of the wrong type raises when it is read. ``permissive`` needs a
    schema and keeps such records instead, their text in the column ``_corrupt_record``, for
    ``corrupt_records`` to count.

    Arrays are read by all tasks: a file is split by bytes, however it is laid out, and files larger
    than ``spark.sql.files.openCostInBytes`` are read twice, first to learn what each split begins
    with. A file that holds anything but one array raises when it is read; of a cut off one the last
    record is malformed. Without a schema Spark infers it with its own reader, one task per file.
    """
    if permissive:
        if schema is None:
            raise ValueError("permissive reading needs a schema")
        schema = _with_corrupt(schema)
    if multiline:
        if schema is None:
            schema = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path).schema
        records = array_records(spark, path)
        parts = [c for c in records.columns if c not in ("text", "is_object")]
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        fields = [f for f in fields if f.name not in parts]
        return parse_records(records, T.StructType(fields), CORRUPT if permissive else None)
    reader = spark.read.option("mode", "FAILFAST")
    if permissive:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _with_corrupt(schema: T.StructType | str, name: str = CORRUPT) -> T.StructType:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return T.StructType([*schema.fields, T.StructField(name, T.StringType())])


def corrupt_records(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_corrupt) of a table read permissively."""
    # All columns are read along: Spark tells misfits only in those that it parses.
    bad, values = col(CORRUPT), F.to_json(F.struct(*[col(c) for c in df.columns if c != CORRUPT]))
    either = F.count(F.coalesce(bad, values))
    good = F.count(F.when(bad.isNull(), values))
    return df.agg(F.count("*").alias("n_rows"), (either - good).alias("n_corrupt"))


def parse_json_col(
    df: DataFrame,
    column: str,
    schema: T.StructType | str,
    out: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Parse a JSON text column into a struct column (``out``, or in place).

    Text that doesn't parse gives null, or raises with ``strict``; ``parse_failures`` counts it.
    """
    options = {"mode": "FAILFAST"} if strict else {}
    return df.withColumn(out or column, F.from_json(col(column), schema, options))


def parse_failures(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """One row (column, n_failed): texts that aren't JSON or hold a value that doesn't fit the schema."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(col(column), _with_corrupt(schema), options)
    failed = F.count_if(col(column).isNotNull() & parsed[CORRUPT].isNotNull())
    return df.agg(failed.alias("n_failed")).select(F.lit(column).alias("column"), "n_failed")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV files written by ``write_csv``; a row that doesn't fit the schema raises.

    Line breaks and backslashes come back from their escapes, so that files stay splittable.
    """
    rows = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").schema(schema).csv(path)
    return rows.select(
        *[
            unescaped(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in rows.schema.fields
        ]
    )


def escaped(text: Column) -> Column:
    """Text on one line: backslash, line feed and carriage return as two characters each."""
    for plain, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escape))
    return text


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""

    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    # Between doubled backslashes, a backslash begins an escape.
    parts = F.split(text, r"\\\\")
    restored = F.array_join(F.transform(parts, breaks), "\\")
    return F.when(F.contains(text, F.lit("\\")), restored).otherwise(text)


def jdbc_read_options(
    url: str,
    query: str,
    driver: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    **options: str,
) -> dict[str, str]:
    """Reader options for a subquery; ``partition`` is (column, lower, upper, partitions)."""
    result = {"url": url, "dbtable": f"({query}) tmp_table", "fetchsize": "10000", **options}
    if driver:
        result["driver"] = driver
    if partition:
        name, lower, upper, parts = partition
        result |= {
            "partitionColumn": name,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return result


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    driver: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    **options: str,
) -> DataFrame:
    """The rows of a query on an external database.

    Without ``partition`` one task reads everything; give it for tables of any size.
    """
    settings = jdbc_read_options(url, query, driver, partition, **options)
    return spark.read.format("jdbc").options(**settings).load()
