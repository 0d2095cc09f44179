"""Writers: CSV, partitioned catalog tables, external databases."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions import col
from starloom.schemas import Profile
from starloom.session import drop_scratch
from starloom.sources import CSV_OPTIONS, escaped


def write_csv(df: DataFrame, directory: str, process_date: str, name: str = "batch") -> str:
    """Write CSV with a header to ``directory/name_date``; returns that path.

    Line breaks in texts are escaped, so every row is one line; ``read_csv`` undoes it.
    """
    path = f"{directory.rstrip('/')}/{name}_{process_date}"
    rows = df.select(
        *[
            escaped(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema.fields
        ]
    )
    rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def ensure_table(
    spark: SparkSession, table: str, profile: Profile, location: str | None = None
) -> None:
    """Create the Parquet table if it is missing, partitioned by the profile's batch column.

    The catalog remembers the sort key and, if the profile has one, the distribution key: rows are
    then kept in buckets, and joins and groupings by that key need no shuffle. ``arranged`` and the
    loads follow what the catalog says, so later batches need no profile. A table that exists with
    another layout raises: its files would not fit.
    """
    if profile.distribute_by and profile.buckets < 1:
        raise ValueError("a distribution key needs a number of buckets")
    if spark.catalog.tableExists(table):
        found = table_layout(spark, table)
        if (found.distribute_by, found.buckets) != (profile.distribute_by, profile.buckets):
            raise ValueError(f"{table} is distributed by {found.distribute_by} in {found.buckets} buckets")
        return
    columns = ", ".join(f"`{name}` {ddl}" for name, ddl in profile.columns)
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if profile.partition_by:
        statement += f" PARTITIONED BY (`{profile.partition_by}`)"
    if profile.distribute_by:
        statement += (
            f" CLUSTERED BY (`{profile.distribute_by}`) SORTED BY (`{profile.sort_by}`) INTO {profile.buckets} BUCKETS"
        )
    if location:
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{quoted}'"
    spark.sql(f"{statement} TBLPROPERTIES ('{SORT_KEY}' = '{profile.sort_by}')")


#: Rows of a bucket of the largest table of those that share a distribution, about.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(*tables: DataFrame, least: int = 1) -> int:
    """Buckets for tables that are to be kept by the same key: ``least``, more where these hold many rows.

    A task joins or groups whole buckets, so their number must follow the rows, or its memory would.
    Counts the tables when called. The number is ``least`` doubled so many times, so that it changes
    seldom while a table grows: a replacement with another number makes a new table.
    """
    rows = max(table.count() for table in tables)
    while rows > least * ROWS_PER_BUCKET:
        least *= 2
    return least


@dataclass(frozen=True)
class TableLayout:
    """What the catalog remembers of a table's layout."""

    sort_by: str | None
    distribute_by: str | None = None
    buckets: int = 0


def table_layout(spark: SparkSession, table: str) -> TableLayout:
    """The layout that ``ensure_table`` gave the table."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    buckets = int(about.get("Num Buckets") or 0)
    key = about["Bucket Columns"].strip("[]`") if buckets else None
    return TableLayout(properties.get(SORT_KEY), key, buckets)


def arranged(df: DataFrame, table: str) -> DataFrame:
    """The rows as the table's layout wants them written: dealt by its distribution key, sorted by its sort key.

    A key that holds a large part of the rows still goes to several tasks, each of which writes a
    file of its own for the bucket.
    """
    found = table_layout(df.sparkSession, table)
    if found.distribute_by is None:
        return layout(df, found.sort_by) if found.sort_by in df.columns else df
    dealt = df.hint("rebalance", found.buckets, col(found.distribute_by))
    # The writer wants the rows of a task by bucket, then by sort key.
    bucket = F.pmod(F.hash(col(found.distribute_by)), F.lit(found.buckets))
    return dealt.sortWithinPartitions(bucket, *([col(found.sort_by)] if found.sort_by else []))


#: The table property that names the sort key.
SORT_KEY = "starloom.sort_by"


def layout(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Cluster rows by ``key`` and sort each output file by it, so that scans skip files.

    The rebalance hint lets adaptive execution split a key that holds a large part of the rows
    over several files and merge small ones; a plain ``repartition`` would give it one task.
    """
    args = [partitions, col(key)] if partitions else [col(key)]
    return df.hint("rebalance", *args).sortWithinPartitions(col(key))


def check_date(process_date: str) -> str:
    """The date, if it is written yyyy-MM-dd."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", process_date):
        raise ValueError(f"process_date must be yyyy-MM-dd, got {process_date!r}")
    return process_date


def _same_columns(df: DataFrame, wanted: list[str]) -> None:
    extra = sorted(set(df.columns) - set(wanted))
    if extra:
        raise ValueError(f"the table has no columns {', '.join(extra)}")


def replace_partition(
    df: DataFrame, table: str, process_date: str, partition_by: str = "process_date"
) -> None:
    """Make the batch the whole content of one date; other dates stay as they are.

    Columns that the table lacks and rows of another date raise before anything changes. The
    files are staged and swapped in when the job commits, so a job that fails leaves the old rows.
    An empty batch clears the date; a repeated load changes nothing. The batch must not be read
    from the same table, and is read twice or three times: give it a stored table.
    """
    check_date(process_date)
    spark = df.sparkSession
    columns = spark.table(table).columns
    _same_columns(df, [*columns, partition_by])
    if partition_by in df.columns:
        foreign = df.filter(~col(partition_by).cast("string").eqNullSafe(F.lit(process_date)))
        if not foreign.isEmpty():
            raise ValueError(f"the batch of {process_date} holds rows of other dates")
    names = [c for c in columns if c != partition_by]
    batch = df.select(*[col(c) for c in names])
    if table_layout(spark, table).buckets:
        batch = arranged(batch, table)
    where = f"`{partition_by}` = '{process_date}'"
    if df.isEmpty():
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({where}) SELECT * FROM {{batch}}", batch=batch)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition_by}`) "
            f"SELECT *, '{process_date}' AS `{partition_by}` FROM {{batch}}",
            batch=batch,
        )
    finally:
        spark.conf.set(mode, before)


def _location(spark: SparkSession, table: str) -> str:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(row["data_type"] for row in about if row["col_name"] == "Location")


def _same_design(spark: SparkSession, first: str, second: str) -> bool:
    return spark.table(first).schema == spark.table(second).schema and table_layout(
        spark, first
    ) == table_layout(spark, second)


def replace_table(df: DataFrame, table: str, profile: Profile, location: str | None = None) -> None:
    """Make the batch the whole content of a table without partitions.

    The rows go to a folder of their own, a version of the table. When it is complete, one change of
    the catalog makes the table point to it, and the old version's folder goes: at any step a crash
    leaves a table that can be read, with the old rows or the new. A job that fails leaves the old
    table; a version whose driver was lost stays as ``<table>_<digits>``. Columns that the profile
    lacks raise first. If the profile's columns or layout aren't the table's, a new table takes the
    name instead: between two renamings no table has it, and the old rows stay as
    ``<table>_old_...`` until the new ones do.
    """
    _same_columns(df, [name for name, _ in profile.columns])
    spark = df.sparkSession
    version = uuid.uuid4().hex
    fresh = f"{table}_{version}"
    existed = spark.catalog.tableExists(table)
    if location:
        folder = f"{location.rstrip('/')}/{version}"
    else:
        folder = f"{_location(spark, table).rstrip('/').rpartition('/')[0]}/{table.rpartition('.')[2]}-{version}" if existed else None
    ensure_table(spark, fresh, profile, folder)
    same = existed and _same_design(spark, fresh, table)
    if existed and not same and not location:  # the new table is to be a managed one again
        spark.sql(f"DROP TABLE {fresh}")
        ensure_table(spark, fresh, profile)
    try:
        names = [col(name) for name, _ in profile.columns]
        spark.sql(f"INSERT INTO {fresh} SELECT * FROM {{batch}}", batch=arranged(df.select(*names), fresh))
    except Exception:
        spark.sql(f"DROP TABLE {fresh}")
        if same:
            drop_scratch(spark, folder)
        raise
    if not same:
        _rename_over(spark, fresh, table, existed)
        return
    old = _location(spark, table)
    quoted = _location(spark, fresh).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
    spark.sql(f"REFRESH TABLE {table}")
    spark.sql(f"DROP TABLE {fresh}")  # its files stay: a table with a location does not own them
    drop_scratch(spark, old)


def _rename_over(spark: SparkSession, fresh: str, table: str, existed: bool) -> None:
    """Names alone change here; the old rows stay until the new ones have the name."""
    old = f"{table}_old_{uuid.uuid4().hex}"
    bare = table.rpartition(".")[2]
    if existed:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old.rpartition('.')[2]}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {bare}")
    except Exception:
        if existed:
            spark.sql(f"ALTER TABLE {old} RENAME TO {bare}")
        spark.sql(f"DROP TABLE {fresh}")
        raise
    if existed:
        spark.sql(f"DROP TABLE {old}")


def jdbc_write_options(
    url: str,
    table: str,
    driver: str | None = None,
    truncate: bool = True,
    column_types: str | None = None,
    batchsize: int = 10000,
    partitions: int = 8,
    **options: str,
) -> dict[str, str]:
    result = {
        "url": url,
        "numPartitions": str(partitions),
        "dbtable": table,
        "truncate": str(truncate).lower(),
        "batchsize": str(batchsize),
        **options,
    }
    if driver:
        result["driver"] = driver
    if column_types:
        result["createTableColumnTypes"] = column_types
    return result


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Write to an external database. ``truncate`` keeps the declared types of the old table;
    ``partitions`` bounds the number of open connections."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **options)).save()
