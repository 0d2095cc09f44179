import uuid
from decimal import Decimal

import data
import pytest

from starloom import schemas, sinks
from starloom.operators.quality import Rule
from starloom.operators.shape import where_lt, with_batch_date
from starloom.plans import tickets
from starloom.plans.batch import Sample, run_batch
from starloom.plans.profile_report import close_report, profile_report
from starloom.sinks import TableLayout, ensure_table, layout, replace_partition, replace_table, table_layout
from starloom.sources import read_csv

PROFILE = schemas.Profile(
    (("id", "int"), ("v", "decimal(10,2)"), ("process_date", "varchar(12)")),
    sort_by="id",
    partition_by="process_date",
)

NO_RULE = Rule("id", "id", "<", 0)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(spark, table):
    return sorted(map(tuple, spark.table(table).collect()))


def batch(spark, rows):
    return spark.createDataFrame(rows, "id int, v decimal(10,2)")


def test_replace_partition(spark, table, tmp_path):
    ensure_table(spark, table, PROFILE, str(tmp_path / "table"))
    ensure_table(spark, table, PROFILE, str(tmp_path / "table"))
    first, second = batch(spark, [(1, Decimal(1)), (2, None)]), batch(spark, [(3, Decimal(3))])
    replace_partition(first, table, "2024-01-01")
    replace_partition(second, table, "2024-01-02")
    once = content(spark, table)
    replace_partition(first, table, "2024-01-01")
    assert content(spark, table) == once, "a repeated load changes nothing"
    replace_partition(first.filter("false"), table, "2024-01-01")
    assert content(spark, table) == [(3, Decimal(3), "2024-01-02")], "an empty batch clears"
    with pytest.raises(ValueError, match="yyyy-MM-dd"):
        replace_partition(first, table, "2024-01-01' OR '1'='1")
    assert dict(spark.table(table).dtypes)["v"] == "decimal(10,2)"


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_an_empty_batch_clears_in_either_overwrite_mode(spark, table, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        ensure_table(spark, table, PROFILE, str(tmp_path / "table"))
        rows = batch(spark, [(1, Decimal(1))])
        replace_partition(rows, table, "2024-01-01")
        replace_partition(rows.filter("false"), table, "2024-01-01")
        assert content(spark, table) == []
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


BUCKETED = schemas.Profile(PROFILE.columns, sort_by="v", partition_by="process_date", distribute_by="id", buckets=4)


def bucket_files(path):
    """Bucket number and rows of each data file."""
    import pyarrow.parquet as pq

    return [(int(p.name.split("_")[1].split(".")[0]), pq.ParquetFile(p).read()) for p in path.rglob("*.parquet")]


def test_loads_keep_the_distribution_that_the_table_remembers(spark, table, tmp_path):
    ensure_table(spark, table, BUCKETED, str(tmp_path / "table"))
    assert table_layout(spark, table) == TableLayout("v", "id", 4)
    for day in ("2024-01-01", "2024-01-02"):
        rows = batch(spark, [(i % 50, Decimal(i * 7 % 100)) for i in range(400)]).repartition(6)
        replace_partition(rows, table, day)
    assert spark.table(table).count() == 800
    files = bucket_files(tmp_path / "table")
    homes = {}
    for bucket, rows in files:
        assert rows["v"].to_pylist() == sorted(rows["v"].to_pylist())
        for i in rows["id"].to_pylist():
            homes.setdefault(i, set()).add(bucket)
    assert len(homes) == 50 and all(len(b) == 1 for b in homes.values())
    assert len(files) <= 8, "more files than buckets per date"
    ensure_table(spark, table, BUCKETED)
    with pytest.raises(ValueError, match="distributed by id in 4"):
        ensure_table(spark, table, PROFILE)
    with pytest.raises(ValueError, match="number of buckets"):
        ensure_table(spark, table, schemas.Profile(PROFILE.columns, sort_by="v", distribute_by="id"))


def test_buckets_follow_the_rows(spark, monkeypatch):
    from workload.queries import REGISTRY

    few, many = spark.range(10), spark.range(1000)
    assert sinks.buckets_for(few, many, least=8) == 8
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 50)
    assert sinks.buckets_for(many, few, least=8) == 32 and sinks.buckets_for(few, least=3) == 3
    assert sinks.buckets_for(many.filter("false")) == 1
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 400)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = REGISTRY["bucketed_join"](spark, "/root/testdata/sf0.001")
        joined.collect()
        text = joined._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SelectedBucketsCount: 16 out of 16" in text and "Exchange" not in text


def crash_at(monkeypatch, spark, step):
    """The ``step``-th statement that changes the catalog or data, from 0, is not run, nor is any after it."""
    done, run = [], type(spark).sql

    def failing(self, query, *args, **kwargs):
        if query.split()[0] in ("CREATE", "INSERT", "ALTER", "REFRESH", "DROP"):
            done.append(query)
            if len(done) > step:
                raise RuntimeError("lost")
        return run(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    return done


@pytest.mark.parametrize("kept", [True, False])
def test_a_crash_between_any_steps_of_a_replacement_leaves_a_table(spark, table, tmp_path, monkeypatch, kept):
    profile = schemas.Profile(PROFILE.columns[:2], sort_by="id", distribute_by="id", buckets=2)
    location = str(tmp_path / "t") if kept else None
    before = [(1, Decimal(1))]
    replace_table(batch(spark, before), table, profile, location)
    steps, seen = 0, []
    while steps < 20:
        after = [(steps + 2, Decimal(2)), (steps + 3, None)]
        with monkeypatch.context() as patch:
            ran = crash_at(patch, spark, steps)
            try:
                replace_table(batch(spark, after), table, profile, location)
            except RuntimeError:
                pass
        found = content(spark, table)
        assert found in (before, after), ran[-1]
        seen.append(found == after)
        before = found
        if len(ran) <= steps:
            break
        steps += 1
    assert seen == sorted(seen) and seen[-1] and not seen[0] and 3 <= steps < 20
    assert table_layout(spark, table).buckets == 2


def test_replacing_by_another_layout_keeps_old_rows_until_the_new_have_the_name(spark, table, tmp_path, monkeypatch):
    profile = schemas.Profile(PROFILE.columns[:2], sort_by="id", distribute_by="id", buckets=2)
    replace_table(batch(spark, [(1, Decimal(1))]), table, profile)
    profile = schemas.Profile(PROFILE.columns[:2], sort_by="id", distribute_by="id", buckets=3)
    replace_table(batch(spark, [(2, Decimal(2))]), table, profile)
    assert content(spark, table) == [(2, Decimal(2))] and table_layout(spark, table).buckets == 3
    profile = schemas.Profile(PROFILE.columns[:2], sort_by="v")
    asked, run = [], type(spark).sql

    def failing(self, query, *args, **kwargs):
        asked.append(query)
        if "RENAME TO" in query and sum("RENAME TO" in q for q in asked) == 2:
            raise RuntimeError("lost")
        return run(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="lost"):
        replace_table(batch(spark, [(3, Decimal(3))]), table, profile)
    monkeypatch.undo()
    assert content(spark, table) == [(2, Decimal(2))]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]


def test_old_versions_of_a_table_go(spark, table, tmp_path):
    profile = schemas.Profile(PROFILE.columns[:2], sort_by="id")
    for i in range(4):
        replace_table(batch(spark, [(i, Decimal(i))]), table, profile, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").iterdir())) == 1 and content(spark, table) == [(3, Decimal(3))]


def test_the_verdict_is_counted_while_the_batch_is_staged(spark, table, tmp_path):
    """No job of its own reads the staged rows for the verdict, and an empty batch passes."""
    from starloom.plans.batch import stage_counted
    from starloom.operators.quality import gate_counts, gate_report, report_of

    rules = (Rule("few", "id", ">=", 7), NO_RULE)
    rows = batch(spark, [(i % 10, None) for i in range(1000)]).repartition(5)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "staging")
    staged, found = stage_counted(rows, "batch", gate_counts(rows, rules))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"n_rows": 1000, "broken_0": 300, "broken_1": 0}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 2
    assert report_of(spark, rules, found).collect() == gate_report(staged, rules).collect()
    for empty in (rows.filter("false"), batch(spark, [])):
        assert stage_counted(empty, "none", gate_counts(empty, rules))[1] == {"n_rows": 0, "broken_0": 0, "broken_1": 0}


def test_too_long_text_is_refused_on_write(spark, table, tmp_path):
    profile = schemas.Profile((("t", "varchar(3)"),), sort_by="t")
    ensure_table(spark, table, profile, str(tmp_path / "table"))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {table} VALUES ('four')")


def test_layout_sorts_and_splits_a_hot_key(spark):
    from pyspark.sql import functions as F

    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id"))
        df = spark.range(0, 300_000, 1, 8).select(key.alias("key"), F.md5(F.col("id").cast("string")))
        laid = layout(df, "key").withColumn("task", F.spark_partition_id())
        tasks = laid.filter("key = -1").select("task").distinct().count()
        assert tasks > 1, "the hot key is in one task"
        steps = laid.select("task", "key").rdd.mapPartitions(
            lambda rows: [all(a <= b for a, b in zip(k, k[1:])) for k in [[r["key"] for r in rows]]]
        )
        assert all(steps.collect()), "rows of a task are not sorted"
        assert laid.count() == 300_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def wide(spark):
    return tickets.tickets_wide(
        data.fact(spark), data.airlines(spark), data.airports(spark), "2024-01-01"
    ).filter("value IS NULL OR NOT isnan(value)")


def test_passing_batch_is_loaded(spark, table, tmp_path):
    passing = where_lt(wide(spark), "number_of_changes", 4)
    result = run_batch(
        passing, table, "2024-01-01", location=str(tmp_path / "t"), csv_dir=str(tmp_path / "csv")
    )
    assert result.passed and result.alerts.count() == 0
    loaded = spark.table(table)
    assert loaded.columns == schemas.STRING_PROFILE.names
    assert loaded.count() == passing.count() == 5
    assert read_csv(spark, result.csv_path, passing.schema).count() == 5
    assert dict(loaded.dtypes)["airport_latitude"] == "decimal(10,2)"


def test_failing_batch_changes_nothing(spark, table, tmp_path):
    where = str(tmp_path / "t")
    run_batch(where_lt(wide(spark), "number_of_changes", 4), table, "2024-01-01", location=where)
    before = sorted(map(str, spark.table(table).collect()))
    result = run_batch(wide(spark), table, "2024-01-01", location=where)
    assert not result.passed
    assert [tuple(r) for r in result.alerts.collect()] == [
        ("changes", "number_of_changes >= 4", 2)
    ]
    assert sorted(map(str, spark.table(table).collect())) == before


def test_failing_batch_makes_no_table(spark, table, tmp_path):
    assert not run_batch(wide(spark), table, "2024-01-01", location=str(tmp_path / "t")).passed
    assert not spark.catalog.tableExists(table)


def test_value_that_does_not_fit_leaves_the_table_alone(spark, table, tmp_path):
    def load(rows):
        df = with_batch_date(spark.createDataFrame(rows, "id int, v double"), "2024-01-01")
        where = str(tmp_path / "t")
        return run_batch(df, table, "2024-01-01", (NO_RULE,), PROFILE, location=where)

    load([(1, 1.0)])
    with pytest.raises(ValueError, match=r"v \(1 rows\)"):
        load([(1, 1e12), (2, 2.0)])
    assert content(spark, table) == [(1, Decimal(1), "2024-01-01")]


def test_sampled_batch_loads_the_sample(spark, table, tmp_path):
    passing = where_lt(wide(spark), "number_of_changes", 4)
    result = run_batch(
        passing, table, "2024-01-01", location=str(tmp_path / "t"), sample=Sample("found_at", 2)
    )
    loaded = spark.table(table)
    assert result.staged.count() == loaded.count()
    assert loaded.select("found_at").distinct().count() == 2


def test_profile_report_has_every_section(spark):
    fact = data.fact(spark)
    report = profile_report(fact, sample=Sample("found_at", 4), n=3)
    sizes = {name: len(df.collect()) for name, df in report.items()}
    assert sizes["overview"] == 1 and sizes["types"] == 9 and sizes["columns"] == 9
    assert sizes["quantiles"] == sizes["moments"] == 3
    assert sizes["text_lengths"] == 6
    assert sizes["pearson"] == sizes["spearman"] == 3
    assert {"head", "tail", "alerts", "duplicates", "missing_patterns", "nulls"} <= set(sizes)
    assert sizes["cramers_v"] >= 1 and sizes["histograms"] == 30
    assert {"uncategorised", "staged"} <= set(sizes)
    close_report(report)


def test_profile_report_takes_all_rows_of_any_table(spark):
    df = spark.range(20_000).withColumnRenamed("id", "n")
    report = profile_report(df)
    assert report["overview"].first()["n_rows"] == 20_000
    assert [r["alert"] for r in report["alerts"].collect()] == ["unique"]


def failing(df):
    """The rows of ``df`` and a task that fails when it is written."""
    from pyspark.sql import functions as F

    bad = F.when(F.col("id") == 2, F.raise_error(F.lit("a task fails"))).otherwise(F.col("v"))
    return df.withColumn("v", bad.cast("decimal(10,2)"))


def test_failed_job_leaves_the_old_rows(spark, table, tmp_path):
    ensure_table(spark, table, PROFILE, str(tmp_path / "table"))
    rows = [(i, Decimal(i)) for i in (1, 2, 3)]
    replace_partition(batch(spark, rows), table, "2024-01-01")
    before = content(spark, table)
    assert len(before) == 3
    with pytest.raises(Exception, match="a task fails"):
        replace_partition(failing(batch(spark, rows).repartition(3)), table, "2024-01-01")
    assert content(spark, table) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_foreign_columns_and_dates_are_refused(spark, table, tmp_path):
    from pyspark.sql import functions as F

    ensure_table(spark, table, PROFILE, str(tmp_path / "table"))
    rows = batch(spark, [(1, Decimal(1))])
    with pytest.raises(ValueError, match="no columns extra"):
        replace_partition(rows.withColumn("extra", F.lit(1)), table, "2024-01-01")
    for day in ("2024-01-02", None):
        with pytest.raises(ValueError, match="other dates"):
            replace_partition(rows.withColumn("process_date", F.lit(day).cast("string")), table, "2024-01-01")
    assert content(spark, table) == []


def test_date_is_checked_before_a_table_is_made(spark, table):
    with pytest.raises(ValueError, match="yyyy-MM-dd"):
        run_batch(wide(spark), table, "01.01.2024")
    assert not spark.catalog.tableExists(table)


def test_unpartitioned_profile_is_replaced_as_a_whole(spark, table, tmp_path):
    profile = schemas.Profile((("id", "int"), ("v", "decimal(10,2)")), sort_by="id")
    for location in (None, str(tmp_path / "t")):
        for rows in ([(1, Decimal(1)), (2, None)], [(3, Decimal(3))]):
            result = run_batch(batch(spark, rows), table, "2024-01-01", (NO_RULE,), profile, location)
            assert result.passed and content(spark, table) == rows
        with pytest.raises(Exception, match="a task fails"):
            replace_table(failing(batch(spark, [(2, Decimal(2))])), table, profile, location)
        assert content(spark, table) == [(3, Decimal(3))]
        spark.sql(f"DROP TABLE {table}")


def test_key_report_and_strict_keys(spark, table, tmp_path):
    inputs = data.fact(spark), data.airlines(spark), data.airports(spark)
    report = {r["dimension"]: r for r in tickets.key_report(*inputs).collect()}
    assert report["airlines"]["n_unmatched"] > 0 and report["airports"]["n_duplicate_keys"] == 0
    doubled = tickets.key_report(inputs[0], inputs[1].unionAll(inputs[1]), inputs[2])
    passing = where_lt(wide(spark), "number_of_changes", 4)
    with pytest.raises(ValueError, match="duplicate keys in airlines"):
        run_batch(passing, table, "2024-01-01", keys=doubled, strict=True)
    result = run_batch(passing, table, "2024-01-01", location=str(tmp_path / "t"), keys=doubled)
    assert result.keys.filter("dimension = 'airlines'").first()["n_duplicate_keys"] == 2


def test_staged_files_are_removed(spark, table, tmp_path):
    import os

    passing = where_lt(wide(spark), "number_of_changes", 4)
    result = run_batch(passing, table, "2024-01-01", location=str(tmp_path / "t"), sample=Sample("found_at", 2))
    folder = result.staged.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder)
    result.close()
    assert not os.path.exists(folder) and spark.table(table).count() > 0
