"""One batch: stage, check, then replace the batch date in the target table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation

from starloom.operators.quality import Rule, alert_rows, gate_counts, report_of
from starloom.operators.sampling import sample_by_key
from starloom.operators.shape import conform, failed_casts
from starloom.schemas import Profile, STRING_PROFILE
from starloom.session import drop_scratch, scratch_path
from starloom.sinks import (
    check_date,
    ensure_table,
    layout,
    replace_partition,
    replace_table,
    write_csv,
)

# Fixed value: a batch fails if any ticket has this many changes.
CHANGES_RULE = Rule("changes", "number_of_changes", ">=", 4)


@dataclass(frozen=True)
class Sample:
    """Keep all rows of ``k`` values of ``key``."""

    key: str
    k: int
    seed: int = 0


# Sample sizes before the load and before profiling.
LOAD_SAMPLE = Sample("found_at", 1000)
PROFILE_SAMPLE = Sample("found_at", 10000)


@dataclass(frozen=True)
class BatchResult:
    """What happened. ``staged`` are the rows that were judged; ``close`` removes their files.
    ``keys`` is the report on unmatched and duplicate keys, if one was given."""

    passed: bool
    report: DataFrame
    alerts: DataFrame
    staged: DataFrame
    csv_path: str | None
    keys: DataFrame | None = None

    def close(self) -> None:
        unstage(self.staged)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared scratch folder and read it back.

    Later steps all see the same rows, nothing upstream runs again, and a lost executor costs a
    re-read rather than a recomputation. ``unstage`` removes the files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, label: str, counts: Sequence[Column]) -> tuple[DataFrame, dict[str, int]]:
    """Stage a table and observe aggregates of its rows while they are written.

    The observation stands directly below the write, so its task results count once however often
    a task is retried. Spark plans an input known to be empty without it; then the few rows that
    were staged, none, are counted.
    """
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    staged = stage(df.observe(seen, *counts), label)
    found = seen.get
    return staged, found if found else staged.agg(*counts).first().asDict()


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged table."""
    drop_scratch(df.sparkSession, *{file.rpartition("/")[0] for file in df.inputFiles()})


def run_batch(
    df: DataFrame,
    table: str,
    process_date: str,
    rules: Sequence[Rule] = (CHANGES_RULE,),
    profile: Profile = STRING_PROFILE,
    location: str | None = None,
    sample: Sample | None = None,
    csv_dir: str | None = None,
    keys: DataFrame | None = None,
    strict: bool = False,
) -> BatchResult:
    """Load the batch if it passes the rules, else change nothing and return alerts.

    The batch is staged once, sampled from there if asked, and staged again, so the verdict is
    about the rows that get loaded and a failure upstream happens before the table is touched.
    What the rules and the table's types need is counted while the rows are staged, so the verdict
    reads nothing. Values that do not fit the table's types raise before it is touched, too. A profile without a partition
    column replaces its whole table. Only verdicts, one row per rule and column, come to the
    driver. ``keys`` is a report as of ``plans.tickets.key_report``; with ``strict`` duplicate
    dimension keys raise.
    """
    check_date(process_date)
    spark = df.sparkSession
    if keys is not None:
        audited = keys.collect()
        doubled = [row["dimension"] for row in audited if row["n_duplicate_keys"]]
        if strict and doubled:
            raise ValueError(f"duplicate keys in {', '.join(doubled)} multiply facts")
        keys = spark.createDataFrame(audited, keys.schema)
    misfits = [failed_casts(df, c, t).alias(f"misfit_{c}") for c, t in profile.columns if c in df.columns]
    counts = [*gate_counts(df, rules), *misfits]
    if sample:
        whole = stage(df, "batch")
        drawn = sample_by_key(whole, sample.key, sample.k, sample.seed)
        staged, found = stage_counted(drawn, "sample", counts)
        unstage(whole)
    else:
        staged, found = stage_counted(df, "batch", counts)
    csv_path = write_csv(staged, csv_dir, process_date) if csv_dir else None
    report = report_of(spark, rules, found)
    passed = not any(found[f"broken_{i}"] for i in range(len(rules)))
    if passed:
        _check_types(found, profile)
        batch = layout(conform(staged, profile), profile.sort_by)
        if profile.partition_by:
            ensure_table(spark, table, profile, location)
            replace_partition(batch, table, process_date, profile.partition_by)
        else:
            replace_table(batch, table, profile, location)
    return BatchResult(passed, report, alert_rows(report), staged, csv_path, keys)


def _check_types(found: dict[str, int], profile: Profile) -> None:
    failed = [(c, found.get(f"misfit_{c}", 0)) for c, _ in profile.columns]
    if any(n for _, n in failed):
        told = ", ".join(f"{c} ({n} rows)" for c, n in failed if n)
        raise ValueError(f"values do not fit the table's types: {told}")
