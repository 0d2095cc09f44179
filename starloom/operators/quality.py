"""Quality gate: rules on columns, their verdicts, the rows that break them."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions.columns import present
from starloom.operators.stats import rows_of

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    "!=": operator.ne,
}


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule if ``column op bound`` is true; null and NaN, which counts as missing
    here, break nothing."""

    name: str
    column: str
    op: str
    bound: float

    @property
    def message(self) -> str:
        return f"{self.column} {self.op} {self.bound}"

    def broken(self, df: DataFrame) -> Column:
        return _COMPARE[self.op](present(df, self.column), F.lit(self.bound))


class GateError(Exception):
    """The data breaks a rule; ``sample`` holds a few of the rows."""

    def __init__(self, message: str, n_violations: int, sample: list):
        super().__init__(message)
        self.n_violations = n_violations
        self.sample = sample


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break a rule with a ``message``, one row per broken rule."""
    broken = df.filter(reduce(operator.or_, [r.broken(df) for r in rules]))
    messages = F.array_compact(F.array(*[F.when(r.broken(df), r.message) for r in rules]))
    return broken.withColumn("message", F.explode(messages))


def gate_counts(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    """The aggregates that a verdict needs: ``n_rows``, and per rule ``broken_<place>``."""
    broken = [F.count_if(r.broken(df)).alias(f"broken_{i}") for i, r in enumerate(rules)]
    return [F.count("*").alias("n_rows"), *broken]


def report_of(spark: SparkSession, rules: Sequence[Rule], counts: Mapping[str, int]) -> DataFrame:
    """The gate report from counts that are known already."""
    rows = [
        (r.name, r.message, counts["n_rows"], counts[f"broken_{i}"], counts[f"broken_{i}"] == 0)
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


REPORT_SCHEMA = "rule string, message string, n_rows long, n_violations long, passed boolean"


def gate_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row (rule, message, n_rows, n_violations, passed) per rule, all from one pass."""
    return rows_of(
        df,
        [
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.message).alias("message"),
                F.count("*").alias("n_rows"),
                F.count_if(r.broken(df)).alias("n_violations"),
                (F.count_if(r.broken(df)) == 0).alias("passed"),
            )
            for r in rules
        ],
    )


def alert_rows(report: DataFrame) -> DataFrame:
    """What to tell about a failed gate: the broken rules of a gate report."""
    return report.filter(~F.col("passed")).select("rule", "message", "n_violations")


def assert_threshold(df: DataFrame, rule: Rule, sample: int = 5) -> None:
    """Raise ``GateError`` with the count and a few rows if any row breaks the rule."""
    verdict = gate_report(df, [rule]).first()
    if not verdict["passed"]:
        n = verdict["n_violations"]
        rows = df.filter(rule.broken(df)).limit(sample).collect()
        raise GateError(f"{n} of {verdict['n_rows']} rows with {rule.message}", n, rows)
