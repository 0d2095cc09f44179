from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


class StepError(Exception):
    """A statement failed; the cause is chained."""


# A quoted text or name (a backslash escapes in texts), a comment, or a semicolon.
_TOKEN = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;""", re.DOTALL)


def split_statements(text: str) -> list[str]:
    """The statements of a text, cut at semicolons outside quotes and comments; empty ones left out."""
    cuts = [m.start() for m in _TOKEN.finditer(text) if m[0] == ";"]
    parts = [text[a + 1 : b].strip() for a, b in zip([-1, *cuts], [*cuts, len(text)])]
    return [p for p in parts if _TOKEN.sub(lambda m: "" if m[0][:2] in ("--", "/*") else m[0], p).strip()]


def sql_steps(spark: SparkSession, statements: str | Sequence[str]) -> DataFrame:
    """Run Spark SQL statements in order and return the last result.

    A text may hold several statements, each but the last ending in a semicolon. Stops at the
    first statement that fails.
    """
    steps = split_statements(statements) if isinstance(statements, str) else list(statements)
    if not steps:
        raise ValueError("no statement given")
    for number, statement in enumerate(steps, 1):
        try:
            result = spark.sql(statement)
        except Exception as cause:
            raise StepError(f"statement {number} of {len(steps)} failed: {cause}") from cause
    return result
