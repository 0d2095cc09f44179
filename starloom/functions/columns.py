from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


def col(name: str) -> Column:
    """The column with exactly this name, even if the name holds dots or backquotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(
        df.schema[name].dataType, T.DecimalType
    )


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = col(name)
    return c.isNull() | F.isnan(c) if is_floating(df, name) else c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value, with NaN turned into null so that statistics skip it."""
    c = col(name)
    return F.when(~F.isnan(c), c) if is_floating(df, name) else c


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def replace_expr(value: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after the other; null stays null."""
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


@dataclass(frozen=True)
class Band:
    """A label for the values that satisfy every given bound."""

    label: str
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None

    def holds(self, value: Column) -> Column:
        tests = [
            *([value > self.gt] if self.gt is not None else []),
            *([value >= self.ge] if self.ge is not None else []),
            *([value < self.lt] if self.lt is not None else []),
            *([value <= self.le] if self.le is not None else []),
        ]
        if not tests:
            raise ValueError(f"band {self.label!r} has no bound")
        result = tests[0]
        for test in tests[1:]:
            result = result & test
        return result


def band_expr(value: Column, bands: Sequence[Band], default: str) -> Column:
    """The label of the first band that holds; ``default`` otherwise, also for null."""
    result = F.when(bands[0].holds(value), bands[0].label)
    for b in bands[1:]:
        result = result.when(b.holds(value), b.label)
    return result.otherwise(default)
