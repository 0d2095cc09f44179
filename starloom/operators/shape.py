"""Projections, casts, filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.columns import Band, band_expr, col, replace_expr
from starloom.schemas import Profile


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Turn nested objects into ``parent.child`` columns; arrays stay as they are."""

    def leaves(value: Column, name: str, data_type: T.DataType):
        if not isinstance(data_type, T.StructType):
            yield value.alias(name), name
            return
        for field in data_type.fields:
            yield from leaves(value.getField(field.name), name + sep + field.name, field.dataType)

    if not any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        return df
    pairs = [leaf for f in df.schema.fields for leaf in leaves(col(f.name), f.name, f.dataType)]
    names = [name for _, name in pairs]
    if len(set(names)) < len(names):
        raise ValueError(f"flattened names clash: {sorted(n for n in names if names.count(n) > 1)}")
    return df.select(*[c for c, _ in pairs])


def replace_literals(df: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Apply ``(column, old, new)`` substring rules in order."""
    per_column: dict[str, list[tuple[str, str]]] = {}
    for column, old, new in rules:
        per_column.setdefault(column, []).append((old, new))
    return df.withColumns({c: replace_expr(col(c), pairs) for c, pairs in per_column.items()})


def _checked(value: Column, cast: Column, name: str, wanted: str, strict: bool) -> Column:
    if not strict:
        return cast
    message = F.concat(
        F.lit(f"column {name} does not fit {wanted}: "), F.substring(value.cast("string"), 1, 100)
    )
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message)).otherwise(cast)


# Widths in bits of the integer types.
_INTEGERS = {"tinyint": 8, "smallint": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64}


def _may_fit(value: Column, source: T.DataType, target: str) -> Column | None:
    """A cheap test that every castable value passes, or None.

    A failing ``try_cast`` raises and catches an exception inside the task, about a hundred
    times the cost of a good cast; with this, dirty data costs little more than clean data.
    """
    if isinstance(source, T.NumericType):
        number = value.cast("double")
        if target in _INTEGERS:
            end = 2.0 ** (_INTEGERS[target] - 1)
            return (number >= -end - 1) & (number <= end)
        decimal = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", target)
        if decimal:
            return F.abs(number) <= 10.0 ** (int(decimal[1]) - int(decimal[2]))
    if isinstance(source, T.StringType):
        if target in _INTEGERS:
            return value.rlike(r"^[^0-9A-Za-z+-]*[+-]?[0-9]+[^0-9A-Za-z]*$")
        if target in ("double", "float"):
            return value.rlike(r"[0-9]|[Nn][Aa][Nn]|[Ii][Nn][Ff]")
        if target == "boolean":
            return value.rlike(r"^[^0-9A-Za-z]*[TtYyFfNn01][A-Za-z]{0,4}[^0-9A-Za-z]*$")
    return None


def _fit(df: DataFrame, name: str, ddl: str) -> Column:
    """The value in the declared type, null where it does not fit."""
    value, target = col(name), ddl.lower().strip()
    bounded = re.fullmatch(r"varchar\((\d+)\)", target)
    if bounded:
        text = value.cast("string")
        return F.when(F.char_length(text) <= int(bounded[1]), text)
    fits = value.try_cast(target)
    test = _may_fit(value, df.schema[name].dataType, target)
    return fits if test is None else F.when(test, fits)


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns. What does not convert becomes null, or raises if ``strict``.

    Both hold whatever the session's ANSI setting.
    """
    return df.withColumns(
        {c: _checked(col(c), _fit(df, c, t), c, t, strict) for c, t in types.items()}
    )


def failed_casts(df: DataFrame, column: str, target: str) -> Column:
    """The number of values present before the cast and null after it, as an aggregate."""
    return F.count_if(col(column).isNotNull() & _fit(df, column, target).isNull())


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows (column, n_failed): values present before the cast and null after it. One pass."""
    counts = [
        F.struct(F.lit(c).alias("column"), failed_casts(df, c, t).alias("n_failed"))
        for c, t in types.items()
    ]
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def conform(df: DataFrame, profile: Profile, strict: bool = True) -> DataFrame:
    """The profile's columns in order and in their declared types.

    A value that does not fit (decimal overflow, text longer than its bound) raises if
    ``strict``, else becomes null; ``cast_failures`` counts those.
    """
    return df.select(
        *[_checked(col(c), _fit(df, c, t), c, t, strict).alias(c) for c, t in profile.columns]
    )


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that hold dots are taken as they are."""
    return df.withColumnsRenamed(dict(mapping))


def project(df: DataFrame, profile: Profile | Sequence[str]) -> DataFrame:
    """Exactly the given columns, in that order."""
    names = profile.names if isinstance(profile, Profile) else profile
    return df.select(*[col(n) for n in names])


def band(df: DataFrame, column: str, out: str, bands: Sequence[Band], default: str) -> DataFrame:
    """Add the label of the first band that the value falls into."""
    return df.withColumn(out, band_expr(col(column), bands, default))


def with_batch_date(df: DataFrame, process_date: str, out: str = "process_date") -> DataFrame:
    return df.withColumn(out, F.lit(process_date))


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(col(column) == F.lit(value))


def where_lt(df: DataFrame, column: str, bound) -> DataFrame:
    return df.filter(col(column) < F.lit(bound))


def drop_nulls(df: DataFrame, subset: str | Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is null (or NaN)."""
    names = [subset] if isinstance(subset, str) else list(subset)
    return df.na.drop(subset=names)
