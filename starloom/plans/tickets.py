"""The two wide tables of the ticket model: facts joined to airlines and airports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.columns import Band
from starloom.operators.dedupe import dedupe, duplicate_report
from starloom.operators.joins import DimSpec, denormalise, join_audit
from starloom.operators.shape import (
    band,
    cast_columns,
    drop,
    drop_nulls,
    flatten_struct,
    project,
    replace_literals,
    where_eq,
    where_lt,
    with_batch_date,
)
from starloom.operators.stats import describe_columns, null_counts, shape, value_counts
from starloom.schemas import STRING_PROFILE, TYPED_PROFILE

# The price classes, and what is replaced in which column.
PRICE_BANDS = (Band("A", gt=100000), Band("B", ge=15000, le=100000))
CHEAPEST = "C"
CLEANING_RULES = (
    ("found_at", "-", "/"),
    ("airport_name", "'", " "),
    ("airline_name_translations", "'", " "),
    # Three Cyrillic letters; in the replacement the last one is a Latin Y.
    ("destination", "ТАУ", "ТАY"),
)
EXPLORE_RULES = (("time_zone", "/", "-"),)
# Fixed value: the columns whose frequencies are looked at first.
FREQUENCY_COLUMNS = ("trip_class", "origin", "number_of_changes", "destination", "airline")


def airline_spec(airlines: DataFrame) -> DimSpec:
    return DimSpec(
        flatten_struct(airlines),
        fact_key="airline",
        dim_key="code",
        columns={"code": "airline_code", "name_translations.en": "airline_name_translations"},
    )


def airport_spec(airports: DataFrame, native_names: bool = False) -> DimSpec:
    """``native_names`` keeps both names, as the exploratory table does; else the English one is
    the ``airport_name``."""
    if native_names:
        names = {"name": "airport_name", "name_translations.en": "airport_name_translations"}
    else:
        names = {"name_translations.en": "airport_name"}
    same = ("country_code", "time_zone", "flightable", "iata_type")
    return DimSpec(
        flatten_struct(airports),
        fact_key="destination",
        dim_key="code",
        columns={
            **names,
            "coordinates.lat": "airport_latitude",
            "coordinates.lon": "airport_longitude",
            **{c: c for c in same},
        },
    )


def key_report(fact: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Rows (dimension, n_unmatched, n_duplicate_keys): facts that find no dimension row, and
    dimension keys that would multiply facts. One shuffle of counts by key per dimension."""
    rows = []
    for name, spec in (("airlines", airline_spec(airlines)), ("airports", airport_spec(airports))):
        rows.append(
            join_audit(fact, spec).agg(
                F.lit(name).alias("dimension"),
                F.coalesce(F.sum("n_lost"), F.lit(0)).alias("n_unmatched"),
                F.count_if(F.col("n_dimension") > 1).alias("n_duplicate_keys"),
            )
        )
    return rows[0].unionByName(rows[1])


def tickets_wide(
    fact: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    process_date: str,
    origin: str = "MOW",
) -> DataFrame:
    """The production table: 18 columns, dates as text.

    Facts equal in all but ``trip_class`` count once. The filter on the origin stands last and
    Catalyst takes it below the joins and the deduplication into the scan.
    """
    facts = flatten_struct(fact)
    facts = cast_columns(facts, {"number_of_changes": "int"})
    facts = dedupe(drop(facts, "trip_class"))
    wide = denormalise(facts, [airline_spec(airlines), airport_spec(airports)])
    wide = band(wide, "value", "class", PRICE_BANDS, CHEAPEST)
    wide = replace_literals(wide, CLEANING_RULES)
    wide = where_eq(wide, "origin", origin)
    wide = with_batch_date(wide, process_date)
    return project(wide, STRING_PROFILE)


def _typed_facts(fact: DataFrame) -> DataFrame:
    return cast_columns(
        flatten_struct(fact),
        {
            "search_date": "date",
            "depart_date": "date",
            "found_at": "timestamp",
            "number_of_changes": "int",
        },
    )


def joined_explore(fact: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Typed facts with both dimensions, before any row is removed by a rule."""
    facts = drop(_typed_facts(fact), "trip_class")
    specs = [airline_spec(airlines), airport_spec(airports, native_names=True)]
    return drop(denormalise(facts, specs), "airline")


def tickets_explore(
    fact: DataFrame, airlines: DataFrame, airports: DataFrame, max_changes: int = 5
) -> DataFrame:
    """The exploratory table: 18 columns, dates typed, no deduplication, rows without a native
    airport name removed, fewer than ``max_changes`` changes."""
    wide = drop_nulls(joined_explore(fact, airlines, airports), "airport_name")
    wide = band(wide, "value", "class", PRICE_BANDS, CHEAPEST)
    wide = replace_literals(wide, EXPLORE_RULES)
    wide = where_lt(wide, "number_of_changes", max_changes)
    return project(wide, TYPED_PROFILE)


def explore_reports(
    fact: DataFrame, airlines: DataFrame, airports: DataFrame
) -> dict[str, DataFrame]:
    """The checks made on the way to the exploratory table, each one lazy job."""
    facts = _typed_facts(fact)
    used = drop(facts, "trip_class")
    wide = joined_explore(fact, airlines, airports)
    named = drop_nulls(wide, "airport_name")
    return {
        "fact_shape": shape(facts),
        "fact_frequencies": value_counts(facts, FREQUENCY_COLUMNS),
        "fact_nulls": null_counts(used),
        "fact_duplicates": duplicate_report(used),
        "airport_shape": shape(flatten_struct(airports)),
        "airport_nulls": null_counts(flatten_struct(airports)),
        "airline_shape": shape(flatten_struct(airlines)),
        "airline_nulls": null_counts(flatten_struct(airlines)),
        "wide_shape": shape(wide),
        "wide_nulls": null_counts(wide),
        "named_shape": shape(named),
        "named_description": describe_columns(named),
    }
