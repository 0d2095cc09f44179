"""Input schemas and the two output profiles of the ticket model."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the three inputs, as DDL for a reader's schema.
FACT = (
    "search_date string, found_at string, depart_date string, number_of_changes double, "
    "trip_class double, value double, origin string, destination string, airline string"
)
AIRPORTS = (
    "code string, name string, name_translations struct<en: string>, "
    "coordinates struct<lat: double, lon: double>, city_code string, country_code string, "
    "time_zone string, iata_type string, flightable boolean"
)
AIRLINES = "code string, name string, name_translations struct<en: string>"


@dataclass(frozen=True)
class Profile:
    """Ordered output columns with declared types, and how the table is laid out.

    With ``distribute_by`` the table keeps its rows in ``buckets`` by that column's hash.
    """

    columns: tuple[tuple[str, str], ...]
    sort_by: str
    partition_by: str | None = None
    distribute_by: str | None = None
    buckets: int = 0

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


# The 18 columns of the production table, dates and times kept as text.
STRING_PROFILE = Profile(
    columns=(
        ("found_at", "varchar(50)"),
        ("class", "varchar(5)"),
        ("value", "decimal(10,2)"),
        ("number_of_changes", "int"),
        ("depart_date", "varchar(12)"),
        ("search_date", "varchar(12)"),
        ("airline_code", "varchar(12)"),
        ("airline_name_translations", "varchar(100)"),
        ("origin", "varchar(12)"),
        ("destination", "varchar(12)"),
        ("country_code", "varchar(12)"),
        ("time_zone", "varchar(50)"),
        ("flightable", "boolean"),
        ("iata_type", "varchar(12)"),
        ("airport_name", "varchar(50)"),
        ("airport_latitude", "decimal(10,2)"),
        ("airport_longitude", "decimal(10,2)"),
        ("process_date", "varchar(12)"),
    ),
    sort_by="found_at",
    partition_by="process_date",
)

# The 18 columns of the exploratory table, dates and times typed. Here
# airport_name is the native name; in the production table it is the English one.
TYPED_PROFILE = Profile(
    columns=(
        ("found_at", "timestamp"),
        ("class", "varchar(5)"),
        ("value", "decimal(10,2)"),
        ("number_of_changes", "int"),
        ("depart_date", "date"),
        ("search_date", "date"),
        ("airline_code", "varchar(12)"),
        ("airline_name_translations", "varchar(100)"),
        ("origin", "varchar(12)"),
        ("destination", "varchar(12)"),
        ("country_code", "varchar(12)"),
        ("time_zone", "varchar(50)"),
        ("flightable", "boolean"),
        ("iata_type", "varchar(12)"),
        ("airport_name", "varchar(50)"),
        ("airport_name_translations", "varchar(100)"),
        ("airport_latitude", "decimal(10,2)"),
        ("airport_longitude", "decimal(10,2)"),
    ),
    sort_by="found_at",
)
