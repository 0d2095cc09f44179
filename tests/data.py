"""Small inputs of the ticket model that hold every special case."""

import json

from starloom import schemas

FACT_ROWS = [
    # search_date, found_at, depart_date, number_of_changes, trip_class, value, origin, dest, airline
    ("2022-01-01", "2022-01-02 10:00:00", "2022-03-01", 0.0, 0.0, 14999.99, "MOW", "LED", "SU"),
    # twice the same, and once more with another trip class
    ("2022-01-01", "2022-01-02 10:00:00", "2022-03-01", 0.0, 0.0, 15000.0, "MOW", "LED", "SU"),
    ("2022-01-01", "2022-01-02 10:00:00", "2022-03-01", 0.0, 0.0, 15000.0, "MOW", "LED", "SU"),
    ("2022-01-01", "2022-01-02 10:00:00", "2022-03-01", 0.0, 1.0, 15000.0, "MOW", "LED", "SU"),
    ("2022-01-01", "2022-01-03 10:00:00", "2022-03-01", 3.0, 0.0, 100000.0, "MOW", "OVB", "S7"),
    ("2022-01-01", "2022-01-04 10:00:00", "2022-03-01", 4.0, 0.0, 100000.01, "MOW", "OVB", "S7"),
    ("2022-01-01", "2022-01-05 10:00:00", "2022-03-01", 5.0, 0.0, None, "MOW", "OVB", "S7"),
    ("2022-01-01", "2022-01-06 10:00:00", "2022-03-01", None, 0.0, float("nan"), "MOW", "LED", "SU"),
    ("2022-01-01", None, "2022-03-01", 1.0, 0.0, 20000.0, "MOW", "LED", "SU"),
    ("2022-01-01", "2022-01-07 10:00:00", "2022-03-01", 1.0, 0.0, 20000.0, "MOW", "ТАУ", "SU"),
    ("2022-01-01", "2022-01-07 10:00:00", "2022-03-01", 1.0, 0.0, 30000.0, "MOW", "LED", "??"),
    ("2022-01-01", "2022-01-07 10:00:00", "2022-03-01", 1.0, 0.0, 40000.0, "MOW", "???", "SU"),
    ("2022-01-01", "2022-01-07 10:00:00", "2022-03-01", 1.0, 0.0, 50000.0, "LED", "OVB", "SU"),
]
AIRPORT_ROWS = [
    ("LED", "Пулково", ("Pulkovo",), (59.8, 30.26), "LED", "RU", "Europe/Moscow", "airport", True),
    ("OVB", None, ("Tolmachevo's",), None, "OVB", "RU", "Asia/Novosibirsk", "airport", True),
    ("ТАУ", "Тау", (None,), (1.005, 2.0), "TAU", "RU", "Asia/Omsk", "railway", False),
]
AIRLINE_ROWS = [("SU", "Аэрофлот", ("Aeroflot",)), ("S7", None, ("S7 'Siberia'",))]


def fact(spark, rows=FACT_ROWS):
    return spark.createDataFrame(rows, schemas.FACT)


def airports(spark):
    return spark.createDataFrame(AIRPORT_ROWS, schemas.AIRPORTS)


def airlines(spark):
    return spark.createDataFrame(AIRLINE_ROWS, schemas.AIRLINES)


def airline_objects():
    return [
        {"code": code, "name": name, "name_translations": {"en": en[0]}}
        for code, name, en in AIRLINE_ROWS
    ]


def write_json(folder, layout):
    """The airlines in one of the layouts that JSON files come in."""
    objects = airline_objects()
    text = {
        "one_line": json.dumps(objects, ensure_ascii=False),
        "indented": json.dumps(objects, ensure_ascii=False, indent=2),
        "lines": "\n".join(json.dumps(o, ensure_ascii=False) for o in objects),
    }[layout]
    path = folder / f"{layout}.json"
    path.write_text(text, encoding="utf-8")
    return str(path)
