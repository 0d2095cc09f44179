from datetime import datetime
from decimal import Decimal

import data
import pytest

from starloom import schemas
from starloom.operators.shape import flatten_struct
from starloom.operators.sql import StepError, split_statements, sql_steps
from starloom.session import scratch_path
from starloom.sinks import jdbc_write_options, write_csv
from starloom.sources import (
    corrupt_records,
    jdbc_read_options,
    parse_failures,
    parse_json_col,
    read_csv,
    read_json,
)


@pytest.mark.parametrize("layout", ["one_line", "indented", "lines"])
def test_json_layouts_give_the_same_table(spark, tmp_path, layout):
    path = data.write_json(tmp_path, layout)
    back = read_json(spark, path, schemas.AIRLINES, multiline=layout != "lines")
    flat = flatten_struct(back)
    assert flat.columns == ["code", "name", "name_translations.en"]
    assert sorted(map(tuple, flat.collect())) == [
        ("S7", None, "S7 'Siberia'"),
        ("SU", "Аэрофлот", "Aeroflot"),
    ]


def test_json_without_schema_is_inferred(spark, tmp_path):
    back = read_json(spark, data.write_json(tmp_path, "indented"), multiline=True)
    assert set(flatten_struct(back).columns) == {"code", "name", "name_translations.en"}


def test_many_json_files_are_one_table(spark, tmp_path):
    for layout in ("one_line", "indented"):
        data.write_json(tmp_path, layout)
    assert read_json(spark, str(tmp_path), schemas.AIRLINES, multiline=True).count() == 4


def test_no_mode_loses_records(spark, tmp_path):
    """Either layout in either mode gives all records or an error."""
    one_line = read_json(spark, data.write_json(tmp_path, "one_line"), schemas.AIRLINES)
    assert len(one_line.collect()) == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, data.write_json(tmp_path, "indented"), schemas.AIRLINES).collect()
    with pytest.raises(Exception, match="not one JSON array"):
        read_json(spark, data.write_json(tmp_path, "lines"), schemas.AIRLINES, multiline=True).collect()


def test_bad_json_raises_or_is_counted(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"code": "A", "n": 1}\n{"code": "B", \n{"code": "C", "n": "abc"}\n')
    schema = "code string, n int"
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, str(path), schema).collect()
    kept = read_json(spark, str(path), schema, permissive=True)
    assert kept.count() == 3 and corrupt_records(kept).first() == (3, 2)
    assert sum(row["_corrupt_record"] is None for row in kept.collect()) == 1
    truncated = tmp_path / "array.json"
    truncated.write_text('[\n  {"code": "A", "n": 1},\n  {"code": "B"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, str(truncated), schema, multiline=True).collect()
    with pytest.raises(ValueError, match="schema"):
        read_json(spark, str(path), permissive=True)


def test_parse_failures_are_counted_or_raise(spark):
    rows = [('{"k": 7}',), ("not json",), (None,), ('{"k": "abc"}',), ("{}",)]
    df = spark.createDataFrame(rows, "props string")
    assert parse_failures(df, "props", "k int").first() == ("props", 2)
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_json_col(df, "props", "k int", strict=True).collect()


def test_parse_json_col_keeps_bad_text_as_null(spark):
    df = spark.createDataFrame([('{"k": 7}',), ("not json",), (None,)], "props string")
    rows = flatten_struct(parse_json_col(df, "props", "k int")).collect()
    assert [r[0] for r in rows] == [7, None, None]


def test_csv_keeps_null_empty_quotes_na_and_microseconds(spark, tmp_path):
    schema = "id int, t string, d decimal(10,2), ts timestamp, n timestamp_ntz, b boolean"
    moment = datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [
        (1, None, None, None, None, None),
        (2, "", Decimal("1.50"), moment, moment, True),
        (3, 'a "quoted", text', Decimal("-0.01"), moment, moment, False),
        (4, "NA", Decimal("0.00"), moment, moment, True),
        (5, "back\\slash", Decimal("0.00"), moment, moment, True),
    ]
    df = spark.createDataFrame(rows, schema)
    path = write_csv(df, str(tmp_path), "2024-01-01", "tickets")
    assert path.endswith("/tickets_2024-01-01")
    assert sorted(map(tuple, read_csv(spark, path, schema).collect())) == rows
    assert write_csv(df.limit(1), str(tmp_path), "2024-01-01", "tickets") == path
    assert read_csv(spark, path, schema).count() == 1


@pytest.mark.parametrize("text", ["two\nlines", "\r\n", "\\n", "\\", "\\\n\\\\n", "\\N", "\\\\\r", "a\\rb", "\n"])
def test_csv_keeps_line_breaks_and_backslashes(spark, tmp_path, text):
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    path = write_csv(df, str(tmp_path), "2024-01-01")
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == [(1, text), (2, None), (3, "")]


def test_csv_rows_that_do_not_fit_raise(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,t\n1,a\nx,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path), "id int, t string").collect()


def test_jdbc_options():
    read = jdbc_read_options(
        "jdbc:x", "select * from s.t", "d.Driver", ("id", 0, 1000, 16), user="me"
    )
    assert read["dbtable"] == "(select * from s.t) tmp_table"
    assert read["numPartitions"] == "16" and read["partitionColumn"] == "id"
    assert read["lowerBound"] == "0" and read["upperBound"] == "1000"
    assert read["driver"] == "d.Driver" and read["user"] == "me"
    write = jdbc_write_options("jdbc:x", "s.t", column_types="v DECIMAL(10,2)", partitions=8)
    assert write["dbtable"] == "s.t" and write["truncate"] == "true"
    assert write["createTableColumnTypes"] == "v DECIMAL(10,2)" and write["numPartitions"] == "8"
    assert jdbc_write_options("jdbc:x", "t", truncate=False)["truncate"] == "false"


def test_sql_text_of_several_statements(spark):
    text = "-- first; not last\nCREATE OR REPLACE TEMP VIEW q AS SELECT 'a;b\\\\'' AS `x;y`;\n/* ; */ SELECT `x;y` FROM q;\n"
    assert len(split_statements(text)) == 2
    assert split_statements("SELECT 1; ;\n-- nothing\n") == ["SELECT 1"]
    assert sql_steps(spark, "SELECT 1 AS a;\nSELECT 2 AS b;").first()["b"] == 2


def test_sql_steps_stop_at_the_first_error_and_keep_its_cause(spark):
    steps = ["CREATE OR REPLACE TEMP VIEW one AS SELECT 1 AS x", "SELECT x + 1 AS y FROM one"]
    assert sql_steps(spark, steps).first()["y"] == 2
    assert sql_steps(spark, "SELECT 3 AS z").first()["z"] == 3
    broken = ["SELECT 1", "SELECT * FROM no_such_table",
              "CREATE OR REPLACE TEMP VIEW never_made AS SELECT 1"]
    with pytest.raises(StepError, match="statement 2 of 3") as error:
        sql_steps(spark, broken)
    assert error.value.__cause__ is not None
    assert not spark.catalog.tableExists("never_made")


def test_scratch_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root.rstrip("/") + "/x-")
