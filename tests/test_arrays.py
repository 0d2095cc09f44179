"""JSON arrays in many splits: equal rows, broken files, what the plan reads."""

import json
import random

import pytest

from starloom.sources import corrupt_records, read_json
from starloom.sources.arrays import _summed, _then

SCHEMA = "id long, text string, more struct<a:array<struct<b:int>>,c:string>"
#: The least that Spark splits.
TINY = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "100"}


@pytest.fixture
def tiny_splits(spark):
    before = {k: spark.conf.get(k) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def objects(n, seed=1):
    random.seed(seed)
    odd = ["}", "{", "[", "]", ",", '"', "\\", '\\"', "}]", "é", "\n", "x" * 40, '"}]', "\\\\"]
    out = []
    for i in range(n):
        text = "".join(random.choices(odd, k=random.randint(0, 12)))
        more = {"a": [{"b": k} for k in range(random.randint(0, 4))], "c": random.choice(odd)}
        out.append({"id": i, "text": text, "more": random.choice([None, more])})
    out[n // 2]["text"] = "}" * 3_000  # a record across several splits
    return out


def rows_of(items):
    return sorted(json.dumps(o, ensure_ascii=False, sort_keys=True) for o in items)


def read_back(df):
    out = []
    for r in df.select("id", "text", "more").collect():
        out.append(r.asDict(recursive=True))
    return rows_of(out)


@pytest.mark.parametrize("indent", [None, 0, 2])
def test_split_arrays_give_all_rows(spark, tmp_path, tiny_splits, indent):
    items = objects(300)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text("﻿ " + json.dumps(items, indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    (tmp_path / "a" / "two.json").write_text(json.dumps(items[:3]), encoding="utf-8")
    (tmp_path / "a" / "empty.json").write_text(" [ \n ]\n", encoding="utf-8")
    (tmp_path / "a" / "blank.json").write_text("", encoding="utf-8")
    back = read_json(spark, str(tmp_path / "a"), SCHEMA, multiline=True)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "a")).rdd.getNumPartitions() > 20
    assert read_back(back) == rows_of(items + items[:3])


def test_partition_columns_come_along(spark, tmp_path, tiny_splits):
    for day in (1, 2):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "x.json").write_text(json.dumps(objects(40, day)))
    back = read_json(spark, str(tmp_path), SCHEMA, multiline=True)
    assert sorted(map(tuple, back.groupBy("day").count().collect())) == [(1, 40), (2, 40)]


BROKEN = [
    '[{"id": 1}, {"id": 2}',
    '[{"id": 1}, {"id": 2',
    '[{"id": 1},]',
    '[{"id": 1}{"id": 2}]',
    '[{"id": 1}, 5]',
    '[{"id": 1}, null]',
    '[{"id": 1}, {"id": "x"}]',
    '[{"id": 1}, [{"id": 2}]]',
    '[{"id": 1}, {"id": 2, "text": "no end}]',
    '[{"id": 1} x, {"id": 2}]',
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_records_raise_or_are_kept(spark, tmp_path, text):
    path = tmp_path / "broken.json"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, str(path), SCHEMA, multiline=True).collect()
    kept = read_json(spark, str(path), SCHEMA, multiline=True, permissive=True)
    total, corrupt = corrupt_records(kept).first()
    assert corrupt >= 1 and total - corrupt <= 1


@pytest.mark.parametrize("text", ['{"id": 1}', '{"id": 1}\n{"id": 2}', '[{"id": 1}] x', '[{"id": 1}][{"id": 2}]', "5", "]"])
def test_other_files_are_refused(spark, tmp_path, text):
    path = tmp_path / "other.json"
    path.write_text(text)
    with pytest.raises(Exception, match="not one JSON array"):
        read_json(spark, str(path), SCHEMA, multiline=True).collect()


def test_a_cut_in_many_splits_raises(spark, tmp_path, tiny_splits):
    path = tmp_path / "cut.json"
    path.write_text(json.dumps(objects(200), indent=2)[:-40])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, str(path), SCHEMA, multiline=True).collect()


def test_sums_of_any_splits_add_up():
    data = json.dumps(objects(60), ensure_ascii=False).encode()
    random.seed(4)
    places = [i + 1 for i, b in enumerate(data) if b == ord("}")]
    for _ in range(200):
        cuts = sorted(random.sample(places, 3))
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        total = _summed(parts[0])
        for part in parts[1:]:
            total = _then(total, _summed(part))
        assert total == _summed(data)


def test_first_pass_leaves_small_files_out(spark, tmp_path):
    """Spark drops files by their size before it makes tasks."""
    (tmp_path / "small.json").write_text(json.dumps(objects(5)))
    first = spark.read.option("lineSep", "}").text(str(tmp_path)).filter("_metadata.file_size > 4194304")
    assert first.rdd.getNumPartitions() == 0
    assert read_json(spark, str(tmp_path), SCHEMA, multiline=True).count() == 5
