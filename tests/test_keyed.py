"""Keyed state: merges rewrite the folders they touch, additions rewrite none, expiry drops whole days."""

import datetime as dt
from pathlib import Path

import pytest

from sparkgauge.operators.keyed import BUCKET, KeyedState

DAY = dt.date(2024, 1, 1)


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet") if "=" in str(p)}


def folder(name):
    return name.rsplit("/", 1)[0]


def test_three_merges_equal_a_dictionary(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), spark.createDataFrame([], "k string, v long").schema, ["k"], buckets=8)
    known = {}
    for rows in ({f"k{i}": i for i in range(200)}, {"k3": None, "k7": 70, None: 1, "": 2}, {"k3": 33, None: 5, "new": 6}):
        before = files(state.path)
        state.merge(spark.createDataFrame(list(rows.items()), state.schema))
        known |= rows
        assert dict(tuple(r) for r in state.read().collect()) == known
        assert state.read().count() == len(known)
        written = {folder(f) for f in files(state.path) - before}
        assert before - files(state.path) == {f for f in before if folder(f) in written}
        assert len(written) <= len(rows)
    state.merge(spark.createDataFrame([], state.schema))
    assert state.read().count() == len(known)


def test_a_merge_touches_its_days_only_and_expiry_drops_days(spark, tmp_path):
    schema = spark.createDataFrame([], "day date, id long, v string").schema
    state = KeyedState(spark, str(tmp_path / "d"), schema, ["id"], day="day", buckets=4)
    rows = [(DAY + dt.timedelta(days=i % 5), i, "old") for i in range(100)] + [(None, 1000, "old")]
    state.merge(spark.createDataFrame(rows, schema))
    before = files(state.path)
    state.merge(spark.createDataFrame([(DAY, 0, "new"), (DAY, 5, "new"), (None, 1000, "new"), (DAY, 1, "added")], schema))
    changed = {folder(f).split("/")[0] for f in before - files(state.path)}
    assert changed <= {"day=2024-01-01", "day=__HIVE_DEFAULT_PARTITION__"}
    found = {(r["day"], r["id"]): r["v"] for r in state.read().collect()}
    assert len(found) == 102 and found[(DAY, 0)] == "new" and found[(None, 1000)] == "new" and found[(DAY, 1)] == "added"
    assert found[(DAY + dt.timedelta(days=1), 1)] == "old"

    plan = state._rows_in(state._touched(state._placed(spark.createDataFrame([(DAY, 0, "x")], schema))))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in shown and "2024-01-01" in shown and BUCKET in shown.split("PartitionFilters")[1].split("]")[0]

    left = files(state.path)
    assert state.expire(DAY + dt.timedelta(days=2)) == 2
    assert files(state.path) == {f for f in left if f[:14] not in ("day=2024-01-01", "day=2024-01-02")}
    assert state.read().count() == 61
    assert state.expire(DAY) == 0


def test_additions_rewrite_nothing_and_are_made_once(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, name string").schema
    state = KeyedState(spark, str(tmp_path / "a"), schema, ["id", "name"], buckets=4)
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None)], schema)
    assert sorted(state.add(first).collect(), key=str) == sorted([(1, "a"), (2, None), (None, None)], key=str)
    before = files(state.path)
    assert state.add(spark.createDataFrame([(1, "b"), (2, None), (1, "a")], schema)).collect() == [(1, "b")]
    assert before < files(state.path)
    assert state.add(first).isEmpty()
    assert state.read().count() == 4


def test_a_merge_that_died_is_finished(spark, tmp_path, monkeypatch):
    state = KeyedState(spark, str(tmp_path / "x"), spark.createDataFrame([], "k long, v long").schema, ["k"], buckets=4)
    state.merge(spark.range(50).selectExpr("id AS k", "0L AS v"))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedState, "_write", dies)
        with pytest.raises(OSError):
            state.merge(spark.range(10).selectExpr("id AS k", "1L AS v"))
    assert Path(state.path + "-pending/_SUCCESS").exists()
    assert state.read().agg({"v": "sum", "k": "count"}).first().asDict() == {"sum(v)": 10, "count(k)": 50}
    assert not Path(state.path + "-pending").exists()


def test_what_a_state_refuses(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, key_bucket int").schema
    with pytest.raises(ValueError):
        KeyedState(spark, str(tmp_path / "r"), schema, ["id"])
    with pytest.raises(ValueError):
        KeyedState(spark, str(tmp_path / "r"), schema, ["id"], day="id")
    with pytest.raises(ValueError):
        KeyedState(spark, str(tmp_path / "r"), spark.createDataFrame([], "id long").schema, ["id"]).expire(DAY)
