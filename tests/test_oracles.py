"""Registered queries against their SQL on DuckDB, on the smallest data folder.

``tools/compare.py`` does the same with more detail.
"""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import rows_of

from sparkgauge.catalog import load_all
from sparkgauge.catalog.base import ORACLES, QUERIES, TABLES, Bound, run
from sparkgauge.catalog.frames import FRAMES

FOLDER = "/root/testdata/sf0.001"

load_all()
CHECKED = sorted(ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, duck, name):
    df = run(name, spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_registry_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 300
    assert not any(name in TABLES for name in FRAMES)


def test_entry_returns_rows(spark):
    import __spark_entry__

    top = __spark_entry__.entry(spark)
    assert top.columns == ["user_name", "total_ms"] and top.count() == 20


def test_bound_frames_have_stable_schema(spark):
    bound = Bound(spark, FOLDER)
    assert bound.query_log.columns == bound.query_log.columns
    with pytest.raises(AttributeError):
        bound.no_such_frame
