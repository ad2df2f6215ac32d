"""Run registered queries next to their SQL on DuckDB and report differences.

usage: compare.py DATA_DIR [--frames] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

from sparkgauge.catalog import load_all
from sparkgauge.catalog.base import ORACLES, QUERIES, TABLES, Bound, with_frames
from sparkgauge.catalog.frames import FRAMES


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return repr(value)
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in rows)


SAME_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double", "FLOAT": "float"}


def type_notes(df, description) -> str:
    """Columns whose types differ between the two sides."""
    mine = dict(df.dtypes)
    notes = [f"{n}: {mine[n]} | {t}" for n, t in ((d[0], str(d[1])) for d in description) if n in mine and SAME_TYPE.get(t, t) != mine[n]]
    return "  types " + ", ".join(notes) if notes else ""


def main(argv):
    sf_dir, *rest = argv
    frames_only = "--frames" in rest
    prefixes = [a for a in rest if not a.startswith("--")]
    spark = session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = []
    if frames_only:
        names = {n: (lambda b, n=n: getattr(b, n), with_frames(f"SELECT * FROM {n}")) for n in FRAMES}
    else:
        load_all()
        names = {n: (QUERIES[n], ORACLES.get(n)) for n in QUERIES}
    for name, (fn, sql) in names.items():
        if prefixes and not any(name == p or name.startswith(p + "_") or (p.endswith("*") and name.startswith(p[:-1])) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(Bound(spark, sf_dir))
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            t1 = time.time()
            if sql is None:
                print(f"ROWS {name} {len(got[1])} rows {t1 - t0:.2f}s")
                continue
            cur = con.execute(sql)
            want = rows_of([d[0] for d in cur.description], cur.fetchall())
            if got == want:
                note = "" if got[1] else "  (empty!)"
                print(f"ok   {name} {len(got[1])} rows {t1 - t0:.2f}s{note}{type_notes(df, cur.description)}", flush=True)
                continue
            bad.append(name)
            print(f"DIFF {name}: columns {got[0]} | {want[0]}; rows {len(got[1])} | {len(want[1])}")
            a, b = set(got[1]), set(want[1])
            for side, items in (("spark", sorted(a - b)[:3]), ("duck ", sorted(b - a)[:3])):
                for item in items:
                    print("    ", side, str(item)[:600])
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            text = str(error).split("\n\nJVM")[0]
            print(f"FAIL {name}: {type(error).__name__}: {text[:900]}")
            if "--trace" in rest:
                traceback.print_exc()
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
