"""Runs with a re-read window: late rows once, and only the window's folders of ids are read. What a run reads for its state."""

import datetime as dt
import json
from functools import reduce

from pyspark.sql import functions as F

from sparkgauge.operators.fanout import KINDS
from sparkgauge.plans import runs as RN

DAY0 = dt.datetime(2024, 1, 1)


def instrumented(spark, rows):
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    empty = "CAST(map() AS map<string,string>)"
    return df.selectExpr(
        "id", "ts", "unix_micros(ts) * 1000 AS start_time", "'m' AS message", f"{empty} AS dimensions", f"{empty} AS attributes",
        "CAST(map() AS map<string,double>) AS metrics", "CAST(map() AS map<string,bigint>) AS event_timestamps",
    )


def context(rows, **options):
    return RN.Context("c", lambda since: rows if since is None else rows.filter(F.col("ts") >= F.lit(since)), "id", "ts", **options)


def test_late_and_repeated_rows_are_taken_once(spark, tmp_path):
    path, hour = str(tmp_path / "runs"), dt.timedelta(hours=1)
    first = [(i, DAY0 + i * hour) for i in range(100)]
    late = [(500, DAY0 + 98 * hour), (501, DAY0 + 96.5 * hour), (502, DAY0 + 10 * hour)]
    options = {"reread": dt.timedelta(hours=3)}
    RN.run_once(spark, path, context(instrumented(spark, first), **options), "a", DAY0)
    grown = context(instrumented(spark, first + late + first[-2:] + late[:1]), **options)
    RN.start(spark, path, grown, "dies", DAY0)
    assert sorted(r["id"] for r in RN.run_once(spark, path, grown, "b", DAY0).rows.collect()) == [500, 501]
    assert RN.run_once(spark, path, grown, "c", DAY0).is_empty
    assert RN.output(spark, path, grown, "logs").groupBy("id").count().filter("count > 1").count() == 0

    known = RN.processed_ids(spark, path, grown, DAY0 + 96 * hour)
    assert known.count() == 100 - 96 + 2
    assert "PartitionFilters: [isnotnull(day" in (shown := known._jdf.queryExecution().executedPlan().toString()) and "day#" in shown and "2024-01-05" in shown
    assert RN.drop_expired(spark, path, grown, dt.date(2024, 1, 4)) == 3
    assert RN.processed_ids(spark, path, grown, None).count() == 102 - 72


def test_a_run_reads_its_rows_once_for_its_state(spark, tmp_path, monkeypatch):
    """Rows without a time or with the id of another are counted; a state of no runs gives no records."""
    path = str(tmp_path / "runs")
    empty = context(instrumented(spark, []))
    assert RN.run_once(spark, path, empty, "none", DAY0).is_empty
    rows = instrumented(spark, [(1, DAY0), (1, DAY0), (2, None), (3, DAY0), (None, DAY0)]).withColumn("metrics", F.expr("IF(id = 3, NULL, map('n', 1D))"))
    run = RN.start(spark, path, context(rows), "a", DAY0)
    assert all(RN.output(spark, path, run.context, kind).isEmpty() for kind in KINDS)

    spark.sparkContext.setJobGroup("asked", "is it empty")
    assert not run.is_empty
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("asked")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    stored, store = [], RN.cut_lineage
    monkeypatch.setattr(RN, "cut_lineage", lambda df: stored.append(df) or store(df))
    run.commit()
    assert len(stored) == 1 and str(stored[0]._jdf.queryExecution().executedPlan()).count("FileScan") == 1
    state = RN.status_log(spark, path, run.context).first()
    counts = {r["kind"]: r["n"] for r in run.outputs.counts().collect()}
    assert json.loads(state["entries_count"]) == counts and counts["metrics"] in (3, 4) and counts["log_lines"] == 5
    assert (state["run_no"], state["last_timestamp"], state["last_id"], state["entries"]) == (0, DAY0, 3, 5)

    second = RN.run_once(spark, path, context(rows.unionByName(instrumented(spark, [(7, DAY0 + dt.timedelta(days=1))]))), "b", DAY0)
    assert second.number == 1
    kinds = [RN.output(spark, path, run.context, kind).groupBy("run").count().withColumn("kind", F.lit(kind)) for kind in KINDS]
    both = reduce(lambda a, b: a.unionByName(b), kinds)
    assert {(r["run"], r["kind"], r["count"]) for r in both.collect()} == {(0, "logs", 5), (0, "metrics", 4), (1, "logs", 1)}
    assert "ReusedSubquery" in str(both._jdf.queryExecution().executedPlan())
