"""Ordered rows by batch and stream, restarts, ties and pruning; metric lines with counts from commits."""

import datetime as dt

import pytest

from sparkgauge.session import fresh_path
from sparkgauge.sources import feeds

DAY0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, note string"


def at(minute):
    return DAY0 + dt.timedelta(minutes=minute)


def add(spark, folder, rows, parts=1):
    spark.createDataFrame(rows, SCHEMA + ", unused binary").repartition(parts).write.mode("append").parquet(folder)


def stream_all(spark, folder, out, schema=SCHEMA):
    rows = spark.readStream.format("ordered_rows").schema(schema).option("folder", folder).option("time", "ts").option("id", "id").load()
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def test_batch_and_stream_agree_after_restarts(spark):
    feeds.register(spark)
    folder, out = fresh_path(spark, "ordered"), fresh_path(spark, "streamed")
    first = [(i, at(i // 3), f"n{i}", None) for i in range(300)] + [(None, at(1), "no id", None), (7, None, "no time", None)]
    add(spark, folder, first, parts=5)
    stream_all(spark, folder, out)
    assert spark.read.parquet(out).count() == 300
    stream_all(spark, folder, out)
    # Ties with the last time are split by the id: only larger ids are new; an older row is not seen.
    add(spark, folder, [(i, at(99 + (i - 300) // 50), "more", None) for i in range(300, 500)] + [(5, at(99), "older", None)], parts=3)
    stream_all(spark, folder, out)
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    batch = spark.read.format("ordered_rows").schema(SCHEMA).option("folder", folder).option("time", "ts").option("id", "id").load()
    assert got == sorted(map(tuple, batch.filter("note <> 'older'").collect()), key=str)
    assert len(got) == 500 and batch.count() == 501


def test_text_ids_and_an_empty_folder(spark):
    feeds.register(spark)
    folder, out = fresh_path(spark, "ordered"), fresh_path(spark, "streamed")
    schema = "id string, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(folder)
    stream_all(spark, folder, out, schema)
    spark.createDataFrame([("b", at(1)), ("a", at(1))], schema).write.mode("append").parquet(folder)
    stream_all(spark, folder, out, schema)
    spark.createDataFrame([("c", at(1)), ("a", at(1))], schema).write.mode("append").parquet(folder)
    stream_all(spark, folder, out, schema)
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(out).collect()) == ["a", "b", "c"]


def test_only_row_groups_of_the_range_are_planned(spark):
    folder = fresh_path(spark, "ordered")
    for day in range(4):
        add(spark, folder, [(day * 10 + i, at(day * 1440 + i), "x", None) for i in range(10)])
    reader = feeds.RowsStreamReader(feeds.Folder({"folder": folder, "time": "ts", "id": "id"}, spark.createDataFrame([], SCHEMA).schema))
    assert reader.latestOffset() == {"time": feeds.micros(at(3 * 1440 + 9)), "id": 39}
    parts = reader.partitions({"time": feeds.micros(at(1440 + 9)), "id": 19}, {"time": feeds.micros(at(2 * 1440 + 4)), "id": 24})
    assert len(parts) == 2  # the day that holds the start and the one that holds the end
    assert sorted(i for p in parts for b in reader.read(p) for i in b.column(0).to_pylist()) == [20, 21, 22, 23, 24]
    assert all(b.schema.names == ["id", "ts", "note"] for p in parts for b in reader.read(p))


def test_times_without_statistics(spark):
    feeds.register(spark)
    folder = fresh_path(spark, "ordered")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        add(spark, folder, [(1, at(1), "x", None)])
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    batch = spark.read.format("ordered_rows").schema(SCHEMA).option("folder", folder).option("time", "ts").option("id", "id").load()
    assert [tuple(r) for r in batch.collect()] == [(1, at(1), "x")]
    with pytest.raises(ValueError, match="no statistics"):
        feeds.Folder({"folder": folder, "time": "ts", "id": "id"}, batch.schema).last()


def test_lines_are_counted_by_commits(spark):
    feeds.register(spark)
    folder = fresh_path(spark, "lines")
    lines = spark.createDataFrame([("a 1",), ("b 2",), (None,), ("é 3",)], "line string").repartition(3)

    def write(mode, rows=lines):
        rows.write.format("metric_lines").option("run", "1").mode(mode).save(folder)

    write("append")
    assert sorted(r["line"] for r in feeds.read_lines(spark, folder, "1").collect()) == ["a 1", "b 2", "é 3"]
    write("append")
    assert feeds.counts(spark, folder, "1").first()["n"] == 6 and feeds.read_lines(spark, folder, "1").count() == 6
    write("overwrite")
    assert feeds.counts(spark, folder, "1").first()["n"] == 3 and feeds.read_lines(spark, folder, "1").count() == 3
    write("overwrite", lines.limit(0))
    assert feeds.counts(spark, folder, "1").first()["n"] == 0 and feeds.read_lines(spark, folder, "2").isEmpty()
    with pytest.raises(Exception, match="one column"):
        write("append", lines.selectExpr("line AS other"))
