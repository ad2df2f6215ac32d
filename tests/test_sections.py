import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from sparkgauge.functions import nested as N
from sparkgauge.functions import sections as S
from sparkgauge.functions import text as X
from sparkgauge.sources.readers import rename_fields, upsert_by_key

NOW = dt.datetime(2024, 2, 9, 16, 0)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_null_members_do_not_exist(spark):
    section = S.text_section({"a": F.lit(None), "b": F.lit(1), "c": F.lit("")})
    assert one(spark, section) == {"b": "1", "c": ""}
    assert one(spark, S.number_section({})) == {}
    assert one(spark, S.drop_blanks(section)) == {"b": "1"}


def test_earlier_section_wins(spark):
    a, b = S.text_section({"k": F.lit("dim")}), S.text_section({"k": F.lit("attr"), "o": F.lit("x")})
    assert one(spark, S.merge_maps(a, b)) == {"k": "dim", "o": "x"}
    assert one(spark, S.merge_maps(F.lit(None).cast(S.TEXT_MAP), b)) == {"k": "attr", "o": "x"}
    assert one(spark, S.unpack_sections(a, b, S.number_section({"o": F.lit(2), "n": F.lit(2.5)}))) == {"k": "dim", "o": "x", "n": "2.5"}


@pytest.mark.parametrize(
    "value, ns",
    [
        (1707494400000, 1707494400000 * 10**6),
        (4100000000000, 4100000000000 * 10**6),
        (4100000000001, 4100000000001 * 10**3),
        (1707494400000123, 1707494400000123 * 10**3),
        (1707494400000123456, 1707494400000123456),
        (1707494400000123456789, 1707494400000123456),
        (1707494400000123456789012, 1707494400000123456),
        (-1000000, None),
        (0, 0),
        (9 * 10**26, None),
    ],
)
def test_unit_detection(spark, value, ns):
    raw = F.lit(str(value)).cast("decimal(38,0)")
    assert one(spark, S.normalize_timestamp_unit(raw, F.lit(NOW), unit="ns", check_range=False)) == ns
    with pytest.raises(ValueError):
        S.normalize_timestamp_unit(raw, F.lit(NOW), unit="s")


def test_range_bounds_are_inclusive(spark):
    def checked(moment):
        ms = F.unix_millis(F.lit(moment))
        return one(spark, S.normalize_timestamp_unit(ms, F.lit(NOW)))

    assert checked(NOW - dt.timedelta(minutes=1435)) is not None
    assert checked(NOW - dt.timedelta(minutes=1435, milliseconds=1)) is None
    assert checked(NOW + dt.timedelta(minutes=10)) is not None
    assert checked(NOW + dt.timedelta(minutes=10, milliseconds=1)) is None


def test_clamp_keeps_span_length(spark):
    minute = 60 * 10**9
    now = 1_700_000_000 * 10**9

    def clamp(start, ts, end):
        as_col = [F.lit(None if v is None else now + v * minute).cast("bigint") for v in (start, ts, end)]
        out = spark.range(1).select(*[c.alias(n) for n, c in zip("abc", S.clamp_timestamps(*as_col, F.lit(now)))]).first()
        return tuple(None if v is None else (v - now) / minute for v in out)

    assert clamp(-10, None, -5) == (-10, None, -5)
    assert clamp(-100, None, -95) == (-59, None, -54)
    assert clamp(20, None, 25) == (4, None, 9)
    assert clamp(None, -100, None) == (None, -59, None)
    assert clamp(-5, None, 30) == (-5, None, 9)


def test_json_values(spark):
    flat = F.create_map(*[F.lit(x) for x in ("l", '[{"a":1},{},"x",[]]', "s", "text", "e", "{}", "n", '{"a":{}}')])
    assert one(spark, S.pack_json_values(flat)) == {"l": '["{\\"a\\":1}","x"]', "s": "text", "n": '{"a":{}}'}


def test_clean_nested_members():
    value = {"a": None, "b": {"c": None}, "d": {"e": {"f": None}}, "g": [None, 1, {"h": None}], "_i": 1, "j": '{"k": null, "l": 2}', "m": "[]", "n": [{}]}
    assert N.without_missing(value, hide_internal=True) == {"g": [1], "j": {"l": 2}, "m": [], "n": []}
    assert N.without_missing({"x": float("nan"), "y": "text"}) == {"y": "text"}


def test_one_type_lists():
    assert N.one_type([1, "2.5", None]) == [1.0, 2.5, None]
    assert N.one_type([1, "x", None]) == ["1", "x"]
    assert N.one_type([True, "3"]) == [True, 3]
    assert N.one_type([{"a": 1}, 2]) == ['{"a": 1}', "2"]
    assert N.one_type({"a": "[1, 2]"}) == {"a": [1, 2]}
    assert N.one_type(["only"]) == ["only"]


def test_nested_functions_run_on_batches(spark):
    rows = spark.createDataFrame([('{"a":null,"b":1}',), (None,), ("plain",)], "t string")
    got = [r[0] for r in rows.select(N.clean_nested("t")).collect()]
    assert got == ['{"b":1}', None, '"plain"']
    assert json.loads(rows.select(N.normalize_mixed_lists(F.lit('[1,"2"]'))).first()[0]) == [1, 2]


def test_sanitize_equals_regex_on_whole_texts(spark):
    texts = [
        "from 8.8.8.8 to 192.168.1.4, 10.1.2.3 and 172.20.0.1 or 200.1.2.3.",
        "abc1234x and 127.0.0.1, 0.0.0.0 then 99.99.99.99" + " filler" * 3000 + " 54.1.1.9",
        "",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    clean, hits = X.sanitize_text(F.col("t"))
    for row, text in zip(rows.select("i", clean.alias("c"), hits.alias("n")).orderBy("i").collect(), texts):
        n = 0
        for pattern, replacement in X.DENY_PATTERNS.values():
            text, k = re.subn(pattern, replacement, text)
            n += k
        assert (row["c"], row["n"]) == (text, n)


def test_text_helpers(spark):
    assert one(spark, X.unquote_content(F.lit('"a"'))) == '"a"'
    assert one(spark, X.unquote_content(F.lit('"abc"'))) == "abc"
    assert one(spark, X.parse_prefix(F.lit("ENV_A_B"))) == "ENV"
    assert one(spark, X.parse_prefix(F.lit("NONE"))) is None
    assert one(spark, X.compress_columns(F.lit('{"columns":[{"objectName":"B","subOperationType":"ADD"},{"objectName":"A","subOperationType":"ADD"},{"objectName":"C"}]}'))) == {"ADD": ["A", "B"], "unknown": ["C"]}
    assert one(spark, X.coerce_array(F.lit("[not json"))) == ["[not json"]
    assert one(spark, X.clean_key(F.lit("Some  Key-1!"))) == "some_key1"
    assert one(spark, X.parse_call_arguments(F.lit("select 1"), "call x\\(")) is None


def test_rename_keeps_existing_new_name(spark):
    section = F.create_map(*[F.lit(x) for x in ("old", "1", "new", "2", "other", "3")])
    assert one(spark, rename_fields(section, {"old": "new"})) == {"new": "2", "other": "3"}


def test_vendor_prefix(spark):
    section = F.create_map(F.lit("platform.query.id"), F.lit("q"), F.lit("db.user"), F.lit("u"))
    assert one(spark, S.with_vendor_prefix(section, "acme")) == {"acme.query.id": "q", "db.user": "u"}


def test_upsert_overwrites_with_null(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    assert sorted(upsert_by_key(old, new, ["k"]).collect()) == [("a", 1), ("b", None), ("c", 3)]
