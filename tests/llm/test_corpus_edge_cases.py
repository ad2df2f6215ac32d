"""Cases in which the corpus operators once gave wrong results."""

import duckdb
import pytest

from sparkgauge.llm import decontaminate, language, licenses, near_dedup, quality_model, quality_rules, queries

ITEM = "one two three four five six seven eight nine ten eleven"
DOCS = "doc_id long, text string, lang string, source string"


def test_items_without_an_id_are_hit_but_not_named(spark):
    docs = spark.createDataFrame([(1, f"before {ITEM} after"), (2, "nothing here"), (3, "- + =")], "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), ("-", "nothing"), ("+", None)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: (11, 0, True), 2: (1, 1, True), 3: (0, 0, False)}
    assert [r["doc_id"] for r in decontaminate.clean_documents(docs, items).collect()] == [3]


def test_decontamination_sql_with_nameless_items(spark, tmp_path):
    docs = spark.createDataFrame([(1, f"x {ITEM} {ITEM}"), (2, "ten eleven"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), (7, ITEM), (None, "ten eleven"), (9, "absent")], "item_id long, text string")
    for name, df in (("documents", docs), ("benchmark", items)):
        df.toPandas().convert_dtypes().to_parquet(tmp_path / f"{name}.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = con.execute(queries.ORACLES["op1_decontaminate"]).fetchall()
    got = decontaminate.decontaminate(docs, items).drop("h").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_long_texts_have_no_false_repeats(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " w5 w6 w7")], "doc_id long, text string").selectExpr("*", "'en' AS lang", "'a' AS source")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.quality_rules(docs, labels).collect()}
    assert got == {1: 0, 2: 6}


def test_training_rows_do_not_depend_on_partitions(spark):
    rows = [(i, f"text number {i} " * (1 + i % 9)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    models = [quality_model.train(docs.repartition(n), labels.repartition(n), sample_rows=60) for n in (1, 3, 7)]
    assert models[0].bias == models[1].bias == models[2].bias
    assert (models[0].factors == models[1].factors).all() and (models[0].factors == models[2].factors).all()


def test_columns_of_the_caller_come_through(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "der Hund und die Katze ") * 5, "en" if i % 2 else "de", 7.5, "mine") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    docs = docs.withColumn("_score", docs.score).withColumn("_lang_pred", docs.lang_pred)
    kept = language.in_languages(docs)
    assert kept.columns == docs.columns
    assert {(r["score"], r["lang_pred"], r["_lang_pred"]) for r in kept.collect()} == {(7.5, "mine", "mine")}
    labels = spark.createDataFrame([(i, 1) for i in range(80)], "doc_id long, quality int")
    good = quality_model.accepted(docs, labels)
    assert good.columns == docs.columns and {r["_score"] for r in good.collect()} == {7.5} and good.count() == 80


def test_one_of_equal_rows_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a")] * 3 + [(1, "quite another text " * 9, "en", "a"), (2, text, "en", "a"), (3, "other words " * 30, "en", "a"), (1, "", "en", "a"), (1, " ", "en", "b"), (None, text, "en", "c")]
    kept = near_dedup.without_copies(spark.createDataFrame(rows, DOCS), 5).collect()
    found = sorted((r["doc_id"] or 0, r["text"].strip()[:5]) for r in kept)
    assert found == [(1, ""), (1, ""), (1, "quite"), (1, "w0 w1"), (3, "other")]


BSD3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


@pytest.mark.parametrize("holder", ["the Foundation", "the Very Long Institute of " + "Applied Things and " * 40 + "Others"])
def test_long_holders_do_not_change_the_licence(holder):
    ids = [name for _, name in licenses.sentence_ids(BSD3.format(holder=holder))]
    assert licenses.match_rules(ids)[0] == ["BSD-3-Clause"]


def test_offsets_are_those_of_the_text():
    text = "İİİ. Released under the MIT License."
    ((offset, _),) = licenses.sentence_ids(text)
    assert text[offset:].startswith("Released")


def test_open_beginnings_without_an_end_stay_linear():
    text = "Neither the name of " + "something, and more; " * 20_000
    assert licenses.sentence_ids(text + "Released under the MIT License.") != []
