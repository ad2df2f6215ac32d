"""Corpus operators against brute force, on the smallest data and on a table of odd rows."""

import collections
import hashlib
import html as H
import itertools
import math
import re
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import rows_of

from sparkgauge.llm import decontaminate, language, licenses, main_text, mix, near_dedup, quality_model, quality_rules, queries, token_counts, warc
from sparkgauge.llm import components as near_components
from sparkgauge.llm.components import components

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ITEM = "one two three four five six seven eight nine ten eleven"
# Nulls, empty and long texts, repeated rows and ids; columns whose names the operators use inside.
ODD = [
    (1, ITEM + " tail", "en", "a"),
    (1, ITEM + " tail", "en", "a"),
    (1, "another text of the same id", "en", "a"),
    (2, None, None, None),
    (None, "a text without an id " * 20, "en", None),
    (None, None, "en", "b"),
    (3, "", "de", "a"),
    (4, " \n\t ", "de", "b"),
    (5, LONG, "en", "a"),
    (6, LONG + " more", "en", "a"),
    (7, "word", "fr", "a"),
    (8, "word", "fr", "a"),
    (9, "12345 !!! ###", "es", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    clash = ", ".join(f"'x' AS {c}" for c in ("h", "term", "node", "score", "block", "slot", "w"))
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "word"), (3, None), (4, ""), (None, ITEM), (5, "one two three four five six seven eight nine TEN")]
    return spark.createDataFrame(rows, "item_id long, text string")


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in read(spark, "documents").collect()}


# --- decontamination -----------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    cursor = con.execute(queries.ORACLES[name])
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_decontaminate_odd_rows(spark, odd, items):
    got = decontaminate.decontaminate(odd, items).collect()
    assert len(got) == len(ODD)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["n_words"], r["n_hit"], r["n_items"]))
    assert sorted(by[1]) == [(6, 0, 0), (12, 11, 2), (12, 11, 2)]
    assert by[7] == by[8] == [(1, 1, 1)] and by[2] == by[3] == by[4] == [(0, 0, 0)]
    assert {r["items_sha256"] for r in got if r["n_items"] == 2} == {hashlib.sha256(b"1,5").hexdigest()}
    kept = decontaminate.clean_documents(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 4
    assert decontaminate.decontaminate(odd.limit(0), items).count() == 0
    assert decontaminate.decontaminate(odd, items.limit(0)).filter("contaminated").count() == 0


def test_proximity_allows_a_word_between(spark, items):
    docs = spark.createDataFrame([(1, ITEM.replace("six", "six and"))], "doc_id long, text string")
    assert not decontaminate.decontaminate(docs, items).first()["contaminated"]
    assert decontaminate.decontaminate(docs, items, slack=1).first()["contaminated"]


# --- near duplicates -----------------------------------------------------------------------


def test_near_duplicates_odd_rows(spark, odd):
    got = [tuple(r) for r in near_dedup.near_duplicates(odd, 2).drop("h").collect()]
    assert len(got) == len(ODD)
    by = collections.defaultdict(set)
    for doc, n, comp, kept in got:
        by[doc].add((n, comp, kept))
    assert by[2] == {(0, 2, True)} and by[3] == {(0, 3, True)} and by[8] == {(1, 7, False)}
    assert by[6] == {(978, 5, False)} and by[5] == {(977, 5, True)}
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0
    assert near_dedup.without_copies(odd, 2).count() == len(ODD) - 3


def test_group_of_near_copies_equals_brute_force(spark):
    rng = np.random.RandomState(5)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for at in rng.randint(0, 120, rng.randint(0, 14)):
            words[at] = f"x{rng.randint(40)}"
        docs.append((i, " ".join(words)))
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, 2).collect()}
    assert got == {i: find(i) for i in sets}


def test_sketch_estimates(spark):
    rng = np.random.RandomState(1)
    order = near_dedup._borrow_order()
    x = np.unique(rng.randint(0, 2**63, 4000).astype(np.uint64))
    for share in (0.5, 0.8):
        k = int(len(x) * share)
        y = np.unique(np.concatenate([x[rng.permutation(len(x))[:k]], rng.randint(0, 2**63, len(x) - k).astype(np.uint64)]))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(near_dedup.estimate(near_dedup.registers(x, order), near_dedup.registers(y, order))[0] - true) < 0.15
        differ = int(np.bitwise_count(near_dedup.odd_sketch(x) ^ near_dedup.odd_sketch(y)).sum())
        assert differ <= len(np.setxor1d(x, y))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 501: 500}


def test_components_of_random_links_and_of_stars(spark, monkeypatch):
    rng = np.random.RandomState(3)
    links = [tuple(map(int, rng.randint(0, 300, 2))) for _ in range(220)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}

    # Stars are final: their links are written once and not rewired.
    stored, store = [], near_components.store
    monkeypatch.setattr(near_components, "store", lambda df, name: stored.append(name) or store(df, name))
    stars = spark.createDataFrame([(i % 5, i) for i in range(5, 100)] + [(5, 0), (200, 201)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(stars).collect()}
    assert got == {**{i: i % 5 for i in range(100)}, 200: 200, 201: 200} and stored == ["links"]


def test_a_bucket_of_no_more_rows_than_hubs_is_finished(spark):
    odd = [f"0L AS {c}" for c in near_dedup.ODD]
    rows = spark.range(60).selectExpr("'k' AS key", "id AS node", "id DIV 2 AS component", "60L AS rows", "10L AS n", "id AS weight", *odd)
    pairs, rest = near_dedup._pairs(rows, 64, 0.8)
    assert rest.isEmpty()
    assert {tuple(r) for r in pairs.collect()} == {(a, b, a // 2, b // 2) for a in range(60) for b in range(a) if a // 2 != b // 2}
    # With fewer hubs than rows the hubs alone meet the others and leave.
    pairs, rest = near_dedup._pairs(rows, 1, 0.8)
    assert rest.count() == 59 and {tuple(r) for r in pairs.collect()} == {(59, b, 29, b // 2) for b in range(58)}


# --- quality rules -------------------------------------------------------------------------


def test_text_counts_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in quality_rules.text_counts(read(spark, "documents")).collect()}
    for doc, text in texts(spark).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = list(zip(w, w[1:], w[2:]))
        often = collections.Counter(runs)
        covered = {j + d for j, x in enumerate(runs) if often[x] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r["n_symbols"] == sum(x in "#*$%&|<>" for x in text)


def test_binomial_bound_is_exact(spark):
    cases = [(100, 0, 0.02), (500, 3, 0.02), (5000, 60, 0.02), (5000, 100, 0.02), (7, 7, 0.5), (100_000, 1800, 0.02)]
    df = spark.createDataFrame(cases, "n long, f long, p double")
    from pyspark.sql import functions as F

    for r in df.withColumn("cdf", quality_rules.binomial_cdf(F.col("n"), F.col("f"), F.col("p"))).collect():
        n, f, p = r["n"], r["f"], r["p"]
        term = lambda k: math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
        assert r["cdf"] == pytest.approx(min(1.0, sum(map(term, range(f + 1)))), rel=1e-8)


def test_certified_cutoffs_keep_good_texts(spark, odd):
    rows = [(i, "good words here " + " ".join(f"g{i}_{j}" for j in range(60)), "en") for i in range(1500)]
    rows += [(10_000 + i, " ".join(f"b{i}_{j}###" for j in range(60)), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id < 10000 AS INT) AS quality")
    got = quality_rules.quality_rules(docs, labels)
    assert got.filter("doc_id < 10000 AND NOT kept").count() == 0 and got.filter("doc_id >= 10000 AND kept").count() == 0
    none = quality_rules.quality_rules(odd, labels.limit(0))
    assert none.count() == len(ODD) and none.filter("n_rules_hit > 0").count() == 0
    assert quality_rules.quality_rules(odd.limit(0), labels).count() == 0


# --- pages and archives --------------------------------------------------------------------


def test_main_text_is_the_article(spark):
    got = {r["page_id"]: r["text"] for r in main_text.extract_main_text(read(spark, "pages")).collect()}
    for r in read(spark, "pages").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h\d|br)[^>]*>", "\x01", inner)).split("\x01")
        assert got[r["page_id"]] == " ".join(x for x in (" ".join(H.unescape(b).split()) for b in blocks) if x)


def test_main_text_odd_pages(spark):
    page = (
        "<body><div id='top-menu'>Home</div><main><h1>T&eacute;st</h1><p>First <b>pa</b>ragraph, with words; and more.<p>Second one, long enough."
        "<div class='comments'>Nice!</div><form>mail</form></main><aside>side</aside><footer>foot</footer>"
    )
    assert main_text.main_text(page).endswith("First paragraph, with words; and more. Second one, long enough.")
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<p><script>x") == ""
    pages = spark.createDataFrame([(None, None, None), (1, "u", page), (1, "u", page)], "page_id long, url string, html string")
    assert main_text.extract_main_text(pages).count() == 3 and main_text.extract_main_text(pages.limit(0)).count() == 0


LINES = [f"Paragraph {i} of the body, long enough to count; it goes on, and on, to its end." for i in range(8)]
BODY = "".join(f"<p>{x}</p>" for x in LINES)


def test_main_text_beside_a_teaser():
    """A page whose body is in a div keeps it when a teaser is in an article; short text in an article stays, short text outside goes."""
    page = f"<body><div class='page'><h1>Head</h1>{BODY}</div><article><h3>Next</h3><p>A teaser, short.</p></article></body>"
    got = main_text.main_text(page)
    assert all(x in got for x in LINES) and "A teaser, short." in got
    got = main_text.main_text(f"<body><p>Top</p><span>x</span><article><h1>Head</h1>{BODY}<p>Short</p></article><ul><li>a</li><li>b</li><li>c</li><li>d</li></ul></body>")
    assert got.startswith("Head Paragraph 0") and "Short" in got and " d" not in got
    got = main_text.main_text(f"<body><main><h1>Head</h1>{BODY}<h2>Sub</h2></main></body>")
    assert got == " ".join(["Head", *LINES, "Sub"])


@pytest.mark.parametrize(
    "attrs",
    ["class='content no-sidebar'", "class='layout has-sidebar'", "class='elementor-widget elementor-widget-theme-post-content'", "class='post has-comments'",
     "id='share-price-report'", "class='widget'", "class='sidebar'", "class='menu'", "id='comments'"],
)
def test_main_text_in_marked_wrappers(attrs):
    """A wrapper with a word of asides in its class or id keeps the body, with and without an article; true asides go."""
    rest = "<div id='top-menu'>Home, and more</div><div class='ad'>Buy, now.</div><section class='related'><article>Other, short.</article></section>"
    assert main_text.main_text(f"<body>{rest}<div {attrs}><article>{BODY}<p>Short</p></article></div></body>") == " ".join([*LINES, "Short"])
    assert main_text.main_text(f"<body>{rest[:-len('<article>Other, short.</article></section>')]}</section><div {attrs}>{BODY}</div></body>") == " ".join(LINES)
    assert main_text.main_text(f"<body><form id='f'><main {attrs}>{BODY}</main></form></body>") == " ".join(LINES)
    assert main_text.main_text(f"<body><article>{BODY}<div class='comments'>{BODY * 2}</div></article></body>") == " ".join(LINES)


def test_main_text_leaves_out_readers_comments():
    """Comments that are articles of their own, beside a body in a div: many short ones, one, and more text than the body."""
    for remarks in (["Nice, thanks!"] * 9, ["Nice, thanks!"], [f"I disagree, and {x}" for x in LINES * 2]):
        section = "<section id='comments'><h2>Comments</h2>" + "".join(f"<article><p>{x}</p></article>" for x in remarks) + "</section>"
        assert main_text.main_text(f"<body><div class='page'>{BODY}</div>{section}</body>") == " ".join(LINES)


def test_main_text_keeps_headings_and_lists_of_a_div():
    page = f"<body><div><ul><li>Home</li><li>News</li><li>About</li></ul></div><div class='page'><h1>Head</h1>{BODY}<h2>Sub</h2><ul><li>one</li><li>two</li></ul></div><div><span>x</span></div></body>"
    assert main_text.main_text(page) == " ".join(["Head", *LINES, "Sub", "one", "two"])


def test_main_text_leaves_out_marked_parts_of_main():
    parts = "<div class='site-header'><p>Site, and name.</p></div><div class='ads-slot'><p>Buy, now.</p></div><div class='notice'><p>We use, well, things.</p></div>"
    assert main_text.main_text(f"<body><main>{parts}<h1>Head</h1>{BODY}</main></body>") == " ".join(["Head", *LINES])
    widgets = "".join(f"<div class='widget'><p>{x}</p></div>" for x in LINES)
    assert main_text.main_text(f"<body><main><h1>Head</h1>{widgets}</main></body>").endswith(" ".join(LINES))


def test_archives_round_trip(spark):
    rows = [(1, "u", "<p>é" * 30_000), (2, "u", "same"), (3, None, "same"), (4, "u\r\nX: y", None), (5, "u", ""), (None, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (7, "u", "seven"), (7, "u", "seven")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages).collect())
    assert got == collections.Counter(
        [(1, 150_000, "response", None), (2, 4, "revisit", 3), (3, 4, "response", None), (4, 0, "revisit", 5), (5, 0, "response", None), (None, 16, "response", None), (7, 5, "response", None), (7, 5, "revisit", 7)]
    )
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    assert {r["record_type"] for r in warc.archive_round_trip(pages, 10**9).collect()} == {"response"}


def test_lost_segment_is_an_error(spark, tmp_path):
    records = list(warc.page_records("0:1", "u", "x" * 50_000, "", None))
    assert len(records) > 2
    (tmp_path / "a.warc").write_bytes("".join(r + warc.END_OF_RECORD for r in records[:1] + records[2:]).encode())
    with pytest.raises(Exception, match="not whole"):
        warc.read_archives(spark, str(tmp_path)).collect()


# --- licences, models, tokens --------------------------------------------------------------


def test_license_rules(spark, odd):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License."
    assert licenses.match_rules([n for _, n in licenses.sentence_ids("Intro.\n" + apache)]) == (["Apache-2.0"], [])
    assert [n for _, n in licenses.sentence_ids("Licensed under CC BY-NC 4.0.\nText.")] == ["cc-by-nc-4.0-short"]
    assert licenses.match_rules(["gpl-see", "mit-short"]) == (["MIT"], ["gpl-see"])
    assert licenses.scan_licenses(odd).count() == len(ODD) and licenses.scan_licenses(odd.limit(0)).count() == 0
    found = licenses.scan_licenses(read(spark, "documents")).filter("size(licenses) > 0").count()
    assert found >= sum(bool(re.search(r"^(Licensed under (CC BY-NC 4.0|the Apache License, Version 2.0)|Released under the MIT License)\.$", t, re.M)) for t in texts(spark).values())


BSD = """Copyright (c) 2020, Foo Inc. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """3. Neither the name of Foo Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GNU = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU {0} General Public
License as published by the Free Software Foundation; either
version {1} of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
{0} General Public License for more details.
"""


@pytest.mark.parametrize(
    "text,licence",
    [
        (BSD, "BSD-2-Clause"),
        (BSD + THIRD, "BSD-3-Clause"),
        (GNU.format("Lesser", "2.1"), "LGPL-2.1-or-later"),
        (GNU.format("Affero", "3"), "AGPL-3.0-or-later"),
        ("Intro.\nThis project is licensed under the MIT License.", "MIT"),
        ("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"),
        ("This software is released under the Apache License, Version 2.0.", "Apache-2.0"),
        ("This work is licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        ("The code is licensed\nunder the Eclipse Public License 2.0.", "EPL-2.0"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ],
)
def test_license_texts(text, licence):
    assert licenses.match_rules([n for _, n in licenses.sentence_ids(text)]) == ([licence], [])


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 7, 200])
def test_license_texts_with_lines_of_any_length(width):
    words = GNU.format("Lesser", "2.1").split()
    text = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
    text += "\nThe code is distributed by us.\n" + " ".join(GNU.format("Affero", "3").split())
    assert licenses.match_rules([n for _, n in licenses.sentence_ids(text)]) == (["LGPL-2.1-or-later", "AGPL-3.0-or-later"], [])


def test_linear_time_interactions_equal_pairs():
    rng = np.random.RandomState(0)
    model = quality_model.FactorisationMachine(0.3)
    model.weights[:] = rng.standard_normal(len(model.weights))
    model.factors[:] = rng.standard_normal(model.factors.shape)
    ids, x = np.array([1, 5, 9], np.int32), np.array([0.5, 1.0, 2.0], np.float32)
    v = model.factors[ids]
    pairs = sum(float(v[i] @ v[j]) * x[i] * x[j] for i in range(3) for j in range(i))
    assert model.margins(ids, x, np.array([0]))[0] == pytest.approx(0.3 + float(model.weights[ids] @ x) + pairs, rel=1e-4)


def test_quality_model_on_held_out_rows(spark, odd):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_model.classify(docs, labels).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() >= 0.97 * got.count()
    assert quality_model.classify(odd, labels).count() == len(ODD)
    assert {r["score"] for r in quality_model.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_model.classify(odd.limit(0), labels).count() == 0
    assert quality_model.accepted(odd, labels).columns[0] == "doc_id"


def test_language_on_held_out_rows(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.98 * got.count()
    odd_rows = language.language_id(odd).collect()
    assert len(odd_rows) == len(ODD) and {r["lang_pred"] for r in odd_rows if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert language.language_id(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.language_id(odd.withColumn("lang", odd["lang"].substr(9, 1)).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}


def test_token_counts_equal_direct_ones(spark, odd):
    encode = token_counts.encoding().encode_ordinary
    for df, block in ((read(spark, "documents").select("doc_id", "text"), 1000), (odd, 7)):
        got = collections.Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.token_counts(df, block_tokens=block).collect())
        assert got == collections.Counter((r["doc_id"], len(encode(r["text"] or ""))) for r in df.select("doc_id", "text").collect())
    assert token_counts.token_counts(odd.limit(0)).count() == 0


# --- mixing --------------------------------------------------------------------------------


def test_mix_stays_within_one_block(spark):
    rows = [(i, "t", "abcde"[min(i % 9, 4)]) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 0.4, "b": 0.3, "c": 0.15, "d": 0.1, "e": 0.05}
    got = mix.mix(docs, weights, block_rows=10, period=100).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(9000))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    slots = {r["slot"]: r["source"] for r in got}
    share = {r["source"]: r["weight_share"] for r in got}
    assert sum(share.values()) == pytest.approx(1) and abs(share["a"] - 0.4) < 0.03
    ends = {s: max(t for t, x in slots.items() if x == s) for s in share}
    taken = collections.Counter()
    for t in range(min(ends.values())):
        taken[slots[t]] += 1
        assert all(abs(taken[s] - share[s] * (t + 1)) < 1 for s in share)


def test_mix_odd_rows(spark, odd):
    got = mix.mix(odd)
    assert got.count() == len(ODD) and set(odd.columns) <= set(got.columns)
    places = [(r["source"], r["block"], r["place"]) for r in got.collect()]
    assert len(set(places)) == len(ODD)
    assert mix.mix(odd.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0.6 * docs.count() and set(docs.columns) <= set(out.columns)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    left = docs.join(out.select("doc_id"), "doc_id", "left_semi")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert decontaminate.decontaminate(left, benchmark).filter("contaminated").count() == 0


FOREIGN = {
    "it": "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Quanto a dir qual era è cosa dura, questa selva selvaggia e aspra e forte.",
    "nl": "Het was een koude dag in het begin van april en de klokken sloegen dertien. Hij liep snel door de glazen deuren van het gebouw, maar niet snel genoeg om het stof buiten te houden.",
    "pl": "Dawno temu w małej wiosce na skraju lasu mieszkała dziewczynka, która każdego ranka chodziła zbierać grzyby i jagody, a wieczorem słuchała opowieści przy ogniu.",
    "ru": "Давным-давно в маленькой деревне на краю леса жила девочка, которая каждое утро ходила собирать грибы и ягоды, а вечером слушала сказки у огня.",
    "fi": "Olipa kerran pieni tyttö, joka asui metsän reunalla mökissä isoäitinsä kanssa. Joka aamu hän lähti poimimaan marjoja ja sieniä metsästä.",
}


def with_foreign(docs):
    """The documents and two texts of each foreign language, short and long, with ids from 10**9 and no label."""
    rows = [(10**9 + i, t * n, None, "planted", len(t) * n) for i, (t, n) in enumerate(itertools.product(FOREIGN.values(), (1, 6)))]
    return docs.unionByName(docs.sparkSession.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema))


def test_foreign_texts_are_rejected(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lettered = {r["doc_id"] for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"])}
    kept = {r["doc_id"] for r in language.in_languages(with_foreign(docs)).collect()}
    assert not {i for i in kept if i >= 10**9}
    assert kept <= lettered and len(kept) >= 0.985 * len(lettered)
    only = {r["lang"] for r in language.in_languages(docs, ["de"]).filter("lang IS NOT NULL").groupBy("lang").count().filter("count > 5").collect()}
    assert only == {"de"}
    # Nothing is learned without a label: all rows stay.
    assert language.in_languages(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).count() == docs.count()
    assert language.in_languages(odd.limit(0)).count() == 0


def test_stages_equal_brute_force(spark):
    """Each stage keeps what brute force keeps of the documents it gets, planted foreign texts among them."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    docs = with_foreign(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    got = stages["quality classifier"](spark, docs, folder)
    assert ids(got) == ids(quality_model.classify(docs, labels).filter("predicted = 1"))
    got = stages["language ID"](spark, docs, folder)
    assert max(ids(got)) < 10**9 and got.columns == docs.columns

    few = docs.filter("doc_id < 300 OR doc_id >= 1000000000").cache()
    words = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER)) for r in few.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert ids(stages["near-dedup"](spark, few, folder)) == sorted(i for i in root if find(i) == i)

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    items = [w for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if (w := split(r["text"]))]
    windows = {n: set().union(*(grams(w, n) for w in items if min(10, len(w)) == n)) for n in {min(10, len(w)) for w in items}}
    clean = sorted(r["doc_id"] for r in docs.collect() if not any(x & grams(split(r["text"]), n) for n, x in windows.items()))
    assert ids(stages["decontamination"](spark, docs, folder)) == clean
    assert ids(stages["mixing"](spark, docs, folder)) == ids(docs)
