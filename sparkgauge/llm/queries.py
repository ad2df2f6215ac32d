"""Registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgauge import configure
from sparkgauge.llm import (
    decontaminate,
    language,
    licenses,
    main_text,
    merkle,
    mix,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    token_alignment,
    token_counts,
    warc,
)
from sparkgauge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("h")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, threshold=0.8).drop("h")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return main_text.extract_main_text(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return language.language_id(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "weight_share", "block", "release", "deadline", "slot", "place"
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.packed_digests(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return token_alignment.alignment_measures(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(docs, merkle.tampered(F.col("text"), F.col("doc_id")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_near_duplicates,
        op3_quality_rules,
        op4_main_text,
        op5_license_scan,
        op6_archives,
        op7_quality_model,
        op8_language_id,
        op9_token_counts,
        op10_mix,
        op11_packing,
        op12_token_alignment,
        op13_merkle_manifest,
    )
}

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{1}')"
_INDEX_WORDS = _WORDS.format("coalesce(text, '')", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACE_WORDS = _WORDS.format("coalesce(text, '')", r"[^\x20\x09-\x0D]+")

ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_INDEX_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_INDEX_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS win
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(s) WHERE len(w) >= size),
hits AS (SELECT doc_id, item, s, size FROM dw JOIN bw USING (size, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM hits, unnest(range(s, s + size)) AS u(p) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item) FILTER (WHERE item IS NOT NULL)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op2_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACE_WORDS} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS x
  FROM d, unnest(range(1, greatest(len(w), 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sh AS a JOIN sh AS b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n AS m ON m.doc_id = a JOIN n AS o ON o.doc_id = b WHERE 100 * common >= 80 * (m.n + o.n - common)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)""",
    "op13_merkle_manifest": """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text,
    list_reduce([4294967295::UBIGINT] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT),
      lambda c, x: list_reduce([xor(c, x)] || list_transform(range(8), lambda i: 0::UBIGINT), lambda r, k: xor(r >> 1, 3988292384::UBIGINT * (r & 1::UBIGINT)))) AS r
  FROM documents),
p AS (
  SELECT doc_id, lang, coalesce(xor(r, 4294967295::UBIGINT) % 3 = 0, false) AS tampered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || CASE WHEN tampered THEN coalesce(strlen(low) || ':' || low, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS now FROM p),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM tops WHERE n > 1 GROUP BY level, idx // 8),
low AS (
  SELECT doc_id, leaf, lang, 0 AS level, idx, now AS h, '' AS proof, n FROM placed
  UNION ALL
  SELECT any_value(f.doc_id), f.leaf, f.lang, f.level + 1, any_value(f.idx) // 8, sha256(string_agg(CASE WHEN s.idx = f.idx THEN f.h ELSE s.h END, '' ORDER BY s.idx)),
    any_value(f.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx <> f.idx), ''), (any_value(f.n) + 7) // 8
  FROM low AS f JOIN nodes AS s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.idx // 8 = f.idx // 8 WHERE f.n > 1 GROUP BY f.leaf, f.lang, f.level),
up AS (
  SELECT l.doc_id, l.leaf, 0 AS level, s.idx, l.h, l.proof, s.h AS subroot, s.n FROM low AS l JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM l.lang WHERE l.n = 1
  UNION ALL
  SELECT any_value(f.doc_id), f.leaf, f.level + 1, any_value(f.idx) // 8, sha256(string_agg(CASE WHEN s.idx = f.idx THEN f.h ELSE s.h END, '' ORDER BY s.idx)),
    any_value(f.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx <> f.idx), ''), any_value(f.subroot), (any_value(f.n) + 7) // 8
  FROM up AS f JOIN tops AS s ON s.level = f.level AND s.idx // 8 = f.idx // 8 WHERE f.n > 1 GROUP BY f.leaf, f.level)
SELECT u.doc_id, u.leaf, u.subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.h AS folded_root, u.h = r.h AS verified
FROM up AS u, (SELECT h FROM tops WHERE n = 1) AS r WHERE u.n = 1""",
}
