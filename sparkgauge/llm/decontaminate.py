"""Benchmark decontamination by a positional inverted index (DataFrame functions only).

The index is a stored table of postings (document, term, position). A test item is cut
into windows of consecutive terms. For every window the corpus counts name its rarest
terms: the postings of the rarest are read first and shifted by the term's offset, which
gives candidate alignments of item and document; these are intersected with the shifted
postings of the second rarest, and what is left with those of all other terms. Nothing is
grouped by term, so a word that a third of the corpus consists of is no hot key.

Defined results
  - null or wordless texts have no words, no postings and no hits (n_words 0);
  - items without words never occur; items with equal ids count once per id; what an item
    without an id covers is hit, but the item is not named or counted;
  - repeated documents, equal ids with different texts and null ids give one row each;
  - empty tables give an empty result, or documents without hits;
  - other columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.llm.common import ascii_lower, small, store

# Fixed value: what a word consists of, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

# No id has this value; it stands for a null id inside the index, where ids are join keys.
NO_ID = -(2**63)
# The empty term marks the end of a document; its position is the number of words.
END = ""

DOC = ["id", "h"]
# An item's id as a join key: a mark for null, else the id behind another mark.
ITEM = ["item", "ih"]
UNNAMED = "-"


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct item and word: item, ih, m (words of the item), j (offset), term."""
    return (
        items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
        .withColumn("item", F.coalesce(F.concat(F.lit("+"), "item_id"), F.lit(UNNAMED)))
        .select("item", F.xxhash64("text").alias("ih"), words(F.col("text")).alias("w"))
        .dropDuplicates(ITEM)
        .select(*ITEM, F.size("w").alias("m"), F.posexplode("w").alias("j", "term"))
    )


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (id, h, term, pos) of the documents, stored; h tells texts of equal ids apart.

    With a vocabulary (column term) only its terms are kept, besides the end marks.
    """
    postings = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.col(id_col).isNull(), F.col(text_col)).alias("h"),
        F.posexplode(F.concat(words(F.col(text_col)), F.array(F.lit(END)))).alias("pos", "term"),
    )
    if vocabulary is not None:
        ends = vocabulary.sparkSession.range(1).select(F.lit(END).alias("term"))
        terms = vocabulary.select("term").filter(F.col("term") != END).distinct().unionByName(ends)
        postings = postings.join(small(store(terms, "vocabulary")), "term")
    return store(postings.select("id", "h", "term", "pos"), "postings")


def window_terms(terms: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """Rarest and second rarest term of every window whose terms all occur in the index.

    Columns: item, m, j1, term1, j2, term2 (null for windows of one term); one row for all
    windows that share them.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    starts = terms.withColumn("size", F.least("m", F.lit(window))).withColumn(
        "s",
        F.explode(F.sequence(F.greatest(F.col("j") - F.col("size") + 1, F.lit(0)), F.least(F.col("j"), F.col("m") - F.col("size")))),
    )
    ranked = (
        starts.join(counts, "term")
        .groupBy(*ITEM, "m", "s", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "j", "term"))).alias("t"))
        .filter(F.size("t") == F.col("size"))
    )
    first, second = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    return ranked.select(
        *ITEM, "m", first["j"].alias("j1"), first["term"].alias("term1"), second["j"].alias("j2"), second["term"].alias("term2")
    ).distinct()


def _near(position: Column, slack: int) -> Column:
    """The position itself, or all positions up to slack away."""
    return F.explode(F.sequence(position - slack, position + slack)) if slack else position


def matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0, **columns) -> DataFrame:
    """Occurrences of item windows: id, h, item_id, covered (document positions, ascending).

    slack 0 finds exact phrases. With more, every term may stand up to slack words away from
    where the rarest term of its window puts it (a proximity match).
    """
    terms = store(item_terms(items, **columns), "item-terms")
    return _matches(index, terms, window, slack)


def _matches(index: DataFrame, terms: DataFrame, window: int, slack: int) -> DataFrame:
    rare = store(window_terms(terms, index, window), "window-terms")

    # Postings of the rarest terms, shifted to where the item would begin.
    anchors = rare.select(*ITEM, "j1", F.col("term1").alias("term")).distinct()
    begun = index.join(small(anchors), "term").select(*DOC, *ITEM, "j1", (F.col("pos") - F.col("j1")).alias("base"))

    # Intersection with the postings of the second rarest terms.
    seconds = rare.filter("j2 IS NOT NULL").select(*ITEM, "j1", "j2", F.col("term2").alias("term")).distinct()
    wanted = begun.join(small(seconds), [*ITEM, "j1"]).select(
        *DOC, *ITEM, "base", "term", _near(F.col("base") + F.col("j2"), slack).alias("pos")
    )
    lists = index.join(small(seconds.select("term").distinct()), "term", "left_semi")
    single = begun.join(small(rare.filter("j2 IS NULL").select(*ITEM, "j1")), [*ITEM, "j1"], "left_semi").select(*DOC, *ITEM, "base")
    left = store(
        wanted.join(lists, [*DOC, "pos", "term"]).select(*DOC, *ITEM, "base").unionByName(single).distinct(), "alignments"
    )

    # Intersection with the postings of all terms, in the documents that are left.
    lists = index.join(small(left.select(*DOC).distinct()), DOC, "left_semi")
    found = (
        left.join(small(terms), ITEM)
        .select(*DOC, *ITEM, "m", "base", "j", "term", _near(F.col("base") + F.col("j"), slack).alias("pos"))
        .join(lists, [*DOC, "pos", "term"])
        .groupBy(*DOC, *ITEM, "m", "base")
        .agg(F.sort_array(F.collect_set("j")).alias("js"), F.collect_set(F.struct("j", "pos")).alias("at"))
    )
    size = F.least(F.col("m"), F.lit(window))
    starts = F.filter("js", lambda j, i: F.get(F.col("js"), i + size - 1) == j + size - 1)
    inside = F.filter(
        "at", lambda p: F.exists("starts", lambda s: (p["j"] >= s) & (p["j"] < s + F.least(F.col("m"), F.lit(window))))
    )
    return (
        found.withColumn("starts", starts)
        .filter(F.size("starts") > 0)
        .select(*DOC, F.expr(f"CASE WHEN item <> '{UNNAMED}' THEN substr(item, 2) END AS item_id"), F.array_sort(F.transform(inside, lambda p: p["pos"])).alias("covered"))
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, h, n_words, n_hit, n_items, items_sha256, contaminated."""
    terms = store(item_terms(items), "item-terms")
    index = build_index(docs, terms.select("term"), id_col, text_col)
    hits = (
        _matches(index, terms, window, slack)
        .select(*DOC, "item_id", F.explode("covered").alias("pos"))
        .groupBy(*DOC)
        .agg(
            F.count_distinct("pos").alias("n_hit"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
    )
    ends = index.filter(F.col("term") == END).select(*DOC, F.col("pos").cast("long").alias("n_words"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return ends.join(hits, DOC, "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "h",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_of), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that contain no window of any item, with all their columns."""
    verdicts = decontaminate(docs, items, window)
    bad = verdicts.filter("contaminated").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("h").alias("_h")).distinct()
    return docs.join(
        bad,
        (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == bad["_id"]) & (F.xxhash64(docs["doc_id"].isNull(), docs["text"]) == bad["_h"]),
        "left_anti",
    )
