"""Near-duplicate groups by HyperMinHash.

Sketch: every shingle of a text is hashed once; the first bits choose one of 256 buckets,
and each bucket keeps the smallest rest of the hash, compressed to its number of leading
zeros (6 bits) and the 9 mantissa bits after them. A bucket without a shingle borrows the
register of another by a fixed random order and carries a flag, so short texts band like
long ones. Runs of 6 registers make 42 bands; texts that agree in a band are candidates
(a pair at similarity 0.8 is missed with a probability of 3 in a million).

Links: equal sets are one node from the start, found by a digest of the whole set. Within a
band's bucket no all-pairs list is made: each round picks hub nodes in every bucket that
still holds more than one component and meets the other components' nodes with the hubs. A
pair whose set sizes or odd sketches rule the threshold out is not formed. (The odd sketch
has 1024 bits, each the parity of the shingles that hash to it; bits that differ between two
texts are never more than the shingles only one of them has, so this loses no link. It
ends the pairs of copies that are all close to one text but not to each other.) Of the rest,
those whose collision-corrected estimate is far below the threshold are dropped, and the
others are confirmed on the full sets. Then components are joined by the links between them, and
hubs, whose pairs are all settled, leave the bucket. Buckets of one component (copies, however
many) are finished after the first round; the others get GROWTH times as many hubs each round,
and one that has no more rows than that makes hubs of all of them and is finished too.

Defined results
  - null, empty or blank texts have an empty set, are linked with nothing and kept;
  - texts with fewer words than a shingle have one, the whole sequence;
  - rows with equal sets are linked; repeated ids keep their own rows; the component is
    named by the smallest id that is not null; a row without an id is kept only if its
    component has no id;
  - empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.llm.common import discard, free_name, packed, small, store
from sparkgauge.llm.components import components
from sparkgauge.llm.shingles import ascii_words, shingle_set, word_hasher

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
MANTISSA_BITS = 9
BORROW_TRIES = 64
# Share of registers of two unequal sets that agree by chance of the compression.
COLLISION = 0.169919487159739 * 2 / (1 << MANTISSA_BITS)
# An estimate drops a pair if it is so many standard deviations below the threshold.
SIGMAS = 6
# Hubs per bucket grow by this factor each round.
GROWTH = 64
# Pairs with sketches or sets that a partition holds at least, where their number bounds the partitions.
PART_PAIRS = 2_000

ODD_BITS = 10
ODD = [f"s{i}" for i in range((1 << ODD_BITS) // 64)]
SKETCH = "doc_id long, h long, n long, digest binary, sketch binary, " + ", ".join(f"{c} long" for c in ODD)


def _borrow_order() -> np.ndarray:
    """For every try and bucket, the bucket to borrow from; then the next ones in a circle."""
    rng = np.random.RandomState(20240229)
    tries = rng.randint(0, BUCKETS, (BORROW_TRIES, BUCKETS))
    circle = (np.arange(BUCKETS)[None, :] + np.arange(1, BUCKETS)[:, None]) % BUCKETS
    return np.concatenate([tries, circle])


def registers(shingles: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The compressed, filled-up sketch of a sorted, non-empty set: 256 numbers of 16 bits."""
    starts = np.searchsorted(shingles, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
    first = shingles[np.minimum(starts, len(shingles) - 1)]
    full = (first >> np.uint64(64 - BUCKET_BITS) == np.arange(BUCKETS, dtype=np.uint64)) & (starts < len(shingles))
    rest = ((first << np.uint64(BUCKET_BITS)) >> np.uint64(11)).astype(np.float64)
    mantissa, exponent = np.frexp(rest)
    zeros = np.where(rest > 0, 53 - exponent, 53).astype(np.uint16)
    bits = ((np.maximum(mantissa, 0.5) * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.uint16)
    values = (zeros << np.uint16(MANTISSA_BITS)) | bits
    if not full.all():
        open_ = np.flatnonzero(~full)
        for row in order:
            source = row[open_]
            ok = full[source]
            values[open_[ok]] = values[source[ok]] | np.uint16(0x8000)
            open_ = open_[~ok]
            if not len(open_):
                break
    return values


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per bit, as 64-bit numbers."""
    place = ((shingles * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - ODD_BITS)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=1 << ODD_BITS) & 1).astype(np.uint8)).view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, hashes = _borrow_order(), word_hasher()
        for batch in batches:
            n, digests, sketches, odd = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(hashes(ascii_words(text.as_py())), size)
                n.append(len(s))
                digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append(registers(s, order).tobytes() if len(s) else None)
                odd.append(odd_sketch(s))
            odd = np.array(odd, np.int64).reshape(len(n), len(ODD))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()),
                    *[pa.array(odd[:, i]) for i in range(len(ODD))],
                ],
                names=["doc_id", "h", "n", "digest", "sketch", *ODD],
            )

    return run


def _sets(size: int):
    """Full sets of the texts asked for: node, digest asked for, text -> node, set (where the digest is the text's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hasher()
        for batch in batches:
            nodes, sets = [], []
            for node, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = shingle_set(hashes(ascii_words(text)), size).tobytes()
                if blake2b(data, digest_size=16).digest() == digest:
                    nodes.append(node)
                    sets.append(data)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def estimate(x: np.ndarray, y: np.ndarray) -> tuple[float, int]:
    """Similarity from two sketches, corrected for chance agreement, and the registers it rests on."""
    own = ((x & 0x8000) == 0) | ((y & 0x8000) == 0)
    filled = int(own.sum())
    equal = int(((x == y) & own).sum()) / max(filled, 1)
    return max(0.0, (equal - COLLISION) / (1 - COLLISION)), filled


def _promising(threshold: float):
    """Pairs a, b, components p, q, sketches -> the pairs worth a full comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                similarity, filled = estimate(np.frombuffer(x.as_py(), np.uint16), np.frombuffer(y.as_py(), np.uint16))
                keep.append(similarity >= threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / max(filled, 1)))
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(percent: int):
    """Pairs a, b, components p, q, full sets -> the pairs with 100 * common >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible(x: str, y: str, threshold: float) -> Column:
    """Whether two nodes can be similar enough, by their set sizes and odd sketches; true for all that are."""
    less, more = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ODD), F.lit(0))
    return (less >= threshold * more - 1e-9) & (apart <= (1 - threshold) / (1 + threshold) * (less + more) + 1e-9)


def _pairs(members: DataFrame, hubs: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of hubs and nodes of other components in the same bucket; the rows but the hubs' own.

    A pair is a, b (nodes, the larger first) and p, q (their components). Hubs are the nodes that
    share most buckets with others: in a group of copies of one text that is the text they were
    made from, which is closer to each of them than they are to each other, so one round joins
    them. A bucket has at most so many hubs as asked for; all rows are, if they are no more.
    """
    own = ["node", "component", "n", *ODD]
    part = F.when(F.col("rows") <= hubs, F.col("node")).otherwise(F.pmod(F.xxhash64("node"), F.lit(hubs)))
    chosen = members.groupBy("key", part.alias("part")).agg(F.max(F.struct("weight", *own)).alias("hub")).select("key", "hub.*")
    met = members.alias("x").join(
        chosen.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & _possible("x", "y", threshold),
    )
    sides = [F.struct(F.col(f"{s}.node"), F.col(f"{s}.component")) for s in "xy"]
    met = met.select(F.greatest(*sides).alias("x"), F.least(*sides).alias("y"))
    pairs = met.selectExpr("x.node AS a", "y.node AS b", "x.component AS p", "y.component AS q").distinct()
    rest = members.join(chosen.select("key", "node"), ["key", "node"], "left_anti")
    return pairs, rest


def _open_buckets(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with the number of rows of their bucket."""
    several = (
        members.groupBy("key")
        .agg(F.min("component").alias("l"), F.max("component").alias("m"), F.count(F.lit(1)).alias("rows"))
        .filter("l < m")
        .select("key", "rows")
    )
    return store(members.join(several, "key"), "bands")


def _described(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of open buckets with what the join of hubs needs of their nodes.

    The weight of a node is the number of rows it shares buckets with.
    """
    known = nodes.select("node", "n", *ODD).join(shared.groupBy("node").agg(F.sum("rows").alias("weight")), "node")
    return store(shared.join(known, "node"), "bands")


def _renamed(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
    """The rows with the component that theirs (components' names being nodes) has been joined to."""
    if joined is None:
        return rows
    new = joined.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    return rows.join(small(new), "component", "left").withColumn("component", F.coalesce("_new", "component")).drop("_new")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, h (hash of the text), n_shingles, component_id, kept."""
    percent = round(threshold * 100)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    hashed = texts.select("doc_id", "text", F.xxhash64("text").alias("h"))
    sketched = hashed.select("doc_id", "text", "h").mapInArrow(_sketches(shingle_words), SKETCH)
    sketches = store(sketched.withColumn("uid", F.monotonically_increasing_id()), "sketches")

    # One node per distinct set: its smallest row number; rep is the smallest id of its rows.
    classes = sketches.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("uid").alias("node"), F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    classes = store(classes, "classes")
    nodes = sketches.drop("doc_id").withColumnRenamed("uid", "node").join(classes.select("node"), "node", "left_semi")
    nodes = store(nodes, "nodes")

    parts = [F.substring("sketch", 2 * BAND_ROWS * i + 1, 2 * BAND_ROWS) for i in range(BANDS)]
    bands = nodes.select("node", F.posexplode(F.array(*parts)).alias("i", "part"))
    members = store(bands.select(F.xxhash64("i", "part").alias("key"), "node", F.col("node").alias("component")), "bands")

    shared = _open_buckets(members)
    discard(members)
    members = _described(shared, nodes)
    discard(shared)
    labels, sets, hubs = None, None, 1
    while not members.isEmpty():
        pairs, rest = _pairs(members, hubs, threshold)
        links, sets = _verified(store(pairs, "pairs"), nodes, hashed, sets, shingle_words, threshold, percent)
        joined = None
        if not links.isEmpty():
            joined = store(components(links.select(F.col("p").alias("a"), F.col("q").alias("b"))), "components")
            if labels is None:
                labels = joined
            else:
                alone = joined.join(labels.select("node"), "node", "left_anti")
                last, labels = labels, store(_renamed(labels, joined).select("node", "component").unionByName(alone), "components")
                discard(last)
        last, members = members, store(_renamed(rest, joined).drop("rows"), "bands")
        discard(last)
        last, members = members, _open_buckets(members)
        discard(last)
        hubs *= GROWTH

    groups = classes.select("digest", "node", "rep", "rows")
    if labels is None:
        named = groups.filter("rows > 1").select("digest", F.col("rep").alias("component_id"))
    else:
        grouped = groups.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        smallest = grouped.groupBy("component").agg(F.min("rep").alias("component_id"), F.sum("rows").alias("n"))
        named = grouped.join(smallest.filter("n > 1").select("component", "component_id"), "component").select("digest", "component_id")
    named = named.withColumn("_named", F.lit(True))
    component = F.when(F.col("_named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        sketches.select("doc_id", "h", "n", "digest")
        .join(named, "digest", "left")
        .select("doc_id", "h", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _with_sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, sets: DataFrame | None, size: int) -> DataFrame:
    """The full sets read so far and those of the wanted nodes: node, shingles."""
    if sets is not None:
        wanted = wanted.join(sets.select("node"), "node", "left_anti")
    asked = store(nodes.select("node", "digest", "h").join(wanted, "node", "left_semi"), "asked")
    n = asked.count()
    if sets is not None and not n:
        return sets
    full = (
        texts.select("h", "text")
        .join(small(asked), "h")
        .select("node", "digest", "text")
        .mapInArrow(_sets(size), "node long, shingles binary")
        .dropDuplicates(["node"])
    )
    full = store(packed(full, n, PART_PAIRS), "sets")
    discard(asked)
    return full if sets is None else sets.unionByName(full)


def _verified(
    pairs: DataFrame, nodes: DataFrame, texts: DataFrame, sets: DataFrame | None, size: int, threshold: float, percent: int
) -> tuple[DataFrame, DataFrame]:
    """The pairs whose full sets are similar enough (a, b, p, q); all full sets read so far (node, shingles)."""
    names, kept = ["a", "b", "p", "q"], "a long, b long, p long, q long"
    sketch, n = nodes.select("node", "sketch"), pairs.count()
    compared = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b").select(*names, "x", "y")
    likely = store(packed(compared, n, PART_PAIRS).mapInArrow(_promising(threshold), kept), "likely")
    sets = _with_sets(likely.select("a").union(likely.select("b")).distinct().toDF("node"), nodes, texts, sets, size)
    both = likely.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select(*names, "x", "y")
    links = store(packed(both, n, PART_PAIRS).mapInArrow(_confirmed(percent), kept), "links")
    discard(pairs, likely)
    return links, sets


def without_copies(docs: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each group of near duplicates (that with the smallest id), with all columns.

    Of rows equal in id and text one stays. Rows of a group that share its smallest id and differ in
    text all stay.
    """
    verdicts = near_duplicates(docs, shingle_words, threshold)
    gone = verdicts.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    # Rows equal in id and text: few, so only they are shuffled with their texts.
    i, h = free_name("_id", docs.columns), free_name("_h", docs.columns)
    several = verdicts.filter("kept AND n_shingles > 0").groupBy(F.col("doc_id").alias(i), F.col("h").alias(h)).agg(F.count(F.lit(1)).alias("_n"))
    several = store(several.filter("_n > 1").drop("_n"), "equal-rows")
    left = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["_h"]), "left_anti")
    if several.isEmpty():
        return left
    same = left["doc_id"].cast("long").eqNullSafe(several[i]) & (F.xxhash64(left["text"]) == several[h])
    one = left.join(several, same).dropDuplicates([i, h]).select(*[left[c] for c in docs.columns])
    return left.join(several, same, "left_anti").unionByName(one)
