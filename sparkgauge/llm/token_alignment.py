"""Alignment of two tokenizers' tokens by byte ranges, with corpus-wide counts of id pairs.

Copies of a text have the same tokens, so the texts are shuffled by their full value, each
distinct text is tokenised and aligned once, and its id pairs count as often as the text
occurs. The measures of a text are joined back to its documents on a digest of the text.

Two tokens are linked where their byte ranges overlap. Between neighbouring ends of tokens of
either side lies exactly one link, and offsets where both sides end cut the tokens into groups.
Neither vocabulary has a token across a single space between two words, so both sides end
before it: a text is aligned chunk by chunk, and frequent chunks are tokenised and aligned once.

Defined results
  - null and empty texts, and texts one of the tokenizers does not give back byte by byte (with
    the leading space), have no tokens: zeros and an empty digest; they add nothing to a count;
  - every row counts, repeated rows and null ids too; ids keep their type;
  - strings of special tokens are plain text; long texts are aligned whole;
  - other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkgauge.llm.chunks import REMEMBERED, SLICE_CHARS, Chunks, slices
from sparkgauge.llm.common import discard, small, store
from sparkgauge.llm.token_counts import TOKENIZERS

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Before a space with a word on either side.
CHUNKS = re.compile(r"(?<=\S)(?= \S)")
ALIGNED = "text_key string, copies long, n_a long, n_b long, n_groups long, groups string, pairs array<struct<a:int,b:int,n:long>>"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: ids of texts that begin with a space, bytes of an id."""

    def __init__(self, encode, values: list[bytes]):
        self.encode, self.values = encode, values
        self.sizes = list(map(len, values))

    def gives_back(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.values.__getitem__, ids)) == text.encode()


def byte_side(path: str) -> Side:
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    alphabet = byte_alphabet()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pieces = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    values = [b""] * (max(pieces.values()) + 1)
    for piece, i in pieces.items():
        values[i] = bytes(map(alphabet.__getitem__, piece))

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return Side(encode, values)


def piece_side(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def value(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    # The model adds the space itself.
    return Side(lambda texts: model.encode([t[1:] for t in texts], num_threads=1), [value(i) for i in range(model.get_piece_size())])


def align(ids_a: list[int], ids_b: list[int], sizes_a: list[int], sizes_b: list[int]) -> tuple[int, str, bytes]:
    """Number of groups, groups as `a1,a2|b1;a3|b2,b3`, and the links as packed pairs of ids."""
    links, groups = array("q"), []
    i = j = start_a = start_b = 0
    end_a, end_b = sizes_a[ids_a[0]], sizes_b[ids_b[0]]
    while True:
        links.append(ids_a[i] << 32 | ids_b[j])
        step_a, step_b = end_a <= end_b, end_b <= end_a
        i, j = i + step_a, j + step_b
        if step_a and step_b:
            groups.append(",".join(map(str, ids_a[start_a:i])) + "|" + ",".join(map(str, ids_b[start_b:j])))
            start_a, start_b = i, j
            if i == len(ids_a):
                return len(groups), ";".join(groups), links.tobytes()
        if step_a:
            end_a += sizes_a[ids_a[i]]
        if step_b:
            end_b += sizes_b[ids_b[j]]


NOTHING = (0, 0, 0, "", b"")


@cache
def chunk_alignments(path_a: str, path_b: str) -> Chunks:
    """Chunk -> n_a, n_b, n_groups, groups, links; NOTHING if a side does not give it back. Kept between tasks."""
    a, b = byte_side(path_a), piece_side(path_b)

    def work(chunks: list[str]) -> Iterator[tuple]:
        for chunk, ids_a, ids_b in zip(chunks, a.encode(chunks), b.encode(chunks)):
            if a.gives_back(ids_a, chunk) and b.gives_back(ids_b, chunk):
                yield len(ids_a), len(ids_b), *align(ids_a, ids_b, a.sizes, b.sizes)
            else:
                yield NOTHING

    # An alignment takes more memory than its chunk.
    return Chunks(work, remembered=REMEMBERED // 2)


def alignments(path_a: str, path_b: str, texts: list[str]) -> Iterator[tuple]:
    """Per text: n_a, n_b, n_groups, groups, (packed pairs, links of each)."""
    known = chunk_alignments(path_a, path_b)
    split = [CHUNKS.split(" " + t) for t in texts]
    found = known.values(chain.from_iterable(split))
    for chunks in split:
        parts = list(map(found.__getitem__, chunks))
        # A text has no tokens if any part of it is not given back.
        n_a, n_b, n_groups, groups, links = zip(*([NOTHING] if NOTHING in parts else parts))
        yield sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)


def _align(path_a: str, path_b: str, slice_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k.as_py(), n.as_py(), t.as_py()) for x in batches for k, n, t in zip(*x.columns))
        for part in slices(rows, 2, slice_chars):
            keys, copies, texts = zip(*part)
            n_a, n_b, n_groups, groups, pairs = zip(*alignments(path_a, path_b, texts))
            packed, times = (np.concatenate(x) for x in zip(*pairs))
            ids = [pa.array(x.astype(np.int32)) for x in (packed >> 32, packed & 0xFFFFFFFF)]
            offsets = np.cumsum([0, *(len(x) for x, _ in pairs)]).astype(np.int32)
            struct = pa.StructArray.from_arrays([*ids, pa.array(times.astype(np.int64))], names=["a", "b", "n"])
            columns = [pa.array(keys, pa.string()), *(pa.array(x, pa.int64()) for x in (copies, n_a, n_b, n_groups)), pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), struct)], names=_ALIGNED_NAMES)

    return run


_ALIGNED_NAMES = ["text_key", "copies", "n_a", "n_b", "n_groups", "groups", "pairs"]


def align_texts(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    byte_vocabulary: str = BYTE_VOCABULARY,
    piece_vocabulary: str = PIECE_VOCABULARY,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """Per distinct text: text_key, copies, n_a, n_b, n_groups, groups (as text), pairs (a, b, n links)."""
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = distinct.select(F.sha2("text", 256).alias("text_key"), "copies", "text")
    return rows.mapInArrow(_align(f"{folder}/{byte_vocabulary}", f"{folder}/{piece_vocabulary}", slice_chars), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per id pair: a, b, pair_count (links of all documents), best (the highest count of its b, ties too)."""
    counts = (
        aligned.select("copies", F.inline("pairs"))
        .groupBy("a", "b")
        .agg(F.sum(F.col("n") * F.col("copies")).alias("pair_count"))
    )
    # An id has at most as many partners as the other vocabulary has ids.
    return counts.withColumn("best", F.col("pair_count") == F.max("pair_count").over(Window.partitionBy("b")))


def alignment_measures(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = store(align_texts(docs, **options).withColumn("groups_sha256", digest).drop("groups"), "aligned-texts")
    counts = store(pair_counts(aligned), "pair-counts")
    per_text = ["text_key", "n_a", "n_b", "n_groups", "groups_sha256"]
    links = aligned.select(*per_text, F.inline_outer("pairs")).join(small(counts), ["a", "b"], "left")
    measures = links.groupBy(per_text).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("pair_count")), F.lit(0)).alias("count_sum"),
    )
    # Stored, so that the join below reads both sides from shuffles of its own and can split a hot text.
    measures = store(measures, "text-measures")
    discard(aligned, counts)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = rows.filter("text <> ''").select("doc_id", F.sha2("text", 256).alias("text_key")).join(measures, "text_key")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    none = rows.filter("text IS NULL OR text = ''").select(
        "doc_id", *(F.lit(0).cast("long").alias(n) for n in names), F.lit("").alias("groups_sha256")
    )
    return found.select("doc_id", *names, "groups_sha256").unionByName(none)
