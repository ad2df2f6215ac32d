"""Harmonic packing of tokenised documents into training sequences.

A piece of n tokens is of class i when i pieces of its length fit into the capacity and
i + 1 do not, so that its length lies between capacity / (i + 1) and capacity / i. A bin of
class i takes exactly i pieces, whatever their lengths, so no bin is ever searched: a worker
keeps one open bin per class and knows nothing of the others. A document is cut so that every
full bin is nearly full: whole capacities first, then, while i pieces of the rest would leave
more than the slack of a bin unused, a piece of exactly capacity / (i + 1). Such cuts leave
a rest of at most capacity / (i * (i + 1)), so a document has at most four of them beyond its whole
capacities. A bin of n pieces cut this way pads at most the slack plus what rounding the
reciprocals costs.

When a worker has no more documents, the pieces of its open bins (less than one bin per
class) are laid end to end in the order of their texts, joined where they were cut, and cut
at the capacity. What remains after the last whole capacity is cut at powers of two, which
need no padding.

Defined results
  - null and empty texts have one token, the end-of-document id, and so one piece;
  - every row is packed, repeated rows and null ids too; ids keep their type;
  - special strings in a text are read as the tokenizer reads them by default;
  - other columns are ignored, whatever their names; an empty table gives an empty result;
  - a worker is a task; sequence ids hold its number, so the ids are unique but not gapless.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from sparkgauge.llm.chunks import REMEMBERED, Chunks, slices
from sparkgauge.llm.token_counts import TOKENIZERS

WORD_VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_OF_DOCUMENT = 1
# Part of a bin that pieces kept whole may leave unused, as its reciprocal.
SLACK = 64
_OUT_PIECES = 1_000


# Chunks of these characters are composed already, and lower case has one character for each.
_SIMPLE = r"^[\x00-\x{12F}\x{131}-\x{2FF}]*$"
_LETTERS_AND_MARK = r"^\pL+[^\pL\pN]$"


@cache
def word_ids(path: str) -> Chunks:
    """Word -> its token ids as little-endian 32-bit numbers; a worker process keeps it between tasks."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole, lowered, letters = (Tokenizer.from_file(path) for _ in range(3))
    lowered.normalizer = letters.normalizer = normalizers.Sequence([])
    letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def of_words(words: list[str]) -> Iterator[bytes]:
        """Simple words are in lower case; letters alone need no splitting either."""
        simple = [w.isascii() or (max(w) < "\u0300" and "\u0130" not in w) for w in words]
        use = [letters if s and w.isalpha() else lowered if s and "<|" not in w else whole for w, s in zip(words, simple)]
        found = {}
        for t in (whole, lowered, letters):
            some = t.encode_batch_fast([w for w, u in zip(words, use) if u is t], add_special_tokens=False)
            found[id(t)] = (array("I", e.ids).tobytes() for e in some)
        return (next(found[id(u)]) for u in use)

    return Chunks(of_words, remembered=REMEMBERED)


def taken(pool: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a pool at these places, end to end, and where each begins and the last ends."""
    n = sizes[at]
    ends = np.cumsum(n)
    places = np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - n), n)
    places += np.arange(len(places))
    return pool[places], np.concatenate([[0], ends])


def encoded(path: str, texts: list[str]) -> Iterator[bytes]:
    """Token ids of texts.

    The vocabulary drops white space: no token reaches over it and normalising composes nothing
    across it, so a text's ids are those of its chunks between ASCII white space. A simple chunk is
    lowered, and a mark after letters is a word of its own. Each distinct word is looked up once; the
    ids of its places are gathered by position.
    """
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    coded = split.flatten().dictionary_encode()
    chunks = coded.dictionary
    simple = pc.and_not(pc.match_substring_regex(chunks, _SIMPLE), pc.match_substring(chunks, "<|"))
    chunks = pc.if_else(simple, pc.utf8_lower(chunks), chunks)
    marked = pc.and_(simple, pc.match_substring_regex(chunks, _LETTERS_AND_MARK))
    stems = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
    marks = pc.utf8_slice_codeunits(chunks.filter(marked), -1)
    words = pa.chunked_array([stems, marks]).combine_chunks().dictionary_encode()

    found = word_ids(path).each(words.dictionary.to_pylist())
    pool = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    numbers, marked = words.indices.to_numpy(), marked.to_numpy(zero_copy_only=False)
    last = np.cumsum(1 + marked)  # where the words of a chunk end
    in_order = np.empty(len(numbers), numbers.dtype)
    in_order[last - 1 - marked] = numbers[: len(chunks)]
    in_order[last[marked] - 1] = numbers[len(chunks) :]
    pool, borders = taken(pool, sizes, in_order)
    ids, borders = taken(pool, np.diff(borders[np.concatenate([[0], last])]), coded.indices.to_numpy())
    ends = borders[split.offsets.to_numpy()].tolist()
    return (ids[a:b].tobytes() for a, b in zip(ends, ends[1:]))


class Piece(NamedTuple):
    serial: int
    start: int
    tokens: bytes
    doc: tuple


def cuts(n: int, capacity: int, slack: int) -> Iterator[int]:
    """Lengths of the pieces of n tokens."""
    while n >= capacity:
        yield capacity
        n -= capacity
    while n:
        fits = capacity // n
        piece = n if capacity - fits * n <= capacity // slack else capacity // (fits + 1)
        yield piece
        n -= piece


def joined(pieces: list[Piece]) -> Iterator[Piece]:
    """Pieces in the order of their texts; neighbours of a text become one."""
    last = None
    for p in sorted(pieces):
        if last and last.serial == p.serial and last.start + len(last.tokens) // 4 == p.start:
            last = last._replace(tokens=last.tokens + p.tokens)
        else:
            if last:
                yield last
            last = p
    if last:
        yield last


def end_to_end(pieces: list[Piece], capacity: int) -> Iterator[list[Piece]]:
    """Bins of the capacity, then bins whose sizes are powers of two."""
    pieces = list(joined(pieces))
    left = sum(len(p.tokens) // 4 for p in pieces)
    held, room, bin_ = left, 0, []
    for p in pieces:
        at, n = 0, len(p.tokens) // 4
        while at < n:
            if not room:
                room = capacity if held >= capacity else 1 << (held.bit_length() - 1)
                held -= room
            take = min(room, n - at)
            bin_.append(Piece(p.serial, p.start + at, p.tokens[4 * at : 4 * (at + take)], p.doc))
            at, room = at + take, room - take
            if not room:
                yield bin_
                bin_ = []


def _pack(path: str, capacity: int, slack: int, end: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = np.array([end], "<u4").tobytes()
        sequence = count(TaskContext.get().partitionId() << 40)
        open_bins: dict[int, list[Piece]] = {}
        rows: list[tuple] = []

        def close(bin_: list[Piece], per_bin: int) -> None:
            number, offset = next(sequence), 0
            for p in bin_:
                n = len(p.tokens) // 4
                rows.append((p.doc[0], p.start, n, p.doc[1], number, offset, per_bin, p.tokens))
                offset += n

        def flush() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            out = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names=_NAMES)

        texts = ((d.as_py(), t.as_py() or "") for b in batches for d, t in zip(b.column(0), b.column(1)))
        serial = 0
        for part in slices(texts, 1):
            for (doc_id, _), ids in zip(part, encoded(path, [t for _, t in part])):
                tokens = ids + ending
                doc, at = (doc_id, len(tokens) // 4), 0
                for n in cuts(doc[1], capacity, slack):
                    per_bin = capacity // n
                    bin_ = open_bins.setdefault(per_bin, [])
                    bin_.append(Piece(serial, at, tokens[4 * at : 4 * (at + n)], doc))
                    at += n
                    if len(bin_) == per_bin:
                        close(open_bins.pop(per_bin), per_bin)
                serial += 1
                if len(rows) >= _OUT_PIECES:
                    yield flush()
        for bin_ in end_to_end([p for b in open_bins.values() for p in b], capacity):
            close(bin_, 0)
        if rows:
            yield flush()

    return run


_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "per_bin", "tokens"]


def pack(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    vocabulary: str = WORD_VOCABULARY,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    end: int = END_OF_DOCUMENT,
) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, per_bin, tokens.

    per_bin is the fixed count of its bin (0: from the open bins laid end to end); tokens are
    little-endian 32-bit ids.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType
    fields = [StructField(n, LongType()) for n in _NAMES[1:6]]
    schema = StructType([StructField("doc_id", id_type), *fields, StructField("per_bin", IntegerType()), StructField("tokens", BinaryType())])
    return rows.mapInArrow(_pack(f"{folder}/{vocabulary}", capacity, slack, end, to_arrow_type(id_type)), schema)


def packed_digests(docs: DataFrame, **options) -> DataFrame:
    """The pieces with a checksum in place of their tokens."""
    return pack(docs, **options).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")
