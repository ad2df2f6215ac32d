"""Token counts by a separator scan over flat token files.

Texts are tokenised with a public byte-level vocabulary and written as flat files of 16-bit
token ids, in which an end-of-document id follows every text and nothing says where a text
begins. A file is a row of fixed-size blocks, cut without regard to texts. The scan looks
for the separator in each block with one vectorised comparison and reduces a block to its
separators' positions and the tokens before the first and after the last of them. A prefix
scan over the blocks of a file (two running sums) carries open tails and the number of
earlier texts into every block, so blocks are read in any order and on any executor.

Defined results
  - null and empty texts have 0 tokens; a separator in a text is ordinary text, since
    special strings are not read as such;
  - repeated rows and null ids are counted row by row; empty tables give an empty result;
  - other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkgauge.llm.common import store

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
SEPARATOR = 50_256
BLOCK_TOKENS = 1 << 18
# Fixed value: how a text is cut into pieces before byte pairs are merged.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The tokenizer of a vocabulary file; read on the machine that uses it."""
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


FILE_ROWS = "kind string, file long, at long, doc_id long, tokens binary"


def _files(folder: str, vocabulary: str, block_tokens: int):
    """Texts of a task -> one flat file, as blocks, and the ids in the order of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(folder, vocabulary).encode_ordinary
        file, texts, block, pending = TaskContext.get().partitionId(), 0, 0, np.empty(0, np.uint16)

        def rows(kind: str, at: list[int], ids: list, tokens: list) -> pa.RecordBatch:
            n = len(at)
            columns = [pa.array([kind] * n, pa.string()), pa.array([file] * n, pa.int64()), pa.array(at, pa.int64())]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(ids, pa.int64()), pa.array(tokens, pa.binary())], names=["kind", "file", "at", "doc_id", "tokens"]
            )

        for batch in batches:
            parts = [pending]
            for text in batch.column(1):
                parts.append(np.array(encode(text.as_py() or ""), np.uint16))
                parts.append(np.array([SEPARATOR], np.uint16))
            yield rows("doc", list(range(texts, texts + batch.num_rows)), batch.column(0).to_pylist(), [None] * batch.num_rows)
            texts += batch.num_rows
            pending = np.concatenate(parts)
            full = len(pending) // block_tokens
            for i in range(full):
                yield rows("block", [block], [None], [pending[i * block_tokens : (i + 1) * block_tokens].tobytes()])
                block += 1
            pending = pending[full * block_tokens :]
        if len(pending):
            yield rows("block", [block], [None], [pending.tobytes()])

    return run


def write_token_files(
    docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """Blocks (file, block, tokens) and manifest (file, ordinal, doc_id), stored."""
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) doc_id", "text").mapInArrow(_files(folder, vocabulary, block_tokens), FILE_ROWS)
    stored = store(rows, "token-files")
    blocks = stored.filter("kind = 'block'").select("file", F.col("at").alias("block"), "tokens")
    manifest = stored.filter("kind = 'doc'").select("file", F.col("at").alias("ordinal"), "doc_id")
    return blocks, manifest


def _scan(separator: int):
    """Block -> its size, the number of separators, head and tail, and the lengths between separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, heads, tails, inner = [], [], [], []
            for data in batch.column(2):
                tokens = np.frombuffer(data.as_buffer(), np.uint16)
                found = np.flatnonzero(tokens == separator)
                sizes.append(len(tokens))
                heads.append(int(found[0]) if len(found) else None)
                tails.append(int(len(tokens) - 1 - found[-1]) if len(found) else len(tokens))
                inner.append(np.diff(found) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(heads, pa.int64()),
                    pa.array(tails, pa.int64()),
                    pa.array(inner, pa.list_(pa.int64())),
                ],
                names=["file", "block", "head", "tail", "inner"],
            )

    return run


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Tokens of every text of flat files: file, ordinal (from 0), n_tokens."""
    found = blocks.select("file", "block", "tokens").mapInArrow(
        _scan(separator), "file long, block long, head long, tail long, inner array<bigint>"
    )
    # Blocks of a file in order; a file is what one task wrote, its block rows are small.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    count = F.when(F.col("head").isNull(), 0).otherwise(F.size("inner") + 1)
    stitched = (
        store(found, "block-scan")
        .withColumn("first", F.coalesce(F.sum(count).over(before), F.lit(0)))
        # Blocks since the last one with a separator, that one included, share a number.
        .withColumn("run", F.coalesce(F.sum(F.col("head").isNotNull().cast("long")).over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    )
    open_tail = F.sum("tail").over(Window.partitionBy("file", "run").orderBy("block"))
    carried = F.coalesce(F.lag("open_tail").over(Window.partitionBy("file").orderBy("block")), F.lit(0))
    lengths = F.concat(F.array(F.col("head") + F.col("carried")), F.col("inner"))
    return (
        stitched.withColumn("open_tail", open_tail)
        .withColumn("carried", carried)
        .filter("head IS NOT NULL")
        .select("file", "first", F.posexplode(lengths).alias("i", "n_tokens"))
        .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")
    )


def token_counts(docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document: doc_id, n_tokens."""
    blocks, manifest = write_token_files(docs, folder, vocabulary, block_tokens)
    return manifest.join(count_tokens(blocks), ["file", "ordinal"]).select("doc_id", "n_tokens")
