"""Quality classifier: a factorisation machine over hashed words, structure and metadata of a text.

Features of a text: its hashed words (log counts, length 1 together), structure statistics
(shares of symbols, capitals, marks, repeated word runs, line lengths; each as the indicator
of its bin) and metadata of the text itself (bins of its number of words, characters and
lines). The model is a bias, a weight per feature and a vector of FACTORS numbers per
feature; pairwise interactions are scored in linear time by the identity

    sum over i<j of <v_i, v_j> x_i x_j = 1/2 sum over f of [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

Training reads at most SAMPLE_ROWS labelled rows, spread over all by a hash of the id, as
feature lists made on the executors. Scoring is one pass over Arrow batches.

Defined results
  - null, empty and blank texts have the features of an empty text and a score like others;
  - rows with a null id are not held out; labels without a text, null labels and labels of
    held-out rows are not learned from; an id labelled 0 and 1 is learned as both;
  - without any label, or with one class only, the score is the share of ones (0.5 without
    labels); empty tables give an empty result; repeated rows are scored row by row;
  - other columns are ignored, whatever their names; lang, source and ids are no features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.llm.common import free_name
from sparkgauge.llm.shingles import mix64, word_hasher

WORD_BITS = 15
FACTORS = 8
SAMPLE_ROWS = 6_000
EPOCHS = 12
BATCH = 64
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.7
HOLD_OUT = (4, 2)  # rows with crc32(id) mod 4 = 2 are held out

# Lower ends of the bins of every statistic.
_SHARE = (0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
_SIZE = (1, 5, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000)
_LENGTH = (2, 3, 4, 5, 6, 7, 8, 10, 15, 30, 100)
STATISTICS = (
    ("symbols", _SHARE),
    ("capitals", _SHARE),
    ("exclamations", _SHARE),
    ("bars", _SHARE),
    ("digits", _SHARE),
    ("marks", _SHARE),
    ("repeated_runs", _SHARE),
    ("repeated_words", _SHARE),
    ("repeated_lines", _SHARE),
    ("word_length", _LENGTH),
    ("line_words", _SIZE),
    ("words", _SIZE),
    ("characters", _SIZE),
    ("lines", _SIZE),
)
_STEPS = max(len(b) for _, b in STATISTICS) + 1
FEATURES = (1 << WORD_BITS) + len(STATISTICS) * _STEPS

_SYMBOL_BYTES = b"#*$%&|<>"
_MARK_BYTES = b".,;:!?"


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def statistics(text: str, words: list[bytes], hashes: np.ndarray) -> list[float]:
    """Values of STATISTICS for a text with its lower-cased words and their hashes."""
    data = text.encode("utf-8", "surrogatepass")
    n, size = len(words), len(data) - len(words) + 1
    count = lambda chars: len(data) - len(data.translate(None, chars))
    capitals = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    lines = [x for x in text.split("\n") if x.strip()]
    runs = mix64(mix64(hashes[:-2]) + hashes[1:-1]) + hashes[2:] if n > 2 else np.empty(0, np.uint64)
    letters = len(data) - count(b" \t\n\r\x0b\x0c")
    return [
        _share(count(_SYMBOL_BYTES), size),
        _share(capitals, size),
        _share(count(b"!"), size),
        _share(count(b"|"), n),
        _share(count(b"0123456789"), size),
        _share(count(_MARK_BYTES), size),
        1 - _share(len(np.unique(runs)), len(runs)) if len(runs) else 0.0,
        _share(int((hashes[1:] == hashes[:-1]).sum()), n - 1) if n > 1 else 0.0,
        1 - _share(len(set(lines)), len(lines)) if lines else 0.0,
        _share(letters, n),
        _share(n, len(lines)),
        float(n),
        float(len(text)),
        float(len(lines)),
    ]


def features(text: str | None, hasher) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = hasher(words)
    ids, counts = np.unique((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32), return_counts=True)
    values = np.log1p(counts).astype(np.float32)
    values /= max(float(np.sqrt((values * values).sum())), 1e-9)
    bins = [int(np.searchsorted(b, v, side="right")) for (_, b), v in zip(STATISTICS, statistics(text, words, hashes), strict=True)]
    own = np.arange(len(bins), dtype=np.int32) * _STEPS + np.array(bins, np.int32) + (1 << WORD_BITS)
    weight = np.full(len(bins), 1 / np.sqrt(len(bins)), np.float32)
    return np.concatenate([ids, own]), np.concatenate([values, weight])


class FactorisationMachine:
    """Bias, weights and factors; plain arrays, so it travels to the executors as it is."""

    def __init__(self, bias: float = 0.0) -> None:
        rng = np.random.RandomState(7)
        self.bias = bias
        self.weights = np.zeros(FEATURES, np.float32)
        self.factors = (rng.standard_normal((FEATURES, FACTORS)) * 0.01).astype(np.float32)

    def margins(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Raw scores of many texts; text i has the features from starts[i] on (none is empty)."""
        linear = np.add.reduceat(self.weights[ids] * values, starts)
        vx = self.factors[ids] * values[:, None]
        total = np.add.reduceat(vx, starts)
        return self.bias + linear + 0.5 * ((total * total) - np.add.reduceat(vx * vx, starts)).sum(axis=1)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """Adagrad on the logistic loss, in a fixed random order; both classes weigh the same."""
        rng = np.random.RandomState(11)
        g_bias, g_w, g_v = 1e-6, np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, FACTORS), 1e-6, np.float32)
        class_weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                part = order[at : at + BATCH]
                ids = np.concatenate([rows[i][0] for i in part])
                x = np.concatenate([rows[i][1] for i in part])
                sizes = np.array([len(rows[i][0]) for i in part])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                vx = self.factors[ids] * x[:, None]
                total = np.add.reduceat(vx, starts)
                margin = self.margins(ids, x, starts)
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]) * class_weight[part] / len(part)
                each = np.repeat(error, sizes).astype(np.float32)
                d_w = each * x
                d_v = d_w[:, None] * (np.repeat(total, sizes, axis=0) - vx)
                own, where = np.unique(ids, return_inverse=True)
                s_w = np.bincount(where, d_w, len(own)).astype(np.float32) + DECAY * self.weights[own]
                s_v = np.zeros((len(own), FACTORS), np.float32)
                np.add.at(s_v, where, d_v)
                s_v += DECAY * self.factors[own]
                g_w[own] += s_w**2
                g_v[own] += s_v**2
                self.weights[own] -= RATE * s_w / np.sqrt(g_w[own])
                self.factors[own] -= RATE * s_v / np.sqrt(g_v[own])
                d_b = float(error.sum())
                g_bias += d_b**2
                self.bias -= RATE * d_b / g_bias**0.5


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % HOLD_OUT[0] == HOLD_OUT[1], F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = word_hasher()
    for batch in batches:
        both = [features(x.as_py(), hasher) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1),
                pa.array([i.tobytes() for i, _ in both], pa.binary()),
                pa.array([v.tobytes() for _, v in both], pa.binary()),
                batch.column(2),
            ],
            names=["label", "ids", "x", "place"],
        )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fit on at most sample_rows labelled rows: those with the smallest hashes of the id, whatever the task order."""
    marks = labels.select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).cast("int").alias("label")).filter(
        F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("_id"))
    )
    place = [F.xxhash64("_id"), F.col("_id"), F.col("label")]
    chosen = marks.distinct().orderBy(*place).limit(sample_rows)
    data = (
        docs.select(F.col("doc_id").alias("_id"), "text")
        .join(chosen, "_id")
        .select("text", "label", F.xxhash64("_id").alias("place"))
        .mapInArrow(_featured, "label int, ids binary, x binary, place long")
        # An id may have several texts; the bound holds for them too.
        .orderBy("place", "ids", "x", "label")
        .limit(sample_rows)
        .collect()
    )
    y = np.array([r[0] for r in data], np.float64)
    model = FactorisationMachine()
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        model.factors[:] = 0
        model.bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return model
    # The order of collected rows is not fixed; the training order must be.
    packed = sorted(zip(data, y, strict=True), key=lambda r: (bytes(r[0][1]), bytes(r[0][2]), r[1]))
    model.fit([(np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.float32)) for r, _ in packed], np.array([l for _, l in packed]))
    return model


def score(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents (all columns) with the score of their text."""
    columns = [c for c in docs.columns if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = word_hasher()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            both = [features(x.as_py(), hasher) for x in batch.column(at)]
            starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in both])[:-1]])
            margin = shared.value.margins(np.concatenate([i for i, _ in both]), np.concatenate([v for _, v in both]), starts)
            scores = 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*columns, name])

    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{name}` double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier accepts, with all their columns."""
    model = train(docs, labels)
    own = free_name("_score", docs.columns)
    return score(docs, model, name=own).filter(F.col(own) >= threshold).drop(own)
