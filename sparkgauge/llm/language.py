"""Language identification by hierarchical discrimination.

A text is the mean of hashed runs of one to four bytes of its lower-cased letters. Linear
support vector machines first choose the language family (one against the rest), then,
within the family, one machine per pair of languages votes; the sum of margins decides
equal votes. Families of known languages are fixed values; any other label is a family of
its own. Training reads at most SAMPLE_ROWS texts per language, spread by a hash of the id.

The machines always choose one of the learned languages, so the filter (in_languages) also
asks whether a text is like that language at all: the mean logarithm of the frequencies its
runs have in the language must reach what all but LOST_SHARE of the labelled texts of about
its length reach, each measured against the frequencies of the others.

Defined results
  - null texts and texts without a letter are `und` with score 0;
  - with one learned language every text with a letter gets it, with score 1; with none
    every text is `und`;
  - the filter keeps every document if nothing is learned; it does not ask for likeness where
    fewer than FIT_ROWS texts of a language are labelled, or fewer than FIT_LEAST in all;
  - rows with a null id are not held out; rows without a language are not learned from;
    repeated rows are judged row by row; empty tables give an empty result;
  - other columns are ignored, whatever their names; lang, source and ids are no input of a
    prediction.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.llm.common import free_name

UNKNOWN = "und"
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
RUNS = (1, 2, 3, 4)
SAMPLE_ROWS = 400
HOLD_OUT = (5, 0)  # rows with crc32(id) mod 5 = 0 are held out
FIT_ROWS = 20
FIT_LEAST = 100
FIT_GROUP = 400  # labelled texts of about the same length that set a least likeness
LOST_SHARE = 0.005
FIT_SLACK = 0.3  # below the least likeness, for texts that are not among the labelled ones
EPOCHS = 30
RATE = 2.0
DECAY = 1e-4
SCALE = 30.0  # a row of mean frequencies is put on a scale of about 1

# Families of languages by code.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is lb fy yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk tt".split(),
    "indic": "hi ur bn pa gu mr ne si".split(),
    "semitic": "ar he mt am".split(),
    "sinitic": "zh yue wuu".split(),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(rb"[\x00-\x60\x7b-\x7f]+")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def buckets(text: str) -> np.ndarray:
    """Hashed byte runs of a text; anything but letters separates, and counts as one blank."""
    data = np.frombuffer(b" " + _OTHERS.sub(b" ", text.lower().encode("utf-8", "surrogatepass")) + b" ", np.uint8).astype(np.uint32)
    parts = []
    for n in RUNS:
        if len(data) < n:
            continue
        x = np.full(len(data) - n + 1, n, np.uint32)
        for i in range(n):
            x = x * np.uint32(0x01000193) + data[i : len(data) - n + 1 + i] + np.uint32(1)
        x = x * np.uint32(0x9E3779B1)
        parts.append(x >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(parts)


def row_of(text: str) -> np.ndarray:
    """Square roots of the frequencies of all buckets, of length 1."""
    return np.sqrt(np.bincount(buckets(text), minlength=BUCKETS).astype(np.float32) / max(1, len(text.encode("utf-8", "surrogatepass")) * len(RUNS)))


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def _machine(x: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (averaged subgradients, classes weigh the same)."""
    y = np.where(positive, 1.0, -1.0)
    cost = np.where(positive, 0.5 / max(positive.mean(), 1e-9), 0.5 / max(1 - positive.mean(), 1e-9))
    w, b = np.zeros(x.shape[1]), 0.0
    w_sum, b_sum, steps = np.zeros(x.shape[1]), 0.0, 0
    rng = np.random.RandomState(3)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        rate = RATE / (1 + epoch)
        for at in range(0, len(order), 32):
            part = order[at : at + 32]
            wrong = part[y[part] * (x[part] @ w + b) < 1]
            w *= 1 - rate * DECAY
            if len(wrong):
                g = (cost[wrong] * y[wrong]) / len(part)
                w += rate * (g @ x[wrong])
                b += rate * g.sum() * 0.1
            w_sum += w
            b_sum += b
            steps += 1
    return (w_sum / steps).astype(np.float32), b_sum / steps


def _shares(x: np.ndarray) -> np.ndarray:
    """Frequencies of the buckets, of sum 1, from rows of their square roots."""
    shares = np.square(x.astype(np.float32))
    return shares / np.maximum(shares.sum(axis=1, keepdims=True), 1e-9)


def _logs(shares: np.ndarray) -> np.ndarray:
    """Logarithms of frequencies, a hundredth of which is given to all buckets alike."""
    return np.log(0.99 * np.maximum(shares, 0) + 0.01 / BUCKETS)


class Hierarchy:
    """Machines per family and per pair of languages; predicts from rows of frequencies."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, sizes: np.ndarray | None = None) -> None:
        self.langs = sorted(set(langs))
        self.families: dict[str, list[str]] = {}
        for lang in self.langs:
            self.families.setdefault(family_of(lang), []).append(lang)
        own = np.array([family_of(v) for v in langs])
        names = list(self.families)
        self.first = {f: _machine(x, own == f) for f in names} if len(names) > 1 else {}
        self.pairs = {}
        for members in self.families.values():
            for a, b in itertools.combinations(members, 2):
                two = (langs == a) | (langs == b)
                self.pairs[a, b] = _machine(x[two], langs[two] == a)
        self.logs: dict[str, np.ndarray] = {}
        self.least = (np.zeros(0), np.zeros(0))  # sizes up to which a least likeness holds, and the likeness
        if sizes is not None:
            self._measure(x, langs, sizes)

    def _measure(self, x: np.ndarray, langs: np.ndarray, sizes: np.ndarray) -> None:
        """Frequencies by language, and the least likeness by size from rows compared with the other rows."""
        likeness, of_size = [], []
        for lang in self.langs:
            own = _shares(x[langs == lang])
            if len(own) < FIT_ROWS:
                continue
            total = own.sum(axis=0)
            self.logs[lang] = _logs(total / len(own))
            likeness.append(np.array([r @ _logs((total - r) / (len(own) - 1)) for r in own]))
            of_size.append(sizes[langs == lang])
        if sum(map(len, likeness)) < FIT_LEAST:
            return
        likeness, of_size = np.concatenate(likeness), np.concatenate(of_size)
        order = np.argsort(of_size, kind="stable")
        groups = np.array_split(order, max(1, len(order) // FIT_GROUP))
        self.least = (
            np.array([of_size[g[-1]] for g in groups], float),
            np.array([np.quantile(likeness[g], LOST_SHARE, method="lower") - FIT_SLACK for g in groups]),
        )

    def fits(self, x: np.ndarray, langs: list[str], sizes: np.ndarray) -> np.ndarray:
        """Whether each row is as like its language as labelled texts of about its size are."""
        ends, least = self.least
        if not len(ends):
            return np.ones(len(x), bool)
        at = np.minimum(np.searchsorted(ends, sizes), len(ends) - 1)
        return np.array([v not in self.logs or r @ self.logs[v] >= least[k] for r, v, k in zip(_shares(x), langs, at, strict=True)], bool)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """Language and score (0 to 1) of every row."""
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(x)
        sure = lambda m: 1 / (1 + np.exp(-4 * np.clip(m, -10, 10)))
        families = list(self.families)
        if self.first:
            margins = np.stack([x @ self.first[f][0] + self.first[f][1] for f in families], axis=1)
            top = margins.argmax(axis=1)
            rest = np.sort(margins, axis=1)[:, -2]
            score = sure((margins.max(axis=1) - rest) / 2)
        else:
            top, score = np.zeros(len(x), int), np.ones(len(x))
        margin = {p: x @ w + b for p, (w, b) in self.pairs.items()}
        out = []
        for i in range(len(x)):
            members = self.families[families[top[i]]]
            votes = {lang: [0, 0.0] for lang in members}
            for a, b in itertools.combinations(members, 2):
                m = float(margin[a, b][i])
                votes[a if m >= 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
            best = max(members, key=lambda lang: votes[lang])
            own = [abs(float(margin[p][i])) for p in itertools.combinations(members, 2) if best in p]
            out.append((best, float(score[i] * (sure(min(own)) if own else 1.0))))
        return out


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % HOLD_OUT[0] == HOLD_OUT[1], F.lit(False))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.as_py() for x in batch.column(0)]
        rows = [(row_of(t) * SCALE).astype(np.float16).tobytes() if t and _LETTER.search(t) else None for t in texts]
        sizes = [_size(t) if t else 0 for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary()), pa.array(sizes, pa.int64())], names=["lang", "x", "size"])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Hierarchy:
    """Fit on about sample_rows texts of every language (at most 1.5 times as many), chosen by a hash of the id."""
    learn = docs.select("doc_id", F.col("lang").alias("lang"), "text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Hierarchy(np.empty((0, BUCKETS), np.float32), np.array([], object))
    parts = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, int(1_000_000 * min(1.0, sample_rows / n)))])
    place = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.length("text")), F.lit(1_000_000))
    data = (
        learn.filter(place < parts[F.col("lang")])
        .select("text", "lang")
        .mapInArrow(_rows, "lang string, x binary, size long")
        .filter("x IS NOT NULL")
        .limit(sample_rows * len(counts) * 3 // 2)
        .collect()
    )
    data.sort(key=lambda r: (r[0], bytes(r[1])))
    x = np.array([np.frombuffer(r[1], np.float16) for r in data], np.float32).reshape(len(data), BUCKETS)
    return Hierarchy(x, np.array([r[0] for r in data], object), np.array([r[2] for r in data], np.int64))


def identify(
    docs: DataFrame, model: Hierarchy, text_col: str = "text", reject: bool = False, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The documents (all columns but those of the two names) with the language predicted for their text and its score.

    With reject, the prediction is und and 0 if the text is unlike the language.
    """
    columns = [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(at)]
            with_letters = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
            found = [(UNKNOWN, 0.0)] * len(texts)
            # So many texts at a time that their rows take a few megabytes.
            for k in range(0, len(with_letters), 256):
                part = with_letters[k : k + 256]
                x = np.stack([row_of(texts[i]) for i in part]) * np.float32(SCALE)
                results = shared.value.predict(x)
                fit = shared.value.fits(x, [r[0] for r in results], np.array([_size(texts[i]) for i in part])) if reject else [True] * len(part)
                for i, result, ok in zip(part, results, fit, strict=True):
                    if ok:
                        found[i] = result
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*columns, *names],
            )

    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def language_id(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    model = train(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def in_languages(docs: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """The documents in one of the wanted languages (all learned ones if none are named), with all columns.

    Texts without a letter and texts unlike the language predicted for them are in none and go. If no
    language is learned, nothing can be told and all documents stay.
    """
    model = train(docs)
    if not model.langs:
        return docs
    wanted = [x for x in model.langs if wanted is None or x in wanted]
    names = (free_name("_lang_pred", docs.columns), free_name("_lang_score", docs.columns))
    found = identify(docs, model, reject=True, names=names)
    return found.filter(F.col(names[0]).isin(wanted)).select(*[F.col(f"`{c}`") for c in docs.columns])
