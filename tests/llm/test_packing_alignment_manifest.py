"""Packing, token alignment and the manifest against brute force, on the smallest data and on odd rows."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkgauge.llm import merkle, packing, token_alignment
from sparkgauge.llm.chunks import Chunks
from sparkgauge.llm.token_counts import TOKENIZERS

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}é" for i in range(30_000))
STRANGE = [
    "<|endoftext|> it's <|startoftext|>they'll",
    "a b\x1cc d e ́x é İSTANBUL ΣΑΣ",
    "tabs\tand\r\nlines\x0b\x0c \x85 end",
    "日本語のテキスト 🙂🙂 and ▁ underline",
    "</s><s> <unk> <0x41> text",
    "x" * 3000 + "ﬁ" * 50,
    "nul \x00 byte",
]
ODD = [
    (1, "one two three", "en", "a", 13),
    (1, "one two three", "en", "a", 13),
    (1, "ONE two three", "en", None, None),
    (2, None, None, None, None),
    (None, "No id Here", "en", "a", 1),
    (None, None, None, None, None),
    (3, "", "de", "", 0),
    (4, " \n\t ", "", "b", 4),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG, "en", "a", len(LONG)),
    *((100 + i, t, "zz", "a:b", i) for i, t in enumerate(STRANGE)),
    *((200 + i, "Same Text", f"l{i}", "c", 9) for i in range(12)),
]


@pytest.fixture(scope="module")
def odd(spark):
    clash = [f"'x' AS {c}" for c in ("scope", "idx", "total", "tokens", "copies", "pairs", "text_key", "digest", "block")]
    return spark.createDataFrame(ODD, SCHEMA).selectExpr("*", *clash).repartition(5).cache()


def read(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# --- packing -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(f"{TOKENIZERS}/{packing.WORD_VOCABULARY}")
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", [*STRANGE, LONG, "", " "])
def test_chunks_give_the_ids_of_the_whole_text(words, text):
    (ids,) = packing.encoded(f"{TOKENIZERS}/{packing.WORD_VOCABULARY}", [text])
    assert np.frombuffer(ids, "<u4").tolist() == words(text)[:-1]


def test_random_texts_give_the_ids_of_the_whole_text(words):
    rng = np.random.default_rng(3)
    parts = ["word", "Éa", "it's", "'ll", " ", " ", " ", "\n", "\u00a0", "\x85", "\x1c", "\u0301", "ª", "²", "12", "3.", "!", ",", "_", "İ", "日本", "ﬁ", "Σ", "Ⱥ", "ß,", "½", "<|", "<|ENDOFTEXT|>", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, 40).tolist()) for _ in range(400)]
    for text, ids in zip(texts, packing.encoded(f"{TOKENIZERS}/{packing.WORD_VOCABULARY}", texts)):
        assert np.frombuffer(ids, "<u4").tolist() == words(text)[:-1], text


def test_chunks_are_forgotten_by_generations():
    asked = []

    def work(chunks):
        asked.extend(chunks)
        return [c.upper() for c in chunks]

    known = Chunks(work, remembered=500)
    for i in range(20):
        assert known.values(["often", f"rare{i}"])["often"] == "OFTEN" and len(known.young) <= 4
    assert asked.count("often") == 1 and known.values(["rare0"])["rare0"] == "RARE0" and asked.count("rare0") == 2


def test_cuts_are_few_and_fill_their_bins():
    for n in [*range(1, 4200), 49_000]:
        pieces = list(packing.cuts(n, 2048, 64))
        assert sum(pieces) == n and len(pieces) <= n // 2048 + 5
        # The slack of a bin, and what rounding a reciprocal down costs each of its pieces.
        assert all(2048 - (2048 // p) * p <= max(32, 2048 // p) for p in pieces)


def check_sequences(rows, capacity):
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
    for bin_ in by_sequence.values():
        bin_.sort(key=lambda r: r["offset"])
        at = 0
        for r in bin_:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        per_bin = {r["per_bin"] for r in bin_}
        assert at <= capacity and len(per_bin) == 1
        if (n := per_bin.pop()) > 0:
            assert len(bin_) == n
        else:
            assert at & (at - 1) == 0
    return by_sequence


def test_pack_round_trip(spark, words):
    docs = read(spark).union(spark.createDataFrame([r for r in ODD if r[0] and r[0] >= 100], SCHEMA).selectExpr("doc_id + 1000000", "text", "lang", "source", "n_chars"))
    rows = packing.pack(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = collections.defaultdict(list)
    for r in rows:
        assert len(r["tokens"]) == 4 * r["length"]
        pieces[r["doc_id"]].append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        found = sorted(pieces[doc_id], key=lambda r: r["start"])
        at = np.cumsum([0, *(r["length"] for r in found)]).tolist()
        assert at[:-1] == [r["start"] for r in found] and {at[-1]} == {r["doc_tokens"] for r in found}
        assert np.frombuffer(b"".join(r["tokens"] for r in found), "<u4").tolist() == words(text)
    sequences = check_sequences(rows, packing.CAPACITY)
    filled = [sum(r["length"] for r in bin_) for bin_ in sequences.values()]
    padded = sum(packing.CAPACITY - n for n in filled if n & (n - 1))
    assert padded <= 0.02 * sum(filled)


def test_pack_digests_and_odd_rows(spark, odd, words):
    rows = packing.packed_digests(odd).collect()
    assert sum(r["length"] for r in rows) == sum(len(words(r[1])) for r in ODD)
    starts = collections.Counter(r["doc_id"] for r in rows if r["start"] == 0)
    assert starts == collections.Counter(r[0] for r in ODD)
    empty = [r for r in rows if r["doc_id"] in (2, 3, 4)]
    assert [r["ids_crc32"] for r in empty] == [zlib.crc32(b"\x01\x00\x00\x00")] * 3
    check_sequences(rows, packing.CAPACITY)
    assert packing.packed_digests(odd.limit(0)).collect() == []


def test_pack_one_worker_fills_bins_by_class(spark, words):
    docs = spark.createDataFrame([(f"d{i}", "word " * (i % 40 + 1)) for i in range(3000)], "doc_id string, text string").coalesce(1)
    rows = packing.pack(docs, capacity=64, slack=8).collect()
    sequences = check_sequences(rows, 64)
    loose = sum(r["length"] for r in rows if r["per_bin"] == 0)
    assert loose < 64 * 64 and {r["doc_id"] for r in rows} == {f"d{i}" for i in range(3000)}
    assert len(sequences) == len({r["sequence_id"] for r in rows})


# --- token alignment -----------------------------------------------------------------------


def brute_alignment(rows):
    """doc -> measures, from all pairs of byte ranges."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{TOKENIZERS}/{token_alignment.BYTE_VOCABULARY}")
    a.encode_special_tokens = True
    names = {i: p for p, i in a.get_vocab().items()}
    b = SentencePieceProcessor(model_file=f"{TOKENIZERS}/{token_alignment.PIECE_VOCABULARY}")
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    alphabet = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(sorted(set(range(256)) - set(shown)))}
    links, counts = [], collections.Counter()
    for _, text, *_ in rows:
        own, groups = [], []
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            ids_a = ids_b = []
        if ids_a:
            ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
            spans_b = list(zip([0, *ends_b], ends_b, ids_b))
            for s, e, i in zip([0, *ends_a], ends_a, ids_a):
                own += [(i, j) for u, v, j in spans_b if s < v and u < e]
            cut_a, cut_b = [], []
            both = set(ends_a) & set(ends_b)
            i = j = 0
            while i < len(ids_a):
                cut_a.append(ids_a[i])
                if ends_a[i] in both:
                    while True:
                        cut_b.append(ids_b[j])
                        j += 1
                        if ends_b[j - 1] == ends_a[i]:
                            break
                    groups.append(",".join(map(str, cut_a)) + "|" + ",".join(map(str, cut_b)))
                    cut_a, cut_b = [], []
                i += 1
        counts.update(own)
        links.append((len(ids_a), len(ids_b), groups, own))
    best = collections.Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for (doc_id, *_), (n_a, n_b, groups, own) in zip(rows, links):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), digest))
    return collections.Counter(out)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_matches_brute_force(spark, odd):
    short = [r for r in ODD if not r[1] or len(r[1]) < 10_000]
    got = token_alignment.alignment_measures(odd.filter("text IS NULL OR length(text) < 10000"), slice_chars=40)
    assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute_alignment(short)


@pytest.mark.parametrize("seed", range(3))
def test_chunks_align_like_whole_texts(seed):
    """Random mixtures of words, spaces of all kinds, marks and symbols."""
    rng = np.random.default_rng(seed)
    parts = ["word", "it's", "'ll", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\u0301", "é", "123", "3.14", "!?", "▁", "🙂", "日本", "ﬁ", "A", "<s>"]
    texts = ["".join(rng.choice(parts, 40, p=[0.2, *[0.8 / (len(parts) - 1)] * (len(parts) - 1)]).tolist()) for _ in range(300)]
    paths = (f"{TOKENIZERS}/{token_alignment.BYTE_VOCABULARY}", f"{TOKENIZERS}/{token_alignment.PIECE_VOCABULARY}")
    a, b = token_alignment.byte_side(paths[0]), token_alignment.piece_side(paths[1])
    spaced = [" " + t for t in texts]
    for text, ids_a, ids_b, found in zip(spaced, a.encode(spaced), b.encode(spaced), token_alignment.alignments(*paths, texts)):
        whole = a.gives_back(ids_a, text) and b.gives_back(ids_b, text)
        want = (len(ids_a), len(ids_b), *token_alignment.align(ids_a, ids_b, a.sizes, b.sizes)[:2]) if whole else (0, 0, 0, "")
        assert found[:4] == want


def test_alignment_of_the_table(spark):
    docs = read(spark).filter("length(text) < 3000")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert len(rows) > 50
    got = token_alignment.alignment_measures(docs).collect()
    assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute_alignment(rows)


def test_alignment_without_broadcast_and_empty(spark, odd, monkeypatch):
    docs = odd.filter("doc_id >= 100")
    want = sorted(map(tuple, token_alignment.alignment_measures(docs).collect()))
    monkeypatch.setattr(token_alignment, "small", lambda df: df)
    assert sorted(map(tuple, token_alignment.alignment_measures(docs).collect())) == want
    assert token_alignment.alignment_measures(odd.limit(0)).collect() == []
    nothing = token_alignment.alignment_measures(odd.filter("text IS NULL OR text = ''")).collect()
    assert len(nothing) == 3 and all(r["n_links"] == 0 and r["groups_sha256"] == "" for r in nothing)


# --- manifest ------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def parents(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def root_of(nodes):
    while len(nodes) > 1:
        nodes = parents(nodes)
    return nodes[0]


def siblings(nodes, at):
    out = []
    while len(nodes) > 1:
        run = at // 8 * 8
        out += [n for i, n in enumerate(nodes[run : run + 8]) if run + i != at]
        nodes, at = parents(nodes), at // 8
    return out


def brute_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted(((r, leaf(*r)) for r in rows if r[2] == x), key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1])) for x in langs}
    tops = [root_of([d for _, d in trees[x]]) for x in langs]
    out = []
    for k, x in enumerate(langs):
        nodes = [d for _, d in trees[x]]
        for i, (r, digest) in enumerate(trees[x]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = root_of([*nodes[:i], leaf(r[0], text, *r[2:]), *nodes[i + 1 :]])
            proof = sha("".join(siblings(nodes, i) + siblings(tops, k)))
            got = root_of([*tops[:k], folded, *tops[k + 1 :]])
            out.append((r[0], digest, tops[k], root_of(tops), proof, got, got == root_of(tops)))
    return collections.Counter(out)


def manifest(docs, **options):
    rows = merkle.verify(docs, merkle.tampered(F.col("text"), F.col("doc_id")), **options).collect()
    return collections.Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in rows)


def test_manifest_of_odd_rows(spark, odd):
    # Equal rows have equal leaves but proofs of their own; their order among themselves does not matter.
    assert manifest(odd) == brute_manifest(ODD)
    assert manifest(odd.limit(0)) == collections.Counter()
    assert manifest(odd.filter("doc_id = 3")) == brute_manifest([r for r in ODD if r[0] == 3])


def test_manifest_over_several_tiers(spark):
    rows = [(i, f"Text {i % 7}", "en" if i % 3 else f"l{i % 11}", "s", i) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for high in (1, 2, 3):
        assert manifest(docs, block_levels=high) == brute_manifest(rows)


def test_untouched_rows_verify(spark):
    docs = read(spark)
    rows = merkle.verify(docs).collect()
    assert len(rows) == docs.count() and all(r["verified"] for r in rows) and len({r["root"] for r in rows}) == 1
    changed = merkle.verify(docs, F.when(F.col("doc_id") == 5, F.lit("other")).otherwise(F.col("text"))).filter("NOT verified").collect()
    assert [r["doc_id"] for r in changed] == [5]


def test_states_hold_what_stands_left_of_a_slot():
    children = [sha(str(i)).encode() for i in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        want = sha("".join(c.decode() for c in [*children[:slot], sha("new").encode(), *children[slot + 1 :]]))
        assert merkle.resume(parent.states[slot], sha("new").encode(), parent.right(slot)).decode() == want
    assert [merkle.levels(n) for n in (1, 2, 8, 9, 64, 65, 513)] == [0, 1, 1, 2, 2, 3, 4]
