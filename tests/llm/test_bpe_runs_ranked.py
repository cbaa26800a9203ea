"""Byte-level BPE against its library, periodic runs and ranked search against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import bpe, ranked, runs
from rillflow.llm.queries import QUERIES, public_vocabularies

from .. import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.from_file(public_vocabularies().path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {t: i for i, t in enumerate(vocabulary.tokens.to_pylist())}
    return tiktoken.Encoding("own", pat_str=public_vocabularies().PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["op12_periodic_runs", "op13_ranked_search"])
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.duck(SF), SF, QUERIES[name]) is None


def test_byte_bpe_of_all_documents_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"].run(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


ODD_TEXTS = [
    None, "", " ", "\n\n  \t x", "I'll 'S don't", "<|endoftext|>", "naïve  café　日本語 \x1c\x85", "🤖🤖 é", "1234567890" * 40,
    "a" * 200_000, "ab" * 50_000 + " " * 3000, "x y " * 300_000, "\0\1\2", "word", "word", "A‍B﻿",
]


def test_byte_bpe_of_odd_texts(spark, vocabulary, library):
    rows = [(i if i % 5 else None, t, "own", "other") for i, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _ids string, _bpe_text string").repartition(3)
    shared = bpe.shared_vocabulary(spark, vocabulary)
    encoded = bpe.encode(docs, shared, public_vocabularies().PATTERN)
    assert encoded.columns == ["doc_id", "text", "_bpe_text", "_ids"]
    for r in bpe.decode(encoded, shared).collect():
        ids = np.frombuffer(r["_ids"], "<u4").tolist()
        assert ids == library.encode_ordinary(r["text"] or "") and bytes(r["_decoded"]) == (r["text"] or "").encode()
        assert r["_bpe_text"] == "other"
    empty = bpe.encode(docs.where("false"), shared, public_vocabularies().PATTERN)
    assert bpe.decode(empty, shared).collect() == []
    nulls = spark.createDataFrame([(bytearray(b""),), (None,), (bytearray(b"\x40\0\0\0"),)], "_ids binary").coalesce(1)
    assert [r["_decoded"] and bytes(r["_decoded"]) for r in bpe.decode(nulls, shared).collect()] in ([bytearray(), None, b"a"], [b"", None, b"a"])


def test_long_texts_are_cut_in_steps(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 20)
    monkeypatch.setattr(bpe, "STEP", 3)
    texts = ["short one", "a longer text of more than twenty letters, 12 words  \n\n or so", "", "again a rather long text, this one", "end"]
    parts, counts = bpe.Encoder(vocabulary, public_vocabularies().PATTERN).encode(texts)
    ids = np.frombuffer(b"".join(bytes(p) for p in parts), "<u4").tolist()
    want = [library.encode_ordinary(t) for t in texts]
    assert ids == sum(want, []) and counts.tolist() == list(map(len, want))


def test_merges_equal_the_library_for_any_bytes(vocabulary, library):
    ranks = {t: i for i, t in enumerate(vocabulary.tokens.to_pylist())}
    rng = random.Random(7)
    for _ in range(300):
        piece = bytes(rng.choice(b"aabcdeht \xc3\xa9") for _ in range(rng.randrange(1, 60)))
        assert bpe.merged(piece, ranks) == library._encode_single_piece(piece)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(min_size=0, max_size=6), min_size=1, max_size=400))
def test_perfect_hash_is_minimal(keys):
    hashes = bpe._hashes(sorted(keys))
    assert sorted(bpe.PerfectHash.of(hashes).slots(hashes).tolist()) == list(range(len(keys)))


def test_perfect_hash_answers_only_for_its_keys(vocabulary):
    tokens = vocabulary.tokens.to_pylist()
    assert vocabulary.ids_of(tokens).tolist() == list(range(len(tokens)))
    strange = [t + b"\xff\xfe" for t in tokens[::50]]
    assert (vocabulary.ids_of(strange) == -1).all()


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        bpe.Vocabulary.of({b"a": 0})


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= 3 * q:
                found.setdefault((start, i + q), q)
    return sorted((s, e, p) for (s, e), p in found.items())


pattern_of_blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=24), st.integers(1, 90)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(pattern_of_blocks)
def test_runs_equal_those_of_a_plain_search(blocks):
    """Stretches that repeat, beside and within each other."""
    words = [base[i % len(base)] for base, size in blocks for i in range(size)]
    assert runs.runs_of(np.array([*words, -1], np.int64), len(words)) == plain_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(1, 4), st.lists(st.integers(4, 6), min_size=1, max_size=3), st.integers(60, 260), st.integers(0, 300))
def test_runs_with_highly_periodic_parts(inner, times, tail, size, broken):
    """A period that holds repetitions of a smaller one, with or without a word that breaks it."""
    base = [i % 3 for i in range(inner)] * (times * 3) + tail
    words = [base[i % len(base)] for i in range(size)]
    if broken < size:
        words[broken] = 9
    assert runs.runs_of(np.array([*words, -1], np.int64), len(words)) == plain_runs(words)


def test_runs_of_odd_documents(spark):
    texts = [None, "", "  \n ", "a " * 23, "a " * 24, " ".join(["b"] * 24), "x " + "to be or not " * 9 + "y", "to be or not " * 5, "é \x85 " * 12, "c " * 70_000, "one"]
    rows = [(i if i else None, t, "own", "kept") for i, t in enumerate(texts + texts[4:5])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _runs string, _run_text string").repartition(2)
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        want = [(s, e, p) for s, e, p in plain_runs(words) if e - s >= 24] if len(words) < 1000 else [(0, 70_000, 1)]
        assert [(x["start"], x["start"] + x["length"], x["period"]) for x in r["_runs"]] == want and r["_n_words"] == len(words)
        gone = {i for s, e, p in want for i in range(s + p, e)}
        assert r["_collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone) and r["_run_text"] == "kept"
    assert runs.periodic_runs(docs.where("false")).collect() == []


def test_planted_repetitions_are_found(spark):
    """The query's own repetitions: a tenth of the documents, where they are long enough."""
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    planted = 0
    for r in QUERIES["op12_periodic_runs"].run(spark, SF).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = [(s, e, q) for s, e, q in plain_runs(words) if e - s >= 24]
        planted += bool(want)
        assert r["n_runs"] == len(want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in want).encode()).hexdigest()
    assert planted


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, out = sum(len(b) for _, b in bags), []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 25 + 75 * len(bag) * len(bags) // total
            score = 0
            for t in terms(text):
                df, tf = sum(t in b for _, b in bags), bag.count(t)
                score += math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_items", [4096, 2])
def test_ranked_search_equals_a_plain_one(spark, block_items):
    rng = random.Random(3)
    words = "to Be or not the a cat Dog über 42".split()
    docs = [(i if i else None, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    docs += docs[:3] + [(70, None), (71, ""), (72, "..."), (73, "cat cat"), (74, "cat cat"), (75, "Cat_cat")]
    items = [(1, "the cat"), (2, "dog dog DOG"), (2, "über 42 über"), (3, None), (4, ""), (5, "unheard of"), (None, "to be or not to be"), (1, "the cat")]
    got = ranked.search(
        spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, score int").repartition(5),
        spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, rank int"), block_items=block_items,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(docs, items)


def test_ranked_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "b")], "item_id bigint, text string")
    none = docs.where("false")
    assert ranked.search(none, items).collect() == [] and ranked.search(docs, items.where("false")).collect() == []
    assert ranked.search(docs, spark.createDataFrame([(1, None)], "item_id bigint, text string")).collect() == []


def test_sums_beyond_doubles_are_exact():
    value = np.array([2**53 + 1, 2**53 + 1, 3], np.int64)
    assert ranked._sums(np.array([0, 0, 2]), value, 3).tolist() == [2**54 + 2, 0, 3]


def test_heaps_keep_the_best_of_many_runs():
    rng = np.random.default_rng(5)
    heaps, seen = ranked.Heaps(4, 3), [[] for _ in range(4)]
    for _ in range(30):
        scores = rng.integers(0, 6, (7, 4))
        ids = [None if rng.random() < 0.1 else int(x) for x in rng.integers(0, 50, 7)]
        heaps.offer(scores, ids)
        for i in range(4):
            seen[i] += [(-s, d is None, d or 0) for s, d in zip(scores[:, i].tolist(), ids) if s > 0]
    got = [sorted((-s, d is None, d or 0) for i, d, s in heaps.rows() if i == item) for item in range(4)]
    assert got == [sorted(x)[:3] for x in seen]
