"""Tokens, token files and packing against the tokenizer itself."""

import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rillflow.llm import packing, token_files, tokens
from rillflow.llm.queries import QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n", "  ", "a  b", " a\n\nb\n", "\na b ", "x\n", "tab\tx y", " q", "don't  we'll it's", "a\r\nb  c\n\n\n d",
    "<|endoftext|> x <|startoftext|>", "a<|endoftext|>b", "a <|ENDOFTEXT|> b", "<|endoftext|", "x<|startoftext|><|endoftext|> \xa0 y", "ǅ İstanbul ΣΑΣ é ́ ñ", "12 345a b2c $$ 100%", "日本語 テスト  x", "a b\xa0c",
    "\x1c a\x1f b", "a.'s b!'t", "x_y __z", "É ÉÉ! ß", "a b ", "word " * 3000,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_tokenizers_ids(name):
    encode = tokens.PieceEncoder(tokenizer_path(name))
    whole = [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch([t or "" for t in ODD], add_special_tokens=False)]
    for _ in range(2):  # the second time from the cache
        ids, counts = encode.encode(pa.array(ODD, pa.string()))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == whole


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, row string, shard string")


@pytest.mark.parametrize("n", [0, 1, 511, 512, 5000])
def test_directly_addressable_codes(n):
    ids = np.random.default_rng(n).choice([3, 255, 256, 49_000, 70_000], n).astype(np.uint32)
    levels = token_files.encode_levels(ids)
    assert token_files.decode_levels(levels).tolist() == ids.tolist()
    assert [token_files.token_at(levels, i) for i in range(0, n, 37)] == ids[::37].tolist()


def expected(path, rows, end):
    tokenizer = Tokenizer.from_file(path)
    return {key: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4") for key, text in rows}


def test_token_files_round_trip(spark):
    path = tokenizer_path("word_bpe_49k.json")
    rows = [(i, t) for i, t in enumerate(ODD)]
    want = expected(path, rows, 1)
    files = token_files.token_files(docs_of(spark, [(i, t, "x", "y") for i, t in reversed(rows)]), path, 1)
    start = 0
    for r in sorted(token_files.read_documents(files).collect()):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want[r["doc_id"]]), zlib.crc32(want[r["doc_id"]]))
        start += r["n_tokens"]
    flat = np.concatenate([want[i] for i in range(len(rows))])
    asked = spark.createDataFrame([(p,) for p in (0, 5, 700, len(flat) - 1, len(flat), 5)], "position bigint")
    got = token_files.read_tokens(files, asked).collect()
    assert sorted((r["position"], r["token_id"]) for r in got if r["token_id"] is not None) == sorted((p, int(flat[p])) for p in (0, 5, 5, 700, len(flat) - 1))


def test_token_files_of_nothing_and_of_null_ids(spark):
    path = tokenizer_path("word_bpe_49k.json")
    assert token_files.read_documents(token_files.token_files(docs_of(spark, []), path, 1)).collect() == []
    got = token_files.read_documents(token_files.token_files(docs_of(spark, [(None, "a", "", ""), (None, "a", "", ""), (3, None, "", "")]), path, 1)).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == [(-1, 2), (-1, 2), (3, 1)] and {r["start"] for r in got} == {0, 2, 4}


def check_pieces(pieces, want):
    """Each id lies in one piece; sequences have no gap and are full but for one of each shard."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        own = want[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["doc_tokens"] == len(want[p["doc_id"]]) and p["ids_crc32"] == zlib.crc32(own)
    assert set(by_doc) == set(want)
    for key, own in by_doc.items():
        spans = sorted((p["start"], p["start"] + p["length"]) for p in own)
        assert spans[0][0] == 0 and spans[-1][1] == len(want[key]) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    short = {s >> 32 for s, own in by_sequence.items() if sum(p["length"] for p in own) < 1024}
    assert len(short) == sum(1 for own in by_sequence.values() if sum(p["length"] for p in own) < 1024)


def test_packing_covers_every_token_once(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = expected(path, [(r["doc_id"], r["text"]) for r in docs.collect()], 0)
    check_pieces(QUERIES["op9_packing"].run(spark, SF_DIR).collect(), want)
    check_pieces(packing.pack(docs, path, 0, shard_docs=40).collect(), want)


def test_packing_of_odd_rows(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    want = expected(path, list(enumerate(ODD)), 0)
    check_pieces(packing.pack(docs_of(spark, [(i, t, "r", "s") for i, t in enumerate(ODD)]), path, 0).collect(), want)
    assert packing.pack(docs_of(spark, []), path, 0).collect() == []
    same = packing.pack(docs_of(spark, [(1, "a b", "", "")] * 3 + [(None, None, "", "")]), path, 0).collect()
    assert sorted((p["doc_id"] or 0, p["length"]) for p in same) == [(0, 1), (1, 3), (1, 3), (1, 3)]


def test_neighbours_share_windows():
    weight, window = np.ones(100), 10
    tails = [np.full(5, 7, "<u4"), np.full(5, 8, "<u4"), np.full(5, 7, "<u4"), np.full(5, 8, "<u4")]
    index = packing.Index(tails, weight, 5.0)
    assert index.scores(0).argsort()[::-1][:2].tolist() in ([0, 2], [2, 0]) and index.scores(1)[0] == 0
    import pandas as pd

    frame = pd.DataFrame({"shard": 0, "row": range(4), "doc_id": range(4), "doc_tokens": 5, "full_crcs": [b""] * 4, "tail": [packing._packed(t) for t in tails]})
    packed = packing._pack_shard(frame, weight, 5.0, window)
    assert packed.groupby("sequence_id")["doc_id"].apply(set).tolist() == [{0, 2}, {1, 3}]


def plain_scores(bags, weight, mean_length, seed):
    """BM25 of all texts, given as term counts, for every term of one."""
    lengths = [sum(b.values()) for b in bags]
    norm = [packing.K1 * (1 - packing.B + packing.B * n / mean_length) for n in lengths]
    return [sum(weight[t] * b[t] * (packing.K1 + 1) / (b[t] + norm[i]) for t in bags[seed] if t in b) for i, b in enumerate(bags)]


def test_all_terms_count():
    random_ = np.random.default_rng(3)
    weight = random_.random(900)
    weight[:100] += 10
    tails = [np.arange(300, dtype="<u4"), np.arange(100, 300, dtype="<u4"), np.arange(400, 500, dtype="<u4")]
    tails += [random_.integers(100, 900, n).astype("<u4") for n in (5, 50, 500, 1000, 1)]
    index = packing.Index(tails, weight, 150.0)
    for seed in range(len(tails)):
        assert np.allclose(index.scores(seed), plain_scores([Counter(t.tolist()) for t in tails], weight, 150.0, seed), rtol=1e-5)


def share_of_best_neighbours(docs, pieces, path, best=1, step=1):
    """Of documents with text: how many of their ``best`` documents by plain BM25 over all are in their shard."""
    encode = tokens.encoder(path).encode
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"]]
    ids, counts = encode(pa.array([t for _, t in rows]))
    bags = [np.unique(x, return_counts=True) for x in np.split(ids.astype(np.int64), np.cumsum(counts)[:-1])]
    holders = np.bincount(np.concatenate([b[0] for b in bags]))
    weight = np.log1p((len(bags) - holders + 0.5) / (holders + 0.5))
    mean = float(counts.mean())
    terms = np.zeros((len(bags), len(weight)), np.float32)
    asked = np.arange(0, len(bags), step)
    held = np.zeros((len(asked), len(weight)), np.float32)
    for i, place in enumerate(asked):
        held[i, bags[place][0]] = 1
    for i, (own, n) in enumerate(bags):
        terms[i, own] = weight[own] * n * (packing.K1 + 1) / (n + packing.K1 * (1 - packing.B + packing.B * n.sum() / mean))
    scores = held @ terms.T
    scores[np.arange(len(asked)), asked] = -1
    shard = {p["doc_id"]: p["sequence_id"] >> 32 for p in pieces if p["start"] + p["length"] == p["doc_tokens"]}
    own = np.array([shard[key] for key, _ in rows])
    return float((own[np.argsort(-scores, axis=1)[:, :best]] == own[asked][:, None]).mean())


def test_neighbours_come_from_the_whole_corpus(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    random_ = np.random.default_rng(11)
    words = ["".join(w) for w in random_.choice(list("abcdefghijklmnoprstuvw"), (320, 6))]
    topics = [words[i:i + 40] for i in range(0, 320, 40)]
    rows = [(i, " ".join(random_.choice(topics[i % 8], 60)), "", "") for i in range(400)]
    # Long documents whose remainder is of another topic than the whole.
    rows += [(400 + i, " ".join(random_.choice(topics[i % 8], 900)) + " ok ok", "", "") for i in range(40)]
    docs = docs_of(spark, rows)
    pieces = packing.pack(docs, path, 0, shard_docs=80).collect()
    check_pieces(pieces, expected(path, [(r[0], r[1]) for r in rows], 0))
    shards = defaultdict(int)
    for p in pieces:
        shards[p["sequence_id"] >> 32] += p["start"] + p["length"] == p["doc_tokens"]
    assert len(shards) > 4 and max(shards.values()) <= 100
    assert share_of_best_neighbours(docs, pieces, path) > 0.6  # by chance less than 0.2


def test_equal_documents_are_split_over_shards():
    dealt = packing._dealt({0: 10, 1: 20, 2: 250, 3: 90, 5: 20}, 100)
    assert dealt == [(0, 0, 1), (1, 0, 1), (2, 1, 3), (3, 4, 1), (5, 5, 1)]


def test_byte_level_texts_by_ranks():
    """Whole texts by ranks, long runs by pieces and added tokens by the tokenizer, as a fresh tokenizer encodes them."""
    path = tokenizer_path("byte_bpe_50k.json")
    random = np.random.default_rng(4)
    parts = [" ", "  ", "\n", "a", "aa", "b", "the", "'s", "'", "é", "ß", "中", "1", "23", "!", "...", "\t", "\u3000", "\u00a0", "<|endoftext|>", "\U0001f600"]
    texts = ["".join(random.choice(parts, n)) for n in random.integers(0, 60, 2000)]
    texts += ["", None, "a" * 5000, " " * 5000 + "x", "b " * 4000, "a<|endoftext|>b" + "c" * 3000, "x" * 2000 + " " + "y" * 2001]
    own = tokens.PieceEncoder(path)
    whole = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for column, want in ((pa.array(texts), whole), (pa.array(texts).slice(3, 500), whole[3:503]), (pa.array([], pa.string()), []), (pa.array(["x" * 3000]), None)):
        ids, counts = own.encode(column)
        if want is None:
            want = [Tokenizer.from_file(path).encode("x" * 3000, add_special_tokens=False).ids]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert own.by_rank is not None and tokens.PieceEncoder(tokenizer_path("word_bpe_49k.json")).by_rank is None


def test_ranks_only_where_ids_follow_the_merges(tmp_path):
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = json.load(f)
    assert tokens._ranks(file) is not None
    merges = file["model"]["merges"]
    swapped = {**file, "model": {**file["model"], "merges": [merges[1], merges[0], *merges[2:]]}}
    assert tokens._ranks(swapped) is None
    assert tokens._ranks({**file, "pre_tokenizer": {**file["pre_tokenizer"], "add_prefix_space": True}}) is None
