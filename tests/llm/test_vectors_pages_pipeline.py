"""Nearest neighbours, Hilbert shards, archives and the pipeline."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillflow.llm import ann, hilbert, language, near_dup, warc
from rillflow.llm.queries import QUERIES
from rillflow.llm.shared import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_and_exact_scores(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in QUERIES["op1_multiprobe"].run(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    found = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        want = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1)) and all(d[ids == v][0] == s for _, v, s in own)
        found += len({v for _, v, _ in own} & set(ids[want]))
        total += 10
    assert found >= 0.9 * total


def test_odd_vectors(spark, monkeypatch):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, "n") for i in range(50)] + [
        (100, [1.0, 2.0, 3.5], "n"), (200, None, "n"), (300, [0.0, 0.0, 0.0], "n"), (400, [1.0, None, 1.0], "n"), (500, [float("nan"), 1.0, 1.0], "n"), (600, [float("inf"), 1.0, 1.0], "n"),
        (700, [1.0, 2.0], "n"), (None, same, "n"), (0, same, "n"), (800, [], "n"),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, slot string")
    monkeypatch.setattr(ann, "BLOCK", 3)
    got = ann.nearest(frame, "vec_id", "embedding", lambda k: k % 100 == 0).collect()
    by = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in {r["query_id"] for r in got}}
    assert set(by) == {0, 100}
    assert by[0] == [(i, 0.0) for i in range(1, 11)] and by[100] == [(i, 0.5) for i in range(10)]
    assert ann.nearest(frame.limit(0), "vec_id", "embedding", lambda k: k % 100 == 0).count() == 0
    assert ann.nearest(frame.where("vec_id = 100"), "vec_id", "embedding", lambda k: k % 100 == 0).count() == 0


@pytest.mark.parametrize("case", ["tiny", "cluster", "norms", "own"])
@pytest.mark.parametrize("exact_pairs", [ann.EXACT_PAIRS, 0])
def test_every_query_finds_all_it_can(spark, monkeypatch, case, exact_pairs):
    monkeypatch.setattr(ann, "EXACT_PAIRS", exact_pairs)
    random_ = np.random.default_rng(5)
    x = random_.normal(size=(5 if case == "tiny" else 800, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    if case == "cluster":
        x[200:] = x[200] + 1e-4 * x[200:]
    if case == "norms":
        x *= random_.lognormal(0, 2, (len(x), 1))
    if case == "own":
        ids[100:140], x[100:140] = 100, x[100] + 1e-6 * x[100:140]
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    asked = (lambda c: c >= 0) if case == "tiny" else (lambda c: c % 10 == 0)
    got = {}
    for r in ann.nearest(frame, "vec_id", "embedding", asked).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {int(i) for i in ids if case == "tiny" or i % 10 == 0}
    most = min(10, len(set(ids.tolist())) - 1)
    assert set(got) == want
    for q, own in got.items():
        assert [r for r, _, _ in sorted(own)] == list(range(1, most + 1)) and len({v for _, v, _ in own} - {q}) == most


def test_steps_come_in_order_of_their_cost():
    inside = np.random.default_rng(3).random(4)
    sets = list(ann._in_order(inside, 81))
    cost = [sum((inside[f] if s < 0 else 1 - inside[f]) ** 2 for f, s in chosen) for chosen in sets]
    assert len(sets) == len({tuple(sorted(s)) for s in sets}) == 81 and cost == sorted(cost)


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2)])
def test_curve_visits_neighbours(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select([F.expr(f"cast(shiftright(id, {bits * k}) & {(1 << bits) - 1} as int)").alias(f"c{k}") for k in range(n)])
    rows = sorted(cells.withColumn("h", hilbert.hilbert_index([F.col(f"c{k}") for k in range(n)], bits)).collect(), key=lambda r: r["h"])
    assert [r["h"] for r in rows] == list(range(1 << (n * bits)))
    assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_are_even_and_gapless(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = QUERIES["op4_hilbert_shards"].run(spark, f"/root/testdata/{sf}").collect()
        docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
        slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(40)}
        assert all(v == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        assert len(rows) == len(docs) and all(r["size"] == len(docs[r["doc_id"]].encode()) + 16 for r in rows)


def test_shards_of_odd_rows(spark):
    rows = [(None, None, None, None, 1)] * 5 + [(1, "", "en", "s", 1), (2, "x" * 100_000, None, "s", 1)] + [(3, "same", "de", "t", 1)] * 200
    meta = hilbert.metadata(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, slot int"))
    got = hilbert.hilbert_shards(meta, ["lang_code", "source_code", "size"], 8, "text_hash", "doc_id").collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert sum(counts) == 207 and max(counts) - min(counts) <= 1 and len({(r["shard"], r["slot"]) for r in got}) == 207
    assert hilbert.hilbert_shards(meta.limit(0), ["size"], 8, "text_hash", "doc_id").count() == 0
    sharded = hilbert.hilbert_shards(meta, ["size"], 8, "text_hash", "doc_id")
    assert sum(r["rows"] for r in hilbert.shard_ranges(sharded, ["size"]).collect()) == 207


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archives_of_odd_pages_read_by_small_ranges(spark, tmp_path):
    noise = "".join(random.Random(4).choices("abcdefghijklmnop0123456789 <>/", k=40_000))
    rows = [(5, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (9, None, "same"), (None, "u", "same"), (1, "u", None), (3, "u", ""), (4, "u", noise), (7, "u", "é" + noise * 2), (8, "u", "a" * 17_000_000), (5, "http://a/", "same")]
    frame = spark.createDataFrame([(*r, "p") for r in rows], "page_id bigint, url string, html string, payload string")
    path = f"{tmp_path}/warc"
    warc.write_warc(frame.repartition(2), path)
    files = list((tmp_path / "warc").glob("part-*"))
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files) == len(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_warc(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bodies = {p: (h or "").encode() for p, _, h in rows}
    assert sorted((r["page_id"] or -1) for r in got) == sorted((p or -1) for p, _, _ in rows)
    for r in got:
        body = bodies[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), digest(body))
        first = {b"same": 2, b"": 1}.get(body, r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == first else ("revisit", first))
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == body
    assert all(r["record_type"] == "response" for r in warc_types(spark, frame, tmp_path))
    warc.write_warc(frame.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def warc_types(spark, frame, tmp_path):
    warc.write_warc(frame.where("page_id IN (2, 5, 9)"), f"{tmp_path}/small", least_revisit=5)
    return warc.read_warc(spark, f"{tmp_path}/small", payloads=False).collect()


def test_false_magic_is_part_of_its_member():
    # A magic inside a member: its parts are put together again, whether in one range or across two.
    body = random.Random(1).randbytes(3000)
    body = body[:1000] + warc.MAGIC + body[1000:2000] + warc.MAGIC + b"\x00WARC/" + body[2000:]
    member = warc._gzip(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3013\r\n\r\n" + body)
    assert member.count(warc.MAGIC) == 3
    parts = member.split(warc.MAGIC)[1:]
    one = warc._Range()
    assert [one.add(p)[0] is not None for p in parts] == [False, False, True]
    head, tail = warc._Range(), warc._Range()
    assert head.add(parts[0]) == (None, None) and head.open_part() == warc.MAGIC + parts[0]
    assert [tail.add(p)[1] for p in parts[1:]] == [warc.MAGIC + p for p in parts[1:]]


def test_magic_near_a_members_start(spark, tmp_path):
    # In the time field and in the name, both before the first inflated byte.
    wanted = list(range(60))
    data = b""
    for i in wanted:
        body = random.Random(i).randbytes(40 + 7 * i)
        text = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(body)) + body + b"\r\n\r\n"
        packed = warc._gzip(text)
        time = warc.MAGIC + b"\0" if i % 3 == 0 else b"\0" * 4
        name = (b"n" * (i % 9) + warc.MAGIC) * (1 + i % 2) + b"\0"
        data += warc.MAGIC + b"\x08" + time + packed[8:10] + name + packed[10:]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(wanted)
    (tmp_path / "part-0").write_bytes(data)
    whole = warc._Range()
    assert sum(text is not None for part in data.split(warc.MAGIC)[1:] for text, _ in whole.take(part)) == len(wanted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for most in ("100000", "701", "97"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            assert sorted(r["page_id"] for r in warc.read_warc(spark, str(tmp_path / "part-0")).collect()) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stages_keep_their_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    start = docs
    for name, work in corpus_pipeline.STAGES:
        docs = stage(work(spark, docs, SF_DIR), name)
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
        if name == "language_id":
            model = language.learn(start.where(~language.held_out()))
            named = language.predict(start, model)
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in named.collect() if r["_lang"] != "und" and r["_score"] >= language.LEAST_SCORE}
            before = docs
        if name == "near_dedup":
            kept = {r["doc_id"] for r in near_dup.near_duplicates(before).where("kept").collect()}
            assert {r["doc_id"] for r in docs.collect()} == kept
        if name == "secrets":
            assert docs.where(F.col("text").rlike("AKIA[A-Z0-9]{16,}")).count() == 0
            last = {r["doc_id"] for r in docs.collect()}
    assert counts[0] >= counts[1] > counts[2] >= counts[3] == counts[4]
    assert {r["doc_id"] for r in docs.collect()} == last


def test_short_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    long = docs.where("length(text) > 400").orderBy("doc_id").collect()
    columns, cut = docs.columns, []
    for lang in sorted({r["lang"] for r in long if r["lang"]}):
        for i, r in enumerate([r for r in long if r["lang"] == lang][:40]):
            words = [w for w in r["text"].split() if w.isalpha()]
            cut.append(r.asDict() | {"doc_id": 10**9 + len(cut), "text": " ".join(words[5:6 + i % 10])})
    letters = random.Random(2)
    noise = [cut[0] | {"doc_id": 2 * 10**9 + i, "lang": None, "text": " ".join("".join(letters.choices("qxzjkwv", k=7)) for _ in range(2 + i % 9))} for i in range(40)]
    both = docs.unionByName(spark.createDataFrame(cut + noise, docs.schema).select(*columns))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, both, SF_DIR).select("doc_id").collect()}
    assert sum(r["doc_id"] in kept for r in cut) >= 0.93 * len(cut)
    assert sum(r["doc_id"] in kept for r in noise) <= 4


def test_stages_take_empty_and_odd_documents(spark):
    rows = [(1, None, "en", "s", None), (2, "", None, "s", 0), (3, "the and of that with this", "en", "s", 25), (3, "the and of that with this", "en", "s", 25)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = frame
        for name, work in corpus_pipeline.STAGES:
            docs = stage(work(spark, docs, SF_DIR), name)
