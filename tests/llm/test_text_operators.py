"""Decontamination, near duplicates, secrets, language and toxicity against plain versions."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rillflow.llm import decontaminate, language, near_dup, secrets, toxicity
from rillflow.llm.queries import QUERIES

from .. import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.duck(SF_DIR), SF_DIR, QUERIES[name]) is None


def words(n, seed):
    return [random.Random(seed * 1000 + i).choice("abcdefgh") + str(random.Random(seed * 977 + i).randrange(40)) for i in range(n)]


# Decontamination.

def plain_marks(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for item, text in items:
        w = split(text)
        windows += [(item, w[i:i + 13]) for i in range(len(w) - 12)] if len(w) > 13 else [(item, w)] if w else []
    out = []
    for _, text in docs:
        w, hit, found = split(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_marks_equal_a_plain_search_in_one_block_and_in_many(spark):
    item = " ".join(words(30, 1))
    items = [(1, item), (2, item), (3, "Short Item"), (4, None), (5, "..."), (6, "one"), (10, " ".join(words(13, 2))), (11, "é É x"), (1, item), (12, "x\0y")]
    docs = [
        (1, item), (2, "pre " + item.upper() + " post"), (3, None), (4, ""), (5, "short, ITEM short item"), (6, " ".join(words(20, 1))), (7, " ".join(words(12, 1))),
        (8, "a\n" + " ".join(words(13, 2)) * 2), (9, " ".join(words(3000, 3)) + " " + item), (9, item), (None, "one" + "-" * 50), (11, "É É é É x"), (12, "short"), (13, "item"),
        (14, item.split()[-1]), (15, item), (16, "z " * 5000), (17, "x y"),
    ]
    want = plain_marks(docs, items)
    frame = spark.createDataFrame([(i, k, t, "n") for i, (k, t) in enumerate(docs)], "at int, doc_id bigint, text string, _n_words string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block_bytes in (1 << 20, 150):
        got = decontaminate.with_decision(decontaminate.mark(frame, bench, block_bytes)).orderBy("at").collect()
        assert [(r["_n_words"], r["_n_hit"], r["_items"]) for r in got] == want
        assert [r["_contaminated"] for r in got] == [h > 0 and 20 * h >= n for n, h, _ in want]
    none = decontaminate.mark(frame, bench.limit(0)).collect()
    assert {tuple(r["_items"]) for r in none} == {()} and decontaminate.mark(frame.limit(0), bench).count() == 0
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns and kept.count() == sum(not (h > 0 and 20 * h >= n) for n, h, _ in want)


# Near duplicates.

def plain_groups(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(ids.get(root(i), key), key)
    return [(len(sets[i]), ids.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def mutated(base, share, seed):
    r = random.Random(seed)
    return [f"m{r.randrange(10**6)}" if r.random() < share else w for w in base]


def test_groups_equal_a_plain_search(spark):
    rows = [(None, None), (100, None), (101, ""), (102, " \n\t"), (103, "one"), (104, "ONE"), (105, "one two three"), (106, "one\ttwo  three"), (107, "x\0y z"), (108, "\xa0 a b c d")]
    base = words(200, 7)
    # A family of near and not so near copies, whose links need not go through its first member.
    rows += [(1000 - i, " ".join(mutated(base, share, i))) for i, share in enumerate([0, 0.01, 0.02, 0.025, 0.03, 0.04, 0.05, 0.06, 0.07] * 6)]
    rows += [(2000 + i, " ".join(base)) for i in range(30)]
    rows += [(3000, " ".join(words(6000, 9))), (3001, " ".join(words(6000, 9)[:5900])), (3001, " ".join(words(50, 11))), (None, " ".join(words(50, 11))), (3003, " ".join(words(50, 11)))]
    frame = spark.createDataFrame([(k, t, "n", 5) for k, t in rows], "doc_id bigint, text string, node string, digest int").repartition(3)
    got = near_dup.near_duplicates(frame).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in got) == sorted((k or -1, n, c or -1) for (k, _), (n, c) in zip(rows, plain_groups(rows)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert near_dup.near_duplicates(frame.limit(0)).collect() == []


def test_one_row_of_each_group_stays(spark):
    a, b, c, e = (" ".join(words(40, seed)) for seed in (21, 22, 23, 24))
    rows = [(4, a), (5, a), (5, b), (7, c), (7, c), (None, e), (None, e), (8, None), (8, None), (9, ""), (9, " "), (3, a + " z"), (None, c)]
    frame = spark.createDataFrame([(k, t, "own") for k, t in rows], "doc_id bigint, text string, _row string").repartition(3)
    kept = near_dup.one_of_each(frame)
    assert kept.columns == frame.columns
    got = sorted(((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()))
    assert got == sorted([(3, a + " z"), (5, b), (7, c), (-1, e), (8, ""), (8, ""), (9, ""), (9, " ")])
    assert near_dup.one_of_each(frame.limit(0)).collect() == []


def test_links_of_a_family_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 7)
    monkeypatch.setattr(near_dup, "COLUMNS", 16)
    base = words(150, 5)
    rows = [(i, " ".join(mutated(base, 0.04 + 0.01 * (i % 3), i))) for i in range(60)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((k, c) for (k, _), (_, c) in zip(rows, plain_groups(rows)))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (103, 103), (105, 100)]
    got = near_dup.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    groups = {r["node"]: r["group"] for r in got.collect()}
    assert groups == {**{i: 0 for i in range(1, 41)}, 103: 100, 105: 100}
    assert near_dup.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Secrets.

KEY = "AKIA" + "Q7" * 8
WEAK = "wJalrXUtnFEMI/K7MDENGbPxRfiCY"


def plain_base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_spans(spark):
    far = " x" * 400
    texts = [
        None, "", "token=abc", "token=token\"=abcdef", "𝒳é PassWord = 'abcdefg' " + "0" * 24, f"{KEY}{KEY}", f"{KEY} and {WEAK} at db.example.com", f"{WEAK} alone, db.example.com",
        f"user=bob {far} {WEAK}", f"user=bob {WEAK}", f"see db.example.com{far} user=bob token=abcdefgh", f"secret: {'f' * 30} " * 700, "api_key:abcdefg" * 3, f"{KEY} is an id, 10.0.0.1:80 a host",
    ]
    frame = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] + [(6, texts[6], "k")], "doc_id bigint, text string, kind string")
    rows = secrets.find_secrets(frame, "doc_id").select("doc_id", secrets.listed(F.col("strong")).alias("base"), secrets.listed(F.col("spans")).alias("all")).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts) + 1
    for i, text in enumerate(texts):
        assert got[i]["base"] == plain_base(text or ""), text
    added = {i: set(r["all"].split(",")) - set(r["base"].split(",")) for i, r in got.items()}
    kinds = {i: sorted(a.split(":")[0] for a in found) for i, found in added.items()}
    assert kinds[6] == ["endpoint", "secret"] and kinds[7] == [] and kinds[8] == [] and kinds[9] == ["identifier", "secret"] and kinds[10] == ["identifier"] and kinds[13] == []
    assert secrets.find_secrets(frame.limit(0), "doc_id").count() == 0


def test_endpoints_are_whole_hosts(spark):
    hosts = {
        "db.example.com": "db.example.com", "db.example.com.": "db.example.com", "db.example.com:5432": "db.example.com:5432", "a.com.b.net-": "a.com.b.net", "a.community": "",
        "a.com.community": "a.com", "10.0.0.1": "10.0.0.1", "10.0.0.1:80": "10.0.0.1:80", "1.2.3": "", "word": "", "http://x/y%20.com": "http://x/y%20.com", ".com": "", "x.com:99": "x.com:99",
    }
    frame = spark.createDataFrame([(h,) for h in hosts], "m string")
    assert {r["m"]: r["h"] for r in frame.select("m", secrets.host_part(F.col("m")).alias("h")).collect()} == hosts


def test_long_runs_take_linear_time_and_no_deep_stack(spark):
    size = 1_000_000
    runs = ["a." * (size // 2), "a" * size, "1.2" * (size // 3), "f" * size, "aB3" * (size // 3), "user=" + "b" * size, "x.com." * (size // 6), "https://" + "p/" * (size // 2), "token=" + "=" * size]
    rows = [(i, f"user=abc {run} at db.example.com x") for i, run in enumerate(runs)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    began = time.time()
    found = {r["doc_id"]: r["all"] for r in secrets.find_secrets(frame, "doc_id").select("doc_id", secrets.listed(F.col("spans")).alias("all")).collect()}
    cleaned = {r["doc_id"]: r["text"] for r in secrets.redacted(frame).collect()}
    assert time.time() - began < 120
    assert found[3] == f"identifier:0:8,hex:9:{9 + size}" and found[8].startswith("identifier:0:8,assign:9:")
    assert len(cleaned) == len(runs) and cleaned[3] == "[REDACTED] [REDACTED] at db.example.com x"


def test_weak_parts_clear_of_many_strong_ones(spark):
    """A dump: thousands of strong and weak spans in one text, the weak ones inside strong ones gone."""
    text = " ".join(f"user=u{i:04d} token=wJalrXUtnFEMI7K{i:07d} {'0' * 24}" for i in range(4000))
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = secrets.find_secrets(frame, "doc_id").select(secrets.listed(F.col("strong")).alias("base"), secrets.listed(F.col("spans")).alias("all")).first()
    assert row["base"] == plain_base(text)
    added = [s for s in row["all"].split(",") if s.split(":")[0] not in ("assign", "access", "hex")]
    assert len(added) == 4000 and {s.split(":")[0] for s in added} == {"identifier"}


def test_redaction(spark):
    frame = spark.createDataFrame([(1, f"é password=hunter22 {KEY}!", 99, "s"), (2, "plain", 5, "s"), (3, None, None, "s"), (1, f"{KEY}", 20, "s")], "doc_id bigint, text string, n_chars bigint, _found_spans string")
    got = secrets.redacted(frame.drop("_found_spans")).collect()
    assert sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in got if r["doc_id"] != 3) == [
        (1, "[REDACTED]", 10), (1, "é [REDACTED] [REDACTED]!", 24), (2, "plain", 5)
    ]
    assert len(got) == 4


# Language.

def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    named = QUERIES["op10_language"].run(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = named.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 100
    assert named.where("score < 0 OR score > 1").count() == 0


def test_texts_without_letters(spark):
    docs = spark.createDataFrame(
        [(1, "der die das und nicht", "de", "x"), (2, "the and of that with", "en", "x"), (3, None, "en", "x"), (4, "", None, "x"), (5, "12 ?!", "de", "x"), (None, "the that " * 20000, None, "x"), (2, "the and of that with", "en", "x")],
        "doc_id bigint, text string, lang string, _lang string",
    )
    got = {(r["doc_id"], r["text"] and r["text"][:3]): (r["_lang"], r["_score"]) for r in language.predict(docs, language.learn(docs)).collect()}
    assert got[1, "der"][0] == "de" and got[2, "the"][0] == "en" and got[None, "the"][0] == "en"
    assert got[3, None] == got[4, ""] == got[5, "12 "] == ("und", 0.0)
    nothing = language.predict(docs, language.learn(docs.where("lang IS NULL")))
    assert {r["_lang"] for r in nothing.collect()} == {"und"} and language.predict(docs.limit(0), language.learn(docs)).count() == 0


# Toxicity.

def test_toxic_documents_of_unseen_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    categories = {"low_quality": 1 - F.col("quality"), "toxicity": F.col("toxic")}
    chain = toxicity.learn(toxicity.labelled_sample(docs, labels.where("doc_id % 4 <> 0"), categories).cache(), list(categories))
    assert chain[1].before.shape == (1,)
    unseen = labels.where("doc_id % 4 = 0").select("doc_id", "toxic")
    scored = toxicity.predict(docs, chain, list(categories)).join(unseen, "doc_id").cache()
    caught = scored.where("toxicity >= 0.5")
    right = caught.where("toxic = 1").count()
    assert right >= 0.95 * caught.count() and right >= 0.8 * scored.where("toxic = 1").count() > 50


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "foul foul words here", 3), (3, "foul foul words here", 3), (None, "nice words", 3)], "doc_id bigint, text string, fold int")
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 1)], "doc_id bigint, toxic int")
    sample = toxicity.labelled_sample(docs, labels, {"toxic": F.col("toxic")})
    assert sorted(r["doc_id"] for r in sample.collect()) == [1, 2, 3]
    assert toxicity.predict(docs, toxicity.learn(sample, ["toxic"]), ["toxic"]).count() == 5
    empty = toxicity.labelled_sample(docs, labels.limit(0), {"toxic": F.col("toxic")})
    got = toxicity.predict(docs, toxicity.learn(empty, ["toxic"]), ["toxic"]).collect()
    assert len(got) == 5 and all(r["toxic"] < 0.01 for r in got)


def test_digest_columns(spark):
    row = QUERIES["op2_secrets"].run(spark, SF_DIR).where("spans = ''").first()
    assert row["base_sha256"] == hashlib.sha256(b"").hexdigest()
