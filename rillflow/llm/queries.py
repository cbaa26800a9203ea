"""Registered queries of the training-data operators."""

from __future__ import annotations

import importlib.util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import ann, bpe, decontaminate, hilbert, language, near_dup, packing, ranked, runs, secrets, token_files, toxicity, warc
from rillflow.llm.shared import stage, table
from rillflow.queries import Query, Registered

QUERIES: dict[str, Registered] = {}


def registered(sql: str | None = None):
    """Adds a query as it is: these operators leave the session's settings alone."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = Registered(run, sql)
        return run

    return add


def public_vocabularies():
    """The installed package of public vocabularies."""
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None:
        raise RuntimeError("the package public_tokenizers is not installed")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    return public_vocabularies().path(name)


@registered()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as directly addressable codes and read back."""
    docs = table(spark, sf_dir, "documents")
    return token_files.read_documents(token_files.token_files(docs, tokenizer_path("word_bpe_49k.json"), 1))


@registered()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 tokens, with lexical neighbours side by side."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 0)


DECONTAMINATION_SQL = r"""
WITH words AS (
    SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (SELECT item_id, w, least(len(w), 13) AS size FROM item_words WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM sized)
), sizes AS (SELECT DISTINCT size FROM windows),
doc_windows AS (
    SELECT r, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS win
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM words, sizes WHERE len(w) >= size)
), found AS (SELECT r, size, p, item_id FROM doc_windows JOIN windows USING (size, win)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS place FROM found) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@registered(DECONTAMINATION_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.with_decision(decontaminate.mark(docs, table(spark, sf_dir, "benchmark")))
    return marked.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"), F.col("_contaminated").alias("contaminated"),
    )


def _shingles(source: str) -> str:
    """SQL for ``r, doc_id, s``: the 4-word shingles of every row of ``source``."""
    return f"""
    SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(list_slice(w, p, p + 3), ' ')) END) AS s
    FROM (SELECT r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {source})"""


NEAR_DUP_SQL = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
shingle AS MATERIALIZED ({_shingles('docs')}),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS MATERIALIZED (
    SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r
), links AS MATERIALIZED (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.r = c.a JOIN sizes y ON y.r = c.b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), reach AS (
    SELECT r AS a, r AS b FROM docs
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), ids AS (SELECT reach.a AS r, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY reach.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN ids USING (r) LEFT JOIN sizes USING (r)
"""


@registered(NEAR_DUP_SQL)
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked at a similarity of 0.8."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@registered()
def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards along the curve over language, source and size."""
    rows = hilbert.metadata(table(spark, sf_dir, "documents"))
    sharded = hilbert.hilbert_shards(rows, ["lang_code", "source_code", "size"], 40, "text_hash", "doc_id")
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


WARC_SQL = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(sha, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM rows
"""


@registered(WARC_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back by byte ranges."""
    records = warc.read_warc(spark, warc.warc_archive(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _found_sql(kind: int, pattern: str, condition: str = "true") -> str:
    """SQL for the spans of one pattern: lengths of what lies between the matches and of the matches."""
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT r, {kind} AS kind, e - length(m) AS s, e, m FROM (
        SELECT r, m[i] AS m, list_sum(list_transform(between[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e
        FROM (SELECT r, m, between, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT r, regexp_extract_all(text, '{quoted}') AS m, regexp_split_to_array(text, '{quoted}') AS between FROM docs WHERE regexp_matches(text, '{quoted}')
        ))
    ) WHERE {condition}"""


_ASSIGN_RE = f"(?:{_either_case('password')}|{_either_case('passwd')}|{_either_case('secret')}|{_either_case('token')}|{_either_case('api')}_?{_either_case('key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SECRETS_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
strong AS MATERIALIZED (
    {_found_sql(0, _ASSIGN_RE, "length(regexp_extract(m, '" + _ASSIGN_RE.replace("'", "''") + "', 1)) >= 6")}
    UNION ALL {_found_sql(1, secrets.ACCESS)} UNION ALL {_found_sql(2, secrets.HEX)}
), weak AS MATERIALIZED (
    SELECT r, kind, s, e FROM (SELECT r, kind, s, e FROM ({_found_sql(3, secrets.IDENTIFIER)}
    UNION ALL {_found_sql(4, secrets.SECRET, "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')")})
    UNION ALL SELECT r, kind, s, s + length(host) AS e FROM (
        SELECT *, regexp_replace(regexp_extract(m, '{secrets.HOST}'), '[.:-]+$', '') AS host FROM ({_found_sql(5, secrets.ENDPOINT)})) WHERE host <> '') w
    WHERE NOT EXISTS (SELECT 1 FROM strong t WHERE t.r = w.r AND t.s < w.e AND t.e > w.s)
), each_part AS (SELECT r, kind, s, e FROM strong UNION ALL SELECT r, kind, s, e FROM weak),
ids AS (SELECT * FROM each_part WHERE kind IN (1, 3)), keys AS (SELECT * FROM each_part WHERE kind IN (0, 2, 4)),
scoped AS (
    SELECT w.*, EXISTS (SELECT 1 FROM ids x WHERE x.r = w.r AND x.s <= w.e + {secrets.SCOPE} AND x.e >= w.s - {secrets.SCOPE}) AS by_id,
           EXISTS (SELECT 1 FROM keys x WHERE x.r = w.r AND x.s <= w.e + {secrets.SCOPE} AND x.e >= w.s - {secrets.SCOPE}) AS by_key
    FROM weak w
), every AS (
    SELECT r, kind, s, e FROM strong
    UNION ALL SELECT r, kind, s, e FROM scoped WHERE (kind = 3 AND by_key) OR (kind = 4 AND by_id) OR (kind = 5 AND by_id AND by_key)
), told AS (SELECT *, ['assign', 'access', 'hex', 'identifier', 'secret', 'endpoint'][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS span FROM every),
listed AS (
    SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
           string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans
    FROM told GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
"""


@registered(SECRETS_SQL)
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak parts only where they complete each other."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), "doc_id")
    base = secrets.listed(F.col("strong"))
    return found.select(
        "doc_id", *[_of_kind(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)],
        F.sha2(base, 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


def _of_kind(kind: int):
    return F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("bigint")


@registered()
def op1_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth vector among all others."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda key: key % 100 == 0)


@registered()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    model = language.learn(docs.where(~F.col("held_out")))
    named = language.predict(docs.select("doc_id", "held_out", "text"), model, for_length=False)
    return named.select("doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


@registered()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low quality, then toxicity, of every document; the second also learns from the first."""
    docs = table(spark, sf_dir, "documents")
    categories = {"low_quality": 1 - F.col("quality"), "toxicity": F.col("toxic")}
    sample = stage(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), categories), "labelled")
    chain = toxicity.learn(sample, list(categories))
    scored = toxicity.predict(docs, chain, list(categories))
    return scored.select("doc_id", "low_quality", "toxicity", (F.col("toxicity") >= 0.5).alias("toxic"))


@registered()
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids by the public ranks, and the bytes that they decode to."""
    vocabularies = public_vocabularies()
    shared = bpe.shared_vocabulary(spark, bpe.Vocabulary.from_file(vocabularies.path("byte_bpe_50k.tiktoken")))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), shared, vocabularies.PATTERN, keep=["doc_id"])
    decoded = bpe.decode(encoded, shared)
    return decoded.select(
        "doc_id", F.expr("octet_length(_ids) div 4").alias("n_tokens"), F.sha2("_ids", 256).alias("ids_sha256"), F.sha2("_decoded", 256).alias("decoded_sha256")
    )


RUNS_SQL = r"""
WITH words AS MATERIALIZED (
    SELECT r, doc_id, h, h // 10 AS g, w, len(w) AS n FROM (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               xor(4294967295, list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, 8 * length(CAST(doc_id AS VARCHAR))),
                       lambda i: CAST((ascii(substr(CAST(doc_id AS VARCHAR), CAST(1 + i // 8 AS INT), 1)) >> CAST(i % 8 AS INT)) & 1 AS BIGINT))),
                   lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1)))) AS h
        FROM documents)
), turned AS MATERIALIZED (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i:
               w[1 + CASE WHEN i < g % n THEN i ELSE g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) END]) ELSE w END AS w
    FROM words
), grams AS MATERIALIZED (
    SELECT r, i, hash(array_to_string(list_slice(w, i + 1, i + 16), ' ')) AS x FROM (SELECT r, w, unnest(range(0, n - 15)) AS i FROM turned WHERE n >= 24)
), often AS (SELECT r, x FROM grams GROUP BY r, x HAVING count(*) > 1),
repeated AS MATERIALIZED (SELECT grams.* FROM grams JOIN often USING (r, x)),
same AS (SELECT a.r, a.i, b.i - a.i AS q FROM repeated a JOIN repeated b ON a.r = b.r AND a.x = b.x AND b.i > a.i),
stretch AS (
    SELECT r, q, min(i) AS s, max(i) + 16 + q AS e
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same) GROUP BY r, q, island
), run AS MATERIALIZED (
    SELECT r, s AS "start", e - s AS "length", min(q) AS period FROM stretch WHERE e - s >= greatest(24, 3 * q) GROUP BY r, s, e
), told AS (
    SELECT r, count(*) AS n_runs, string_agg("start" || ',' || "length" || ',' || period || chr(10), '' ORDER BY "start", period) AS runs FROM run GROUP BY r
), best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY "length" / period DESC, "start", period) AS place FROM run) WHERE place = 1
), dropped AS (SELECT DISTINCT r, unnest(range("start" + period, "start" + "length")) AS i FROM run),
collapsed AS (
    SELECT r, string_agg(x.word, ' ' ORDER BY x.i) AS kept
    FROM (SELECT r, unnest(list_zip(w, range(0, n))) AS p FROM turned) t, LATERAL (SELECT t.p[1] AS word, t.p[2] AS i) x
    WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.r = t.r AND d.i = x.i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, "start", "length", period, 1000 * "length" // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM turned LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN collapsed USING (r)
"""


def _with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text as the contract has it: in a tenth of the documents, by the checksum of the id, words repeat from one on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turned = F.expr(r"""
        element_at(transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w ->
            if(size(w) = 0, '', element_at(transform(array(named_struct('a', cast(_g % size(w) as int), 'p', cast(1 + (size(w) - _g % size(w)) div (3 + _g % 8) as int))), c ->
                array_join(transform(w, (x, i) -> if(i < c.a, x, get(w, c.a + (i - c.a) % c.p))), ' ')), 1))), 1)""")
    rows = docs.select("doc_id", "text", checksum.alias("_h"), F.floor(checksum / 10).alias("_g"))
    return rows.select("doc_id", F.when(F.col("_h") % 10 == 0, turned).otherwise(F.col("text")).alias("text"))


@registered(RUNS_SQL)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document's words, and the words without their repetitions."""
    found = runs.periodic_runs(_with_periods(table(spark, sf_dir, "documents")), keep=["doc_id"])
    best = F.expr("""aggregate(_runs, _runs[0], (b, x) -> if(x.length * b.period > b.length * x.period, x, b))""")
    told = F.expr("""array_join(transform(_runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')""")
    rows = found.select("doc_id", F.size("_runs").cast("bigint").alias("n_runs"), F.when(F.size("_runs") > 0, best).alias("b"), told.alias("told"), "_collapsed")
    return rows.select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("1000 * b.length div b.period").alias("exponent_milli"),
        F.sha2("told", 256).alias("runs_sha256"), F.sha2("_collapsed", 256).alias("collapsed_sha256"),
    )


RANKED_SQL = r"""
WITH terms AS (
    SELECT r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), counted AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY r, doc_id, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY r),
corpus AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), corpus),
wanted AS (
    SELECT item, item_id, term, count(*) AS times FROM (
        SELECT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY item, item_id, term
), scored AS (
    SELECT item, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (r), corpus GROUP BY item, item_id, r, doc_id
)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0) WHERE place <= 10
"""


@registered(RANKED_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
