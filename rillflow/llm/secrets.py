"""Secret scan with multipart credential linking; DataFrame functions only.

Strong spans stand alone: an assignment to a secret's name (``assign``), an
access key id (``access``), a long hex run (``hex``). Weak parts are reported
only beside what completes them, within ``SCOPE`` characters: a weak
``identifier`` with a secret, a weak ``secret`` with an identifier, an
``endpoint`` with both. Parts are joined by overlapping intervals: each lies in
the block of its start, and identifiers, secrets and endpoints meet in equal
blocks of their text. A block is as long as the scope, so what meets in one is
bounded by its length, whatever the text.

Positions count code points, ends are exclusive. A null text is empty. Equal
texts are linked once and their spans given to every row; columns of the input
are passed through by ``redacted`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.shared import stage

SCOPE = 240
BLOCK = 64
MARK = "[REDACTED]"

# The contract's patterns, letters of names in either case.
_NAMES = "(password|passwd|secret|token|api_?key)"
ASSIGN = f"(?i:{_NAMES})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

# Weak parts.
IDENTIFIER = r"""(?:(?i:user_?name|user|login|client_?id|account|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}|(?:ASIA|AROA|AIDA)[A-Z0-9]{16,})"""
SECRET = "[A-Za-z0-9+/_-]{20,}={0,2}"
# An endpoint is an address or a whole run of host letters, which is then cut behind its last known suffix, or
# dropped. A run is consumed at once and no group repeats, so any text takes linear time and no deep stack.
ENDPOINT = "(?:https?://[A-Za-z0-9.:/_%-]+|[A-Za-z0-9.-]+(?::[0-9]{1,5})?)"
HOST = r"^(?:https?://.*|(?:[0-9]{1,3}[.]){3}[0-9]{1,3}(?::[0-9]{1,5})?$|[A-Za-z0-9.-]*[A-Za-z0-9-][.](?:com|net|org|io|internal|local)(?:$|:[0-9]{1,5}$|[.:-]))"
_SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"


def _named(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running_totals(numbers: Column) -> Column:
    """Running totals of an array; in blocks, so that long arrays do not cost the square of their length."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def in_blocks(x: Column) -> Column:
        heads = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
        sums = F.transform(heads, lambda b: total(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))
        return _named(sums, lambda s: _named(F.transform(heads, lambda b: total(F.slice(s, F.lit(1), b))), lambda before: F.transform(
            x, lambda _, i: F.get(before, F.floor(i / BLOCK).cast("int")) + total(F.slice(x, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1))
        )))

    return F.when(F.size(numbers) > 0, _named(numbers, in_blocks)).otherwise(F.array().cast("array<bigint>"))


def host_part(match: Column) -> Column:
    """The part of a match of ``ENDPOINT`` that names an endpoint; empty if none does."""
    return F.regexp_replace(F.regexp_extract(match, HOST, 0), "[.:-]+$", "")


def spans(text: Column, pattern: str, kind: int, keep=None, cut=None) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end), those that ``keep`` holds for.

    ``cut`` gives the first part of a match that counts; an empty one drops the match.

    What lies between matches and the matches alternate, so their lengths give
    the positions. Texts without a match are only searched once.
    """
    regex = F.lit(pattern)
    matches, between = F.regexp_extract_all(text, regex, F.lit(0)), F.split(text, pattern, -1)

    def place(m: Column) -> Column:
        steps = F.zip_with(m, F.slice(between, F.lit(1), F.size(m)), lambda a, b: (F.length(a) + F.length(b)).cast("bigint"))
        ends = running_totals(steps)
        placed = F.zip_with(m, ends, lambda a, e: F.struct(a.alias("text"), (e - F.length(a)).alias("start"), e.alias("end")))
        if keep is not None:
            placed = F.filter(placed, lambda x: keep(x["text"]))
        if cut is not None:
            placed = F.transform(placed, lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), (x["start"] + F.length(cut(x["text"]))).alias("end")))
            placed = F.filter(placed, lambda x: x["end"] > x["start"])
        return F.transform(placed, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.when(text.rlike(pattern), _named(matches, place)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def _is_mixed(text: Column) -> Column:
    return text.rlike("[0-9]") & text.rlike("[A-Z]") & text.rlike("[a-z]")


def _has_identifier(text: Column) -> Column:
    return text.rlike(ACCESS) | text.rlike(IDENTIFIER)


def parts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` with ``text_key, strong, weak``: the arrays of spans of every row; weak ones only beside an identifier, those that overlap strong ones too."""
    text = F.coalesce("text", F.lit(""))
    assign = spans(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
    rows = docs.select(*keep, text.alias("_text"), F.sha2(text, 256).alias("text_key"), F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2)).alias("strong"))
    text = F.col("_text")
    weak = F.concat(spans(text, IDENTIFIER, 3), spans(text, SECRET, 4, _is_mixed), spans(text, ENDPOINT, 5, cut=host_part))
    # Without an identifier nothing weak is ever complete.
    weak = F.when(_has_identifier(text), weak).otherwise(F.array().cast(_SPAN))
    return rows.select(*keep, "text_key", "strong", weak.alias("weak"))


def _clear_of_strong(each: DataFrame) -> DataFrame:
    """The spans without the weak ones that overlap a strong one: what overlaps shares a block of the text."""
    blocks = each.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE))))
    strong = blocks.where("kind < 3").select(F.col("text_key").alias("k"), F.col("block").alias("b"), F.col("start").alias("s"), F.col("end").alias("e"))
    meets = (F.col("text_key") == F.col("k")) & (F.col("block") == F.col("b")) & (F.col("s") < F.col("end")) & (F.col("e") > F.col("start"))
    covered = blocks.where("kind >= 3").join(strong, meets, "left_semi").select("text_key", "kind", "start", "end").distinct()
    return each.join(covered, ["text_key", "kind", "start", "end"], "left_anti")


def linked(found: DataFrame) -> DataFrame:
    """``text_key, added``: the weak spans of each text whose complementary parts are in scope."""
    texts = found.where(F.size("weak") > 0).groupBy("text_key").agg(F.first("strong").alias("strong"), F.first("weak").alias("weak"))
    each = _clear_of_strong(texts.select("text_key", F.explode(F.concat("strong", "weak")).alias("s")).select("text_key", "s.kind", "s.start", "s.end"))
    block = F.floor(F.col("start") / SCOPE)
    identifiers = each.where(F.col("kind").isin(1, 3))
    secrets = each.where(F.col("kind").isin(0, 2, 4))

    def spread(side: DataFrame) -> DataFrame:
        """A partner lies in every block in which a part that it may complete can start."""
        first = F.floor((F.col("start") - SCOPE) / SCOPE)
        last = F.floor((F.col("end") + SCOPE) / SCOPE)
        # A part that starts in an earlier block and is long enough to reach here is met from its own blocks.
        return side.select(F.col("text_key").alias("k"), F.explode(F.sequence(first - 1, last)).alias("b"), F.col("start").alias("s"), F.col("end").alias("e"))

    def in_scope(left: DataFrame, right: DataFrame) -> DataFrame:
        blocks = left.withColumn("blocks", F.sequence(block, F.floor(F.col("end") / SCOPE))).withColumn("b1", F.explode("blocks")).drop("blocks")
        r = spread(right)
        near = (F.col("text_key") == F.col("k")) & (F.col("b1") == F.col("b")) & (F.col("s") <= F.col("end") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE)
        return blocks.join(r, near, "left_semi").select("text_key", "kind", "start", "end").distinct()

    whole = (
        in_scope(identifiers.where("kind = 3"), secrets)
        .unionByName(in_scope(secrets.where("kind = 4"), identifiers))
        .unionByName(in_scope(in_scope(each.where("kind = 5"), identifiers), secrets))
    )
    return whole.groupBy("text_key").agg(F.collect_list(F.struct("kind", "start", "end")).cast(_SPAN).alias("added"))


def find_secrets(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` with the arrays ``strong`` and ``spans`` of every row, in order of start, then kind."""
    found = stage(parts(docs, *keep), "secrets")

    def in_order(x: Column) -> Column:
        return F.transform(F.array_sort(F.transform(x, lambda s: F.struct(s["start"], s["kind"], s["end"]))), lambda s: F.struct(s["kind"], s["start"], s["end"]))

    every = found.join(linked(found), "text_key", "left")
    every = every.withColumn("spans", F.concat("strong", F.coalesce("added", F.array().cast(_SPAN))))
    return every.select(*keep, "text_key", in_order(F.col("strong")).alias("strong"), in_order(F.col("spans")).alias("spans"))


def listed(span_array: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(span_array, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by a mark; ``n_chars``, where there is one, follows.

    Only texts in which a part is found are joined with their spans. Other
    columns pass through; the names ``_found_key`` and ``_found_spans`` are taken.
    """
    docs = docs.drop("_found_key", "_found_spans")
    text = F.coalesce("text", F.lit(""))
    suspect = text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX) | _has_identifier(text)
    dirty = docs.where(suspect)
    by_text = find_secrets(dirty.select("text").distinct()).where(F.size("spans") > 0).select(F.col("text_key").alias("_found_key"), F.col("spans").alias("_found_spans"))
    joined = dirty.withColumn("_found_key", F.sha2("text", 256)).join(by_text, "_found_key", "left")

    def cover(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["to"]
        gap = F.substring(F.col("text"), (done["to"] + 1).cast("int"), (s["start"] - done["to"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(done["out"], gap, F.lit(MARK))).otherwise(done["out"]).alias("out"),
            F.greatest(done["to"], s["end"]).alias("to"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("to"))
    clean = F.aggregate("_found_spans", start, cover, lambda d: F.concat(d["out"], F.substring(F.col("text"), (d["to"] + 1).cast("int"), F.length("text"))))
    new = {"text": F.coalesce(clean, F.col("text"))}
    out = joined.withColumns(new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_found_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return docs.where(~suspect).unionByName(out.select(*docs.columns))
