"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-gram is its letters'
vectors, permuted by their place, bound by multiplication; a text is its
three-grams bundled by addition. A language's prototype bundles texts of that
language, and a text gets the language whose prototype has the largest cosine.

Prototypes are learned from at most ``PER_LANGUAGE`` texts of each language, a
documented bound, chosen by a hash of the id. Runs of anything but letters are
one blank; letters are lower-cased. A null text, or one without letters, is
``und`` with score 0. Repeated rows and rows with null ids are predicted like
any other. Without any labelled text all rows are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rillflow.llm.shared import slices
from rillflow.operators.lookup import lookup_join

DIMENSIONS = 1024
PER_LANGUAGE = 4000
LEARNING_PARTS = 8
#: Vectors of three-grams held at once, a byte for each dimension.
MOST_GRAMS = 20_000
GRAM_BLOCK = 2_000
BATCH_BYTES = 1 << 20
#: Scores for the length below this reject a text in the pipeline: noise of letters scores lower.
LEAST_SCORE = 0.25
#: The cosine of a text of fewer three-grams than this falls with the root of their number.
FULL_GRAMS = 200
UNKNOWN = "und"
_LETTERS: dict[int, int] = {}
_VECTORS: dict[int, np.ndarray] = {}


def letter_codes(points: np.ndarray) -> np.ndarray:
    """Each code point if it is a letter, else the blank."""
    distinct, place = np.unique(points, return_inverse=True)
    for p in distinct.tolist():
        if p not in _LETTERS:
            _LETTERS[p] = p if chr(p).isalpha() else 32
    return np.array([_LETTERS[p] for p in distinct.tolist()], np.int64)[place]


def letter_vector(point: int) -> np.ndarray:
    """The letter's vector: a rule of its code point, equal in every task."""
    if point not in _VECTORS:
        bits = np.random.default_rng([point, 20240607]).integers(0, 2, DIMENSIONS, dtype=np.int8)
        _VECTORS[point] = bits * 2 - 1
    return _VECTORS[point]


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """One vector for each three-gram: letters permuted by place and bound."""
    letters = np.stack([grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF])
    distinct, place = np.unique(letters, return_inverse=True)
    table = np.stack([letter_vector(int(p)) for p in distinct])
    place = place.reshape(letters.shape)
    out = np.roll(table, 2, axis=1)[place[0]]
    out *= np.roll(table, 1, axis=1)[place[1]]
    out *= table[place[2]]
    return out


def text_vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector for each text and whether it has letters."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    owners, grams, times = [], [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
        codes = letter_codes(points)
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = codes[kept]
        if len(codes) < 3:
            continue
        own, number = np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)
        owners.append(i)
        grams.append(own)
        times.append(number.astype(np.float32))
    if grams:
        distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
        vectors = gram_vectors(distinct) if len(distinct) <= MOST_GRAMS else None
        at = 0
        for i, own, number in zip(owners, grams, times):
            for first in range(0, len(own), GRAM_BLOCK):
                part = slice(first, first + GRAM_BLOCK)
                rows = vectors[place[at:at + len(own)][part]] if vectors is not None else gram_vectors(own[part])
                out[i] += number[part] @ rows.astype(np.float32)
            at += len(own)
            out[i] /= max(1e-9, float(np.linalg.norm(out[i])))
    lettered = np.zeros(len(texts), bool)
    lettered[owners] = True
    return out, lettered


def _training(docs: DataFrame, per_language: int) -> DataFrame:
    """``text, lang`` of labelled rows, about ``per_language`` of each language at most, chosen by a hash."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    counts = labelled.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n"))
    drawn = F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)
    # The counts are measured and sent to the texts: a language's texts never meet in one task.
    return lookup_join(labelled, counts, "lang", "of", "inner").where(drawn).select("text", "lang")


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes from ``text, lang, doc_id`` of labelled rows.

    Tasks bundle their own texts; what the driver gets is a vector per language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, limit=BATCH_BYTES):
            vectors, lettered = text_vectors(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs[lettered]):
                sums[lang] = sums.get(lang, 0) + vectors[lettered & (langs == lang)].sum(0, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], names=["lang", "vector"])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "vector": [np.sum(np.stack(frame["vector"]), axis=0)]})

    partial = _training(docs, per_language).repartition(LEARNING_PARTS).mapInArrow(bundle, "lang string, vector array<double>")
    rows = sorted(partial.groupBy("lang").applyInPandas(together, "lang string, vector array<double>").collect())
    if not rows:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    prototypes = np.array([r["vector"] for r in rows])
    # What all languages share says nothing about any of them.
    prototypes /= np.linalg.norm(prototypes, axis=1, keepdims=True)
    return [r["lang"] for r in rows], prototypes.astype(np.float32)


def _grams():
    return F.length(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], for_length: bool = True) -> DataFrame:
    """``docs`` with ``_lang`` and ``_score``, the cosine of the nearest prototype, at least 0.

    With ``for_length`` the cosine is divided by what a text of so many three-grams can reach of a long text's.
    Columns of these names that ``docs`` has are replaced.
    """
    languages, prototypes = model
    docs = docs.drop("_lang", "_score")
    shared = docs.sparkSession.sparkContext.broadcast((languages, prototypes))
    columns = docs.columns

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in slices(batches, limit=BATCH_BYTES):
            vectors, lettered = text_vectors(batch.column("text").to_pylist())
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if names:
                cosines = vectors @ table.T
                best = cosines.argmax(1)
                langs = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
                scores = np.where(lettered, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs), pa.array(scores)], names=[*columns, "_lang", "_score"])

    schema = StructType([*docs.schema.fields, StructField("_lang", StringType()), StructField("_score", DoubleType())])
    named = docs.mapInArrow(name, schema)
    if not for_length:
        return named
    reach = F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(1.0), F.coalesce(_grams(), F.lit(1))) / F.lit(float(FULL_GRAMS))))
    return named.withColumn("_score", F.least(F.lit(1.0), F.col("_score") / reach))


def held_out():
    """Whether a row is kept from learning: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
