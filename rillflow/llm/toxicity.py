"""Toxicity by a chain of linear classifiers.

Categories are predicted in a given order; each model also gets the log-odds of
the categories before it. For learning these come from models that have not
seen the row: labelled rows are dealt to folds by a hash, and a category's model
for a fold learns from the other folds. The last model of each category learns
from all labelled rows and is the one that predicts.

Features are the presence of words and of their first bytes, hashed, scaled by
their log-odds in the labelled rows. The labelled sample has at most about
``SAMPLE`` rows, a documented bound; every document is predicted.

Null and empty texts have no features and get the models' bias. A label that is
null keeps its row out of that category's learning. Repeated documents are
predicted each for itself and learned from once. Without labels of both kinds a
category's probability is its share of positive labels, 0 if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.shared import NOT_ALPHANUMERIC, coded, slices, words_of

SAMPLE = 12_000
FOLDS = 3
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
STEPS = 60
RATE = 0.1
PENALTY = 2e-4
LEAST_SIGNIFICANCE = 3.5
LARGEST_ODDS = 6.0


@dataclass
class Linear:
    """Weights of hashed features, of the categories before, and a bias."""

    weights: np.ndarray
    before: np.ndarray
    bias: float

    def odds(self, totals: np.ndarray, before: np.ndarray) -> np.ndarray:
        return np.clip(totals + before @ self.before + self.bias, -LARGEST_ODDS, LARGEST_ODDS)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of every text: row numbers and features, in order of rows."""
    words, offsets = words_of(texts, NOT_ALPHANUMERIC)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = coded(words)
    hashed = [np.array([xxhash.xxh3_64_intdigest(w) % BUCKETS for w in distinct], np.int64)]
    for length in PREFIXES:
        hashed.append(np.array([xxhash.xxh3_64_intdigest(b"^" + w[:length]) % BUCKETS for w in distinct], np.int64))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    # Equal words of a text first, on small numbers; then their features.
    pairs = np.unique(owner * len(distinct) + codes)
    owner, codes = pairs // len(distinct), pairs % len(distinct)
    every = np.unique(np.concatenate([owner * BUCKETS + h[codes] for h in hashed]))
    return every // BUCKETS, every % BUCKETS


def fit(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, before: np.ndarray) -> Linear:
    """Logistic regression on features scaled by their log-odds, by Adagrad over all rows at once."""
    n, positive = len(target), int(target.sum())
    if not 0 < positive < n:
        odds = -LARGEST_ODDS if not positive else LARGEST_ODDS
        return Linear(np.zeros(BUCKETS, np.float32), np.zeros(before.shape[1]), odds)
    held = np.bincount(columns, minlength=BUCKETS)
    with_ = np.bincount(columns, target[rows], minlength=BUCKETS)
    odds = np.log((with_ + 1) / (positive + 2)) - np.log((held - with_ + 1) / (n - positive + 2))
    # Rare words are nearly all on one side by chance; only what stands out from that is a feature.
    odds[np.abs(odds) < LEAST_SIGNIFICANCE * np.sqrt(1 / (with_ + 1) + 1 / (held - with_ + 1))] = 0
    used = odds[columns] != 0
    rows, columns = rows[used], columns[used]
    scale = odds[columns]
    w, c, b = np.full(BUCKETS, 0.1), np.zeros(before.shape[1]), np.log(positive / (n - positive))
    sums = [np.full(BUCKETS, 1e-8), np.full(before.shape[1], 1e-8), 1e-8]
    for _ in range(STEPS):
        z = np.bincount(rows, w[columns] * scale, minlength=n) + before @ c + b
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
        steps = [np.bincount(columns, miss[rows] * scale, minlength=BUCKETS) + PENALTY * w, before.T @ miss + PENALTY * c, miss.sum()]
        for k, g in enumerate(steps):
            sums[k] = sums[k] + g * g
        w -= RATE * steps[0] / np.sqrt(sums[0])
        c -= RATE * steps[1] / np.sqrt(sums[1])
        b -= RATE * steps[2] / np.sqrt(sums[2])
    return Linear((w * odds).astype(np.float32), c, float(b))


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, fold, features`` and a column for each category (0, 1 or null) of about ``sample`` labelled rows.

    The drawn labels are bounded by ``sample``, so they may be sent to all tasks
    and the texts need no shuffle.
    """
    total = labels.count()
    share = min(1.0, sample / total) if total else 0.0
    drawn = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)))
    drawn = drawn.select("doc_id", *[c.cast("double").alias(name) for name, c in categories.items()]).dropDuplicates(["doc_id"])
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"])
    names = list(categories)
    schema = f"doc_id bigint, fold int, features array<int>, {', '.join(f'{n} double' for n in names)}"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, columns = features(batch.column("text"))
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(columns.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), lists, *[batch.column(n) for n in names]], names=["doc_id", "fold", "features", *names])

    dealt = texts.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int")).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return dealt.select("doc_id", "text", "fold", *names).mapInArrow(extract, schema)


def _flat(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in frame["features"]], np.int64)
    return np.repeat(np.arange(len(frame)), lengths), np.concatenate([np.asarray(x, np.int64) for x in frame["features"]]) if len(frame) else np.zeros(0, np.int64)


def learn(sample: DataFrame, categories: list[str]) -> list[Linear]:
    """The chain's models. For each category one task per fold and one for all rows learns; the driver gets weights."""
    spark = sample.sparkSession
    chain: list[Linear] = []
    by_fold: list[dict[int, Linear]] = []
    models = [*range(FOLDS), -1]
    spread = sample.withColumn("model", F.explode(F.array(*map(F.lit, models)))).where("model <> fold")

    def odds_before(frame: pd.DataFrame, learned: list[dict[int, Linear]]) -> np.ndarray:
        """Of each earlier category, from the model that has not seen the row's fold."""
        rows, columns = _flat(frame)
        out, fold = np.zeros((len(frame), len(learned))), frame["fold"].to_numpy()
        for k, own in enumerate(learned):
            for f, model in own.items():
                here = fold == f
                out[here, k] = model.odds(np.bincount(rows, model.weights[columns], minlength=len(frame)), out[:, :k])[here]
        return out

    def trainer(category: str, shared):
        def train(frame: pd.DataFrame) -> pd.DataFrame:
            model_of = int(frame["model"].iloc[0])
            frame = frame[frame[category].notna()].sort_values("doc_id")
            rows, columns = _flat(frame)
            model = fit(rows, columns, frame[category].to_numpy(np.float64), odds_before(frame, shared.value))
            return pd.DataFrame({"model": [model_of], "weights": [model.weights.tobytes()], "before": [model.before.tolist()], "bias": [model.bias]})

        return train

    for category in categories:
        train = trainer(category, spark.sparkContext.broadcast(by_fold))
        found = spread.groupBy("model").applyInPandas(train, "model int, weights binary, before array<double>, bias double").collect()
        learned = {r["model"]: Linear(np.frombuffer(r["weights"], np.float32), np.array(r["before"], np.float64), r["bias"]) for r in found}
        empty = Linear(np.zeros(BUCKETS, np.float32), np.zeros(len(chain)), -LARGEST_ODDS)
        by_fold = [*by_fold, {f: learned.get(f, empty) for f in range(FOLDS)}]
        chain.append(learned.get(-1, empty))
    return chain


def predict(docs: DataFrame, chain: list[Linear], categories: list[str]) -> DataFrame:
    """``doc_id`` and the probability of every category for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, columns = features(batch.column("text"))
            odds = np.zeros((batch.num_rows, len(categories)))
            for k, model in enumerate(shared.value):
                odds[:, k] = model.odds(np.bincount(rows, model.weights[columns], minlength=batch.num_rows), odds[:, :k])
            chance = 1 / (1 + np.exp(-odds))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(chance[:, k]) for k in range(len(categories))]], names=["doc_id", *categories])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(score, "doc_id bigint, " + ", ".join(f"{c} double" for c in categories))
