"""Periodic runs of words, found by string synchronising sets.

A run is a longest stretch of words in which words ``q`` apart are equal, ``q``
its smallest period, that is at least three periods long. For every dyadic scale
t the synchronising set of a text holds the positions i for which, among the
t-word contexts that start in i..i+t, the least hash is that of i or of i+t;
contexts of period t/3 or less do not take part. Whether a position belongs
depends on its next 2t words alone, so a run that repeats them repeats the
position. Positions with equal contexts propose their distance as a period.

Why no run is missed: a run of period q starts with a highly periodic region or
has a position of the set among its first t; in the first case it has one
before the region's end, within q - 5t/3 of its start. With contexts of 4t words
for q from 2.5t to 4t, and of 5t for q up to 5t, that position's context fits
into the run once more q words on, and being at least q words long it does not
recur earlier, as the run would then have a smaller period. The scales' ranges
meet, from period 3 on. What contexts of small period would propose is omitted
by the sets: the highly periodic regions are known when a scale needs them, as
they are runs of the scales before, and those of one or two words are detected
directly.

Hashes propose only; a stretch is measured on the words themselves. A batch's
texts are laid end to end, a unique word after each. Memory is about a hundred
bytes for each word of the longest text or batch. Words are the maximal parts
without blanks. Null, empty and short texts have no run; a null text has no
words and collapses to an empty one. Repeated rows are rows of their own; other
columns pass through, those named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.llm.shared import BLANKS, coded, free_name, ranges, slices, sums_between, text_bytes, words_from

BATCH_BYTES = 2 << 20
LEAST_LENGTH = 24
POWER = 3
FOUND = "_n_words bigint, _runs array<struct<start:bigint,length:bigint,period:bigint>>, _collapsed string"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _joined(a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of the contexts made of ``a`` here and ``b`` ``apart`` words on."""
    n = min(len(a), len(b) - apart)
    return _mixed(a[:n] * _ODD + b[apart:apart + n]) if n > 0 else np.zeros(0, np.uint64)


def _least_within(x: np.ndarray, scale: int) -> np.ndarray:
    """The least of ``x[i:i + scale + 1]`` for every i; ``scale`` is a power of two."""
    span = 1
    while span < scale:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:-1], x[1:])


def synchronising_set(contexts: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """The positions of the set, ascending; ``contexts`` are hashes of ``scale`` words, ``periodic`` marks those left out."""
    if len(contexts) <= scale:
        return np.zeros(0, np.int64)
    held = np.where(periodic, _TOP, contexts)
    least = _least_within(held, scale)
    return np.flatnonzero((least != _TOP) & ((least == held[:len(least)]) | (least == held[scale:scale + len(least)])))


def _inside(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Marks the positions of ``starts[j]..ends[j]``, ends left out."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _proposals(keys: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and distance of neighbours with equal contexts of ``length`` words that overlap or touch."""
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    apart = np.diff(at)
    near = (keys[1:] == keys[:-1]) & (apart > 0) & (apart <= length)
    return at[:-1][near], apart[near]


def _first_difference(words: np.ndarray, at: int, apart: int, step: int) -> int:
    """The first place from ``at`` on, in the direction of ``step``, where words ``apart`` differ."""
    size, limit = 64, len(words) - apart
    while True:
        if step > 0:
            a, b = at, min(at + size, limit)
            if a >= b:
                return limit
            other = np.flatnonzero(words[a:b] != words[a + apart:b + apart])
            if len(other):
                return a + int(other[0])
            at = b
        else:
            a, b = max(at + 1 - size, 0), at + 1
            if a >= b:
                return -1
            other = np.flatnonzero(words[a:b] != words[a + apart:b + apart])
            if len(other):
                return a + int(other[-1])
            at = a - 1
        size *= 2


def _direct(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretches with a period, at least ``POWER`` periods long."""
    same = np.concatenate([[False], words[:-period] == words[period:], [False]]) if len(words) > period else np.zeros(2, bool)
    edge = np.flatnonzero(same[1:] != same[:-1])
    start, end = edge[::2], edge[1::2] + period
    long = end - start >= POWER * period
    return start[long], end[long]


def runs_of(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Start, end and smallest period of all runs in ``words`` (numbers), by start, then end.

    ``longest``: the words of the longest text in it; texts are parted by words that occur once.
    """
    found: dict[tuple[int, int], int] = {}
    for period in (1, 2):
        for key in zip(*(x.tolist() for x in _direct(words, period))):
            found.setdefault(key, period)
    level = [_mixed(words.view(np.uint64) * _ODD + _MIX)]
    level += [_joined(level[0], level[0], 1)]
    level += [_joined(level[1], level[1], 2)]
    scale = 1
    while 5 * scale * POWER <= 2 * longest:
        periods = np.array([(s, e) for (s, e), p in found.items() if POWER * p <= scale and e - s >= scale], np.int64).reshape(-1, 2)
        periodic = _inside(periods[:, 0], periods[:, 1] - scale + 1, len(level[0]))
        at = synchronising_set(level[0], scale, periodic)
        places, distances, reach = [], [], []
        for length, contexts in ((4 * scale, level[2]), (5 * scale, _joined(level[2], level[0], 4 * scale))):
            own = at[at < len(contexts)]
            place, distance = _proposals(contexts[own], own, length)
            places.append(place)
            distances.append(distance)
            reach.append(np.full(len(place), length))
        _measure(words, np.concatenate(places), np.concatenate(distances), np.concatenate(reach), found)
        scale *= 2
        level = [level[1], level[2], _joined(level[2], level[2], 2 * scale)]
    return sorted((s, e, p) for (s, e), p in found.items())


def _measure(words: np.ndarray, place: np.ndarray, distance: np.ndarray, reach: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Adds the runs that the proposals lie in; of proposals in one stretch only the first is measured."""
    order = np.lexsort((place, distance))
    measured, end = 0, -1
    for s, q, c in zip(*(x[order].tolist() for x in (place, distance, reach))):
        if q == measured and s < end:
            continue
        measured = q
        first = _first_difference(words, s + c - 1, q, -1) + 1
        if first > s:
            # Equal hashes of different words: what follows s is still to be looked at.
            end = s + 1
            first = _first_difference(words, s, q, -1) + 1
            if first > s:
                continue
        last = _first_difference(words, s, q, 1)
        end = last
        if last + q - first >= POWER * q:
            key = (first, last + q)
            found[key] = min(found.get(key, q), q)


def _batch_runs(codes: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in the text, length and period of the runs of a batch, ascending; texts of like length are searched together."""
    counts = np.diff(offsets)
    out = []
    classes = np.where(counts >= least, np.log2(np.maximum(counts, 1)).astype(np.int64), -1)
    for own_class in np.unique(classes[classes >= 0]):
        texts = np.flatnonzero(classes == own_class)
        sizes = counts[texts]
        heads = np.concatenate([[0], np.cumsum(sizes + 1)])
        line = np.empty(heads[-1], np.int64)
        line[ranges(heads[:-1], sizes)] = codes[ranges(offsets[:-1][texts], sizes)]
        line[heads[1:] - 1] = -1 - np.arange(len(texts))
        for start, end, period in runs_of(line, int(sizes.max())):
            if end - start >= least:
                own = int(np.searchsorted(heads, start, side="right")) - 1
                out.append((int(texts[own]), start - int(heads[own]), end - start, period))
    out.sort(key=lambda r: (r[0], r[1], r[3]))
    table = np.array(out, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def _collapsed(words: pa.Array, offsets: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    """Every text's words without the repetitions of its runs, joined by spaces."""
    at = offsets[text] + start
    kept = ~_inside(at + period, at + length, len(words))
    bounds = np.concatenate([[0], np.cumsum(sums_between(kept.astype(np.int64), offsets))])
    own = words.filter(pa.array(kept)) if len(text) else words
    lists = pa.LargeListArray.from_arrays(pa.array(bounds), own)
    return pc.binary_join(lists, b" " if pa.types.is_binary(own.type) else pa.scalar(b" ", own.type))


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_LENGTH, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``_n_words``, ``_runs`` and ``_collapsed``.

    ``_runs``: the runs of at least ``least`` words, by start, then period.
    ``_collapsed``: the words joined by single spaces, without those that lie in
    a run behind its first period.
    """
    new = StructType.fromDDL(FOUND)
    kept = [docs.schema[c] for c in (docs.columns if keep is None else keep) if c not in new.names]
    names = [f.name for f in kept]
    given = free_name("_run_text", [*names, *new.names])
    pair = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separators = np.ones(256, bool)
        separators[list(BLANKS)] = False
        for batch in slices(batches, given, BATCH_BYTES):
            raw, bounds = text_bytes(batch.column(given))
            words, offsets = words_from(raw, separators[raw], bounds)
            codes = coded(words)[0].astype(np.int64) if len(words) else np.zeros(0, np.int64)
            found = _batch_runs(codes, offsets, least)
            place = np.searchsorted(found[0], np.arange(batch.num_rows + 1))
            runs = pa.ListArray.from_arrays(pa.array(place.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x) for x in found[1:]], fields=list(pair)))
            collapsed = _collapsed(words, offsets, *found).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(np.diff(offsets)), runs, collapsed], names=[*names, *new.names])

    rows = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias(given))
    return rows.mapInArrow(find, StructType([*kept, *new.fields]))
