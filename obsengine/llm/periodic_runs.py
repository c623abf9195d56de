"""Periodic run detection with string synchronising sets.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends, of length ``max(12, 2 * q)`` or more.  All runs of a text are found:

* periods up to ``DIRECT`` come from comparing the words with themselves, shifted;
* at the scale t (8, 16, 32, ...) the periods ``3t-1 .. 6t-2`` come from a
  t-synchronising set.  Windows of t words carry a hash; position i is selected if
  the least hash of the windows at ``i .. i+t`` stands at i or i+t, where windows of
  period t/3 or less (they lie in runs known by then) do not compete.  Whether i is
  selected depends on its context of 2t words alone, so both ends of a shift inside
  a run are selected: pairs of selected positions with equal context propose their
  distance as a period.  Equal contexts lie more than t/3 apart, which bounds the pairs;
* where all windows of a period have a small period p themselves, nothing is selected.
  Such a run joins two neighbouring runs of period p, and the phases of the two
  give its possible periods.

Every proposal is verified word by word and extended to both sides, so hashes decide
nothing but where to look.  Of equal stretches the smallest period counts (by Fine and
Wilf it divides the others).  Texts of an Arrow batch are searched together, closed
by numbers of their own that equal nothing; a task holds at most ``CHUNK_WORDS``
words at once, or one text.

Defined cases: a null or empty text, and one of fewer than 12 words, has no run and
collapses to its words joined by single spaces; a null id is kept; repeated rows are
searched alike, each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 12
#: Shortest stretch that counts as known while searching, and the periods found by shifting.
SHORTEST, FIRST_SCALE = 8, 8
DIRECT = 3 * FIRST_SCALE - 2
CHUNK_WORDS = 250_000

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array (its fixed values are those of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide."""
    return _mixed(h[:-width] * _ODD + h[width:])


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width + 1`` neighbours from each position on; ``width`` a power of two."""
    step = 1
    while step < width:
        a = np.minimum(a[:-step], a[step:])
        step *= 2
    return np.minimum(a[:-1], a[1:])


def _agree(t: np.ndarray, i: int, q: int, way: int) -> int:
    """How many words from i on (way 1) or before i (way -1) equal those q further on."""
    n, step, at = len(t), 16, 0
    while True:
        room = n - q - i - at if way > 0 else i - at
        step = min(step, room)
        if step <= 0:
            return at
        lo = i + at if way > 0 else i - at - step
        differ = t[lo:lo + step] != t[lo + q:lo + q + step]
        if differ.any():
            return at + int(differ.argmax() if way > 0 else differ[::-1].argmax())
        at += step
        step *= 2


class _Known:
    """Runs found so far: the smallest period of each stretch."""

    def __init__(self) -> None:
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, q: int) -> None:
        if q < self.period.get((start, end), q + 1):
            self.period[start, end] = q

    def arrays(self, largest: int, length: int) -> np.ndarray:
        """Rows (period, start, end) of period ``largest`` or less, sorted."""
        rows = [(p, s, e) for (s, e), p in self.period.items() if p <= largest and e - s >= length]
        return np.array(sorted(rows), np.int64).reshape(-1, 3)


def _shifted(t: np.ndarray, known: _Known) -> None:
    """Runs of the periods up to ``DIRECT``."""
    for q in range(1, min(DIRECT, len(t) - 1) + 1):
        same = np.flatnonzero(t[q:] == t[:-q])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) != 1)
        first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]] + 1
        for i in np.flatnonzero(last - first >= max(SHORTEST - q, q)):
            known.add(int(first[i]), int(last[i]) + q, q)


def _extended(t: np.ndarray, known: _Known, lo: int, hi: int, q: int) -> int:
    """Extend the equality of ``lo .. hi`` with the words q further on; keep it if it is
    a run.  Returns where the equality ends."""
    lo -= _agree(t, lo, q, -1)
    hi += _agree(t, hi, q, 1)
    if hi - lo >= q:
        known.add(lo, hi + q, q)
    return hi


def _selected(h: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """The synchronising set over the window hashes ``h``."""
    competing = np.where(periodic, _NONE, np.where(h == _NONE, _NONE - np.uint64(1), h))
    least = _least(competing, scale)
    n = len(least)
    return np.flatnonzero((least != _NONE) & ((competing[:n] == least) | (competing[scale:scale + n] == least)))


def _proposals(chosen: np.ndarray, context: np.ndarray, low: int, high: int) -> np.ndarray:
    """Rows (period, position): selected positions of equal context, ``low`` to below
    ``high`` apart, sorted."""
    order = np.argsort(context[chosen], kind="stable")
    at, same = chosen[order], context[chosen][order]
    found, left, lag = [], np.arange(len(at)), 1
    while len(left):
        left = left[left + lag < len(at)]
        apart = at[left + lag] - at[left]
        alive = (same[left + lag] == same[left]) & (apart < high)
        left, apart = left[alive], apart[alive]
        take = apart >= low
        found.append(np.stack([apart[take], at[left[take]]], 1))
        lag += 1
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def _joined(t: np.ndarray, known: _Known, scale: int) -> None:
    """Runs whose period has a small period itself: they join neighbouring runs of it."""
    low, high = 3 * scale - 1, 6 * scale - 1
    rows = known.arrays(scale // 3, low)
    if len(rows) < 2:
        return
    meet = np.flatnonzero((rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] <= rows[:-1, 2]))
    for k in meet:
        (p, a1, b1), (_, a2, b2) = rows[k].tolist(), rows[k + 1].tolist()
        most = min(b1 - a1, b2 - a2, (b2 - a1) // 2, high - 1)
        phase = next((o for o in range(p) if np.array_equal(t[a2 + o:a2 + o + p], t[b1 - p:b1])), None)
        if phase is None or most < low:
            continue
        q = a2 + phase - (b1 - p)
        q += -(-(low - q) // p) * p  # the least period in reach with these phases
        for q in range(q, most + 1, p):
            _extended(t, known, max(a1, a2 - q), min(b1, b2 - q), q)


def find_runs(t: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run in the word numbers ``t``: texts of the given
    lengths one after another, each closed by a number that stands nowhere else."""
    known = _Known()
    _shifted(t, known)
    size = lengths + 1
    where = np.arange(len(t))
    h, scale = _mixed(t.astype(np.uint64) * _ODD + np.uint64(1)), 1
    while scale < FIRST_SCALE and len(h) > scale:
        h = _doubled(h, scale)
        scale *= 2
    if scale < FIRST_SCALE:
        size = size[:0]
    while len(size):
        low, high = 3 * scale - 1, 6 * scale - 1
        long = size - 1 >= 2 * low
        if not long.any():
            break
        if not long.all():  # only texts that have room for such periods go on
            stay = np.repeat(long, size)
            h, where, size = h[stay[:len(h)]], where[stay], size[long]
        wide = _doubled(h, scale) if len(h) > scale else h[:0]
        if len(wide):
            mark = np.zeros(len(h) + 1, np.int32)
            rows = known.arrays(scale // 3, scale)
            inside = np.searchsorted(where, rows[:, 1])
            rows, inside = rows[inside < len(where)], inside[inside < len(where)]
            kept = where[inside] == rows[:, 1]
            np.add.at(mark, np.minimum(inside[kept], len(h)), 1)
            np.add.at(mark, np.minimum((inside + rows[:, 2] - rows[:, 1] - scale + 1)[kept], len(h)), -1)
            chosen = _selected(h, np.cumsum(mark[:-1]) > 0, scale)
            ends: dict[int, int] = {}
            for q, i in _proposals(chosen[chosen < len(wide)], wide, low, high).tolist():
                i = int(where[i])
                if i < ends.get(q, 0) or not np.array_equal(t[i:i + 2 * scale], t[i + q:i + q + 2 * scale]):
                    continue
                ends[q] = _extended(t, known, i, i + 2 * scale, q)
        _joined(t, known, scale)
        h = wide
        scale *= 2
    return sorted((s, e, p) for (s, e), p in known.period.items() if e - s >= max(MIN_LENGTH, 2 * p))


def runs_of(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every list of words, by start and period."""
    lengths = np.array([len(x) for x in texts], np.int64)
    total = int(lengths.sum())
    numbers, _ = pd.factorize(np.array([w for x in texts for w in x], object)) if total else (np.empty(0, np.int64), 0)
    stops = np.cumsum(lengths)
    t = np.insert(numbers.astype(np.int64), stops, total + np.arange(len(texts)))
    starts = stops - lengths + np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, p in find_runs(t, lengths):
        k = int(np.searchsorted(starts, s, "right")) - 1
        out[k].append((s - int(starts[k]), e - s, p))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The text without the words that a run repeats after its first period."""
    if not runs:
        return " ".join(words)
    drop = np.zeros(len(words) + 1, np.int32)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return " ".join(w for w, k in zip(words, kept, strict=True) if k)


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` per row: the runs (word number of the start,
    length, smallest period; by start, then period) and the text without repeats."""
    id_type = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                first, words, total = at, [], 0
                while at < len(texts) and (at == first or total < CHUNK_WORDS):
                    words.append(WORD.findall(texts[at].as_py()))
                    total += len(words[-1])
                    at += 1
                found = runs_of(words)
                flat = np.array([r for x in found for r in x], np.int64).reshape(-1, 3)
                offsets = np.cumsum([0] + [len(x) for x in found], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, at - first),
                    pa.array([len(x) for x in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                        [pa.array(flat[:, k]) for k in range(3)], fields=list(run))),
                    pa.array(list(map(collapse, words, found)), pa.string()),
                ], names=[id_col, "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col), body(text_col).alias("text")).mapInArrow(
        searched, f"`{id_col}` {id_type}, n_words bigint, runs {_RUNS}, collapsed string")
