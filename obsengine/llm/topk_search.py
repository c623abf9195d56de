"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; each keeps its mean and its (population)
deviation.  For segments of n components,

    |x - y|^2  >=  sum n * ((mean_x - mean_y)^2 + (dev_x - dev_y)^2),

and as |x|^2 = sum n * (mean_x^2 + dev_x^2), this lower bound of the distance is the upper
bound ``sum n * (mean_x * mean_y + dev_x * dev_y)`` of the inner product.  Candidates
whose bound stays below the k-th best score of a query go, from coarse to fine segments;
survivors get their exact integer score.  Bounds carry a margin for rounding, so
nothing is lost and the result is exact.

Vectors are packed into blocks, query blocks are sent to groups of candidate blocks by
an equi-join on the group, and a task works on one pair of blocks at a time.  One
sixteenth of the blocks is searched first; the k-th best score from there prunes
the rest and keeps what the second pass returns near k rows a query.  Each row of
the query set meets all rows; no index and no approximation is involved.

Defined cases: a vector that is null or holds a null takes no part; vectors of
different lengths do not meet; a repeated row is a row of its own, so a query's copies
are its candidates, and repeated query ids have their ranks each; ties go to the smaller
id, a null id last; fewer than k candidates are all returned; scores beyond 64 bits
stop at their ends; an empty table or no query gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.common import written

#: Vectors in a block of candidates and of queries, and the share searched first.
BLOCK, QUERIES, FIRST_PART = 4096, 1024, 16
#: Candidate blocks that one group holds at most, if there are enough groups for all cores.
GROUP_BLOCKS = 64
#: Below this share of pairs left, pairs are handled one by one.
SPARSE, PAIRS = 0.05, 1 << 16
_LONG = np.iinfo(np.int64)

_BLOCK = "dims int, n int, wide boolean, rows binary, ids binary, named binary, data binary"


def _packed(rows, ids, named, matrix) -> list:
    small = not matrix.size or np.abs(matrix.astype(np.float64)).max() < 2 ** 31
    data = matrix.astype(np.int32 if small else np.int64)
    return [matrix.shape[1], len(rows), not small, rows.tobytes(), ids.tobytes(),
            named.tobytes(), np.ascontiguousarray(data).tobytes()]


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    kind = np.int64 if row["wide"] else np.int32
    return (np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64),
            np.frombuffer(row["named"], bool),
            np.frombuffer(row["data"], kind).reshape(row["n"], row["dims"]).astype(np.int64))


def _by_length(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the vectors of each length."""
    sizes = np.asarray(vectors.value_lengths())
    flat, starts = np.asarray(vectors.flatten()), np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[starts[at][:, None] + np.arange(size)] if size else np.empty((len(at), 0), np.int64)


def _table(rows: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_TYPES = [pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 4]
_NAMES = ["dims", "n", "wide", "rows", "ids", "named", "data"]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of candidates; rows are ordered by id within, so that ties keep their order."""
    for batch in batches:
        rows, ids = np.asarray(batch.column(0)), batch.column(1)
        named = np.asarray(ids.is_valid())
        numbers = np.asarray(ids.fill_null(_LONG.max)).astype(np.int64)
        out = []
        for at, matrix in _by_length(batch.column(2)):
            order = np.lexsort((rows[at], numbers[at], ~named[at]))
            at, matrix = at[order], matrix[order]
            for i in range(0, len(at), BLOCK):
                part = at[i:i + BLOCK]
                out.append(_packed(rows[part], numbers[part], named[part], matrix[i:i + BLOCK]))
        yield _table(out, _NAMES, _TYPES)


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of queries with the score that a candidate has to reach, if any."""
    for batch in batches:
        rows, ids, floors = (np.asarray(batch.column(k).fill_null(_LONG.min)) for k in (0, 1, 3))
        out = []
        for at, matrix in _by_length(batch.column(2)):
            for i in range(0, len(at), QUERIES):
                part = at[i:i + QUERIES]
                out.append([*_packed(rows[part], ids[part], np.ones(len(part), bool),
                                     matrix[i:i + QUERIES]), floors[part].tobytes()])
        yield _table(out, [*_NAMES, "floors"], [*_TYPES, pa.binary()])


def levels(matrix: np.ndarray) -> list[np.ndarray]:
    """Per resolution, a matrix whose products with another's bound the inner products."""
    x, dims, out, count = matrix.astype(np.float64), matrix.shape[1], [], 1
    while 2 * count <= dims:
        edges = np.arange(count) * dims // count
        size = np.diff(np.append(edges, dims))
        mean = np.add.reduceat(x, edges, axis=1) / size
        spread = np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, edges, axis=1)
        out.append(np.hstack([mean * np.sqrt(size), np.sqrt(spread)]))
        count *= 2
    return out


def exact_scores(a: np.ndarray, b: np.ndarray, paired: bool) -> np.ndarray:
    """Integer inner products of rows of ``a`` with rows of ``b``: all, or pair by pair."""
    largest = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if largest < 0 or largest >= 2 ** 63 or (a == _LONG.min).any() or (b == _LONG.min).any():
        a, b = a.astype(object), b.astype(object)
        big = (a * b).sum(axis=1) if paired else a @ b.T
        return np.clip(big, _LONG.min, _LONG.max).astype(np.int64)
    if paired:
        return (a * b).sum(axis=1)
    if largest < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _passing(a: np.ndarray, b: np.ndarray, floors: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Pairs still alive whose bound reaches the floor."""
    slack = 1e-9 * (np.sqrt((a ** 2).sum(1))[:, None] * np.sqrt((b ** 2).sum(1).max(initial=0)) + 1)
    need = floors[:, None] - slack
    if alive.mean() > SPARSE:
        return alive & (a @ b.T >= need)
    out, (i, j) = np.zeros_like(alive), np.nonzero(alive)
    for at in range(0, len(i), PAIRS):
        p, q = i[at:at + PAIRS], j[at:at + PAIRS]
        out[p, q] = (a[p] * b[q]).sum(1) >= need[p, 0]
    return out


def survivors(queries: np.ndarray, candidates: np.ndarray, floors: np.ndarray,
              mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of every pair that may reach the query's floor.
    ``mine`` marks a query's own row."""
    alive, bound = ~mine, floors.astype(np.float64)
    # a floor near the end of long is no floor: float64 has no room for a margin there
    bound[floors == _LONG.min] = -np.inf
    for a, b in zip(levels(queries), levels(candidates), strict=True):
        if not alive.any():
            break
        alive = _passing(a, b, bound, alive)
    if alive.mean() > SPARSE:
        score = exact_scores(queries, candidates, False)
        i, j = np.nonzero(alive & (score >= floors[:, None]))
        return i, j, score[i, j]
    i, j = np.nonzero(alive)
    score = np.concatenate([np.empty(0, np.int64)] + [
        exact_scores(queries[i[at:at + PAIRS]], candidates[j[at:at + PAIRS]], True)
        for at in range(0, len(i), PAIRS)])
    good = score >= floors[i]
    return i[good], j[good], score[good]


class _Best:
    """The k best rows so far of every query of one block."""

    def __init__(self, row: dict, k: int) -> None:
        self.rows, self.ids, _, self.vectors = _unpacked(row)
        self.floors, self.k = np.frombuffer(row["floors"], np.int64).copy(), k
        self.found = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]

    def _keep(self, *more: np.ndarray) -> None:
        query, score, named, ids, rows = (np.concatenate(x) for x in zip(self.found, more, strict=True))
        order = np.lexsort((rows, ids, ~named, ~score, query))
        first = np.searchsorted(query[order], query[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.found = [x[order] for x in (query, score, named, ids, rows)]
        full = np.flatnonzero(np.bincount(self.found[0], minlength=len(self.rows)) == self.k)
        last = np.searchsorted(self.found[0], full, "right") - 1
        self.floors[full] = np.maximum(self.floors[full], self.found[1][last])

    def meet(self, row: dict) -> None:
        rows, ids, named, vectors = _unpacked(row)
        if self.vectors.shape[1] != vectors.shape[1]:
            return
        mine = self.rows[:, None] == rows[None, :]
        new = np.flatnonzero(self.floors == _LONG.min)
        head = min(len(rows), 4 * self.k)
        if len(new) and head > self.k:  # a first floor: the k-th best of a few candidates
            score = exact_scores(self.vectors[new], vectors[:head], False)
            score[mine[new, :head]] = _LONG.min
            self.floors[new] = np.partition(score, head - self.k, axis=1)[:, head - self.k]
        i, j, score = survivors(self.vectors, vectors, self.floors, mine)
        self._keep(i, score, named[j], ids[j], rows[j])

    def batch(self) -> pa.RecordBatch:
        query, score, named, ids, rows = self.found
        return pa.RecordBatch.from_arrays(
            [pa.array(self.rows[query]), pa.array(self.ids[query]), pa.array(rows),
             pa.array(ids, mask=~named), pa.array(score)],
            names=["query_row", "query_id", "row", "vec_id", "score"])


_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def _search(queries: DataFrame, blocks: DataFrame, groups: int, k: int) -> DataFrame:
    """The k best of the given candidate blocks per group, for every query."""
    packed = queries.repartition(max(1, -(-queries.count() // QUERIES)), "row").mapInArrow(
        _pack_queries, _BLOCK + ", floors binary")
    sent = packed.select(F.monotonically_increasing_id().alias("q_block"), F.struct("*").alias("q"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    grouped = blocks.select(F.pmod(F.xxhash64("block", F.lit("group")), F.lit(groups)).cast("int").alias("group"),
                            F.struct(*_NAMES).alias("c"))
    pairs = sent.repartition(groups, "group").hint("merge").join(
        grouped.repartition(groups, "group"), "group").select("group", "q_block", "q", "c")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            for at in range(len(batch)):
                key = (batch.column(0)[at].as_py(), batch.column(1)[at].as_py())
                if key != held:
                    if state is not None:
                        yield state.batch()
                    held, state = key, _Best(batch.column(2)[at].as_py(), k)
                state.meet(batch.column(3)[at].as_py())
        if state is not None:
            yield state.batch()

    return pairs.mapInArrow(best, _FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "vector") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product for each row
    that ``is_query`` marks (null: no), among all others.  ``vector_col`` holds integers."""
    spark = vectors.sparkSession
    usable = F.col(vector_col).isNotNull() & ~F.coalesce(
        F.exists(vector_col, lambda x: x.isNull()), F.lit(False))
    rows = vectors.where(usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast("array<bigint>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = written(rows, "vectors")
    blocks = written(rows.select("row", "id", "vector").mapInArrow(_pack, _BLOCK)
                     .withColumn("block", F.monotonically_increasing_id()), "vector-blocks")
    count = blocks.count()
    first = F.pmod(F.xxhash64("block"), F.lit(FIRST_PART)) == 0
    asked = rows.where("asks").drop("asks")

    def groups(n: int) -> int:
        return max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, n // GROUP_BLOCKS)))

    by = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")

    def kept(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    early = written(kept(_search(asked.withColumn("floor", F.lit(None).cast("bigint")), blocks.where(first),
                                 groups(-(-count // FIRST_PART)), k)), "early-top")
    floors = early.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("floor"))
    late = _search(asked.join(floors, "row", "left").select("row", "id", "vector", "floor"),
                   blocks.where(~first), groups(count), k)
    return kept(early.drop("rank").unionByName(late)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
