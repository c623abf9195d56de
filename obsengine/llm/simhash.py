"""SimHash near-dedup with pigeonring candidate filtering.

A text's fingerprint is the bit-wise majority of the XXH64 hashes (seed 42) of
its word shingles.  Fingerprints within ``max_bits`` bits link; documents in one
connected component are near-duplicates.

Pigeonring: the 64 bits form a ring of ``max_bits + 1`` segments.  If two
fingerprints differ in at most d of 64 bits, some segment starts a chain whose
first l segments differ in at most ``l * d / (d + 1)`` bits together, for every l.
So the first segment is equal, and the first two differ in at most one bit.  That
pair is the join key: a fingerprint is listed under (start, first, second) and,
if its second segment has even parity, also under the 16 keys one bit away (two
segments one bit apart have different parity, so one listing is enough).  Longer
chains are checked before the full Hamming distance.

Copies collapse to one row per distinct fingerprint before anything is joined.
Under a key, members are compared in blocks and only a spanning forest is
returned, never all pairs.  A key with more than ``RUN_LIMIT`` members is spread
instead: every member goes to the points within ``max_bits - 1`` bits that share
its first segment; a point that has a member within one bit links all its members
exactly.  This is linear in the members and needs no gathering.

Defined cases: a null text counts as empty; a text without words has fingerprint
zero, which links like any other; fewer words than a shingle are hashed whole; a
null id takes part but never names a component (a component of null ids has null);
repeated rows share a fingerprint, and ``dedup`` keeps one of them; an empty table
gives no rows; other columns are kept by ``dedup`` and ignored by ``groups``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body, let, written
from obsengine.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Members under one key that a task compares directly.
RUN_LIMIT = 2048
#: Shingles hashed at a time, which bounds the memory of a very long text.
CHUNK = 1 << 16

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text as an unsigned number."""
    found = WORD.findall((text or "").translate(TO_LOWER))
    if not found:
        return 0
    count = max(1, len(found) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, CHUNK):
        part = found[start:start + CHUNK + shingle - 1]
        if len(found) < shingle:
            joined = [" ".join(part)]
        else:
            joined = map(" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        hashes = np.fromiter((digest(s, seed) for s in joined), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` per row, the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts],
                                     np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), of(body(text_col)).alias("fp"))


def _segment(fp: Column, start: Column | int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start * width).bitwiseAND((1 << width) - 1)


def ring_keys(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``key, fp``: every listing of a fingerprint (``max_bits + 1`` divides 64)."""
    m = max_bits + 1
    width = 64 // m
    listed = []
    for i in range(m):
        first, second = _segment(F.col("fp"), i, width), _segment(F.col("fp"), (i + 1) % m, width)
        flips = F.when(F.bit_count(second) % 2 == 0, F.array(
            F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(width)]
        )).otherwise(F.array(F.lit(0).cast("long")))
        head = F.lit(i).cast("long") * F.lit(1 << min(2 * width, 62)).cast("long")
        listed.append(F.transform(flips, _key(head, first, second, width)))
    return distinct.select(F.explode(F.flatten(F.array(*listed))).alias("key"), "fp")


def _key(head: Column, first: Column, second: Column, width: int):
    return lambda x: head + F.shiftleft(first, width) + second.bitwiseXOR(x)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64)).astype(np.int8)


def forest(run: np.ndarray, first: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the members of one run (distinct, unsigned) that are
    within ``max_bits``, as a spanning forest.  Chains from segment ``first`` are
    tested before the whole distance."""
    m = max_bits + 1
    width = np.uint64(64 // m)
    mask = np.uint64((1 << int(width)) - 1)
    links = []
    left = run
    waiting = np.empty(0, np.uint64)
    while len(left) or len(waiting):
        if not len(waiting):
            waiting, left = left[:1], left[1:]
        at, waiting = waiting[0], waiting[1:]
        if not len(left):
            continue
        x = left ^ at
        chain = np.zeros(len(x), np.int8)
        alive = np.ones(len(x), bool)
        for k in range(m - 1):
            chain = chain + _bits((x >> (np.uint64((first + k) % m) * width)) & mask)
            alive &= chain <= (k + 1) * max_bits // m
        near = np.zeros(len(x), bool)
        near[alive] = _bits(x[alive]) <= max_bits
        links += [(int(at), int(y)) for y in left[near]]
        waiting = np.concatenate([waiting, left[near]])
        left = left[~near]
    return links


def key_links(keyed: DataFrame, max_bits: int, run_limit: int) -> DataFrame:
    """``a, b, key``: links under each key, or (``b`` null) the members of a key
    that has more than ``run_limit`` of them."""
    shift = min(2 * (64 // (max_bits + 1)), 62)

    def run_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key, over = [], None, False

        def close() -> list[tuple[int, int | None, int]]:
            if over or key is None or sum(map(len, held)) < 2:
                return []
            run = np.unique(np.concatenate(held)).view(np.uint64)
            if len(run) < 2:
                return []
            signed = lambda v: int(np.uint64(v).view(np.int64))
            return [(signed(a), signed(b), key) for a, b in forest(run, key >> shift, max_bits)]

        def frame(rows):
            a, b, keys = zip(*rows, strict=True)
            return pd.DataFrame({"a": np.array(a, np.int64), "b": pd.array(b, dtype="Int64"),
                                 "key": np.array(keys, np.int64)})

        for batch in batches:
            keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy()
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            rows = []
            # Runs of one row inside a batch cannot link; only the last run may go on.
            live = np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == len(starts) - 1)
                                  | (np.arange(len(starts)) == 0))
            for s, e in zip(starts[live], ends[live], strict=True):
                if keys[s] != key:
                    rows += close()
                    held, key, over = [], int(keys[s]), False
                if over:
                    rows += [(int(v), None, key) for v in fps[s:e]]
                    continue
                held.append(fps[s:e])
                if sum(map(len, held)) > run_limit:
                    over = True
                    rows += [(int(v), None, key) for part in held for v in part]
                    held = []
            if rows:
                yield frame(rows)
        rows = close()
        if rows:
            yield frame(rows)

    parts = keyed.repartition("key").sortWithinPartitions("key")
    return parts.mapInPandas(run_links, "a long, b long, key long")


def spread_links(members: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: exact links among the members of crowded keys (``key, a``).

    Two members within d bits have a point one bit or less from one of them and
    d - 1 bits or less from the other.  Each point keeps its smallest near member
    (within one bit) and links every member to it."""
    m = max_bits + 1
    width = 64 // m
    start = F.shiftrightunsigned("key", min(2 * width, 62)).cast("int")
    masks = np.array([((1 << width) - 1) << (i * width) for i in range(m)], np.uint64).view(np.int64)
    first = F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in masks]), start + 1)
    # The first segment is equal, so only the other bits are flipped.
    single = F.filter(F.expr("transform(sequence(0, 63), b -> shiftleft(1L, b))"),
                      lambda s: s.bitwiseAND(F.col("first")) == 0)
    flips = F.array(F.lit(0).cast("long"))
    for _ in range(max_bits - 1):
        flips = let(flips, lambda f: F.array_distinct(F.concat(f, F.flatten(F.transform(
            f, lambda p: F.transform(F.col("single"), lambda s: p.bitwiseXOR(s)))))))
    own = members.select("key", F.col("a").alias("fp"), first.alias("first")).distinct()
    points = (own.withColumn("single", single)
              .select("key", "fp", F.explode(flips).alias("flip"))
              .select("key", "fp", F.bit_count("flip").alias("bits"),
                      F.col("fp").bitwiseXOR(F.col("flip")).alias("point")))
    near = points.groupBy("key", "point").agg(
        F.min(F.when(F.col("bits") <= 1, F.col("fp"))).alias("b"),
        F.count(F.lit(1)).alias("n")).where("n > 1 AND b IS NOT NULL")
    return points.join(near, ["key", "point"]).where("fp <> b").select(
        F.col("fp").alias("a"), "b").distinct()


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS,
                      run_limit: int = RUN_LIMIT) -> DataFrame:
    """``a, b``: links that connect all fingerprints within ``max_bits`` bits."""
    if 64 % (max_bits + 1) or max_bits < 1:
        raise ValueError("max_bits + 1 must divide 64")
    found = written(key_links(ring_keys(distinct, max_bits), max_bits, run_limit), "simhash-links")
    direct = found.where("b IS NOT NULL").select("a", "b")
    crowded = found.where("b IS NULL").select("key", "a")
    if crowded.isEmpty():
        return direct
    return direct.unionByName(spread_links(crowded, max_bits))


def _named(rows: DataFrame, max_bits: int, run_limit: int) -> DataFrame:
    """``fp, root, component_id, n`` per distinct fingerprint of ``id, fp``."""
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("first_id"),
                                             F.count(F.lit(1)).alias("n")), "simhash-classes")
    links = fingerprint_links(classes.select("fp"), max_bits, run_limit)
    roots = components(links.select("a", "b"), "simhash-components")
    named = (classes.join(roots, classes["fp"] == roots["node"], "left")
             .select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return written(named.join(names, "root").select("fp", "root", "component_id", "n"), "simhash-names")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           max_bits: int = MAX_BITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``id_col, fingerprint, component_id, links`` per row; ``links`` counts the
    documents with the same fingerprint, itself not included."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    return rows.join(_named(rows, max_bits, run_limit), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", (F.col("n") - 1).alias("links"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
          max_bits: int = MAX_BITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest id (without any id: any id); if several texts share that id, the one
    with the smallest hash; of rows that repeat id and text, one."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(whole.alias("_row"), F.col(text_col).alias("_text"), F.struct(
        F.col(id_col).alias("id"), F.xxhash64(body(text_col)).alias("h")).alias("_key"))
    rows = written(fingerprints(keyed, "_key", "_text", shingle)
                   .select(F.col("id").alias("key"), F.col("id.id").alias("id"), "fp"), "simhash-rows")
    chosen = (rows.join(_named(rows, max_bits, run_limit).select("fp", "root", "component_id"), "fp")
              .where("id <=> component_id")
              .groupBy("root").agg(F.min("key").alias("_key")))
    kept = keyed.join(chosen, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select("_row.*")
