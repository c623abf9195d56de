"""Line dedup by a segment-partition edit join.

A line of a document is dropped when an earlier line of the corpus (by document
id, then place) is equal to it or near it.  Two lines are near within one edit for
every ``CHARS_PER_EDIT`` characters of the shorter one, at most ``max_edits``; so the
shortest lines are near only to themselves.  Lines without a word always stay.

Equal lines meet by hash in one aggregation (map-side combined, so a very common
line costs one row per task).  Near lines: a line with a limit of k edits is cut into
k + 1 even segments; if another line is within k edits, one segment occurs in it
unchanged, near its own place.  Each line lists its segments,
and probes the segments of all lengths it may be near to with the substrings at the
places that can match (length-aware, multi-match-aware windows).  Keys with several
distinct lines are candidates; only their lines are fetched (behind a fixed-size
bit map, then an exact join) and verified by banded bit-parallel edit distance.

A task compares the members of a key; it returns the lines that have an earlier
near line, never pairs.  A key with more than ``RUN_LIMIT`` members is dealt out
again under the counts of ``2 * max_edits + 1`` groups of characters: edits change at
most ``2 * max_edits`` counts, so near lines agree in one whole group.  What is still
crowded (lines of one template) is rid of the start and end that all members of the
key share, and near remainders meet under what is left of them without up to
``max_edits`` characters; where a remainder has more such forms than the key has
members, blocks of the members meet in pairs instead.  Both ways are exact.

Defined cases: a null text stays null and an empty one empty; a text whose lines
are all dropped becomes empty; equal lines of one document keep their first place;
rows that repeat an id count as one document for equal lines; a null id comes
first; an empty table gives no rows; all other columns are returned as they are.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.llm.common import body, written

MAX_EDITS = 2
CHARS_PER_EDIT = 20
RUN_LIMIT = 2048
#: Lines a task remembers so as to list a common line once, not each time.
REMEMBERED = 200_000
#: Bits of the fixed-size map that lets candidates' lines through (16 MB).
MAP_BITS = 27
WORD = re.compile(r"[^\x20\x09-\x0D]")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def lines_of(text: str | None) -> Iterator[tuple[int, str]]:
    """Eligible lines of a text at their first place."""
    seen = set()
    for i, line in enumerate((text or "").split("\n")):
        if line not in seen and WORD.search(line):
            seen.add(line)
            yield i, line


def line_key(line: str) -> tuple[int, int]:
    data = line.encode("utf-8", "replace")
    return signed(xxhash.xxh64_intdigest(data, 42)), zlib.crc32(data)


def without(text: str | None, dropped) -> str | None:
    """The text without the lines at the places in ``dropped`` and without eligible
    lines that repeat an earlier one of the text."""
    if text is None:
        return None
    first = {}
    dropped = set(dropped)
    for i, line in lines_of(text):
        first[line] = i
    return "\n".join(line for i, line in enumerate(text.split("\n"))
                     if i not in dropped and first.get(line, i) == i)


def limit_of(length, max_edits: int):
    """Edits within which a line of this length (a number or an array) may be near a
    line that is not shorter."""
    return np.minimum(length // CHARS_PER_EDIT, max_edits)


def segments(length: int, max_edits: int) -> list[tuple[int, int]]:
    """(start, length) of the even segments of a line of this length."""
    n = max_edits + 1
    short, longer = divmod(length, n)
    found, at = [], 0
    for i in range(n):
        size = short + (i >= n - longer)
        found.append((at, size))
        at += size
    return found


def plan_of(length: int, max_edits: int) -> list[tuple[int, int, int]]:
    """(start, end, seed) of every substring that a line of this length lists: its
    own segments, and its probes of the segments of equal or shorter lines."""
    found = {}
    for other in range(max(length - max_edits, CHARS_PER_EDIT), length + 1):
        gap, limit = length - other, int(limit_of(other, max_edits))
        for i, (start, size) in enumerate(segments(other, limit) if gap <= limit else ()):
            after = limit - i
            low = max(0, start - i, start + gap - after)
            high = min(length - size, start + i, start + gap + after)
            for at in range(low, high + 1):
                found[at, at + size, other * (max_edits + 1) + i] = None
    return list(found)


def within(a: str, b: str, max_edits: int) -> bool:
    """Whether the edit distance of two texts is at most ``max_edits``.

    The band of ``2 * max_edits + 1`` diagonals is one bit vector per number of
    edits; a column is advanced with shifts and masks and the scan stops when no
    diagonal is left."""
    if abs(len(a) - len(b)) > max_edits:
        return False
    start, limit = 0, min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    end = 0
    while end < limit - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    k, band = max_edits, 2 * max_edits + 1
    full, n = (1 << band) - 1, len(a)
    reach = [sum(1 << (k + d) for d in range(e + 1)) for e in range(k + 1)]
    for j, c in enumerate(b):
        match = ends = 0
        for d in range(band):
            i = j + d - k
            if 0 <= i < n:
                if a[i] == c:
                    match |= 1 << d
                ends |= 1 << d
        # Diagonal d at column j stands at a[j + d]; bits outside a are cleared.
        inside = 0
        for d in range(band):
            if 0 <= j + 1 + d - k <= n:
                inside |= 1 << d
        fresh = [reach[0] & match & inside]
        for e in range(1, k + 1):
            fresh.append((reach[e] & match | reach[e - 1] & ends | reach[e - 1] >> 1
                          | fresh[e - 1] << 1 | fresh[e - 1]) & full & inside)
        reach = fresh
        if not reach[k]:
            return False
    return bool(reach[k] >> (k + n - len(b)) & 1)


def counts_of(line: str) -> np.ndarray:
    """Counts of 32 classes of characters."""
    return np.bincount(np.array([ord(c) for c in line], np.int64) % 61 % 32, minlength=32)


def later_near(run: list[str], max_edits: int) -> list[int]:
    """Places in ``run`` (ordered lines) that have an earlier line within the limit.
    Earlier lines are tried in growing stretches: among many near lines the first ones
    decide."""
    counted = np.stack([counts_of(line) for line in run]).astype(np.int32)
    length = np.array([len(line) for line in run])
    limits = limit_of(length, max_edits)
    found = []
    for y in range(1, len(run)):
        start, size = 0, 64
        while start < y:
            end = min(y, start + size)
            limit = np.minimum(limits[start:end], limits[y])
            near = np.abs(counted[start:end] - counted[y]).sum(axis=1) <= 2 * limit
            near &= (np.abs(length[start:end] - length[y]) <= limit) & (limit > 0)
            if any(within(run[start + x], run[y], int(limit[x])) for x in np.flatnonzero(near)):
                found.append(y)
                break
            start, size = end, size * 8
    return found


def shortened(text: str, max_edits: int) -> set[str]:
    """The text without up to ``max_edits`` of its characters, in all ways: two texts
    within that many edits have one of these forms in common."""
    found = last = {text}
    for _ in range(max_edits):
        last = {t[:i] + t[i + 1:] for t in last for i in range(len(t))}
        found = found | last
    return found


def _occurrences(docs: DataFrame) -> DataFrame:
    """``id, row, pos, h, c`` for the eligible lines of ``id, row, text``."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, pos, h, c = [], [], [], []
            for n, text in enumerate(batch["text"].to_pylist()):
                for i, line in lines_of(text):
                    key = line_key(line)
                    at.append(n)
                    pos.append(i)
                    h.append(key[0])
                    c.append(key[1])
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(at, pa.int64())),
                 batch["row"].take(pa.array(at, pa.int64())), pa.array(pos, pa.int32()),
                 pa.array(h, pa.int64()), pa.array(c, pa.int64())], ["id", "row", "pos", "h", "c"])

    schema = T.StructType([*docs.select("id", "row").schema, T.StructField("pos", T.IntegerType()),
                           T.StructField("h", T.LongType()), T.StructField("c", T.LongType())])
    return docs.mapInArrow(listed, schema)


def _segment_keys(docs: DataFrame, max_edits: int) -> DataFrame:
    """``key, h``: every listing of every line that is long enough."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plans, seen = {}, set()
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            keys, owners, sizes = [], [], []
            for text in batch["text"]:
                for _, line in lines_of(text):
                    n = len(line)
                    if n < CHARS_PER_EDIT:
                        continue
                    h = line_key(line)[0]
                    if h in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(h)
                    plan = plans.get(n)
                    if plan is None:
                        plan = plan_of(n, max_edits)
                        if len(plans) < 4096:
                            plans[n] = plan
                    keys += [digest(line[s:e], seed) for s, e, seed in plan]
                    owners.append(h)
                    sizes.append(len(plan))
            yield pd.DataFrame({"key": np.array(keys, np.uint64).view(np.int64),
                                "h": np.repeat(np.array(owners, np.int64), sizes)})

    return docs.select("text").mapInPandas(listed, "key long, h long")


def _shared_keys(keyed: DataFrame) -> DataFrame:
    """The rows of ``key, h`` whose key has at least two distinct ``h``, once each."""
    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = first = None
        many = False
        for batch in batches:
            keys, hs = batch["key"].to_numpy(), batch["h"].to_numpy()
            if not len(keys):
                continue
            if key is None:
                before_key, before_h = np.int64(~keys[0]), hs[0]
            else:
                before_key, before_h = np.int64(key), np.int64(first)
            all_keys, all_h = np.r_[before_key, keys], np.r_[before_h, hs]
            same = all_keys[1:] == all_keys[:-1]
            new = ~same | (all_h[1:] != all_h[:-1])  # once per (key, h)
            # A row counts if its key goes on with another line before or after it.
            joined = same & (all_h[1:] != all_h[:-1])
            run = np.cumsum(~same)
            crowded = np.zeros(run[-1] + 1, bool)
            crowded[run[joined]] = True
            carried = many and bool(same[0])
            if carried:
                crowded[0] = True
            keep = crowded[run] & new
            out_k, out_h = keys[keep], hs[keep]
            # The run that came in from the last batch shows its first line late.
            if not carried and key is not None and run[0] == 0 and crowded[0]:
                out_k, out_h = np.r_[np.int64(key), out_k], np.r_[np.int64(first), out_h]
            many = bool(crowded[run[-1]])
            key, first = keys[-1], hs[-1]
            yield pd.DataFrame({"key": out_k, "h": out_h})

    return (keyed.repartition("key").sortWithinPartitions("key", "h")
            .mapInPandas(shared, "key long, h long"))


def _bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit map of fixed size with the bits of ``h`` set."""
    place = F.col("h").bitwiseAND((1 << bits) - 1)
    rows = (hashes.select(place.alias("p"))
            .groupBy(F.shiftright("p", 15).alias("block"))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << 15) - 1)).alias("map")))
    full = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.toLocalIterator():  # at most 2 ** (bits - 15) blocks of 4 KB
        full[r.block * 4096:(r.block + 1) * 4096] = np.frombuffer(r.map, np.uint8)
    return full


def _candidate_lines(docs: DataFrame, hashes: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``h, c, first, line`` of the lines named in ``hashes``; ``first`` is the
    earliest (id, place)."""
    sent = docs.sparkSession.sparkContext.broadcast(_bit_map(hashes, bits))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, mask = sent.value, (1 << bits) - 1
        for batch in batches:
            at, pos, h, c, lines = [], [], [], [], []
            for n, text in enumerate(batch["text"].to_pylist()):
                for i, line in lines_of(text):
                    if len(line) >= CHARS_PER_EDIT:
                        key = line_key(line)
                        p = key[0] & mask
                        if full[p >> 3] >> (p & 7) & 1:
                            at.append(n)
                            pos.append(i)
                            h.append(key[0])
                            c.append(key[1])
                            lines.append(line)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(at, pa.int64())), pa.array(pos, pa.int32()),
                 pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(lines, pa.string())],
                ["id", "pos", "h", "c", "line"])

    schema = T.StructType([*docs.select("id").schema, T.StructField("pos", T.IntegerType()),
                           T.StructField("h", T.LongType()), T.StructField("c", T.LongType()),
                           T.StructField("line", T.StringType())])
    return (docs.select("id", "text").mapInArrow(passed, schema)
            .groupBy("h", "c", "line").agg(F.min(F.struct("id", "pos")).alias("first"))
            .join(hashes, "h", "left_semi"))


def _verified(members: DataFrame, max_edits: int, run_limit: int | None) -> DataFrame:
    """Under each key of ``key, first, line, h, c``: the lines with an earlier near
    line (``key`` null).  A key with more than ``run_limit`` members gives its
    members back under finer keys instead."""
    groups = 2 * max_edits + 1

    def finer(key: int, line: str) -> list[int]:
        counted = counts_of(line)
        return [signed(xxhash.xxh64_intdigest(
            np.r_[key, g, counted[g::groups]].astype(np.int64).tobytes(), 7)) for g in range(groups)]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        key, line, h, c = zip(*rows, strict=True)
        return pd.DataFrame({
            "key": pd.array(key, dtype="Int64"), "line": pd.Series(line, dtype=object),
            "h": np.array(h, np.int64), "c": np.array(c, np.int64)})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, over, held = None, False, []

        def close() -> list[tuple]:
            if over or len(held) < 2:
                return []
            return [(None, None, *held[y][1:])
                    for y in later_near([x[0] for x in held], max_edits)]

        for batch in batches:
            rows = []
            for k, line, h, c in zip(batch["key"].tolist(), batch["line"], batch["h"].tolist(),
                                     batch["c"].tolist(), strict=True):
                if k != key:
                    rows += close()
                    key, over, held = k, False, []
                if not over:
                    held.append((line, h, c))
                    if run_limit is None or len(held) <= run_limit:
                        continue
                    over = True
                else:
                    held = [(line, h, c)]
                rows += [(f, *x) for x in held for f in finer(key, x[0])]
                held = []
            if rows:
                yield frame(rows)
        rows = close()
        if rows:
            yield frame(rows)

    return (members.repartition("key").sortWithinPartitions("key", "first", "line")
            .select("key", "line", "h", "c")
            .mapInPandas(verify, "key long, line string, h long, c long"))


def _template_keys(members: DataFrame, max_edits: int) -> DataFrame:
    """``members`` under finer keys where their lines differ in a short part only.

    The least and the greatest line of a key share the start that all its lines share
    (and read backwards their end); without both, distances stay what they are.  The new
    keys name this start and end and not the old key, so a template whose lines meet
    under many keys is dealt out once."""
    back = F.reverse("line")
    shapes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("line").alias("low"), F.max("line").alias("high"),
        F.min(back).alias("back_low"), F.max(back).alias("back_high"),
        F.min(F.length("line")).alias("least"), F.max(F.length("line")).alias("most"))

    def trimmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                head = len(os.path.commonprefix([r.low, r.high]))
                tail = min(len(os.path.commonprefix([r.back_low, r.back_high])), r.least - head)
                forms = sum(math.comb(r.most - head - tail, i) for i in range(max_edits + 1))
                rows.append((r.key, head, tail, forms <= r.n))
            yield pd.DataFrame(rows, columns=["key", "head", "tail", "short"])

    placed = members.join(shapes.mapInPandas(trimmed, "key long, head int, tail int, short boolean"), "key")

    @F.pandas_udf("array<long>")
    def forms(frames: pd.Series, rests: pd.Series) -> pd.Series:
        digest = xxhash.xxh64_intdigest
        return pd.Series([[signed(digest(form.encode("utf-8", "replace"), frame & ((1 << 64) - 1)))
                           for form in shortened(rest, max_edits)] for frame, rest in zip(frames, rests, strict=True)])

    inner = F.length("line") - F.col("head") - F.col("tail")
    frame = F.xxhash64(F.substring("line", F.lit(1), F.col("head")),
                       F.substring("line", F.col("head") + 1 + inner, F.col("tail")))
    finer = (placed.where("short").dropDuplicates(["h", "c", "line", "head", "tail"])
             .withColumn("key", F.explode(forms(frame, F.substring("line", F.col("head") + 1, inner)))))
    return (placed.where("NOT short").select(*members.columns)
            .unionByName(finer.select(*members.columns)))


def _block_pairs(members: DataFrame, run_limit: int) -> DataFrame:
    """``members`` with keys under which any two of a key meet, though at most about
    ``2 * run_limit`` share one: a key's members are dealt into blocks, and a block
    goes to each of its pairs with another block."""
    sizes = members.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / run_limit).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("h", "c", "line"), F.col("blocks"))
    return (members.join(sizes, "key")
            .withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("key", F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
            .drop("blocks", "block", "other"))


def near_lines(docs: DataFrame, max_edits: int = MAX_EDITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``h, c`` of the lines of ``id, text`` that have an earlier near line."""
    shared = written(_shared_keys(_segment_keys(docs, max_edits)), "line-candidates")
    lines = written(_candidate_lines(docs, shared.select("h").distinct()), "line-texts")
    found = written(_verified(shared.join(lines, "h"), max_edits, run_limit), "line-near")
    near = found.where("key IS NULL").select("h", "c")
    crowded = found.where("key IS NOT NULL").select("key", "h", "c", "line").distinct()
    if not crowded.isEmpty():
        again = crowded.join(lines.select("h", "c", "line", "first"), ["h", "c", "line"])
        finer = written(_template_keys(again, max_edits), "line-templates")
        near = near.unionByName(
            _verified(_block_pairs(finer, run_limit), max_edits, None).select("h", "c"))
    return near.distinct()


def dropped_lines(docs: DataFrame, max_edits: int = MAX_EDITS,
                  run_limit: int = RUN_LIMIT) -> DataFrame:
    """``id, row, places`` of the lines to drop from ``id, row, text``."""
    places = written(_occurrences(docs), "line-places")
    repeated = (places.groupBy("h", "c")
                .agg(F.min("id").alias("least"), F.max(F.col("id").isNull()).alias("null_first"),
                     F.count(F.lit(1)).alias("n"))
                .where("n > 1")
                .select("h", "c", F.when(~F.col("null_first"), F.col("least")).alias("first_id"),
                        F.lit(False).alias("near")))
    near = near_lines(docs, max_edits, run_limit).select(
        "h", "c", F.lit(None).cast(repeated.schema["first_id"].dataType).alias("first_id"),
        F.lit(True).alias("near"))
    doomed = written(repeated.unionByName(near).groupBy("h", "c").agg(
        F.max("first_id").alias("first_id"), F.max("near").alias("near")), "line-doomed")
    return (places.join(doomed, ["h", "c"])
            .where(F.col("near") | ~F.col("id").eqNullSafe(F.col("first_id")))
            .groupBy("id", "row").agg(F.collect_set("pos").alias("places")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_edits: int = MAX_EDITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``docs`` with ``text_col`` rid of dropped lines."""
    row = F.xxhash64(body(text_col))
    parts = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    gone = dropped_lines(parts, max_edits, run_limit)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([without(t, () if p is None else p) for t, p in
                          zip(texts, places, strict=True)], dtype=object)

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    joined = docs.select(whole.alias("_row"), F.col(id_col).alias("_id"), row.alias("_hash")).join(
        gone, F.col("_id").eqNullSafe(gone["id"]) & (F.col("_hash") == gone["row"]), "left")
    return (joined.withColumn("_text", cleaned(F.col("_row").getField(text_col), F.col("places")))
            .select(*[F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
                      for c in docs.columns]))
