"""Conversation prefix trie: ROLLUP over positional turn ids.

A turn gets an id of 24 bytes (128 bits of the SHA-256 of role and text, and the text's
length).  Conversations are laid out in rows of ``WIDTH`` positional id columns, and one
``GROUP BY key, ROLLUP(t1, ..., t8)`` with ``grouping_id()`` aggregates the prefixes of all
lengths together.  A long conversation continues in further rows, whose key is the node
that its previous row ends in, so all blocks of columns share the one aggregation.

* Keys: the node of a full row is a digest of everything up to it.  Rows find it by
  doubling (a row's digest joins that of the row 1, 2, 4, ... before it), which takes
  log2 of the longest conversation in rounds and never gathers a conversation.
* Sums over subtrees: a node hands its numbers to its at most ``WIDTH`` ancestors in its
  own row; rows below rows are added up along the tree of rows by pointer doubling.
* Members that end in a node are listed in chunks of ``CHUNK`` ids, and their digest
  is fed from sorted chunks one at a time.

Everything is dealt out by node, by (conversation, row) or by (conversation, block of
turns); counts, minima and sums combine before the shuffle, so a first turn or a
conversation that a third of the rows share stays spread.

Defined cases: rows without a conversation id belong to none and are left out; a null
role or text counts as empty; turns come by turn number (null first), ties by turn id, and
repeated rows are turns of their own; an empty table gives no rows, not even a root;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.common import body, written

WIDTH = 8
#: Turn numbers in a block while turns are numbered; conversation ids in a chunk of ends.
TURN_BLOCK, CHUNK = 256, 4096
#: The positional columns; the root's key is empty.
_IDS = [f"t{i}" for i in range(1, WIDTH + 1)]


def digest(value: Column) -> Column:
    """128 bits of the SHA-256 of a binary value."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def coded(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, turn_id`` of ``conv_id, turn, role, text``: texts stay behind here."""
    role, text = body("role"), body("text")
    size = F.octet_length(text)
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.concat(digest(F.concat_ws(":", F.octet_length(role), role, text).cast("binary")),
                 F.unhex(F.lpad(F.hex(size), 16, "0"))).alias("turn_id"))


def size_of(turn_id: Column) -> Column:
    """UTF-8 bytes of the text behind a turn id."""
    return F.conv(F.hex(F.substring(turn_id, 17, 8)), 16, 10).cast("bigint")


def numbered(codes: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_id, n_turns``: turns numbered from 0 within their conversation,
    block by block, so that a long conversation is not sorted in one task."""
    codes = codes.withColumn("part", F.floor(F.col("turn") / TURN_BLOCK))
    within = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "turn_id")
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("part")).rowsBetween(
        Window.unboundedPreceding, -1)
    parts = codes.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(F.col("conv_id").alias("of"), F.col("part").alias("in_part"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"),
                         F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    rows = codes.withColumn("at", F.row_number().over(within) - 1)
    return rows.join(parts, (F.col("conv_id") == F.col("of")) & F.col("part").eqNullSafe(F.col("in_part"))).select(
        "conv_id", (F.col("skipped") + F.col("at")).alias("pos"), "turn_id", "n_turns")


def laid_out(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation and block of ``WIDTH`` positions: ``conv_id, n_turns, block,
    t1 .. t8``.  ``turns`` has conv_id, pos, turn_id; ``conversations`` conv_id and n_turns; those
    without a turn get an empty row."""
    slot = F.col("pos") % WIDTH
    wide = turns.groupBy("conv_id", F.floor(F.col("pos") / WIDTH).alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("turn_id"))).alias(t) for i, t in enumerate(_IDS)])
    # a conversation's length reaches its rows by block number: no row meets more than one
    blocks = conversations.select(
        "conv_id", "n_turns", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.floor((F.col("n_turns") - 1) / WIDTH)))).alias("block"))
    return blocks.join(wide, ["conv_id", "block"], "left")


def _keyed(rows: DataFrame) -> DataFrame:
    """Add the ``key`` a row starts from, and put the node that a full row ends in behind
    its last turn id."""
    long = rows.where((F.col("n_turns") > WIDTH) & F.col(_IDS[-1]).isNotNull())
    top = long.agg(F.max("block")).first()[0] or 0
    done = written(long.select("conv_id", "block", digest(F.concat(*_IDS)).alias("node")), "trie-keys")
    step = 1
    while step <= top:
        earlier = done.select("conv_id", (F.col("block") + step).alias("block"), F.col("node").alias("earlier"))
        done = written(done.join(earlier, ["conv_id", "block"], "left").select(
            "conv_id", "block", F.coalesce(digest(F.concat("earlier", "node")), F.col("node")).alias("node")), "trie-keys")
        step *= 2
    starts = done.select("conv_id", (F.col("block") + 1).alias("block"), F.col("node").alias("key"))
    rows = (rows.join(starts, ["conv_id", "block"], "left")
            .join(done.withColumnRenamed("node", "ends_in"), ["conv_id", "block"], "left"))
    last = F.concat(F.col(_IDS[-1]), F.coalesce("ends_in", digest(F.concat(*_IDS))))
    return rows.withColumn(_IDS[-1], last).withColumn("key", F.coalesce("key", F.lit(b""))).drop("ends_in")


def path(key: Column) -> Column:
    """Node ids of the prefixes of a row: at 0 its key, at i the node of its first i turns
    (null beyond its end); the last one comes with the last turn id."""
    ids = [F.col(t) for t in _IDS]
    inner = [digest(F.concat(key, *ids[:i])) for i in range(1, WIDTH)]
    return F.array(key, *inner, F.substring(ids[-1], 25, 16))


def _nodes(rows: DataFrame) -> DataFrame:
    """The ROLLUP: one row per node with its members, its path and its depth."""
    names = ", ".join(_IDS)
    level = f"{WIDTH} - bit_count(grouping_id() & {2 ** WIDTH - 1})"
    there = " WHEN ".join(f"{i} THEN {t} IS NOT NULL" for i, t in enumerate(_IDS, 1))
    rolled = rows.sparkSession.sql(
        f"SELECT key, block, {names}, {level} AS level, min(conv_id) AS conv_id, count(*) AS n_convs "
        f"FROM {{rows}} GROUP BY key, block, ROLLUP({names}) "
        f"HAVING CASE {level} WHEN {there} ELSE block = 0 END", rows=rows)
    ids = path(F.col("key"))
    return rolled.select(
        "conv_id", "n_convs", "block", "level", (F.col("block") * WIDTH + F.col("level")).alias("depth"),
        F.slice(ids, F.lit(1), F.col("level") + 1).alias("path"),
        F.when(F.col("level") > 0, (F.col("n_convs") - 1) * size_of(F.get(F.array(*_IDS), F.col("level") - 1)))
        .otherwise(F.lit(0)).alias("saved"))


def _ends(rows: DataFrame) -> DataFrame:
    """``id, n_ends, ends_sha256`` of the nodes that conversations end in."""
    last = rows.where(F.col("block") == F.greatest(F.lit(0), F.floor((F.col("n_turns") - 1) / WIDTH)))
    size = F.col("n_turns") - WIDTH * F.col("block")
    chunks = last.select(F.get(path(F.col("key")), size.cast("int")).alias("id"), "conv_id").groupBy(
        "id", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("id", "chunk", F.size("ids").cast("bigint").alias("n"),
                           F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("listing"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count, state = None, 0, None
        for batch in batches:
            out = []
            for node, n, listing in zip(batch["id"], batch["n"], batch["listing"], strict=True):
                node = bytes(node)
                if node == held:
                    state.update(b",")
                else:
                    if held is not None:
                        out.append((held, count, state.hexdigest()))
                    held, count, state = node, 0, hashlib.sha256()
                state.update(listing.encode())
                count += n
            yield pd.DataFrame(out, columns=["id", "n_ends", "ends_sha256"])
        if held is not None:
            yield pd.DataFrame([(held, count, state.hexdigest())], columns=["id", "n_ends", "ends_sha256"])

    return chunks.repartition("id").sortWithinPartitions("id", "chunk").mapInPandas(
        digests, "id binary, n_ends bigint, ends_sha256 string")


_SUMS = ["saved", "leaves"]


def _below(own: DataFrame, top: int) -> DataFrame:
    """Sums over a row's whole subtree of rows.  ``own`` has id (the row's key), up (the key of
    the row it hangs from, null at the top) and its own sums."""
    reach = 1
    done = own
    while reach < top:
        given = done.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("id")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in _SUMS])
        higher = done.select(F.col("id").alias("up"), F.col("up").alias("up_up"))
        done = written(
            done.join(given, "id", "left").join(higher, "up", "left").select(
                "id", F.col("up_up").alias("up"),
                *[(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in _SUMS]), "trie-rows")
        reach *= 2
    return done


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of numbered turns (``conv_id, pos, turn_id``) of ``conversations``
    (``conv_id, n_turns``): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    rows = written(_keyed(written(laid_out(turns, conversations), "trie-layout")), "trie-rows-of-turns")
    nodes = _nodes(rows).withColumn("id", F.element_at("path", -1))
    nodes = written(nodes.join(_ends(rows), "id", "left").withColumn(
        "leaf", (F.coalesce("n_ends", F.lit(0)) == F.col("n_convs")).cast("bigint")), "trie-nodes")
    # to the ancestors of the own row; what reaches a row's key is the sum of the row
    upward = nodes.select("block", "level", "saved", "leaf", F.posexplode("path").alias("at", "id"))
    hanging = (F.col("at") == 0) & (F.col("block") > 0)
    sums = upward.groupBy("id").agg(
        F.count_if(F.col("at") == F.col("level") - 1).alias("n_children"),
        F.sum(F.when(~hanging, F.col("saved"))).alias("saved"), F.sum(F.when(~hanging, F.col("leaf"))).alias("leaves"),
        F.sum(F.when(hanging, F.col("saved"))).alias("row_saved"),
        F.sum(F.when(hanging, F.col("leaf"))).alias("row_leaves"))
    summed = nodes.drop("saved", "leaf").join(sums, "id")
    top = nodes.agg(F.max("block")).first()[0]
    if top:
        summed = written(summed, "trie-sums")
        holders = summed.where(F.col("row_leaves").isNotNull())
        own = holders.select("id", F.when(F.col("block") > 0, F.get("path", F.lit(0))).alias("up"),
                             F.col("row_saved").alias("saved"), F.col("row_leaves").alias("leaves"))
        below = _below(written(own, "trie-rows"), top)
        more = holders.select("id", "block", "path").join(below.drop("up"), "id").select(
            "block", "saved", "leaves", F.posexplode("path").alias("at", "id")).where(
            (F.col("at") > 0) | (F.col("block") == 0)).groupBy("id").agg(
            *[F.sum(c).alias(f"more_{c}") for c in _SUMS])
        summed = summed.join(more, "id", "left").withColumns(
            {c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0)) for c in _SUMS})
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return summed.withColumn("parent", F.when(F.col("depth") > 0, F.element_at("path", -2))).join(
        parents, "parent", "left").select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"))


def build(conversations: DataFrame) -> DataFrame:
    """The trie of a table ``conv_id, turn, role, text``."""
    turns = written(numbered(coded(conversations)), "trie-turns")
    return trie(turns, turns.where(F.col("pos") == 0).select("conv_id", "n_turns"))


def rebuilt(conversations: DataFrame, source: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations in which every ``conv_id`` starts with the first ``head``
    (at most ``WIDTH``) turns of conversation ``source``, then has its own turns after its
    first ``head``.  Both columns are computed from ``conv_id``."""
    turns = written(numbered(coded(conversations)), "trie-turns")
    # one row per conversation, with its first turns; a conversation may be the source of others
    ids = turns.where(F.col("pos") == 0).select("conv_id", "n_turns").withColumns({"source": source, "head": head})
    firsts = turns.where(F.col("pos") < WIDTH).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id"))).alias("firsts"))
    given = ids.join(firsts.withColumnRenamed("conv_id", "source"), "source", "left").select(
        "conv_id", "n_turns", "head", F.coalesce(F.slice("firsts", F.lit(1), F.col("head")), F.slice(
            F.array(F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(b"").alias("turn_id"))), 1, 0)).alias("given"))
    given = written(given, "trie-given")
    shift = given.select("conv_id", "head", F.size("given").cast("bigint").alias("n_given"))
    # own turns meet their conversation's shift, a row each: adaptive joins split a long one
    own = turns.where(F.col("pos") >= head).join(shift, "conv_id").select(
        "conv_id", (F.col("pos") - F.col("head") + F.col("n_given")).alias("pos"), "turn_id")
    taken = given.select("conv_id", F.explode("given").alias("t")).select("conv_id", "t.pos", "t.turn_id")
    lengths = given.select("conv_id", (F.size("given") + F.greatest(
        F.lit(0), F.col("n_turns") - F.col("head"))).cast("bigint").alias("n_turns"))
    return taken.unionByName(own), lengths
