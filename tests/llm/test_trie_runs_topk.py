"""Prefix trie, periodic runs and top-k search against brute force, and the SQL of the
registered queries over the smallest tables."""
import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from obsengine.llm import oracle, periodic_runs, prefix_trie, queries, topk_search

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


# -- SQL -------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = queries.REGISTRY[name](spark, SMALL)
    columns = sorted(got.columns)
    want = con.sql(oracle.ORACLE[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]

    def rounded(row):
        return str(tuple(float(f"{x:.9g}") if isinstance(x, float) else x for x in row))

    assert (sorted(rounded(r) for r in got.select(*columns).collect())
            == sorted(rounded([r[i] for i in order]) for r in want.fetchall()))


# -- prefix trie -----------------------------------------------------------------

def brute_trie(conversations):
    members = collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def conversation_rows(conversations):
    return [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]


def test_trie_of_short_and_long_conversations(spark):
    rnd = random.Random(5)
    spine = [("user" if i % 2 == 0 else "assistant", f"t{i % 3}é") for i in range(70)]
    conversations = {}
    for c in range(120):
        cut = rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 24, 33, 40, 64, 70])
        conversations[c] = spine[:cut] + [("user", str(rnd.randint(0, 1))) for _ in range(rnd.choice([0, 0, 1, 9, 20]))]
    got = rows_of(prefix_trie.build(spark.createDataFrame(conversation_rows(conversations), TURNS)))
    assert got == brute_trie(conversations)


def test_trie_edge_cases(spark):
    rows = [(1, None, None, "a"), (1, 0, "", None), (2, None, "", "a"), (2, 5, "", ""), (None, 0, "u", "lost"),
            (-3, -300, "u", "x" * 100_000), (-3, 300, "u", "b"), (7, 1, "u", "same"), (7, 1, "u", "same")]
    conversations = {1: [("", "a"), ("", "")], 2: [("", "a"), ("", "")],
                     -3: [("u", "x" * 100_000), ("u", "b")], 7: [("u", "same")] * 2}
    df = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("clash") for c in ("pos", "key", "block", "id", "t1", "n_turns", "saved")})
    assert rows_of(prefix_trie.build(df)) == brute_trie(conversations)
    assert prefix_trie.build(spark.createDataFrame([], TURNS)).collect() == []


def test_trie_lists_many_ends_in_chunks(spark):
    ids = [*range(0, 20_000, 3), *range(10**12, 10**12 + 50)]
    df = spark.createDataFrame([(c, 0, "user", "hi") for c in ids], TURNS)
    leaf = prefix_trie.build(df).where("depth = 1").first()
    assert leaf.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (leaf.n_convs, leaf.saved_tokens) == (len(ids), 2 * (len(ids) - 1))


def test_rebuilt_conversations(spark):
    rnd = random.Random(2)
    given = {c: [("user", rnd.choice("abc")) for _ in range(rnd.randint(1, 14))] for c in range(40) if c % 7}
    head = {c: c * 5 % 9 for c in given}
    want = {c: given.get(c - c % 5, [])[:head[c]] + turns[head[c]:] for c, turns in given.items()}
    assert any(not x for x in want.values())
    turns, lengths = prefix_trie.rebuilt(
        spark.createDataFrame(conversation_rows(given), TURNS), F.col("conv_id") - F.col("conv_id") % 5,
        (F.col("conv_id") * 5 % 9).cast("int"))
    assert rows_of(prefix_trie.trie(turns, lengths)) == brute_trie(want)


# -- periodic runs ---------------------------------------------------------------

def brute_runs(w):
    number = {}
    a = np.array([number.setdefault(x, len(number)) for x in w])
    found = {}
    for q in range(1, len(a) // 2 + 1):
        edge = np.diff(np.concatenate(([0], (a[q:] == a[:-q]).astype(int), [0])))
        for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            if e - s >= q and e - s + q >= 12:
                found.setdefault((int(s), int(e) + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def hard_text(rnd):
    kind, letters = rnd.randint(0, 6), rnd.choice(["ab", "abc", "abcdefghij"])
    if kind == 0:
        return [rnd.choice(letters) for _ in range(rnd.randint(0, 500))]
    if kind == 1:  # one long period between other words
        u = [rnd.choice(letters) for _ in range(rnd.randint(1, 120))]
        return [*"xyz"[:rnd.randint(0, 3)], *[u[i % len(u)] for i in range(rnd.randint(0, 600))], *"pq"[:rnd.randint(0, 2)]]
    if kind == 2:  # runs of one small period that meet out of phase
        u = [rnd.choice(letters) for _ in range(rnd.randint(1, 9))]
        return [u[(i + o) % len(u)] for o in rnd.choices(range(9), k=3) for i in range(rnd.randint(10, 150))]
    if kind == 3:  # Fibonacci words are as repetitive as words get
        x, y = ["a"], ["a", "b"]
        while len(y) < 400:
            x, y = y, y + x
        return y
    if kind == 4:  # periods within periods
        u = [rnd.choice(letters) for _ in range(rnd.randint(1, 5))] * rnd.randint(2, 12) + [rnd.choice("xa")]
        return (u * rnd.randint(1, 5) + [rnd.choice("ab")]) * rnd.randint(1, 4)
    if kind == 5:  # Thue-Morse: squares, never more
        return ["ab"[bin(i).count("1") % 2] for i in range(rnd.randint(0, 400))]
    u = [str(rnd.randint(0, 40)) for _ in range(rnd.randint(23, 200))]
    return [w for _ in range(rnd.randint(1, 4)) for w in u[rnd.randint(0, 3):]]


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        texts = [hard_text(rnd) for _ in range(rnd.randint(1, 8))]
        assert periodic_runs.runs_of(texts) == [brute_runs(w) for w in texts]


def test_runs_of_hard_rows(spark):
    long = ["w%d" % (i * i % 977) for i in range(30_000)]
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 12), (5, "a " * 11), (None, "b\n" * 30), (4, "a " * 12),
             (6, " ".join(long)), (7, "x " + "y z " * 40 + "z y " * 40), (8, "  é " * 9)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns(
        {c: F.lit(0) for c in ("runs", "n_words", "collapsed", "top", "start")})
    got = collections.Counter((r.doc_id, r.n_words, str([tuple(x) for x in r.runs]), r.collapsed)
                              for r in periodic_runs.detect(df).collect())
    want = collections.Counter()
    for doc_id, text in texts:
        w = periodic_runs.WORD.findall(text or "")
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[doc_id, len(w), str(runs), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert got == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.detect(empty).collect() == []


def test_looped_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(100).collect()
    df = spark.createDataFrame([(d.doc_id, d.text) for d in docs], "doc_id long, text string")
    for doc_id, text, got in df.select("doc_id", "text", queries.looped(F.col("doc_id"), F.col("text"))).collect():
        w, h = periodic_runs.WORD.findall(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            a, n = h // 10 % len(w), len(w)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert periodic_runs.WORD.findall(got) == w


# -- top-k search ----------------------------------------------------------------

def brute_top(rows, is_query, k):
    out = []
    for i, (qid, q) in enumerate(rows):
        if q is None or None in q or not is_query(qid):
            continue
        scored = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, c, strict=True)))),
                         cid is None, cid or 0, j)
                        for j, (cid, c) in enumerate(rows)
                        if j != i and c is not None and None not in c and len(c) == len(q))[:k]
        out += [(qid, r + 1, None if no else cid, -score) for r, (score, no, cid, _) in enumerate(scored)]
    return sorted(out, key=str)


def top(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumns(
        {c: F.lit(1) for c in ("row", "id", "asks", "block", "group", "floor")})
    return sorted(map(tuple, topk_search.top_k(df, F.col("vec_id") % 3 == 0, k).collect()), key=str)


@pytest.mark.parametrize("dims,spread", [(64, 100), (7, 3), (1, 2), (33, 10**6), (4, 2**40)])
def test_top_k_matches_brute_force(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(topk_search, "SPARSE", 0.5)  # small tables reach the sparse path, too
    rnd = random.Random(dims)
    rows = [(i, [rnd.randint(-spread, spread) for _ in range(dims)]) for i in range(150)]
    assert top(spark, rows) == brute_top(rows, lambda i: i % 3 == 0, 5)


def test_top_k_edge_cases(spark):
    same = [1, 2, 3]
    rows = [(0, same), (0, same), (3, None), (6, [1, None, 3]), (9, [5]), (12, []), (15, []), (None, same),
            (None, [9, 9, 9]), (18, [2**62, 2**62, -2**63]), (4, [2**62, 2**62, 1])] + [(i, same) for i in range(20, 60)]
    assert top(spark, rows) == brute_top(rows, lambda i: i is not None and i % 3 == 0, 5)
    assert top(spark, [(0, same)]) == []
    assert top(spark, []) == []


def test_bounds_hold():
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(-300, 300, (40, 50)), rnd.integers(-300, 300, (60, 50))
    exact, before = a @ b.T, None
    for x, y in zip(topk_search.levels(a), topk_search.levels(b), strict=True):
        bound = x @ y.T
        assert (bound >= exact - 1e-6).all()
        before = bound if before is None else np.minimum(before, bound)
    assert before.mean() < (topk_search.levels(a)[0] @ topk_search.levels(b)[0].T).mean()
