"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its features: hashed words, hashed
character n-grams, one feature for a word that repeats its predecessor and one
for the end of the text.  A softmax layer gives the classes; vectors and layer are
trained together by numpy stochastic gradient descent.

Learning reads at most ``TRAIN_ROWS`` labelled documents (smallest hash of the id;
whole texts), featurised in tasks; the driver gets at most ``BUCKETS`` counts per
sampled document.  The trained model is linear in the mean, so scoring needs one
number per bucket: that vector (fixed size) is sent to the tasks, and each word's
sum is remembered per task within a bound.

Defined cases: a null text counts as empty; an empty text has the end feature
alone and so a score of its own; labels that are null or of unknown documents are
ignored; a document labelled twice takes the smaller label; without labels every
score is 0.5; repeated rows score alike; an empty table gives no rows; no other
column is an input.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body

BUCKETS = 1 << 16
GRAMS = (3, 4)
DIMENSIONS = 10
TRAIN_ROWS = 4000
EPOCHS = 12
RATE = 0.5
BATCH = 32
THRESHOLD = 0.3
MEMORY, MEMORY_CHARS = 300_000, 64
END, REPEAT = zlib.crc32(b"\x00end") % BUCKETS, zlib.crc32(b"\x00repeat") % BUCKETS


def buckets_of(word: str) -> list[int]:
    """Buckets of a word: itself and its character n-grams with border marks."""
    data = f"<{word}>"
    found = [zlib.crc32(b"\x01" + word.encode("utf-8", "replace")) % BUCKETS]
    for n in GRAMS:
        found += [zlib.crc32(data[i:i + n].encode("utf-8", "replace")) % BUCKETS
                  for i in range(len(data) - n + 1)]
    return found


def features(text: str) -> Counter:
    found = text.split()
    counted: Counter = Counter({END: 1})
    for word, n in Counter(found).items():
        for b in buckets_of(word):
            counted[b] += n
    repeats = sum(map(eq, found, found[1:]))
    if repeats:
        counted[REPEAT] += repeats
    return counted


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> np.ndarray:
    """Per bucket, what one feature there adds to the log odds of label 1 (before
    the mean), from (buckets, counts, label) rows."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / DIMENSIONS, 1.0 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer = np.zeros((DIMENSIONS, 2))
    if not rows:
        return np.zeros(BUCKETS)
    shares = [c / c.sum() for _, c, _ in rows]
    labels = np.array([y for _, _, y in rows])
    steps, done = EPOCHS * -(-len(rows) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            chosen = order[start:start + BATCH]
            idx = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([shares[i] for i in chosen])
            lengths = [len(rows[i][0]) for i in chosen]
            hidden = np.add.reduceat(vectors[idx] * share[:, None], np.r_[0, np.cumsum(lengths)[:-1]])
            logits = hidden @ layer
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1.0
            rate = RATE * (1.0 - done / steps)
            back = error @ layer.T
            layer -= rate * hidden.T @ error
            unique, where = np.unique(idx, return_inverse=True)
            spread = np.repeat(back, lengths, axis=0) * share[:, None]
            for d in range(DIMENSIONS):
                vectors[unique, d] -= rate * np.bincount(where, spread[:, d], len(unique))
            done += 1
    return vectors @ (layer[:, 1] - layer[:, 0])


def sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str,
           label_col: str, most: int = TRAIN_ROWS) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Featurised labelled documents, at most ``most``, one per id, in a fixed order."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
              .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & usable)
              .groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(most))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t) for t in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "label": batch["label"],
                "idx": [np.fromiter(f.keys(), np.int32) for f in found],
                "n": [np.fromiter(f.values(), np.int32) for f in found]})

    texts = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    # At most ``most`` rows, one per id however often it repeats: a bound that does not
    # grow with the table.
    rows = (texts.join(F.broadcast(chosen), "id")
            .groupBy("id", "label").agg(F.min("text").alias("text"))
            .select(F.col("id").cast("string"), F.col("label").cast("int"), "text")
            .mapInPandas(count, "id string, label int, idx array<int>, n array<int>").toArrow())
    # Arrays stay arrays: as Python numbers the sample would take ten times the memory.
    idx, n = ([x.values.to_numpy() for x in rows[c]] for c in ("idx", "n"))
    found = sorted(zip(rows["id"].to_pylist(), rows["label"].to_pylist(), idx, n, strict=True),
                   key=lambda r: (r[0], r[1], r[2].tobytes()))
    return [(i, k.astype(np.float32), y) for _, y, i, k in found]


def score(docs: DataFrame, model: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        add, known = sent.value, {}

        def of(word: str) -> tuple[float, int]:
            found = known.get(word)
            if found is None:
                where = buckets_of(word)
                found = (float(add[where].sum()), len(where))
                if len(word) <= MEMORY_CHARS:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[word] = found
            return found

        for texts in batches:
            odds = []
            for text in texts:
                found = text.split()
                repeats = sum(map(eq, found, found[1:]))
                sums = np.array([of(w) for w in found]).reshape(-1, 2).sum(axis=0)
                odds.append((sums[0] + add[END] + repeats * add[REPEAT]) / (sums[1] + 1 + repeats))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500))))

    return docs.withColumn("score", chance(body(text_col)))


def classify(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``id_col, score, predicted`` per document; ``usable`` (over ``id``) says which
    labels may be learned from."""
    usable = F.lit(True) if usable is None else usable
    model = train(sample(docs, labels, usable, id_col, text_col, label_col, train_rows))
    scored = score(docs.select(F.col(id_col), F.col(text_col).alias("_text")), model, "_text")
    return scored.select(id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
