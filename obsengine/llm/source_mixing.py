"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key ``-ln(u) / w``: ``u`` is a hash of its id, ``w`` a
positive quality weight: a column of the documents (such as a classifier's score) where
one is named, else a measure of the text's symbols.  A source's token target is first served by complete
epochs (every document that many times); the rest is served by documents in key
order until their prefix sum of words meets the rest.  The document at the
border is taken when more than half of it lies inside, so a source ends within
half a document of its target.

Targets share ``budget`` times all words by source weight; no target exceeds
``max_epochs`` times its source, and the excess is shared anew by weight until
none does (solved in closed form over the sources, which are one row each).

Prefix sums are split: keys fall into ``buckets`` ranges, the words of a (source,
range) are summed with map-side combining, whole ranges are decided by these
sums, and only documents of the one border range of a source are sorted.  A
source with a third of all rows is therefore never gathered in one task.

Defined cases: a null text has size 0 and takes 0 words; a null source is a
source of its own, ordered last; a weight that is null, NaN, infinite or not above 0
counts as 1; sources without words have target 0; a null id
gets the key of the empty id; equal keys are ordered by id, then size; repeated
rows are separate rows with equal keys; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.common import body, words, written

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Key ranges per source; more ranges mean a smaller border range to sort.
BUCKETS = 16384


def uniform(id_col: Column, seed: str) -> Column:
    """A hash of the id as a number strictly between 0 and 1 (52 bits)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def quality_weight(text: Column, size: Column) -> Column:
    """1 for text free of markup symbols, falling to 1/2 as symbols reach one per word."""
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>!]+", ""))
    return F.when(size > 0, 1.0 - 0.5 * F.least(F.lit(1.0), symbols / size)).otherwise(F.lit(1.0))


def given_weight(weight: Column) -> Column:
    """A weight column made safe: whatever cannot scale a key counts as 1."""
    value = weight.cast("double")
    return F.when((value > 0) & (value < float("inf")), value).otherwise(F.lit(1.0))


def targets(sources: DataFrame, weights, budget: float, max_epochs: int) -> DataFrame:
    """Token target per source (``source, source_size`` in, one row each).

    With sources in the order of ``cap / weight``, the first k are at their cap
    and the others get ``level * weight``; k is the first for which the level
    stays below the next ratio."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(1))
    ranked = (sources.withColumn("weight", weight)
              .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    level = ((budget * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levels = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))
    return (levels.withColumn("chosen", F.min(fits).over(everything)["level"])
            .select("source", "source_size", "weight",
                    F.least("cap", F.coalesce(F.col("weight") * F.col("chosen"), F.col("cap")))
                    .alias("target")))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", seed: str = SEED, buckets: int = BUCKETS,
          weight_col: str | None = None) -> DataFrame:
    """``id, source, size, key, bucket`` per document; ranges are even in ``1 - exp(-key)``."""
    given = [] if weight_col is None else [given_weight(F.col(weight_col)).alias("weight")]
    sized = (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                         body(text_col).alias("text"), *given)
             .withColumn("size", F.size(words(F.col("text"))).cast("long")))
    weight = F.col("weight") if given else quality_weight(F.col("text"), F.col("size"))
    return sized.select(
        "id", "source", "size",
        (-F.log(uniform(F.col("id"), seed)) / weight).alias("key"),
    ).withColumn("bucket", F.floor((1.0 - F.exp(-F.col("key"))) * buckets).cast("int"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, buckets: int = BUCKETS, weight_col: str | None = None) -> DataFrame:
    """``id_col, source, size, source_size, target, epochs, selected, taken`` per document."""
    rows = written(sizes(docs, id_col, text_col, source_col, seed, buckets, weight_col), "mix-sizes")
    by_range = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")),
                       "mix-ranges")
    plan = targets(by_range.groupBy("source").agg(F.sum("words").alias("source_size")),
                   weights, budget, max_epochs)
    plan = (plan.withColumn("epochs", F.when(
                F.col("source_size") > 0,
                F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size"))))
                .otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranges = by_range.withColumn("through", F.sum("words").over(upto))
    same = plan["source"].eqNullSafe(ranges["source"])
    border = (plan.join(ranges, same)
              .where(F.col("through") >= F.col("rest"))
              .groupBy(plan["source"].alias("source"))
              .agg(F.min(F.struct("bucket", (F.col("through") - F.col("words")).alias("start")))
                   .alias("border")))
    plan = written(plan.join(border, plan["source"].eqNullSafe(border["source"]), "left")
                   .select(plan["source"].alias("mixed_source"), "source_size", "target", "epochs",
                           "rest", F.col("border.bucket").alias("border_bucket"),
                           F.col("border.start").alias("border_start")), "mix-plan")
    placed = rows.join(plan, rows["source"].eqNullSafe(plan["mixed_source"]))
    result = [F.col("id").alias(id_col), "source", "size", "source_size", "target", "epochs"]
    inside = placed.where("bucket = border_bucket")
    others = placed.where("NOT bucket <=> border_bucket").select(
        *result, F.coalesce(F.col("bucket") < F.col("border_bucket"), F.lit(False)).alias("selected"))
    order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    sorted_in = inside.withColumn(
        "start", F.col("border_start") + F.coalesce(F.sum("size").over(order), F.lit(0))).select(
        *result, (F.col("start") + F.col("size") / 2 <= F.col("rest")).alias("selected"))
    return others.unionByName(sorted_in).withColumn(
        "taken", F.col("size") * (F.col("epochs") + F.col("selected").cast("long")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix as documents: each taken as often as the mix takes it, with all columns.

    The counts per id are joined back; rows that share an id share its count
    (the largest of its rows)."""
    taken = (mix(docs, id_col=id_col, **options)
             .withColumn("copies", F.col("epochs") + F.col("selected").cast("long"))
             .groupBy(F.col(id_col).alias("_mixed_id")).agg(F.max("copies").alias("_copies")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(whole.alias("_row"), F.col(id_col).alias("_id"))
            .join(taken, F.col("_id").eqNullSafe(F.col("_mixed_id")))
            .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
            .select("_row.*"))
