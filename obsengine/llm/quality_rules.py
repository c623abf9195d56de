"""Quality rules: a threshold table compiled into one Spark projection.

``measures`` computes the counts of a text with built-in functions only;
``compile_rules`` turns a table of (measure, comparison, limit) rows into one
boolean column.  No user function, no shuffle: a text is judged in its scan
task.

Defined cases: a null text is an empty text (all counts 0, ``base_failed``
true because it has fewer than 20 words); a ratio over zero words is null and
passes its rule; repeated rows are judged alike; other columns of the input,
whatever their names, are neither read nor returned by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body, let, words

WINDOW = 8
SYMBOL = r"[^#*$%&|<>]+"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "be", "have",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "des", "dem", "ist", "sich",
    "le", "la", "les", "de", "et", "un", "une", "que", "qui", "en", "dans", "du",
    "el", "los", "las", "y", "no", "se", "del", "con", "por", "para", "un", "al",
)

#: (measure, comparison, limit): a text is kept if every row holds.
RULES = (
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 16.0),
    ("symbols_per_word", "<=", 0.1),
    ("stop_words", ">=", 1),
    ("dup_line_ratio", "<=", 0.5),
    ("bullet_line_ratio", "<=", 0.9),
    ("ellipsis_line_ratio", "<=", 0.3),
    ("lettered_word_ratio", ">=", 0.4),
)

COMPARISONS = {
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


def window_hashes(word_list: Column, n: int = WINDOW) -> Column:
    """A 64-bit hash of each window of ``n`` words (``n`` a power of two):
    neighbours are combined at distance 1, 2, 4, so each doubling is one pass."""
    def joined(step: int):
        return lambda h: F.zip_with(
            h, F.slice(h, step + 1, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    step = 1
    while step < n:
        hashed = let(hashed, joined(step))
        step *= 2
    return let(hashed, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0))))


def repeated_words(window_list: Column, n: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more: windows are sorted by
    (hash, position), those equal to a neighbour are marked, and the marked
    positions' spans are united."""
    entries = F.array_sort(F.transform(
        window_list, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = let(entries, lambda s: F.filter(s, lambda e, k: (
        (k > 0) & (F.get(s, k - 1)["h"] == e["h"]))
        | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))))
    positions = F.array_sort(F.transform(marked, lambda e: e["i"]))
    covered = F.aggregate(
        positions,
        F.struct(F.lit(-n).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(
            p.alias("last"),
            (acc["n"] + F.least(F.lit(n), p - acc["last"])).cast("long").alias("n")),
        lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(window_list)) == F.size(window_list),
                  F.lit(0).cast("long")).otherwise(covered)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts and ratios that rules may name."""
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = (docs.select(F.col(id_col).alias("_id"), body(text_col).alias("_text"))
             .select("_id", "_text", words(F.col("_text")).alias("_words"), lines.alias("_lines"))
             .select("_id", "_text", "_words", "_lines",
                     window_hashes(F.col("_words")).alias("_windows")))
    n_words = F.size("_words").cast("long")
    counted = parts.select(
        F.col("_id").alias(id_col),
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_windows")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_intersect("_words", F.array(*map(F.lit, dict.fromkeys(STOP_WORDS)))))
        .cast("long").alias("stop_words"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\t]*[-*•]")))
        .cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\t\r]*$")))
        .cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
    )

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b))

    return counted.withColumns({
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "bullet_line_ratio": share("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": share("n_ellipsis_lines", "n_lines"),
        "lettered_word_ratio": share("n_lettered", "n_words"),
    })


def compile_rules(rules=RULES) -> Column:
    """All rows of the threshold table as one boolean column; a null measure
    passes, an unknown comparison is refused."""
    verdict = F.lit(True)
    for name, comparison, limit in rules:
        verdict = verdict & F.coalesce(COMPARISONS[comparison](F.col(name), F.lit(limit)), F.lit(True))
    return verdict


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


def judge(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` per document."""
    judged = measures(docs, id_col, text_col).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def keep(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = judge(docs.select(whole.alias("_row"), F.col(text_col).alias("_body")),
                 rules, "_row", "_body").where("kept")
    return kept.select("_row.*")
