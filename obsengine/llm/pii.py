"""PII: information-theoretic sanitisation.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers
that patterns find.  The corpus then tells which other terms give an entity away:
for every term in a text with an entity, counts over distinct texts estimate
``P(entity | term)`` and the information in bits ``log2(P(entity | term) /
P(entity))``.  A term seen with an entity in at least ``MIN_TEXTS`` texts, that carries
at least ``MIN_BITS`` and makes the entity at least ``REMOVE`` likely, is removed
wherever it stands; from ``GENERALISE`` on it is replaced by a general word.

Everything is built-in functions and joins.  A text is scanned for patterns in its
map task.  Of the texts without an entity only their distinct terms are shuffled.
Copies of a text count once and are combined before the shuffle, as are counts of
terms, so a hot group of copies neither skews a count nor a task.  Pairs are made
only where they can pass: an entity in too few texts, or in so many that no term
tells ``MIN_BITS`` about it, has none, nor has a term in more than ``1 / GENERALISE``
times the texts of the entity.

Positions: a pattern's matches and the text between them (``split`` by the same
pattern) alternate, so running sums of their lengths give starts in code points.
The patterns equal the plain ones but start only where a run starts, which keeps
them linear on long runs.

Defined cases: a null text counts as empty and has no spans; matches that fail
their check are dropped without another try; kinds are searched independently and
may overlap, while a term inside a base span adds none; a null id is kept as it
is; repeated rows get equal spans; an empty table gives no rows; other columns are
ignored by ``find`` and returned by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body, let, written

#: Kinds in their order, and what replaces their spans.
KINDS = ("email", "ip", "card", "phone", "term", "general")
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Single spaces and hyphens between digits become this mark, so that a card
#: number is one run of a character class (no nested repetition on long runs).
JOINT = "\ue000"
CARD = rf"[0-9][0-9{JOINT}]+"
WORD = r"[\p{L}][\p{L}\p{M}'’-]{2,}"

MIN_TEXTS = 2
MIN_BITS = 4.0
REMOVE = 0.5
GENERALISE = 0.25


def located(text: Column, pattern: str, keep=lambda value: value.isNotNull()) -> Column:
    """``value, start, end`` of every match whose value ``keep`` takes, leftmost and
    not overlapping.  Only these are gathered, so the time does not grow with the
    square of the others."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.split(text, pattern, -1), matches,
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("value")))
    empty = F.from_json(F.lit("[]"), "array<struct<value:string,start:int,end:int>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        here = F.struct(pair["value"].alias("value"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            keep(pair["value"]), F.concat(acc["out"], F.array(here))).otherwise(acc["out"])
            .alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step,
                       lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def weight(i: Column, d: Column) -> Column:
        v = F.substring(d, -i, F.lit(1)).cast("int")
        twice = 2 * v
        return F.when(i % 2 == 1, v).when(twice > 9, twice - 9).otherwise(twice)

    return let(digits, lambda d: F.aggregate(
        F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + weight(i, d)) % 10 == 0)


def _typed(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["value"].alias("value")))


def _when_found(found: Column, spans: Column) -> Column:
    none = F.from_json(F.lit("[]"), "array<struct<value:string,start:int,end:int>>")
    return F.when(found, spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """The protected entities of a text, by start and kind."""
    emails = _when_found(text.contains("@"), located(text, EMAIL))
    octet = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
    ips = _when_found(text.rlike(r"[0-9]\.[0-9]"), F.filter(
        located(text, IP),
        lambda s: F.forall(F.split(s["value"], r"\."), lambda part: part.rlike(octet))))
    joined = F.regexp_replace(F.translate(text, JOINT, "x"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    cards = _when_found(text.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"), F.filter(
        let(joined, lambda t: located(t, CARD)),
        lambda s: F.length(_digits(s["value"])).between(14, 19) & luhn(_digits(s["value"]))))
    phones = _when_found(text.contains("+"), F.filter(
        located(text, PHONE), lambda s: F.length(_digits(s["value"])).between(10, 15)))
    found = [_typed(spans, kind) for kind, spans in
             zip(KINDS, (emails, ips, cards, phones), strict=False)]
    return F.array_sort(F.concat(*found))


def _terms(text: Column) -> Column:
    """The distinct lower-case terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, row, spans, terms`` per row; ``row`` is a hash of the text, ``terms`` are the
    terms outside of the spans, null where there is no span."""
    text = body(text_col)
    found = (docs.select(F.col(id_col).alias("id"), text.alias("text"))
             .select("id", "text", F.xxhash64("text").alias("row"), base_spans(F.col("text")).alias("spans")))
    outside = _filled(F.col("text"), F.col("spans"), lambda s: F.lit("\n"))
    return found.select("id", "row", "spans",
                        F.when(F.size("spans") > 0, _terms(outside)).alias("terms"))


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str,
                     min_texts: int = MIN_TEXTS, min_bits: float = MIN_BITS,
                     generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame | None:
    """``term, kind`` of the terms over the thresholds; None if no entity occurs often
    enough to be estimated."""
    names = F.array_distinct(F.transform(
        "spans", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    held = written(found.where(F.size("spans") > 0).select("row", names.alias("entities"), "terms")
                   .dropDuplicates(["row"]), "pii-texts")
    total = found.select("row").distinct().agg(F.count(F.lit(1)).alias("texts"))
    named = held.select("row", F.explode("entities").alias("entity"))
    # No term tells more about an entity than one that only its texts hold.
    often = written(
        named.groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
        .where(F.col("with_entity") >= min_texts)
        .join(F.broadcast(total))  # one row
        .where(F.log2(F.col("texts") / F.col("with_entity")) >= min_bits), "pii-entities")
    if often.isEmpty():
        return None
    kept = named.join(often, "entity")
    listed = (held.select("row", "terms").join(
        kept.groupBy("row").agg(F.max("with_entity").alias("most")), "row")
        .select("row", "most", F.explode("terms").alias("term")))
    candidates = (listed.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.max("most").alias("most"))
                  .where(F.col("n") >= min_texts).select("term", "most"))
    # A term's texts: each text's own terms once, copies once.
    text = body(text_col)
    per_term = (docs.select(F.xxhash64(text).alias("row"), _terms(text).alias("terms"))
                .dropDuplicates(["row"]).select(F.explode("terms").alias("term"))
                .groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
                .where(F.col("with_term") >= min_texts))
    rare = written(candidates.join(per_term, "term")
                   .where(F.col("with_term") * generalise <= F.col("most"))
                   .select("term", "with_term"), "pii-candidates")
    chance = F.col("together") / F.col("with_term")
    bits = F.log2(chance * F.col("texts") / F.col("with_entity"))
    judged = (listed.select("row", "term").join(rare, "term").join(kept, "row")
              .where(F.col("with_term") * generalise <= F.col("with_entity"))
              .groupBy("entity", "term", "with_entity", "with_term", "texts")
              .agg(F.count(F.lit(1)).alias("together"))
              .where((F.col("together") >= min_texts) & (chance >= generalise) & (bits >= min_bits))
              .groupBy("term").agg(F.max(chance).alias("chance")))
    return judged.select("term", F.when(F.col("chance") >= remove, "term")
                         .otherwise("general").alias("kind"))


def term_spans(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """``id, row, terms``: the places of disclosing terms, for the texts that have any."""
    text = body(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("row"))
    listed = (rows.select("id", "row", F.explode(_terms(F.col("text"))).alias("term"))
              .join(terms, "term").distinct()
              .groupBy("id", "row").agg(F.map_from_entries(F.collect_set(
                  F.struct("term", "kind"))).alias("kinds")))
    # ``rows`` repeat if a row does; distinct (id, row) have one text.
    places = rows.join(
        listed.withColumnsRenamed({"id": "lid", "row": "lrow"}),
        F.col("id").eqNullSafe(F.col("lid")) & (F.col("row") == F.col("lrow"))
    ).dropDuplicates(["id", "row"])
    marked = located(F.col("text"), WORD, lambda value: value.isNotNull()
                     & F.map_contains_key(F.col("kinds"), F.lower(value)))
    return places.select("id", "row", F.transform(marked, lambda s: let(
        F.element_at(F.col("kinds"), F.lower(s["value"])), lambda kind: F.struct(
            s["start"].alias("start"),
            F.when(kind == "term", KINDS.index("term")).otherwise(KINDS.index("general")).alias("rank"),
            s["end"].alias("end"), kind.alias("kind"), s["value"].alias("value")))).alias("terms"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``id_col, row, base, spans`` per row: entities, and entities with terms."""
    found = written(entities(docs, id_col, text_col), "pii-spans")
    terms = disclosing_terms(found, docs, text_col, **thresholds)
    base = F.col("spans").alias("base")
    if terms is None:
        return found.select(F.col("id").alias(id_col), "row", base, "spans")
    places = term_spans(docs, id_col, text_col, written(terms, "pii-terms")).withColumnsRenamed(
        {"id": "tid", "row": "trow"})
    free = F.filter("terms", lambda t: ~F.exists(
        "spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    both = F.when(F.col("terms").isNull(), F.col("spans")).otherwise(
        F.array_sort(F.concat("spans", free)))
    return (found.drop("terms").join(places, F.col("id").eqNullSafe(F.col("tid")) & (F.col("row") == F.col("trow")),
                       "left")
            .select(F.col("id").alias(id_col), "row", base, both.alias("spans")))


def listing(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _filled(text: Column, spans: Column, mark) -> Column:
    """The text with ``mark(span)`` in place of each span; of overlapping spans the
    first counts."""
    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), mark(s))
        return F.when(s["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), piece.alias("out")))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(
                           text, acc["at"] + 1, F.length(text))))


def replaced(text: Column, spans: Column) -> Column:
    """The text with entities and general terms replaced by their kind in brackets
    and other disclosing terms removed; of overlapping spans the first counts."""
    return _filled(text, spans, lambda s: F.when(s["kind"] == "term", F.lit("")).when(
        s["kind"] == "general", F.lit("[something]")).otherwise(
        F.concat(F.lit("["), s["kind"], F.lit("]"))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **thresholds) -> DataFrame:
    """``docs`` with sanitised texts; null texts stay null."""
    spans = (find(docs, id_col, text_col, **thresholds).where(F.size("spans") > 0)
             .select(F.col(id_col).alias("_sid"), F.col("row").alias("_srow"), F.col("spans").alias("_spans"))
             .dropDuplicates(["_sid", "_srow"]))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    joined = docs.select(whole.alias("_row"), F.col(id_col).alias("_id"),
                         F.col(text_col).alias("_text")).join(
        spans, F.col("_id").eqNullSafe(F.col("_sid"))
        & (F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_srow")), "left")
    clean = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(
        replaced(F.col("_text"), F.col("_spans")))
    return joined.withColumn("_clean", clean).select(*[
        F.col("_clean").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
        for c in docs.columns])
