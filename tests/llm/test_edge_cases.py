"""Empty tables, clashing columns, repeated rows and very long texts, operator by operator."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obsengine.llm import (
    exact_dedup,
    html_extraction,
    line_dedup,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    source_mixing,
    url_filters,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the river of stone and night " * 20_000
#: Names that the operators use for columns of their own.
CLASHES = ("id", "row", "h", "c", "key", "terms", "spans", "size", "weight", "bucket", "score", "digest",
           "words", "_text", "_row", "_id", "places", "first", "fingerprint", "host", "rest")


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


@pytest.fixture
def docs(spark):
    rows = [(1, "the river of stone", "en", "a", 0), (2, None, None, None, None), (3, "", "en", "b", 0),
            (None, "the river of stone", "en", "a", 0), (4, LONG, "en", "a", 0)] + [(7, "BUY now a@b.co", "en", "b", 0)] * 3
    return spark.createDataFrame(rows, DOCS)


def classified(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1), (1, 1), (7, 0), (9, None)], "doc_id long, quality int")
    return quality_classifier.classify(docs, labels)


PER_ROW = {
    "quality_rules": quality_rules.judge,
    "source_mixing": source_mixing.mix,
    "classifier": classified,
    "pii": lambda docs: pii.find(docs).select("doc_id", pii.listing(F.col("spans")).alias("spans")),
    "sanitise": pii.sanitise,
    "line_dedup": line_dedup.dedup,
    "simhash": simhash.groups,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_hard_documents(docs, name):
    op = PER_ROW[name]
    plain = op(docs)
    assert op(docs.limit(0)).count() == 0
    columns = [c for c in plain.columns if c not in CLASHES or c in ("size", "score", "spans", "fingerprint")]
    got = sorted(map(repr, plain.select(columns).collect()))
    assert len(got) == docs.count()
    with_more = op(clashing(docs))
    assert sorted(map(repr, with_more.select(columns).collect())) == got


def test_repeated_rows_are_judged_alike(docs):
    judged = [r for r in quality_rules.judge(docs).collect() if r.doc_id == 7]
    assert len(judged) == 3 == judged.count(judged[0])
    spans = [r.s for r in PER_ROW["pii"](docs).select("doc_id", F.col("spans").alias("s")).collect() if r.doc_id == 7]
    assert spans == ["email:8:14"] * 3
    scores = {r.score for r in classified(docs).collect() if r.doc_id == 7}
    assert len(scores) == 1


def test_exact_dedup_of_hard_rows(spark, docs, tmp_path):
    clashing(docs).write.parquet(str(tmp_path / "some.parquet"))
    got = exact_dedup.exact_dedup(spark, str(tmp_path / "some.parquet")).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[1].kept and by[1].group_size == 2 and not by[None].kept and by[None].keep_id == 1
    assert by[3].kept and by[3].group_size == 2 and not by[2].kept
    assert by[4].kept and by[7].group_size == 3
    docs.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    assert exact_dedup.exact_dedup(spark, str(tmp_path / "none.parquet")).count() == 0


def test_pages_of_hard_rows(spark):
    article = "<html><body><nav>menu</nav><article><p>" + "word " * 100_000 + "</p></article></body></html>"
    rows = [(1, "http://a.org/x", article), (2, None, None), (None, "no scheme", "")] + [(5, "http://b.net/", "<p>same text")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for df in (pages, clashing(pages).withColumns({c: F.lit("x") for c in ("text", "n_chars", "verdict", "path")})):
        got = html_extraction.extract_pages(df).select("page_id", "url", "text", "n_chars").collect()
        assert len(got) == 5 and {r.n_chars for r in got if r.page_id == 1} == {len("word " * 100_000) - 1}
        assert [r.text for r in got if r.page_id == 5] == ["same text"] * 2
        judged = url_filters.judge(df).select("page_id", "host", "path", "verdict").collect()
        assert sorted(r.host for r in judged) == ["", "", "a.org", "b.net", "b.net"]
    assert html_extraction.extract_pages(pages.limit(0)).count() == 0
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_pipeline_of_no_documents(spark, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_weight_column_scales_the_keys(spark):
    rows = [(i, "w " * 10, "s", 8.0 if i % 2 else 0.125) for i in range(400)]
    rows += [(1000 + i, "w", "s", w) for i, w in enumerate([None, float("nan"), float("inf"), 0.0, -1.0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    got = {r.doc_id: r.taken for r in source_mixing.mix(docs, budget=0.5, weight_col="quality").collect()}
    taken = [sum(got[i] > 0 for i in range(400) if i % 2 == odd) for odd in (0, 1)]
    assert taken[1] > 170 and taken[0] < 30
    keys = {r.id: r.key for r in source_mixing.sizes(docs, weight_col="quality").collect()}
    even = {r.id: r.key for r in source_mixing.sizes(docs.withColumn("quality", F.lit(1.0)), weight_col="quality").collect()}
    assert all(keys[1000 + i] == even[1000 + i] for i in range(5))
    assert all(keys[i] == pytest.approx(even[i] / (8.0 if i % 2 else 0.125)) for i in range(400))
