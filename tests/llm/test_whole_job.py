"""Cases in which an operator did less than its whole job."""
import os
import random
import time
from collections import defaultdict
from itertools import combinations

import pytest

from obsengine.llm import exact_dedup, html_extraction, line_dedup, pii

WEIGHTS = html_extraction.learn({})


def text_of(body):
    return html_extraction.extract(f"<html><body>{body}</body></html>", WEIGHTS)


# -- HTML ----------------------------------------------------------------------

@pytest.mark.parametrize("skipped", [
    "<svg-icon name='x'></svg-icon>", "<button-group></button-group>", "<select-menu></select-menu>",
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<svg><path d='M0'>", "<button>", "<object-view></object-view>",
    "<svg><title>drawn</title><path/></svg>", "<button><div>press</div></button>",
    "<noscript><p>no script</p></noscript>", "<script>var a = '<p>code</p>';</script >",
    "<object><object>in</object>out</object>"])
def test_skipped_elements_take_nothing_else(skipped):
    assert text_of(f"<p>First words of it</p>{skipped}<article><p>Words of the article</p></article>") == (
        "First words of it\n\nWords of the article")


def test_skipped_elements_inside_a_paragraph():
    assert text_of("<p>One <button><p>press</p></button> two <svg><g>x</g></svg>three</p>") == "One two three"
    assert text_of("<div><p>One two</p><button>press</div><p>Three four</p>") == "One two\n\nThree four"
    assert text_of("<p>One two</p><textarea>typed <p>text</p>") == "One two"


@pytest.mark.parametrize("opened, closed", [
    ("<main class='with-sidebar'>", "</main>"), ("<div class='no-sidebar'>", "</div>"),
    ("<article class='has-comments'>", "</article>"), ("<section id='related-work'>", "</section>"),
    ("<div data-id='header'>", "</div>"), ("<div title='class=nav x'>", "</div>"),
    ("<div class='page sidebar-right'><main>", "</main></div>"),
    ("<div id=header-and-all><section><article>", "</article></section></div>"),
    ("<article class='related'>", "</article>")])
def test_names_make_no_boilerplate_of_content(opened, closed):
    assert text_of(f"{opened}<p>Words of the article</p>{closed}") == "Words of the article"


@pytest.mark.parametrize("body", [
    "<div id='comments'><article class='comment'><p>I disagree</p></article></div>",
    "<div class='sidebar'><p>See also</p></div>", "<section id='related-posts'><p>Other posts</p></section>",
    "<section id=comments><p>I disagree</p></section>", "<div class='x ad-slot'>Buy this</div>"])
def test_boilerplate_stays_out(body):
    assert text_of(f"<main><article><p>Words of the article</p></article>{body}</main>") == "Words of the article"


@pytest.mark.parametrize("opened, closed", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")])
def test_long_boilerplate_inside_content_does_not_cut_it(opened, closed):
    body = f"<p>One two three</p><aside><p>{'advert words ' * 200}</p></aside><p>Four five</p><p>Six seven</p>"
    assert text_of(opened + body + closed) == "One two three\n\nFour five\n\nSix seven"


# -- PII -----------------------------------------------------------------------

def test_names_in_few_texts_disclose(spark):
    """A name first or last in the text, or far from the address, seen in two texts each."""
    far = "ordinary words walk along the river " * 4
    rows = [(1, "Alicia a@x.org"), (2, "a@x.org river Alicia"), (3, "Alicia walks along the river"),
            (4, f"Zebulon {far}b@x.org"), (5, f"b@x.org {far}and more {far}Zebulon"),
            (6, f"Zebulon {far}b@x.org"),  # a copy counts once
            (7, "Once c@x.org with Ottokar"), (8, "the x.org of Zebulon")]
    rows += [(i, f"ordinary words walk along the river and more {i}") for i in range(10, 300)]
    got = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in pii.find(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [("term", "Alicia"), ("email", "a@x.org")]
    assert got[2] == [("email", "a@x.org"), ("term", "Alicia")]
    assert got[3] == [("term", "Alicia")] and got[8] == [("term", "Zebulon")]
    assert got[4] == got[6] == [("term", "Zebulon"), ("email", "b@x.org")]
    assert got[5] == [("email", "b@x.org"), ("term", "Zebulon")]
    assert got[7] == [("email", "c@x.org")] and got[10] == []


# -- line dedup ----------------------------------------------------------------

def test_crowded_keys_are_compared_in_blocks(spark):
    rows = [(7, n, n, f"line {n}", (n, 0)) for n in range(300)] + [(8, 1, 1, "line 1", (1, 0)), (8, 2, 2, "line 2", (2, 0))]
    members = spark.createDataFrame(rows, "key long, h long, c long, line string, first struct<id:long,pos:int>")
    met = defaultdict(set)
    for r in line_dedup._block_pairs(members, 20).collect():
        met[r.key].add(r.h)
    assert max(map(len, met.values())) <= 4 * 20 and any(hs == {1, 2} for hs in met.values())
    pairs = {p for hs in met.values() for p in combinations(sorted(hs), 2)}
    assert len(pairs) == 300 * 299 // 2


def test_template_lines_with_a_number(spark):
    lines = [f"the template line of a log that counts up to {n * 7919 % 1000003:06d} and ends" for n in range(120)]
    want = {y for n, y in enumerate(lines) if any(line_dedup.within(x, y, 2) for x in lines[:n])}
    docs = spark.createDataFrame(list(enumerate(lines)), "id long, text string")
    got = {(r.h, r.c) for r in line_dedup.near_lines(docs, run_limit=8).collect()}
    assert got == {line_dedup.line_key(y) for y in want} and 0 < len(want) < len(lines)


def test_template_keys_keep_near_lines_together(spark):
    """Lines of one template part into small groups; near ones share a group."""
    lines = [f"{n * 31 % 1000:03d} stands in a line of many words" for n in range(0, 1000, 3)]
    rows = [(5, n, n, x, (n, 0)) for n, x in enumerate(lines)] + [(6, n, n, x, (n, 0)) for n, x in enumerate(lines[:2])]
    members = spark.createDataFrame(rows, "key long, h long, c long, line string, first struct<id:long,pos:int>")
    met = defaultdict(set)
    for r in line_dedup._template_keys(members, 2).collect():
        met[r.key].add(r.line)
    shared = {p for xs in met.values() for p in combinations(sorted(xs), 2)}
    assert shared >= {(x, y) for x, y in combinations(sorted(lines), 2) if line_dedup.within(x, y, 2)}
    assert max(map(len, met.values())) < len(lines) and any(xs == set(lines[:2]) for xs in met.values())


def test_growing_stretches_find_the_same_lines():
    rnd = random.Random(9)
    run = list(dict.fromkeys("".join(rnd.choice("ab") for _ in range(rnd.randint(18, 23))) + "x" * rnd.choice([0, 20])
                             for _ in range(700)))
    want = [n for n, y in enumerate(run) if any(
        line_dedup.within(x, y, min(len(x) // 20, len(y) // 20, 2)) and min(len(x), len(y)) >= 20 for x in run[:n])]
    assert line_dedup.later_near(run, 2) == want and want


def test_short_lines_that_repeat_go(spark):
    docs = spark.createDataFrame([(1, "Yes.\n--\n\nriver"), (2, "Yes.\n--\n\nstone"), (3, None), (4, "yes.")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    assert got == {1: "Yes.\n--\n\nriver", 2: "\nstone", 3: None, 4: "yes."}
    assert line_dedup.dedup(docs.limit(0)).count() == 0


# -- exact dedup ---------------------------------------------------------------

def test_old_files_count_and_missing_texts_fail(spark, tmp_path):
    folder, checkpoint = tmp_path / "documents.parquet", str(tmp_path / "state")
    folder.mkdir()

    def put(name, rows, days):
        spark.createDataFrame(rows, "doc_id long, text string").toPandas().to_parquet(folder / name)
        os.utime(folder / name, (time.time() - days * 86400,) * 2)

    def run():
        return {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(
            spark, str(folder), checkpoint=checkpoint).collect()}

    put("a.parquet", [(1, "one"), (2, "two")], 0)
    assert run() == {1: (1, 1), 2: (2, 1)}
    put("b.parquet", [(3, "two"), (4, "three")], 30)
    assert run() == {1: (1, 1), 2: (3, 2), 3: (3, 2), 4: (4, 1)}
    put("a.parquet", [(1, "changed in place")], 0)
    with pytest.raises(Exception, match="missing from the state"):
        run()
