"""HTML extraction: the maximum-scoring contiguous region of a page.

A page is read as a sequence of tags and runs of words.  A word scores by the
element that holds it, a tag by its name; both weights are log odds learned from
labelled pages, where the publisher's own ``<article>`` marks the content.  Words
of content elements score positive, tags never do, words of menus, footers or
adverts score negative, or nothing where these stand within content (a region then
spans them).  An element's name makes no boilerplate of an article or main, nor of
what holds one; inside one only a whole name does, and never of prose, tables or
figures.  One linear scan finds the contiguous region with the
largest sum; its blocks, without what still stands in a boilerplate element, are
the text.

Learning reads at most ``TRAIN_PAGES`` labelled pages (those with the smallest
hash of their id); what reaches the driver is one count per known context.
Pages are independent, so extraction is one stage without a shuffle.

Defined cases: null or empty html, or a page without words, gives an empty text;
unclosed and stray tags are closed as a browser closes them; an unclosed script,
style, textarea or iframe takes the rest of the page, as in a browser, while any
other skipped element that nothing closes ends at the next block; without labelled
pages the prior weights are used; of equal sums the first region wins; repeated
rows give equal texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body

TRAIN_PAGES = 2000
SMOOTHING = 20.0
TAG_COST = 0.05
MOST = 4.0

#: Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|iframe"
SKIPPED = frozenset(
    "noscript template svg annotation annotation-xml object canvas select button".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead title tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
INLINE = frozenset("a abbr b cite code em i small span strong sub sup u mark q time".split())
ROLE_OF_TAG = {
    "head": "head", "title": "head", "nav": "menu", "menu": "menu", "header": "header",
    "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "dialog": "notice",
}
ROLE_OF_NAME = {
    "nav": "menu", "navbar": "menu", "navigation": "menu", "menu": "menu", "breadcrumb": "menu",
    "breadcrumbs": "menu", "header": "header", "masthead": "header", "footer": "footer",
    "sidebar": "aside", "aside": "aside", "widget": "aside", "related": "aside",
    "notice": "notice", "cookie": "notice", "cookies": "notice", "consent": "notice",
    "gdpr": "notice", "popup": "notice", "modal": "notice", "newsletter": "notice",
    "subscribe": "notice", "ad": "advert", "ads": "advert", "advert": "advert",
    "advertisement": "advert", "banner": "advert", "sponsor": "advert", "sponsored": "advert",
    "promo": "advert", "comment": "comments", "comments": "comments", "disqus": "comments",
    "respond": "comments", "share": "menu", "social": "menu",
}
ROLES = frozenset(ROLE_OF_TAG.values()) | frozenset(ROLE_OF_NAME.values())
KNOWN = BLOCK | INLINE | VOID

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*>|</?[a-z][^<>\"']*(?:(?:\"[^\"<]*\"|'[^'<]*')[^<>\"']*)*>|</?[a-z][^<>]*>|[^<]+|<",
    re.S | re.I)
NAME = re.compile(r"</?([a-z][^\s/<>]*)", re.I)
ATTRIBUTE = re.compile(
    r"""(?<![^\s"'<>/=])([^\s"'<>/=]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|"[^"]*"|'[^']*'""")
PART = re.compile(r"[^A-Za-z0-9]+")
#: Parts after these tell what an element lacks or stands beside, not what it is.
BESIDE = frozenset("with without has have no not non hide hidden show".split())
CONTENT = frozenset(("article", "main"))
#: An id of these is often the slug of a title: it names a role only with layout words.
TITLED = PROSE | {"section"}
#: What these hold within content is content, whatever they are called.
TOLD = PROSE | INLINE | {"figure", "table", "tr", "thead", "tbody", "tfoot"}
LAYOUT = frozenset(
    "area articles bar block body bottom box button buttons col column container content form group "
    "icons inner left links list main notice outer page post posts right section signup site slot "
    "stories teaser top unit wrap wrapper".split())


def plain_name(parts: list[str]) -> bool:
    """Whether a name tells of nothing but a role and the layout."""
    return all(p in ROLE_OF_NAME or p in LAYOUT or p.isdigit() for p in parts)


def role(tag: str, name: str, inside: bool) -> str | None:
    """What an element's class, id or role attribute makes of it.  Inside content only the
    whole name counts (``modal-verbs`` is no modal), and prose keeps its words."""
    if "=" not in tag or name in ("body", "html") or inside and name in TOLD:
        return None
    for attribute, *values in ATTRIBUTE.findall(tag):
        attribute = attribute.lower()
        if attribute not in ("class", "id", "role"):
            continue
        for value in "".join(values).lower().split():
            parts = [p for p in PART.split(value) if p]
            # A comment is marked up as an article of its own; other articles are content.
            if name in CONTENT:
                if name == "article" and attribute == "class" and parts[:1] == ["comment"]:
                    return "comments"
                continue
            if (inside or attribute == "id" and name in TITLED) and not plain_name(parts):
                continue
            for part in parts:
                if part in BESIDE:
                    break
                if part in ROLE_OF_NAME:
                    return ROLE_OF_NAME[part]
    return None


def events(page: str) -> list[tuple[str, str, str, bool, bool]]:
    """``(kind, context, text, in article, beside content)``: kind ``text`` with its
    context (a boilerplate role, or the nearest block's name), or ``tag`` with its
    context (a boilerplate role, or the element's name) and the element's name as text.
    Boilerplate beside content stands in an open article or main, or in an element
    that also holds paragraphs (the body too, on a page without article and main)."""
    found: list[tuple[str, int, str, str, bool]] = []  # (kind, frame, context, text, in article)
    # Elements in their order: name, name of the nearest block, place of the parent, and
    # the role by tag or by name.  An element is placed before what it holds, and a role
    # by name falls when an article or main turns up inside.
    names, blocks, parents = ["body"], ["body"], [0]
    roles: list[str | None] = [None]
    by_name: list[bool] = [False]
    stack: list[int] = []
    open_names: Counter[str] = Counter()
    skipped: list[tuple[int, int]] = []  # (depth, events before) of open skipped elements

    def pop_to(name: str) -> None:
        while stack:
            top = names[stack.pop()]
            open_names[top] -= 1
            if skipped and skipped[-1][0] == len(stack):
                cut(skipped.pop()[1], top == name)
            if top == name:
                return

    def cut(begin: int, whole: bool) -> None:
        """Drop a skipped element: all of it, or up to the next block if nothing closed it."""
        end = begin
        while end < len(found) and (whole or end == begin or not (
                found[end][0] == "tag" and found[end][3] in BLOCK)):
            end += 1
        del found[begin:end]

    for m in TOKEN.finditer(page):
        token = m.group()
        at = stack[-1] if stack else 0
        if token[0] != "<" or len(token) == 1:
            found.append(("text", at, blocks[at], entities.unescape(token), open_names["article"] > 0))
            continue
        tag = NAME.match(token)
        if m.group(1) or not tag:
            continue
        name = tag.group(1).lower()
        if token[1] == "/":
            if open_names[name] > 0:
                pop_to(name)
            if name not in SKIPPED:
                found.append(("tag", at, name, name, open_names["article"] > 0))
            continue
        # A paragraph outside of a skipped element is not closed by what the element holds.
        if name in BLOCK and open_names["p"] > 0 and (
                not skipped or any(names[x] == "p" for x in stack[skipped[-1][0]:])):
            pop_to("p")
        if name in ("li", "dd", "dt", "tr", "td", "th") and stack and names[stack[-1]] == name:
            pop_to(name)
        at = stack[-1] if stack else 0
        if name not in VOID and not token.endswith("/>"):
            by_tag = ROLE_OF_TAG.get(name)
            within = open_names["article"] > 0 or open_names["main"] > 0
            named = None if by_tag else role(token, name, within)
            # What is named as boilerplate inside the content stays so, whatever it holds.
            if name == "main" or name == "article" and not named and not open_names["article"]:
                for above in stack:
                    if by_name[above] and names[above] != "article":
                        roles[above] = None
            if name in SKIPPED:
                skipped.append((len(stack), len(found)))
            names.append(name)
            blocks.append(name if name in BLOCK else blocks[at])
            parents.append(at)
            roles.append(by_tag or named)
            by_name.append(named is not None)
            at = len(names) - 1
            stack.append(at)
            open_names[name] += 1
        elif name in SKIPPED:
            continue
        found.append(("tag", at, name, name, open_names["article"] > 0))
    pop_to("")

    # Roles pass down: the outermost one counts, with the place where it stands.
    held, roots = [False] * len(names), [0] * len(names)
    inside = [False] * len(names)
    flat = CONTENT.isdisjoint(names)
    for i in range(1, len(names)):
        above = parents[i]
        inside[i] = inside[above] or names[i] in CONTENT
        if roles[above]:
            roles[i], roots[i] = roles[above], roots[above]
        elif roles[i]:
            roots[i] = i
        elif names[i] in ("p", "blockquote", "pre") and (
                flat or names[above] not in ("body", "html")):
            held[above] = True
    beside = [False] * len(names)
    for i in range(1, len(names)):
        if roles[i]:
            above = parents[roots[i]]
            beside[i] = inside[above] or held[above]
    return [(kind, roles[i] or context, text, marked, beside[i])
            for kind, i, context, text, marked in found]


def counts(page: str) -> Counter:
    """Words and tags of a labelled page by context, inside the article and outside."""
    found: Counter = Counter()
    for kind, name, text, inside, _ in events(page):
        if kind == "text":
            found["word", name if name in ROLES or name in KNOWN else "div", inside] += len(text.split())
        else:
            found["tag", name if name in ROLES or name in KNOWN else "span", inside] += 1
    return found


def prior(kind: str, name: str) -> float:
    """Chance that a word or tag is content where nothing was learned."""
    if name in ROLES:
        return 0.02
    if kind == "tag":
        return 0.5
    return 0.9 if name in PROSE else 0.6


def learn(found: dict) -> dict[tuple[str, str], float]:
    """Log odds by (kind, name) from counts by (kind, name, inside)."""
    weights = {}
    for kind in ("word", "tag"):
        for name in ROLES | KNOWN:
            p = prior(kind, name)
            yes = found.get((kind, name, True), 0) + SMOOTHING * p
            no = found.get((kind, name, False), 0) + SMOOTHING * (1 - p)
            odds = max(-MOST, min(MOST, math.log(yes / no)))
            weights[kind, name] = odds if kind == "word" else min(-TAG_COST, odds)
    return weights


def scores(found: list[tuple], weights: dict[tuple[str, str], float]) -> list[float]:
    """What each event adds to a region that holds it."""
    return [
        0.0 if beside  # not in the text anyway, so it does not cut the region either
        else len(text.split()) * weights.get(("word", name), 0.4) if kind == "text"
        else weights.get(("tag", name), -TAG_COST)
        for kind, name, text, _, beside in found]


def best_region(values: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous region with the largest sum, the first to end of equals."""
    best, total, begin, span = 0.0, 0.0, 0, (0, 0)
    for i, value in enumerate(values):
        if total <= 0.0:
            total, begin = 0.0, i
        total += value
        if total > best:
            best, span = total, (begin, i + 1)
    return span


def extract(page: str | None, weights: dict[tuple[str, str], float]) -> str:
    """The text of one page."""
    found = events(page or "")
    begin, end = best_region(scores(found, weights))
    blocks, current = [], []
    for kind, name, text, _, _ in found[begin:end]:
        if kind == "text":
            if name not in ROLES:
                current.append(text)
        elif text in BLOCK:
            blocks.append("".join(current))
            current = []
        elif text == "br":
            current.append(" ")
    blocks.append("".join(current))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def trained(pages: DataFrame, id_col: str, html_col: str, most: int = TRAIN_PAGES) -> dict:
    """Weights from at most ``most`` pages that mark their article."""
    marked = pages.select(F.col(id_col).alias("id"), body(html_col).alias("html")).where(
        F.lower("html").contains("<article"))
    # At most ``most`` ids: a bound that does not grow with the table.
    chosen = marked.select("id").orderBy(F.xxhash64("id"), "id").limit(most).distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter = Counter()
            for page in batch["html"]:
                total.update(counts(page))
            yield pd.DataFrame([(*k, n) for k, n in total.items()],
                               columns=["kind", "name", "inside", "n"])

    rows = (marked.join(F.broadcast(chosen), "id").select("html")
            .mapInPandas(count, "kind string, name string, inside boolean, n long")
            .groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect())
    return learn({(r.kind, r.name, r.inside): r.n for r in rows})


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", weights: dict | None = None) -> DataFrame:
    """``id_col, url_col, text, n_chars`` per page."""
    weights = weights or trained(pages, id_col, html_col)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(page, weights) for page in batch], dtype=object)

    return (pages.select(F.col(id_col), F.col(url_col), text_of(body(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
