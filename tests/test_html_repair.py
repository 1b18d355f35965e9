"""Pages whose tags leave ends out, against a plain parser with a stack."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from scholion.operators import html_articles as H
from scholion.operators import tokens as T

ITEM = re.compile(r"(</?([A-Za-z][^\s/<>]*)[^>]*>|<)([^<]*)")


def plain_tokens(page):
    """(kind, tag, depth, start, end, text) of the repaired page."""
    out, stack = [], []

    def end(count, explicit=""):
        for k in range(count):
            at, tag = stack.pop()
            out[at][4] = len(out)
            last = explicit and k == count - 1
            out.append(["close", tag, len(stack) + 1, at, None, explicit[1:] if last else ""])

    for markup, name, text in ITEM.findall(page):
        tag = name.lower()
        names = [n for _, n in reversed(stack)]
        if markup.startswith("</"):
            if tag in names:
                end(names.index(tag) + 1, "!" + text)
            else:
                out.append(["", "", len(stack), None, None, text])
            continue
        if markup == "<":
            out.append(["", "", len(stack), None, None, "<" + text])
            continue
        for tags, closed, keepers in T.IMPLIED_ENDS:
            if tag in tags:
                seen = next((i for i, n in enumerate(names) if n in keepers), len(names))
                end(max((i + 1 for i, n in enumerate(names[:seen]) if n in closed), default=0))
        if markup.endswith("/>") or tag in T.VOID_TAGS:
            out.append(["empty", tag, len(stack) + 1, len(out), len(out), text])
        else:
            stack.append((len(out), tag))
            out.append(["open", tag, len(stack), len(out), None, text])
    end(len(stack))
    return [tuple(r) for r in out]


def found_tokens(spark, pages):
    payloads = spark.createDataFrame(list(enumerate(pages)), "doc_id long, payload string")
    rows = {}
    for r in T.markup_tokens(payloads, "html").orderBy("doc_id", "pos").collect():
        kind = "open" if r.is_open else "close" if r.is_close else "empty" if r.is_selfclosing else ""
        rows.setdefault(r.doc_id, []).append((kind, r.tag, r.depth, r.start_pos, r.end_pos, r.text))
        assert r.pos == len(rows[r.doc_id]) - 1
    return rows


TAGS = ["p", "li", "ul", "ol", "td", "tr", "th", "table", "tbody", "section", "div", "b", "i", "h1", "h2", "dt", "dd", "dl", "option", "hr", "br", "span"]


def random_page(r, size, opens=0.6):
    parts = []
    for _ in range(size):
        tag = r.choice(TAGS)
        parts.append(f"<{tag}>" if r.random() < opens else f"</{tag}>")
        if r.random() < 0.05:
            parts.append(r.choice(["<", f"<{tag}/>", "< x", "<P class='a>b'>"]))
        parts.append(r.choice(["", " ", "t", "a&amp;b"]))
    return "".join(parts)


def test_random_pages(spark):
    r = random.Random(1)
    pages = [random_page(r, r.randint(1, 120), r.choice([0.4, 0.6, 0.9])) for _ in range(400)]
    pages = [p.replace("<P class='a>b'>", "<P class='ab'>") for p in pages]
    found = found_tokens(spark, pages)
    for i, page in enumerate(pages):
        assert found.get(i, []) == plain_tokens(page), page


@pytest.mark.parametrize("page", ["<div>" * 1500 + "x", "<ul>" + "<li>a" * 5000 + "</ul>z", "<p>a" * 3000, "</b>" * 2000 + "<i>x", "<b><i>" * 600 + "</b>" * 700])
def test_pages_of_many_blocks(spark, page):
    assert found_tokens(spark, [page])[0] == plain_tokens(page)


def body(inner):
    return f"<html><body><h1>T</h1><section class='body main-article-body'>{inner}</section></body></html>"


PAGES = {
    "li": (body("<h2>H</h2><ul><li>one<li>two</ul><p>end"), {"H": "onetwo\nend"}),
    "section": (body("<section><h2>A</h2><p>1<section><h3>B</h3><p>2</p>"), {"A": "1", "section_1": "B\n2"}),
    "td": (body("<h2>H</h2><table><tr><td>a<td>b<tr><td>c</table><p>x"), {"H": "abc\nx"}),
    "div": (body("<h2>H</h2><div>a<div>b</div><p>c"), {"H": "abc"}),
    "inline": (body("<h2>H</h2><p><b>a<p><i>b</p><p>c"), {"H": "a\nb\nc"}),
    "heading": (body("<h2>H<p>in it"), {}),
    "crossed": (body("<h2>H</h2><p><b>a<i>b</b>c</i>d</p>"), {"H": "abcd"}),
    "no_end": ("<h1>T<section class='body main-article-body'><h2>H</h2><p>a<section><h3>I</h3><div>b", {"H": "a", "I": "b"}),
}


def test_sections_of_unclosed_elements(spark):
    payloads = spark.createDataFrame([(k, p) for k, (p, _) in PAGES.items()], "doc_id string, payload string")
    found = {k: {} for k in PAGES}
    for r in H.html_sections(T.markup_tokens(payloads, "html")).collect():
        found[r.doc_id][r.key] = r.text
    assert found == {k: want for k, (_, want) in PAGES.items()}
    flagged = payloads.withColumn("payload", F.concat(F.lit("<meta name='ncbi_type' content='x'>"), "payload"))
    records = {r.doc_id: r.sections for r in H.html_articles(flagged).collect()}
    assert {k: v or {} for k, v in records.items()} == found
    titles = {r.doc_id: r.title for r in H.html_articles(flagged).collect()}
    assert titles["li"] == "T"


KEYWORDS = {
    "one": ("<section class='kwd'><p>a; b<p>c</section>", ["a", "b", "c"]),
    "two": ("<section class='kwd'><p>a<section class='kwd-in'><p>b</section><p>c</section>", ["a", "b", "c", "b"]),
    "three": (
        "<section class='kwd'><p>a</p><section class='kwd'><p>b<div><section class='kwd'><p>c</div></section>"
        "<section class='x'><p>d</section></section><section class='kwd'><p>e",
        ["a", "b", "c", "d", "b", "c", "c", "e"],
    ),
    "empty": ("<section class='kwd'></section><p>x", []),
    "none": ("<section><p>x</section>", None),
}


def test_keywords_of_nested_sections(spark):
    payloads = spark.createDataFrame([(k, p) for k, (p, _) in KEYWORDS.items()], "doc_id string, payload string")
    assert {r.doc_id: r.keywords for r in H.html_articles(payloads).collect()} == {k: v for k, (_, v) in KEYWORDS.items()}
    listed = {}
    for r in H.html_keywords(T.markup_tokens(payloads, "html")).orderBy("doc_id", "ord").collect():
        listed.setdefault(r.doc_id, []).append(r.value)
    assert listed == {k: v for k, (_, v) in KEYWORDS.items() if v}


def test_texts_of_nested_elements(spark):
    payloads = spark.createDataFrame([(1, "<div>a<b>b<div>c</div>d</div>e<b/><div>"), (2, None)], "doc_id long, payload string")
    found = H.html_element_texts(T.markup_tokens(payloads, "html"), "div", "b")
    rows = [(r.tag, r.text) for r in found.orderBy("pos").collect()]
    assert rows == [("div", "abcd"), ("b", "bcd"), ("div", "c"), ("b", ""), ("div", "")]
