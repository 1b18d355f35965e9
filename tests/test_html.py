from __future__ import annotations

import datetime as dt

import pytest

from scholion.operators import html_articles as H


def page(body="", head="", kind="full-text", title="<h1> T &amp; t\n</h1>"):
    meta = f"<meta name='ncbi_type' content='{kind}'>" if kind is not None else ""
    return (
        f"<!DOCTYPE html><html><head><title>x</title>{meta}{head}</head><body>{title}"
        f"<section class='body main-article-body'>{body}</section></body></html>"
    )


def dated(text):
    return page(head=f'<meta name="citation_publication_date" content="{text}">')


DOCS = {
    "scan": page("<p>x</p>", kind="SCAN-page"),
    "no_type": page("<p>x</p>", kind=None),
    "no_title": page("<p>x</p>", title=""),
    "bare": page(""),
    "meta": page(
        head="<meta name='citation_doi' content=\"10.1/x\"><meta name='citation_doi' content='second'>"
        "<meta name='citation_pmid' content='12'><meta name='citation_issue'><meta name='citation_author' content=' A B '>"
        "<meta name='citation_author' content=''>"
    ),
    "authors_blank": page(head="<meta name='citation_author' content=' '>"),
    "abstract": page(
        "<section class='abstract' id='abstract1'><h2>Abstract</h2><p> one\n &eacute;</p><p> </p><p>two</p>"
        "<section class='kwd-group'><p><b>Keywords:</b> a; b,, c</p></section><section class='fn-group'><p>fn</p></section></section>"
        "<section class='kwd-list'><p>Abbreviations: d</p></section>"
    ),
    "abstract_class": page("<section class='front abstract-x'><p>by class</p></section>"),
    "abstract_blank": page("<section class='abstract'><p> </p></section>"),
    "abstract_no_p": page("<section class='abstract'><h2>x</h2></section>"),
    "clash": page(
        "<section><h2>A</h2><p>1</p><h2>A</h2><p>2</p></section><section><h2>A</h2><p>3.Next</p>"
        "<section><h3>Deep</h3><p>4</p><div> </div></section><p>5</p></section>"
        "<h2>A</h2><p>6 <a>Open in a new tab</a></p><p>raw  spaces<br>kept</p><section class='x ref-list'><p>no</p></section>"
        "<h2>A</h2><p>7</p>"
    ),
    "unclosed": page("<h2>H</h2><p>a<p><b>b<p>c<ul><li>d</li></ul>"),
    "script": page("<p>a<script>if (x < 1) { '</p>' }</script>b</p>"),
    "d1": dated("2013 Dec 1"),
    "d2": dated("2013 december 11"),
    "d3": dated("2013 May"),
    "d4": dated("2013 5 7"),
    "d5": dated("2013"),
    "d6": dated("Dec 2013"),
    "d7": dated("2013 Feb 30"),
}


@pytest.fixture(scope="module")
def articles(spark):
    payloads = spark.createDataFrame(list(DOCS.items()), "doc_id string, payload string")
    from pyspark.sql import functions as F

    return {r["doc_id"]: r.asDict() for r in H.html_articles(payloads, F.lit(5)).collect()}


@pytest.mark.parametrize(
    "doc, field, value",
    [
        ("scan", "sections", None),
        ("no_type", "sections", None),
        ("scan", "title", "T &amp; t"),
        ("no_title", "title", None),
        ("bare", "sections", {"full_text": ""}),
        ("meta", "doi", "10.1/x"),
        ("meta", "pm_id", 12),
        ("meta", "issue", ""),
        ("meta", "volume", None),
        ("meta", "authors", ["A B"]),
        ("authors_blank", "authors", []),
        ("bare", "authors", None),
        ("abstract", "abstract_text", "one é two"),
        ("abstract", "keywords", ["a", "b", "c", "d"]),
        ("bare", "keywords", None),
        ("abstract_class", "abstract_text", "by class"),
        ("abstract_blank", "abstract_text", ""),
        ("abstract_no_p", "abstract_text", None),
        ("unclosed", "sections", {"H": "a\nb\nc\nd"}),
        ("script", "sections", {"section_1": "ab"}),
        ("d1", "publish_date", dt.datetime(2013, 12, 1)),
        ("d2", "publish_date", dt.datetime(2013, 12, 11)),
        ("d3", "publish_date", dt.datetime(2013, 5, 1)),
        ("d4", "publish_date", dt.datetime(2013, 5, 7)),
        ("d5", "publish_date", dt.datetime(2013, 1, 1)),
        ("d6", "publish_date", None),
        ("d7", "publish_date", None),
    ],
)
def test_field(articles, doc, field, value):
    assert articles[doc][field] == value


def test_section_keys(articles):
    assert articles["clash"]["sections"] == {
        "A": "3. Next",
        "A_1": "2",
        "section_2": "Deep\n4",
        "section_3": "5",
        "A_4": "6 \nraw  spaceskept",
        "A_5": "7",
    }
