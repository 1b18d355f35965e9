"""Attributes and nesting as real documents have them, and records against single operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scholion.operators import html_articles as H
from scholion.operators import xml_articles as X
from scholion.operators.tokens import markup_tokens


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


HTML_HEADS = {
    "upper": '<META NAME="citation_doi" CONTENT="10.1/x">',
    "name_in_value": '<meta content="see name=foo here" name="citation_doi">',
    "name_in_other": "<meta data-x='a name=zz b' name='citation_doi' content='10.1/x'>",
    "bare": "<meta name=citation_doi content=10.1/x>",
    "glued": '<meta name="citation_doi"content="10.1/x"/>',
    "spaced": "<meta name = 'citation_doi'\n content =\t'10.1/x' >",
    "longer_names": '<meta x-name="a" names="b" name="citation_doi" content="10.1/x">',
    "lone_quote": "<p title=don't>one</p><p>it's two</p><meta name='citation_doi' content='10.1/x'>",
}


def test_html_attributes(spark):
    docs = [(k, f"<html><head>{h}</head><body></body></html>") for k, h in HTML_HEADS.items()]
    tokens = markup_tokens(spark.createDataFrame(docs, "doc_id string, payload string"), "html")
    found = {k: r["doi"] for k, r in rows(H.html_meta(tokens)).items()}
    assert found == dict.fromkeys(HTML_HEADS, "10.1/x") | {"name_in_value": "see name=foo here"}


def test_html_lone_quotes_end_no_tag_late(spark):
    page = "<p title=don't>one</p><p>two it's three</p><p>four</p>"
    tokens = markup_tokens(spark.createDataFrame([("a", page)], "doc_id string, payload string"), "html")
    texts = [r["text"] for r in tokens.where("is_open").orderBy("pos").collect()]
    assert texts == ["one", "two it's three", "four"]


@pytest.mark.parametrize(
    "payload, good",
    [
        ("<article><body/></article>", True),
        ("﻿<article><body/></article>", True),
        (" \n<article><body/></article>", True),
        ("junk<article><body/></article>", False),
        ("<article a='<'><body/></article>", False),
        ("<article a='>'><body/></article>", True),
        ("no markup", False),
        ("", False),
    ],
)
def test_xml_rejects_what_a_parser_rejects(spark, payload, good):
    tokens = markup_tokens(spark.createDataFrame([("a", payload)], "doc_id string, payload string"))
    assert (X.xml_first_article(tokens).count() > 0) == good


WRAP = (
    "<table-wrap id='A&amp;B'><caption><title>Cap <xref>9</xref></title><p>one cap <xref>7</xref></p></caption>"
    "<table><tr><td>v</td></tr></table></table-wrap>"
)
ABSTRACT = f"<abstract><p>one</p>{WRAP}<sec><title>Aim</title><p>two</p>{WRAP}</sec></abstract>"
XML = {
    "table_in_abstract": f"<article><front><article-meta><title-group><article-title>T</article-title></title-group>"
    f"{ABSTRACT}</article-meta></front><body><p>x</p>{WRAP}<table-wrap id='A&amp;B'><table><tr><td>v</td></tr></table></table-wrap></body></article>",
    # without front matter the whole article is searched, its body too
    "no_front": "<article><body><kwd-group><kwd>k <xref>1</xref></kwd></kwd-group><article-title>In body</article-title>"
    f"<p>text</p>{WRAP}</body></article>",
}


def test_whole_records_equal_single_operators(spark):
    payloads = spark.createDataFrame(list(XML.items()), "doc_id string, payload string")
    records = rows(X.xml_articles(payloads))
    tokens = markup_tokens(payloads)
    scoped = X.xml_first_article(tokens)
    abstracts = {k: r["value"] for k, r in rows(X.xml_abstract(scoped)).items()}
    titles = {k: r["value"] for k, r in rows(X.xml_title(scoped)).items()}
    words = scoped.transform(X.xml_keywords).groupBy("doc_id").agg(F.sort_array(F.collect_list("value")).alias("v"))
    keywords = {k: r["v"] for k, r in rows(words).items()}
    for k, record in records.items():
        assert record["abstract_text"] == abstracts.get(k)
        assert record["title"] == titles.get(k)
        assert sorted(record["keywords"] or []) == (keywords.get(k) or [])
    assert "one cap" in records["table_in_abstract"]["abstract_text"]
    tables = X.xml_tables(scoped).where("doc_id = 'table_in_abstract'").collect()
    assert [t["name"] for t in sorted(tables, key=lambda t: t["table_no"])] == ["Cap 9", "Cap 9", "Cap 9", "A&B"]
    assert any("A&B" in key for key in records["table_in_abstract"]["sections"])
