"""One small document per rule; all of them go through one job."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from scholion.operators import xml_articles as X
from scholion.operators.tokens import markup_tokens


def front(meta="", journal="", extra=""):
    return (
        f"<front><journal-meta>{journal}</journal-meta>"
        f"<article-meta>{meta}</article-meta>{extra}</front>"
    )


def art(front_part="", body="", rest=""):
    body = f"<body>{body}</body>" if body is not None else ""
    return f"<set><article>{front_part}{body}{rest}</article></set>"


def date(tag, attrs, *parts):
    names = ("year", "month", "day")
    inner = "".join(f"<{n}>{p}</{n}>" for n, p in zip(names, parts) if p is not None)
    return f"<{tag} {attrs}>{inner}</{tag}>"


TABLE = """<table-wrap id="t1"><label>Table 1</label><caption><title>Cap</title><p>About  <b>it</b>.</p></caption>
<table><thead><tr><th>Group</th><th> </th><th>n<xref>1</xref></th></tr></thead>
<tbody><tr><th>row</th><td>a</td><td/></tr><tr><th>only</th></tr><tr><td>b <label>x</label></td><td>2</td></tr></tbody>
<tfoot><tr><td>sum</td></tr></tfoot><tr><td>loose</td></tr></table>
<table-wrap-foot><fn><p>Note.</p></fn></table-wrap-foot></table-wrap>"""

DOCS = {
    "front_only_pages": art(
        front("<volume>3</volume><fpage>10</fpage>"),
        "<p>x</p>",
        "<back><ref-list><volume>99</volume><lpage>77</lpage><fpage>1</fpage></ref-list></back>",
    ),
    "two_articles": "<set><article><front><article-meta><article-title>A</article-title></article-meta></front></article>"
    "<article><front><article-meta><article-title>B</article-title></article-meta></front></article></set>",
    "ids": art(
        front(
            "<article-id pub-id-type='pmcid'>PMC5</article-id><article-id pub-id-type=\"pmcaid\">PMC 42</article-id>"
            "<article-id pub-id-type='pmid'>x1</article-id><article-id pub-id-type='doi'> 10.1/a&amp;b </article-id>"
        )
    ),
    "id_fallback": art(front("<article-id pub-id-type='pmcid'>PMC77</article-id><article-id pub-id-type='pmcaid'> </article-id>")),
    "id_none": art(front("<article-id pub-id-type='pmcid'>none</article-id>")),
    "no_front": "<article><volume>1</volume><article-title>Bare</article-title></article>",
    "issn": art(front(journal="<issn>1</issn><issn pub-type='epub'>2</issn><journal-title>J\n  one</journal-title>")),
    "issn_blank": art(front(journal="<issn>1</issn><issn pub-type='epub'> </issn><issn pub-type='epub'>3</issn>")),
    "category": art(
        front(
            "<article-categories><subj-group><subject>A</subject></subj-group>"
            "<subj-group subj-group-type='heading'><subj-group><subject>B</subject></subj-group><subject>C</subject></subj-group></article-categories>"
        )
    ),
    "dates_clamped": art(front(date("pub-date", "pub-type='epub'", "2010", "13", "31"))),
    "dates_text_month": art(front(date("pub-date", "pub-type='ppub'", "2010", "Dec", None))),
    "dates_no_year": art(front(date("pub-date", "pub-type='epub'", None, "1", "2"))),
    "dates_history": art(
        front(
            date("pub-date", "pub-type='epub'", "2012", "5", "6")
            + "<pub-history><event>" + date("date", "", "2011", "2", "3") + "</event></pub-history>"
            + date("date", "", "1990", "1", "1")
        )
    ),
    "dates_any": art(front(date("pub-date", "pub-type='other'", "2015", "5", "6") + date("pub-date", "pub-type='x'", "2001", "1", "1"))),
    "authors": art(
        front(
            "<contrib contrib-type='author'><name><surname>Kim</surname><given-names>B J</given-names></name></contrib>"
            "<contrib contrib-type='author'><name><surname>Lee</surname></name></contrib>"
            "<contrib contrib-type='author'><collab>Group</collab></contrib>"
            "<contrib contrib-type='editor'><name><surname>No</surname></name></contrib>"
            "<contrib contrib-type='author'><collab><contrib-group><contrib contrib-type='author'>"
            "<name><surname>In</surname></name></contrib></contrib-group></collab></contrib>"
        )
    ),
    "keywords": art(front("<kwd-group><title>K</title><kwd>a</kwd><kwd> </kwd><kwd>a</kwd><x><kwd>deep</kwd></x></kwd-group>")),
    "abstract_sec": art(
        front(
            "<abstract abstract-type='toc'><p>toc</p></abstract><abstract><p>loose</p><sec><title>Aim</title><p>one</p><p>two</p></sec>"
            "<sec><p>plain</p></sec><sec><title>Empty</title></sec></abstract>"
        )
    ),
    "abstract_typed": art(front("<abstract abstract-type='toc'><p>only <p>nested</p></p></abstract>")),
    "abstract_no_p": art(front("<abstract>text</abstract>")),
    "titles": art(
        body="<sec><title>R</title><p>1.Next</p></sec><sec><p>2</p></sec><sec><title>R</title><p>3</p></sec><sec><title>T</title></sec>"
        "<sec><title>R_3</title><p>4</p></sec><sec><title>R</title><p>5</p></sec>"
    ),
    "nested": art(
        body="<sec><p>before</p><title>Top <xref>9</xref></title><label>1</label><sec><title>In</title><title>again</title><p>deep<sec><title>no</title><p>prose</p></sec></p></sec>"
        "<sec sec-type='Ref-List'><p>skip</p></sec><ref-list><p>skip</p></ref-list><bold>Bold <xref>1</xref></bold></sec><sec sec-type='abstract'><p>no</p></sec>"
    ),
    "bare": art(body="<title>H1</title><title>H2</title><p>a</p><list><l>1</l><l>2</l></list><sec><title>S</title><p>b</p></sec><p>c</p><bold>H3</bold><sec><p>d</p></sec>"),
    "ignored": art(body="<p>see <xref>1</xref>this<fig><p>no</p></fig> <b>x</b> <i>y</i><disp-formula>f</disp-formula></p><fig><p>no</p></fig>"),
    "text_only": art(body=" plain.Text \n here "),
    "body_blank": art(body="  "),
    "no_body": art(body=None),
    "table": art(body="<p>x</p>", rest=f"<floats-group>{TABLE}</floats-group>"),
    "table_clash": art(
        body="<sec><title>Table</title><p>x</p></sec><table-wrap><table><tbody><tr><th>h</th></tr><tr><td>1</td></tr></tbody></table></table-wrap>"
        "<table-wrap><caption>whole <i>cap</i></caption><table/></table-wrap>"
    ),
    "wrap_only": art(body=None, rest="<table-wrap><graphic/></table-wrap>"),
    "nbsp": art(front("<article-title>a  b <![CDATA[<c>]]> &#233;&lt;</article-title>"), "<p>end.Next</p>"),
    "broken": "<set><article><front></article></set>",
    "unclosed": "<set><article><body><p>x</p></body></article>",
    "entity": "<article><body><p>&nbsp;</p></body></article>",
    "no_article": "<set><error>none</error></set>",
    "blank": "   ",
}


@pytest.fixture(scope="module")
def articles(spark):
    payloads = spark.createDataFrame(list(DOCS.items()), "doc_id string, payload string")
    return {r["doc_id"]: r.asDict() for r in X.xml_articles(payloads).collect()}


def test_bad_payloads_give_no_article(articles):
    assert set(DOCS) - set(articles) == {"broken", "unclosed", "entity", "no_article", "blank"}


@pytest.mark.parametrize(
    "doc, field, value",
    [
        ("front_only_pages", "volume", "3"),
        ("front_only_pages", "f_page", "10"),
        ("front_only_pages", "l_page", None),
        ("two_articles", "title", "A"),
        ("ids", "pmc_id", 42),
        ("ids", "pm_id", None),
        ("ids", "doi", "10.1/a&b"),
        ("id_fallback", "pmc_id", 77),
        ("id_none", "pmc_id", 0),
        ("no_front", "title", "Bare"),
        ("no_front", "volume", "1"),
        ("issn", "issn", "2"),
        ("issn", "journal", "J one"),
        ("issn_blank", "issn", "1"),
        ("category", "category", "C"),
        ("dates_clamped", "publish_date", dt.datetime(2010, 12, 28)),
        ("dates_text_month", "publish_date", dt.datetime(2010, 1, 1)),
        ("dates_no_year", "publish_date", None),
        ("dates_history", "publish_date", dt.datetime(2011, 2, 3)),
        ("dates_any", "publish_date", dt.datetime(2015, 5, 6)),
        ("authors", "authors", ["B J Kim", "Lee", "In", "In"]),
        ("keywords", "keywords", ["a", "a"]),
        ("ids", "keywords", None),
        ("abstract_sec", "abstract_text", "Aim: one two plain"),
        ("abstract_typed", "abstract_text", "only nested nested"),
        ("abstract_no_p", "abstract_text", None),
        ("text_only", "sections", {"full_text": "plain.Text here"}),
        ("body_blank", "sections", None),
        ("no_body", "sections", None),
        ("wrap_only", "sections", {}),
        ("nbsp", "title", "a b <c> é<"),
        ("nbsp", "sections", {"section_1": "end. Next"}),
        ("ignored", "sections", {"section_1": "see thisxy"}),
    ],
)
def test_field(articles, doc, field, value):
    assert articles[doc][field] == value


def test_repeated_and_missing_titles(articles):
    assert articles["titles"]["sections"] == {
        "R": "R\n1. Next",
        "section_1": "2",
        "R_2": "R\n3",
        "T": "T",
        "R_3": "R_3\n4",
        "R_4": "R\n5",
    }


def test_nested_sections(articles):
    assert articles["nested"]["sections"] == {
        "Top 9": "Top 9\nbefore\nIn\ndeepnoprose\nBold 1"
    }


def test_bare_headings(articles):
    assert articles["bare"]["sections"] == {
        "H2": "a\n12",
        "S": "S\nb",
        "section_1": "c",
        "section_2": "d",
    }


def test_table(articles):
    sections = articles["table"]["sections"]
    assert sections["section_1"] == "x"
    assert json.loads(sections["Table 1"]) == {
        "TableName": "Table 1",
        "Description": "About it. Note.",
        "Colmuns": ["Group", "n"],
        "Data": [["a", ""], ["b", "2"], ["sum"]],
    }


def test_table_names_clash(articles):
    sections = articles["table_clash"]["sections"]
    assert set(sections) == {"Table", "Table_1", "Table_2"}
    assert json.loads(sections["Table_1"])["Colmuns"] == ["h"]
    assert sections["Table_2"] == (
        '{"TableName":"Table","Description":"whole cap","Colmuns":[],"Data":[]}'
    )


def test_date_candidates_name_their_source(spark):
    payloads = spark.createDataFrame(
        [("h", DOCS["dates_history"]), ("a", DOCS["dates_any"])], "doc_id string, payload string"
    )
    rows = X.xml_date_candidates(markup_tokens(payloads)).collect()
    assert sorted((r["doc_id"], r["source"], r["ts"].year) for r in rows) == [
        ("a", "any", 2015),
        ("h", "epub", 2012),
        ("h", "history", 2011),
    ]
