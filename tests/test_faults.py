"""One row per payload: records, or what is wrong first."""

from __future__ import annotations

import tempfile

import pytest

from scholion.operators import html_articles as H
from scholion.operators import xml_articles as X
from scholion.streaming import streams

GOOD = "<article><front><article-meta><article-id pub-id-type='pmcid'>PMC7</article-id></article-meta></front><body><p>x</p></body></article>"
PAYLOADS = {
    "good": (GOOD, None, None),
    "in_set": (f"<?xml version='1.0'?><set><!-- c -->{GOOD}{GOOD}</set>", None, None),
    "null": (None, "no root", 0),
    "empty": ("", "no root", 0),
    "spaces": (" \n\t", "no root", 0),
    "text": ("no markup", "text outside the root", 0),
    "text_first": (f"x {GOOD}", "text outside the root", 0),
    "text_last": (f"{GOOD}x", "text outside the root", 11),
    "comment": ("<!-- only -->", "no root", 0),
    "no_article": ("<set><error>none</error></set>", "no article", 0),
    "two_roots": (f"{GOOD}<more/>", "second root", 12),
    "open": ("<set><article><p>x</p>", "element without end", 0),
    "inner_open": ("<set><article><p>x</article></set>", "end without element", 3),
    "close": ("<article></p></article>", "end without element", 1),
    "only_close": ("</article>", "end without element", 0),
    "stray": ("<article>a < b</article>", "stray <", 1),
    "entity": ("<article>a &nbsp; b</article>", "unknown entity", 0),
    "empty_article": ("<article/>", None, None),
}


def test_one_row_per_payload(spark):
    payloads = spark.createDataFrame([(k, p) for k, (p, _, _) in PAYLOADS.items()], "doc_id string, payload string")
    rows = {r.doc_id: r for r in X.xml_article_results(payloads).collect()}
    assert {k: (r.fault, r.fault_pos) for k, r in rows.items()} == {k: v[1:] for k, v in PAYLOADS.items()}
    records = {r.doc_id: r for r in X.xml_articles(payloads).collect()}
    assert set(records) == {k for k, v in PAYLOADS.items() if v[1] is None}
    for k, r in rows.items():
        fields = r.asDict()
        if k in records:
            assert {c: fields[c] for c in X.ARTICLE_COLUMNS} == records[k].asDict()
        else:
            assert all(fields[c] is None for c in X.ARTICLE_COLUMNS[1:])


@pytest.mark.parametrize("method", ["Xml", "Web"])
def test_streams_lose_no_payload(spark, method):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    html = {"page": "<h1>T</h1>", "no_title": "<h1> </h1><p>x</p>", "no_h1": "<p>x</p>", "null": None, "blank": " ", "text": "words"}
    given = {k: p for k, (p, _, _) in PAYLOADS.items()} if method == "Xml" else html
    payloads = spark.createDataFrame(list(given.items()), "doc_id string, payload string")
    payloads.repartition(2).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(payloads.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    streams.stream_extract(stream, f"{folder}/out", f"{folder}/state", method).awaitTermination()
    done = [r.doc_id for r in spark.read.parquet(f"{folder}/out/articles").collect()]
    failed = spark.read.parquet(f"{folder}/out/errors").collect()
    assert sorted(done + [r.doc_id for r in failed]) == sorted(given)
    assert {r.error for r in failed} == {f"Extraction failed ({method})"}
    if method == "Xml":
        assert {(r.doc_id, r.fault, r.fault_pos) for r in failed} == {(k, f, p) for k, (_, f, p) in PAYLOADS.items() if f}
    else:
        assert done == ["page"] and {r.fault for r in failed} == {H.NO_TITLE}
