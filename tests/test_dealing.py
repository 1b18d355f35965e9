"""Payloads are dealt to as many tasks as their lengths ask for, whatever the session's setting is."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from scholion.operators import html_articles as H
from scholion.operators import tokens as T
from scholion.operators import xml_articles as X
from scholion.plans import catalog
from scholion.streaming import streams

ARTICLE = "<article><front><article-meta><article-id pub-id-type='pmcid'>PMC{0}</article-id></article-meta></front><body><p>{1}</p></body></article>"
PAGE = "<h1>T{0}</h1><section class='body main-article-body'><p>{1}</p></section>"


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(T, "TASK_CHARS", 1000)
    monkeypatch.setattr(T, "LEAST_TASK_CHARS", 100)


def payloads(spark, form, n):
    return spark.createDataFrame([(i, form.format(i, "x" * 300)) for i in range(n)], "doc_id long, payload string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_follow_lengths(spark, small_tasks):
    lengths = lambda *n: spark.createDataFrame([("x" * i if i else None,) for i in n], "payload string")
    assert T.tasks_for(lengths(0)) == T.tasks_for(lengths(0).limit(0)) == T.tasks_for(lengths(99)) == 1
    assert T.tasks_for(lengths(150, 0, 151)) == 3
    assert T.tasks_for(lengths(*[500] * 20)) == 10 and T.tasks_for(lengths(*[500] * 60)) == 30
    assert T.tasks_for(lengths(*[500] * 20, 1)) == 11


def test_a_task_fits_the_memory_of_a_core(spark):
    """70 bytes for each character of 80 million, in tasks of at most 600 MB."""
    long = spark.range(10).select(F.repeat(F.lit("x"), 8_000_000).alias("payload"))
    assert 80_000_000 * 70 / T.tasks_for(long) <= 600e6


@pytest.mark.parametrize("mode, form", [("xml", ARTICLE), ("html", PAGE)])
def test_tokens_are_dealt_by_length(spark, small_tasks, mode, form):
    given = payloads(spark, form, 60)
    tasks = T.tasks_for(given)
    found = T.markup_tokens(given, mode, tasks=tasks)
    assert tasks > 20 and found.select(F.spark_partition_id()).distinct().count() > 10
    assert rows(found) == rows(T.markup_tokens(given, mode))


def test_records_do_not_depend_on_the_dealing(spark):
    articles, pages = payloads(spark, ARTICLE, 40), payloads(spark, PAGE, 40)
    for of, given in ((X.xml_articles, articles), (X.xml_article_results, articles), (H.html_articles, pages), (H.html_article_results, pages)):
        assert rows(of(given, tasks=7)) == rows(of(given, tasks=1)) == rows(of(given))


def test_queries_deal_by_length(spark, small_tasks):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text = "\n".join("line of words " * 9 for _ in range(6))
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, text, "en", "s", len(text)) for i in range(60)], columns).write.parquet(f"{folder}/documents.parquet")
    for tokens in (catalog._xml_tokens, catalog._html_tokens, catalog._all_tokens):
        assert tokens(spark, folder).select(F.spark_partition_id()).distinct().count() > 20


EXTRACTIONS = [
    "xml_title", "xml_publish_date", "xml_first_article", "xml_keywords", "xml_authors", "xml_category",
    "xml_date_candidates", "xml_ids", "xml_journal", "xml_table_columns", "xml_tables", "xml_section_keys",
    "xml_table_json", "xml_abstract", "xml_table_rows", "xml_sections", "html_articles", "xml_fragment_tables",
]


def test_extractions_have_one_exchange_dealt_by_length(spark, small_tasks):
    """All sorts and windows of a query run in the one exchange that was dealt by length."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    documents = [(i, "line of words\n" * 20, "en", "s", 280) for i in range(40)]
    spark.createDataFrame(documents, columns).write.parquet(f"{folder}/documents.parquet")
    jobs = catalog.jobs()
    for name in EXTRACTIONS:
        plan = jobs[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        tasks = catalog._line_tasks if "fragment" in name else catalog._html_tasks if "html" in name else catalog._jats_tasks
        dealt = "Exchange hashpartitioning(doc_id#"
        found = [line for line in plan.splitlines() if "Exchange " in line]
        assert len(found) == 1 and dealt in found[0], (name, found)
        assert f", {tasks(spark, folder)}), REPARTITION_BY_NUM" in found[0] and tasks(spark, folder) > 20, (name, found)


def test_batches_deal_by_length(spark, small_tasks, monkeypatch):
    seen = []
    monkeypatch.setitem(streams.EXTRACTORS, "Xml", lambda batch, tasks=None: seen.append(tasks) or X.xml_article_results(batch, tasks))
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    given = payloads(spark, ARTICLE, 30)
    given.coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(given.schema).parquet(f"{folder}/in")
    streams.stream_extract(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    assert seen == [T.tasks_for(given)] and seen[0] > 10
    assert spark.read.parquet(f"{folder}/out/articles").count() == 30
