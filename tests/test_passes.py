"""How often a document's tokens are passed over, and that fewer passes give the same rows."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from scholion.operators import elements as E
from scholion.operators import xml_articles as X
from scholion.operators.tokens import markup_tokens
from scholion.plans import catalog
from scholion.session import tuned

BODY = (
    "<body><sec><title>A</title><p>one <xref>1</xref>two</p><fig><p>no</p></fig></sec><p>three <bold>four</bold></p>"
    "<sec sec-type='ref-list'><p>left out</p></sec><sec><title>B</title><sec><title>C</title><p>five</p></sec></sec></body>"
)
TABLE = (
    "<table-wrap><label>T1</label><caption><title>Cap</title><p>Note</p></caption><table><thead><tr><th>h</th></tr></thead>"
    "<tbody><tr><td>x <label>no</label>y <table-wrap><label>T2</label><table><tbody><tr><td>z</td></tr></tbody></table></table-wrap>"
    "</td></tr></tbody></table></table-wrap>"
)
ARTICLE = "<article><front><article-meta><article-id pub-id-type='pmcid'>PMC7</article-id></article-meta></front>{}<floats>{}</floats></article>"
WHOLE = ARTICLE.format(BODY, TABLE)
# Elements around an article are not part of it, whatever their names are.
AROUND = "<body><sec><table-wrap><thead><front><caption>{}</caption></front></thead></table-wrap></sec></body>"


def payloads(spark, *texts):
    return spark.createDataFrame([*enumerate(texts)], "doc_id long, payload string")


def rows(df):
    return sorted(map(str, df.collect()))


def text_of(df):
    return rows(df.drop("doc_id"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


OPERATORS = {
    "sections": lambda t: X.xml_section_keys(X.xml_sections(t)),
    "tables": X.xml_table_json,
    "merged": lambda t: X.xml_merge_tables(X.xml_section_keys(X.xml_sections(t)), X.xml_table_json(t)),
    "ids": X.xml_ids,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_what_lies_around_an_article_does_not_count(spark, name):
    of = OPERATORS[name]
    alone, inside = (of(X.xml_tokens(payloads(spark, text))) for text in (WHOLE, AROUND.format(WHOLE)))
    assert text_of(alone) == text_of(inside) and alone.count() > 0


@pytest.mark.parametrize("name", OPERATORS)
def test_counted_tokens_give_the_same(spark, name):
    given = payloads(spark, WHOLE, AROUND.format(WHOLE), "<article/>", "<a>", "")
    of = OPERATORS[name]
    assert rows(of(X.xml_tokens(given))) == rows(of(markup_tokens(given))) == rows(of(X.xml_first_article(markup_tokens(given))))


def test_sections_and_tables(spark):
    found = OPERATORS["merged"](X.xml_tokens(payloads(spark, WHOLE))).orderBy("ord")
    keys = [(r.key, r.text) for r in found.collect()]
    assert [k for k, _ in keys] == ["A", "section_1", "B", "T1", "T2"]
    assert [t for _, t in keys[:3]] == ["A\none two", "three four", "B\nC\nfive"]
    assert '"Data":[["x y"]]' in keys[3][1] and '"Data":[["z"]]' in keys[4][1]


def test_listed_texts_are_unit_texts(spark):
    """Units in units, hidden elements, elements without content and markers."""
    given = payloads(spark, "<a>0<u>1<h>2<u>3</u>4</h><u/>5<m>6<u>7</u>8</m>9</u>10<h/><u>11<h>12</h>13</u></a>", "<u><h>1</h></u>")
    t = X._scopes(X.xml_tokens(given), F.col("depth") == 1)
    t = t.drop("hidden").selectExpr(
        "*",
        "case when tag in ('u', 'm') then tag end as kind",
        "sum(case when tag = 'h' and is_open then 1 when tag = 'h' and is_close then -1 else 0 end) over (partition by doc_id order by pos) as hidden",
        "pos % 2 = 0 as skip_hidden",
        "if(pos % 3 = 0, 'w', null) as extra",
    )
    asked = (["u"], ["m"], ["extra"], "extra")
    want = rows(E.unit_texts(t, *asked))
    assert len(want) == 7
    listed = lambda t: rows(E.listed_texts(t, *asked).select(E.unit_texts(t, *asked).columns))
    assert listed(t) == want
    # with gaps a stretch is found by its numbers
    some = t.where("text <> '' or is_open or is_selfclosing")
    assert listed(some) == rows(E.unit_texts(t.withColumn("text", F.when(F.expr("is_close and text = ''"), "").otherwise(F.col("text"))), *asked))


@pytest.mark.parametrize("name, most", [("sections", 9), ("tables", 8)])
def test_few_passes(spark, name, most):
    """Windows of a query from payloads to rows; there were 13 for sections and 11 for tables."""
    found = plan(OPERATORS[name](X.xml_tokens(payloads(tuned(spark), WHOLE), tasks=3)))
    assert found.count("- Window [") <= most, found.count("- Window [")
    assert "listagg" not in found and "SortAggregate" in found


def test_records_run_in_two_stages(spark):
    """Tokens in one stage and elements in the next, so that neither has more classes than are kept."""
    given = payloads(spark, WHOLE, WHOLE)
    for of in (X.xml_articles, X.xml_article_results):
        found = plan(of(given, 5))
        assert found.count("Exchange hashpartitioning(doc_id") == 2
        assert rows(of(given, 5)) == rows(of(given))


def test_batches_are_written_by_many_tasks(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    stream = catalog._staged_stream(spark, spark.range(4000), folder, 5)
    assert len(spark.read.parquet(f"{folder}/in").inputFiles()) == 10
    seen = []
    query = stream.writeStream.foreachBatch(lambda df, i: seen.append(df.count())).trigger(availableNow=True)
    query.option("checkpointLocation", f"{folder}/state").start().awaitTermination()
    assert sum(seen) == 4000 and len(seen) == 2
