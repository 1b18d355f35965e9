"""Documents in ranges against documents as a whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from scholion.operators import tokens as T


def random_xml(r, size):
    parts, stack = ["<?xml version='1.0'?><!DOCTYPE a [<!ENTITY x '<b>'>]>" if r.random() < 0.3 else ""], []
    for _ in range(size):
        roll = r.random()
        if roll < 0.35:
            stack.append(r.choice(["a", "b", "x:c", "sec"]))
            parts.append(f"<{stack[-1]} k='{r.randint(0, 9)}'>")
        elif roll < 0.7 and stack:
            parts.append(f"</{stack.pop()}>")
        else:
            parts.append(r.choice([
                "t &amp; u", "<e/>", "<!-- <a> - -- -->", "<![CDATA[ <a>]] x]]>", "<?pi <a>?>", " ", "é😀", "&#65;",
                "<![CDATA[" + "<z>y" * 9 + "]]>", "<!--" + " <q>" * 12 + "-->",
            ]))
            if r.random() < 0.03:
                parts.append(r.choice(["<", "</a>", "<a k='<'>", "&nope;", "<!-- <b>", "<![CDATA[ <c>", "<?x", "<a>", "]]>", "<!DOCTYPE z ["]))
    return "".join(parts) + "".join(f"</{t}>" for t in reversed(stack))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("size", [1, 17, 60, 5000])
def test_ranges_equal_the_whole(spark, size):
    r = random.Random(size)
    pages = [random_xml(r, r.randint(0, 60)) for _ in range(150)]
    pages += ["", " ", "text", "text <a/> x", "﻿<a/>", "﻿x<a/>", "<a>", "</a>", "<!-- only", "<a><!DOCTYPE [ <b> ] ></a>", None]
    payloads = spark.createDataFrame(list(enumerate(pages)), "doc_id long, payload string").repartition(3)
    whole, cut = T.markup_tokens(payloads), T.large_markup_tokens(payloads, size)
    assert cut.columns == whole.columns and [f.dataType for f in cut.schema] == [f.dataType for f in whole.schema]
    assert rows(cut) == rows(whole)


def test_one_document_over_many_tasks(spark):
    """All tokens of one document, but no task and no window with all of them."""
    text = "<set>" + "".join(f"<sec n='{i}'><title>T{i}</title><p>words <b>of</b> it</p><!-- <x> --></sec>" for i in range(40_000)) + "</set>"
    payloads = spark.createDataFrame([(1, text)], "doc_id long, payload string")
    tokens = T.large_markup_tokens(payloads, 1 << 16)
    # so small a document would be coalesced into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    per_task = tokens.groupBy(F.spark_partition_id()).agg(F.count("text").alias("count")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = T.markup_tokens(payloads)
    digest = lambda df: df.select(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.count("*")).first()
    assert digest(tokens) == digest(whole)
    total = sum(r["count"] for r in per_task)
    assert total == 40_000 * 9 + 2 and max(r["count"] for r in per_task) < 0.5 * total


def test_no_payloads(spark):
    assert T.large_markup_tokens(spark.createDataFrame([], "doc_id long, payload string")).count() == 0
