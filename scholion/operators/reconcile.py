"""Batch reconciliation: extracted articles against claimed ids.

Joins run on distinct ids, so a hot id cannot skew them. ``best_version`` ranks within
an id, and Spark cuts every map task down to its own best row per id before the shuffle
(WindowGroupLimit), so an id that holds a third of all rows stays harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WIRE_COLUMNS = (
    "pmc_id", "pm_id", "doi", "title", "category", "journal", "publisher", "volume",
    "issue", "issn", "f_page", "l_page", "authors", "publish_date", "abstract_text",
    "keywords", "sections",
)


def distinct_ids(claims: DataFrame) -> DataFrame:
    """(pmc_id): each claimed id once."""
    return claims.select("pmc_id").distinct()


def drop_failed(articles: DataFrame) -> DataFrame:
    """Keep the attempts that gave an article (``pmc_id`` is never null in a record)."""
    return articles.where(F.col("pmc_id").isNotNull())


def claimed_success(articles: DataFrame, claims: DataFrame) -> DataFrame:
    """(pmc_id, success): extracted ids that were claimed."""
    found = articles.select("pmc_id").distinct()
    return found.join(distinct_ids(claims), "pmc_id", "left_semi").withColumn(
        "success", F.lit(True)
    )


def extraction_errors(articles: DataFrame, claims: DataFrame, method: str = "Xml") -> DataFrame:
    """(pmc_id, error): claimed ids without an article."""
    found = articles.select("pmc_id").distinct()
    return distinct_ids(claims).join(found, "pmc_id", "left_anti").withColumn(
        "error", F.lit(f"Extraction failed ({method})")
    )


def section_count() -> Column:
    return F.coalesce(F.size("sections"), F.lit(0))


def best_version(articles: DataFrame, *keys: str) -> DataFrame:
    """One article per pmc_id: most sections, then longest abstract, then first arrival.

    ``keys`` are further grouping columns, such as the batch."""
    sections = F.when(F.col("sections").isNotNull(), F.size("sections")).otherwise(0)
    length = F.coalesce(F.length("abstract_text"), F.lit(0))
    order = W.partitionBy("pmc_id", *keys).orderBy(
        sections.desc(), length.desc(), F.col("arrival").asc()
    )
    ranked = articles.withColumn("rank_in_id", F.row_number().over(order))
    return ranked.where("rank_in_id = 1").drop("rank_in_id")


def full_text_ids(deduped: DataFrame, claims: DataFrame) -> DataFrame:
    """(pmc_id): claimed ids whose best article has sections."""
    with_text = deduped.where(F.size("sections") > 0).select("pmc_id").distinct()
    return with_text.join(distinct_ids(claims), "pmc_id", "left_semi")


def update_items(deduped: DataFrame, *keys: str) -> DataFrame:
    """Wire records of all articles, claimed or not; an empty section map becomes null."""
    filled = F.when(F.size("sections") > 0, F.col("sections")).alias("sections")
    return deduped.select(*keys, *[c for c in WIRE_COLUMNS if c != "sections"], filled)


def submit_bundle(
    items: DataFrame, success: DataFrame, errors: DataFrame, full_text: DataFrame, *keys: str
) -> DataFrame:
    """One submit record per worker batch: keys, articles, full_text_ids, success_dict,
    error_dict.

    All inputs carry ``keys`` (worker and batch), with which a bundle is never larger than
    one claim. The four parts are tagged, stacked and grouped once."""
    key_cols = list(keys)
    record = F.struct(*WIRE_COLUMNS)
    no_record = F.lit(None).cast(items.select(record.alias("r")).schema["r"].dataType)
    none_text, none_bool = F.lit(None).cast("string"), F.lit(None).cast("boolean")

    def tagged(df: DataFrame, part: str, article, ok, error) -> DataFrame:
        return df.select(
            *key_cols, F.lit(part).alias("part"), F.col("pmc_id").alias("id"),
            article.alias("article"), ok.alias("ok"), error.alias("error"),
        )

    rows = (
        tagged(items, "article", record, none_bool, none_text)
        .unionByName(tagged(success, "success", no_record, F.col("success"), none_text))
        .unionByName(tagged(errors, "error", no_record, none_bool, F.col("error")))
        .unionByName(tagged(full_text, "full_text", no_record, none_bool, none_text))
    )

    def listed(part: str, value: Column) -> Column:
        found = F.collect_list(F.when(F.col("part") == part, F.struct("id", value.alias("v"))))
        return F.sort_array(found)

    ids = F.sort_array(F.collect_set(F.when(F.col("part") == "full_text", F.col("id"))))
    articles = F.array_sort(
        F.collect_list(F.when(F.col("part") == "article", F.col("article"))),
        lambda a, b: a["pmc_id"] - b["pmc_id"],
    )
    return rows.groupBy(*key_cols).agg(
        articles.alias("articles"),
        F.when(F.size(ids) > 0, ids).alias("full_text_ids"),
        F.map_from_entries(listed("success", F.col("ok"))).alias("success_dict"),
        F.map_from_entries(listed("error", F.col("error"))).alias("error_dict"),
    )


def batch_summary(claims: DataFrame, articles: DataFrame) -> DataFrame:
    """Per batch: claimed and extracted ids, errors, unique articles, full texts.

    Both inputs carry ``batch``. Rows are first reduced to one per batch and id, with
    map-side combine, then counted."""
    marks = claims.select(
        "batch", "pmc_id", F.lit(1).alias("claimed"), F.lit(0).alias("rows"), F.lit(0).alias("text")
    ).unionByName(
        articles.select(
            "batch",
            "pmc_id",
            F.lit(0).alias("claimed"),
            F.lit(1).alias("rows"),
            F.when(F.size("sections") > 0, 1).otherwise(0).alias("text"),
        )
    )
    ids = marks.groupBy("batch", "pmc_id").agg(
        F.max("claimed").alias("claimed"), F.sum("rows").alias("rows"), F.max("text").alias("text")
    )
    claimed, found = F.col("claimed") == 1, F.col("rows") > 0
    return ids.groupBy("batch").agg(
        F.count_if(claimed).alias("claimed"),
        F.sum("rows").alias("extracted"),
        F.count_if(claimed & ~found).alias("errors"),
        F.count_if(found).alias("unique"),
        F.count_if(claimed & found & (F.col("text") == 1)).alias("full_text"),
    )


def batch_running_totals(summaries: DataFrame, times: DataFrame | None = None, bits: int = 16) -> DataFrame:
    """(batch, processed, total_processed): running total over the batches, whose numbers are not
    negative. With ``times`` (batch, started_at, ended_at) also batch_seconds and elapsed, the
    minutes from the first start to this batch's end; null where a batch has no times.

    Totals run inside blocks of 2**bits batch numbers, over the sums of the blocks inside blocks of
    those, and so on up to the only block of the highest level: no window holds more than
    2**bits rows, however many batches there are."""
    def upper(c: str) -> Column:
        return F.shiftright(F.col(c).cast("long"), bits)

    def within(c: str, last: int) -> W:
        return W.partitionBy(upper(c)).orderBy(c).rowsBetween(W.unboundedPreceding, last)

    rows = summaries.select("batch", F.col("unique").alias("processed"))
    levels = [rows.groupBy(upper("batch").alias("node")).agg(F.sum("processed").alias("n"))]
    for _ in range(bits, 63 - bits, bits):
        levels.append(levels[-1].groupBy(upper("node").alias("node")).agg(F.sum("n").alias("n")))
    before = None
    for level in reversed(levels):
        own = F.coalesce(F.sum("n").over(within("node", -1)), F.lit(0))
        here = level.select("node", upper("node").alias("above"), own.alias("before"))
        if before is not None:
            outer = before.select(F.col("node").alias("above"), F.col("before").alias("outer"))
            here = here.join(outer, "above").withColumn("before", F.col("before") + F.col("outer"))
        before = here.select("node", "before")
    running = rows.select("*", upper("batch").alias("node"), F.sum("processed").over(within("batch", 0)).alias("so_far"))
    totals = running.join(before, "node").select(
        "batch", "processed", (F.col("so_far") + F.col("before")).alias("total_processed")
    )
    if times is None:
        return totals
    first = times.agg(F.min("started_at").alias("first_start"))
    micros = lambda a, b: F.expr(f"timestampdiff(MICROSECOND, {a}, {b})")
    # a single row
    timed = totals.join(times, "batch", "left").crossJoin(F.broadcast(first))
    return timed.select(
        "batch",
        "processed",
        "total_processed",
        (micros("started_at", "ended_at") / F.lit(1e6)).alias("batch_seconds"),
        (micros("first_start", "ended_at") / F.lit(6e7)).alias("elapsed"),
    )
