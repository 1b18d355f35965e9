"""The polling loop as streaming jobs.

Every micro-batch writes its own folder, in overwrite mode: a batch that is run again
after a failure replaces itself, and none rewrites what earlier ones wrote. What has to be
settled against earlier batches is kept in buckets (``snapshot``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.operators.html_articles import html_article_results
from scholion.operators.reconcile import best_version
from scholion.operators.registry import registry_stats
from scholion.operators.tokens import tasks_for
from scholion.operators.xml_articles import xml_article_results
from scholion.streaming import snapshot

EXTRACTORS = {"Xml": xml_article_results, "Web": html_article_results}


def payload_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(doc_id, payload) of the files that arrive below ``path``; the path is the id."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return files.select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("payload")
    )


def _run(stream: DataFrame, write, checkpoint: str):
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_extract(payloads: DataFrame, path: str, checkpoint: str, method: str = "Xml"):
    """Extract arriving payloads (doc_id, payload) into ``path``/articles. Payloads without
    an article go to ``path``/errors (doc_id, error, fault, fault_pos) and never stop the run.
    Records and errors come out of one pass over the payloads, a row for each of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        results = EXTRACTORS[method](batch, tasks=tasks_for(batch)).persist()
        good = F.col("fault").isNull()
        _write(results.where(good).drop("fault", "fault_pos"), f"{path}/articles", batch_id)
        message = F.lit(f"Extraction failed ({method})").alias("error")
        _write(results.where(~good).select("doc_id", message, "fault", "fault_pos"), f"{path}/errors", batch_id)
        results.unpersist()

    return _run(payloads, write, checkpoint)


def stream_best_version(articles: DataFrame, path: str, checkpoint: str, buckets: int = 64):
    """Keep the best version per id of the articles that arrive, as a table of buckets: a batch
    settles its articles against the versions so far of their buckets and writes those anew."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        merge = lambda old, new: best_version(new if old is None else old.unionByName(new))
        snapshot.merge_batch(batch, path, batch_id, snapshot.by_hash("pmc_id", buckets), merge)
        batch.unpersist()

    return _run(articles, write, checkpoint)


def current_best(spark: SparkSession, path: str) -> DataFrame:
    """The best version per id over all batches so far. Costs what these hold, however many
    batches there were."""
    return snapshot.current(spark, path).drop("bucket")


#: When a row of the registry was true: the last time it names. Rows without one are the oldest.
LAST_CHANGE = ("scraped_at", "success_at", "error_at")


def latest_rows(rows: DataFrame, *order: str) -> DataFrame:
    """One row per pmc_id: the one with the greatest ``order`` columns, by default the last time
    it names; then the greatest row as a whole, so that equal times give one result."""
    names = [c for c in rows.columns if c != "pmc_id"]
    stamps = [F.greatest(*LAST_CHANGE).alias("last_change")] if not order else []
    best = F.max(F.struct(*stamps, *order, *[c for c in names if c not in order]))
    return rows.groupBy("pmc_id").agg(best.alias("row")).select(
        *[F.col("pmc_id") if c == "pmc_id" else F.col(f"row.{c}").alias(c) for c in rows.columns]
    )


def stream_registry_stats(
    registry: DataFrame, path: str, checkpoint: str, *order: str, bucket_size: int = 100_000
):
    """Registry counters while rows arrive, an id as often as it changes: its latest row counts,
    whatever order rows come in, and a row that comes again changes nothing.

    The latest row of every id is kept in ``path``/rows, in buckets of neighbouring ids. A batch reads
    the buckets it touches, and the counters change by the difference between the rows of those
    before and after it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        spark, rows = batch.sparkSession, f"{path}/rows"
        merge = lambda old, new: latest_rows(new if old is None else old.unionByName(new), *order)
        bucket = snapshot.by_range("pmc_id", bucket_size)
        known = batch.where("pmc_id is not null")
        old = snapshot.merge_batch(known, rows, batch_id, bucket, merge)
        new = spark.read.parquet(f"{rows}/data/batch_id={batch_id}") if not known.isEmpty() else known
        change = registry_stats(new) if old is None else _difference(registry_stats(new), registry_stats(old))
        so_far = _stats_before(spark, f"{path}/stats", batch_id)
        _write(change if so_far is None else _sum(change, so_far), f"{path}/stats", batch_id)
        batch.unpersist()

    return _run(registry, write, checkpoint)


def _sum(a: DataFrame, b: DataFrame, sign: int = 1) -> DataFrame:
    """Counters added up: one row each."""
    both = a.unionByName(b.select(*[(F.col(c) * sign).alias(c) for c in b.columns]))
    return both.agg(*[F.sum(c).alias(c) for c in a.columns])


def _difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return _sum(a, b, -1)


def _stats_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The counters of the batch before this one."""
    earlier = [n for n in snapshot.batches(spark, path) if n < batch_id]
    return spark.read.parquet(f"{path}/batch_id={max(earlier)}") if earlier else None


def latest_stats(spark: SparkSession, path: str) -> DataFrame:
    """The counters of the last batch."""
    return spark.read.parquet(f"{path}/stats/batch_id={max(snapshot.batches(spark, f'{path}/stats'))}")
