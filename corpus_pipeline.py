"""A corpus pipeline of five stages, each by one operator of scholion.llm.

Each stage gets the rows that its predecessor kept, written as Parquet and read again, and all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholion.llm import mixing, packing, secret_scan, simhash, toxicity
from scholion.llm.common import shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of a severity above 0 is at most one half. The grades are fitted on
    the labelled ones among the stage's own input."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade_documents(docs, model, keep=COLUMNS[1:]).where("not toxic").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group; of rows that repeat that id, one."""
    kept = simhash.simhash_groups(docs).where("doc_id <=> component_id").select("component_id").distinct()
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("component_id")), "left_semi")
    return rows.select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; n_chars follows the text."""
    clean = secret_scan.redacted(secret_scan.scan_secrets(docs))
    found = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(found, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids."""
    return packing.pack_documents(docs, keep_tables=False)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", keep_one_of_each_group),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Fitted grades, fingerprints and token ids have no SQL form; a brute-force version tests run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
