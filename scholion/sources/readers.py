"""Readers for payload folders and id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def src_xml_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload): every file below ``path`` as one XML payload."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")
    )


def src_html_files(spark: SparkSession, path: str) -> DataFrame:
    """(pmc_id, html) of the ``pmc<id>.html`` files below ``path``; id 0 when the name
    holds no number."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.html")
        .text(path, wholetext=True)
    )
    name = F.col("_metadata.file_name")
    number = F.replace(F.replace(name, F.lit("pmc"), F.lit("")), F.lit(".html"), F.lit(""))
    return files.select(
        F.coalesce(number.try_cast("int"), F.lit(0)).alias("pmc_id"), F.col("value").alias("html")
    )


def src_id_list(spark: SparkSession, path: str, form: str = "txt") -> DataFrame:
    """(pmc_id, filename): one id per line of text files, or the elements of JSON arrays.
    Lines that are no numbers are dropped."""
    reader = spark.read.option("recursiveFileLookup", True)
    name = F.col("_metadata.file_name").alias("filename")
    if form == "txt":
        lines = reader.text(path).select(F.trim("value").try_cast("int").alias("pmc_id"), name)
    else:
        whole = reader.text(path, wholetext=True)
        ids = F.from_json("value", "array<int>")
        lines = whole.select(F.explode(ids).alias("pmc_id"), name)
    return lines.where("pmc_id is not null")
