"""A table of one row per key that batches change, of which each batch writes only what it touches.

Rows lie in buckets. A batch reads the current rows of the buckets its keys fall into, merges
them with its own and writes those buckets anew, in a folder of its own; all other files stay as
they are. Its commit is one small file that names for every bucket the batch that wrote it last.
So a read opens the current files only, whatever came before, and a batch that is run again
starts from the commit before its own: what a failed attempt left behind is never read.

    <path>/data/batch_id=<n>/bucket=<b>/     rows
    <path>/commits/batch_id=<n>/             bucket, version (the batch that wrote it), schema
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "bucket long, version long, schema string"
#: The row of a commit that holds the schema of the rows.
SCHEMA_ROW = -1


def by_hash(key: str, buckets: int = 64) -> Column:
    """Buckets for keys without an order."""
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def by_range(key: str, size: int) -> Column:
    """Buckets of ``size`` neighbouring ids: work that goes through ids in order touches few."""
    return F.floor(F.col(key) / size)


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that finished a folder below ``path``."""
    if not _exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return [int(n.split("=")[1]) for n in named if n.startswith("batch_id=") and _exists(spark, f"{path}/{n}/_SUCCESS")]


def _committed(spark: SparkSession, path: str, before: int | None) -> dict[int, tuple[int, str]]:
    """bucket -> (version, schema) of the last commit, or of the last one before a batch: one row per
    bucket."""
    done = [n for n in batches(spark, f"{path}/commits") if before is None or n < before]
    if not done:
        return {}
    rows = spark.read.schema(COMMIT).parquet(f"{path}/commits/batch_id={max(done)}").collect()
    return {r["bucket"]: (r["version"], r["schema"]) for r in rows}


def current(spark: SparkSession, path: str, before: int | None = None, buckets: set[int] | None = None) -> DataFrame | None:
    """The rows as of the last commit (before that batch, in these buckets), with their bucket; None
    when nothing was committed yet."""
    committed = _committed(spark, path, before)
    if not committed:
        return None
    schema = StructType.fromJson(json.loads(committed.pop(SCHEMA_ROW)[1]))
    wanted = {b: v for b, (v, _) in committed.items() if buckets is None or b in buckets}
    if not wanted:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/batch_id={v}/bucket={b}" for b, v in sorted(wanted.items())]
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*schema.names)


def merge_batch(
    rows: DataFrame,
    path: str,
    batch_id: int,
    bucket: Column,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> DataFrame | None:
    """Commit a batch. ``merge(old, new)`` gives the new rows of the touched buckets from their rows
    so far (None before the first commit) and those of the batch. Returns the old rows.

    The driver holds one number per bucket, whose count is a parameter of the table."""
    spark = rows.sparkSession
    found = rows.select(bucket.cast("long").alias("bucket")).distinct().collect()
    buckets = {r["bucket"] for r in found if r["bucket"] is not None}
    old = current(spark, path, batch_id, buckets)
    merged = merge(old.drop("bucket") if old is not None else None, rows).withColumn("bucket", bucket.cast("long"))
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/batch_id={batch_id}")
    committed = _committed(spark, path, batch_id)
    entries = {b: v for b, (v, _) in committed.items()} | dict.fromkeys(buckets, batch_id)
    entries[SCHEMA_ROW] = batch_id
    schema = merged.schema.json()
    commit = spark.createDataFrame([(b, v, schema if b == SCHEMA_ROW else None) for b, v in entries.items()], COMMIT)
    commit.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch_id={batch_id}")
    return old.drop("bucket") if old is not None else None
