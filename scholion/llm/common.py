"""What several operators of this folder need: shared tables, checked broadcasts, columns."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Rows of whole texts that go to a Python worker at once.
ARROW_ROWS = 1000

#: Bytes of a batch that goes to a Python worker, but for its last row.
ARROW_BYTES = 32 << 20

#: A side is broadcast only if its written table is at most this large.
BROADCAST_BYTES = 8 << 20

_OWN: dict[str, str] = {}


def findable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, if it is not
    installed there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bounded(spark: SparkSession) -> None:
    """Batches to Python workers end at a number of bytes too, so a thousand very long texts
    are not held at once. The setting holds for the session, as for any Arrow operator."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that the cluster names. Only Spark's writers make it.
    A local session that names none, as in tests, gets one folder of its own."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
        key = context.applicationId
        root = _OWN.setdefault(key, "") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
        _OWN[key] = root
    return f"{root}/llm-{uuid.uuid4()}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: later readers see the same rows, whatever
    executors were lost, and the plan starts anew."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Size of the files of a table that `written` made."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A hint only for a written table whose files are small; beyond that Spark shuffles
    both sides, and its adaptive execution splits hot keys."""
    return F.broadcast(df) if written_bytes(df) <= limit else df


def words_pattern() -> str:
    return r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))




def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
