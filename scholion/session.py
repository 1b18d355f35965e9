"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


# The JVM does not compile methods above 8000 bytes. Generated code of that size is split
# into small functions instead of being run by the byte code interpreter.
JOB_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Groups by document come sorted by it: one is held at a time, and in one step.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs need to a session made elsewhere."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "scholion", **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for. Anything may be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # Tokens are many times the size of the compressed payloads they come from, so
        # exchanged payload partitions are kept small.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        # A task of whole records runs at least 172 generated classes; those the cache cannot hold are
        # compiled in every task.
        "spark.sql.codegen.cache.maxEntries": "2000",
        # Groups arrive sorted by document; hash buffers need not give way early.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
        "spark.ui.enabled": "false",
        # Recording a call site for every expression takes longer than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | JOB_CONF | conf
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the session names; on a local master without one, a new
    temporary folder."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root
