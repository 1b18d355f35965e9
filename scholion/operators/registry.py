"""The work registry as a table of one row per article id.

The store itself is not public; row-level effects follow the API contract, and open
points (what counts as free, which ids go first) are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.streaming import snapshot

REGISTRY_SCHEMA = (
    "pmc_id int, scraped boolean, scraped_at timestamp_ntz, success boolean, "
    "success_at timestamp_ntz, error string, error_at timestamp_ntz, user string, "
    "full_text boolean"
)


def new_rows(ids: DataFrame) -> DataFrame:
    """Free registry rows for ids."""
    at, text = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string")
    no = F.lit(False)
    return ids.select(
        "pmc_id", no.alias("scraped"), at.alias("scraped_at"), no.alias("success"),
        at.alias("success_at"), text.alias("error"), at.alias("error_at"),
        text.alias("user"), no.alias("full_text"),
    )


def new_ids(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids the registry does not hold yet, each once."""
    known = registry.select("pmc_id")
    wanted = ids.select("pmc_id").where("pmc_id is not null").distinct()
    return wanted.join(known, "pmc_id", "left_anti")


def registry_insert(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """New registry with the unknown ids added under default flags."""
    return registry.unionByName(new_rows(new_ids(registry, ids)))


def registry_insert_count(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """(inserted)"""
    return new_ids(registry, ids).agg(F.count("*").alias("inserted"))


def registry_insert_file(registry: DataFrame, file_ids: DataFrame) -> DataFrame:
    """(filename, inserted) for ids read from files with ``src_id_list``. An id that
    several files name counts for the first file by name."""
    first = (
        file_ids.where("pmc_id is not null").groupBy("pmc_id").agg(F.min("filename").alias("filename"))
    )
    fresh = first.join(registry.select("pmc_id"), "pmc_id", "left_anti")
    files = file_ids.select("filename").distinct()
    counts = fresh.groupBy("filename").agg(F.count("*").alias("n"))
    return files.join(counts, "filename", "left").select(
        "filename", F.coalesce("n", F.lit(0)).alias("inserted")
    )


def is_free() -> Column:
    return F.col("user").isNull() & ~F.coalesce("scraped", F.lit(False))


def registry_claim(
    registry: DataFrame, users: list[str], batch_size: int = 100, free: Column | None = None
) -> DataFrame:
    """Registry rows claimed by the users, ``batch_size`` each, lowest free ids first.

    Only ``len(users) * batch_size`` rows pass the top-k step, however large the registry
    is; the split among the users works on those."""
    free = is_free() if free is None else free
    taken = registry.where(free).orderBy("pmc_id").limit(len(users) * batch_size)
    place = F.row_number().over(W.orderBy("pmc_id")) - 1
    names = F.array(*[F.lit(u) for u in users])
    ranked = taken.withColumn("place", place)
    return ranked.withColumn(
        "user", F.get(names, F.floor(F.col("place") / batch_size).cast("int"))
    ).drop("place")


def registry_claim_sizes(registry: DataFrame, workers: DataFrame, free: Column | None = None, block: int = 1000) -> DataFrame:
    """Registry rows claimed by ``workers`` (user, size), each as many as its size says, lowest free
    ids first and workers by name; a worker that is listed twice claims twice. Sizes that are null
    or not positive claim nothing, and where rows run out the last workers get fewer or none.

    A worker's claim is an interval of ranks. Ranks meet intervals by blocks of ranks, so that the
    join is by equality; as in ``registry_claim`` only the claimed rows pass the top-k step."""
    free = is_free() if free is None else free
    sized = workers.where("size > 0").select(F.col("user").alias("claimed_by"), F.col("size").cast("long").alias("size"))
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    upto = F.sum("size").over(W.orderBy("claimed_by", "size").rowsBetween(W.unboundedPreceding, 0))
    spans = sized.select("claimed_by", (upto - F.col("size")).alias("first"), upto.alias("upto"))
    blocks = F.sequence(F.floor(F.col("first") / block), F.floor((F.col("upto") - 1) / block))
    spans = spans.select("*", F.explode(blocks).alias("block"))
    taken = registry.where(free).orderBy("pmc_id").limit(total)
    ranked = taken.withColumn("place", (F.row_number().over(W.orderBy("pmc_id")) - 1).cast("long"))
    met = ranked.withColumn("block", F.floor(F.col("place") / block)).join(spans, "block")
    met = met.where("place >= first and place < upto").withColumn("user", F.col("claimed_by"))
    return met.select(*registry.columns)


def registry_after_claim(registry: DataFrame, claimed: DataFrame) -> DataFrame:
    """New registry with the claims noted."""
    names = claimed.select("pmc_id", F.col("user").alias("claimed_by"))
    return registry.join(names, "pmc_id", "left").select(
        *[
            F.coalesce("claimed_by", "user").alias("user") if c == "user" else c
            for c in registry.columns
        ]
    )


def submitted_results(submits: DataFrame) -> DataFrame:
    """(pmc_id, ok, message, has_text, by): what submit bundles (user, success_dict, error_dict,
    full_text_ids, submitted_at) say about each id; ``by`` names the latest bundle.

    When several bundles name an id, the latest one counts."""
    no, text = F.lit(None).cast("boolean"), F.lit(None).cast("string")

    def entry(pmc_id: Column, ok: Column = no, message: Column = text, has_text: Column = no) -> Column:
        return F.struct(
            pmc_id.alias("pmc_id"), ok.alias("ok"), message.alias("message"), has_text.alias("has_text")
        )

    # One list per bundle, so that whatever makes the bundles runs once.
    entries = F.concat(
        *(
            F.coalesce(found, F.array())
            for found in (
                F.transform(F.map_entries("success_dict"), lambda e: entry(e["key"], ok=e["value"])),
                F.transform(F.map_entries("error_dict"), lambda e: entry(e["key"], message=e["value"])),
                F.transform("full_text_ids", lambda i: entry(i, has_text=F.lit(True))),
            )
        )
    )
    rows = submits.select("user", "submitted_at", F.explode(entries).alias("entry")).select(
        "user", "submitted_at", "entry.*"
    )
    latest = F.struct("submitted_at", "user")

    def last(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), latest))

    return rows.groupBy("pmc_id").agg(
        last("ok").alias("ok"),
        last("message").alias("message"),
        F.max("has_text").alias("has_text"),
        F.max(latest).alias("by"),
    )


def registry_apply_results(registry: DataFrame, submits: DataFrame) -> DataFrame:
    """New registry after submit bundles (see ``submitted_results``). Unknown ids are added."""
    return _with_results(registry, submitted_results(submits))


def registry_upsert(spark: SparkSession, path: str, submits: DataFrame, batch_id: int, bucket_size: int = 100_000) -> None:
    """The same on a stored registry (see ``store_registry``): only the buckets of neighbouring ids
    that the bundles name are read, joined and written; the files of all others stay."""
    changes = f"{path}/changes/batch_id={batch_id}"
    submitted_results(submits).write.mode("overwrite").parquet(changes)
    news = spark.read.parquet(changes)
    empty = spark.createDataFrame([], REGISTRY_SCHEMA)
    merge = lambda old, new: _with_results(empty if old is None else old, new)
    snapshot.merge_batch(news, path, batch_id, snapshot.by_range("pmc_id", bucket_size), merge)


def store_registry(registry: DataFrame, path: str, bucket_size: int = 100_000) -> None:
    """Write a registry in buckets of neighbouring ids, as batch 0 of a new table."""
    snapshot.merge_batch(registry, path, 0, snapshot.by_range("pmc_id", bucket_size), lambda _, rows: rows)


def stored_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry as it is now."""
    return snapshot.current(spark, path).drop("bucket")


def _with_results(registry: DataFrame, news: DataFrame) -> DataFrame:
    at = F.col("by.submitted_at")
    won = F.coalesce("ok", F.lit(False))
    known = F.col("by").isNotNull()
    return registry.join(news, "pmc_id", "full").select(
        "pmc_id",
        (known | F.coalesce("scraped", F.lit(False))).alias("scraped"),
        F.when(known, at).otherwise(F.col("scraped_at")).alias("scraped_at"),
        F.when(known, won).otherwise(F.col("success")).alias("success"),
        F.when(won, at).otherwise(F.col("success_at")).alias("success_at"),
        F.when(won, None).otherwise(F.coalesce("message", "error")).alias("error"),
        F.when(won, None)
        .when(F.col("message").isNotNull(), at)
        .otherwise(F.col("error_at"))
        .alias("error_at"),
        F.coalesce("by.user", "user").alias("user"),
        F.coalesce("has_text", "full_text", F.lit(False)).alias("full_text"),
    )


def registry_stats(registry: DataFrame) -> DataFrame:
    """The five counters as one row."""
    return registry.agg(
        F.count("*").alias("Total_List"),
        F.count_if("scraped").alias("Total_Scraped"),
        F.count_if("success").alias("Total_Success"),
        F.count_if("full_text").alias("Total_Full_Text"),
        F.count_if(F.col("error").isNotNull()).alias("Total_Error"),
    )
