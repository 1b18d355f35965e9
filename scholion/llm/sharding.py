"""Sharding by global prefix sums of byte sizes.

Rows are ordered by a range exchange; each partition sums its sizes as it streams, the totals of
the partitions give every partition its offset, and the line of all bytes is cut at equal
targets. Shards are contiguous in the order and differ by about one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import written

#: Bytes that each document counts beside its text.
ROW_BYTES = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, order: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard).

    A null text counts as no bytes. Null ids come first; rows of one id are ordered by size and
    checksum, so copies of an id never meet in one task as a group. An empty table gives no
    rows, fewer documents than shards leave shards empty, extra columns are ignored.

    Only (id, size, checksum) is exchanged, once. The driver sees one total per partition.
    """
    import numpy as np

    narrow = written(
        docs.select(
            F.col(order).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    rule = ["doc_id", "size", "text_crc32", "tie"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, place = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column("size").to_numpy()
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "size", "text_crc32")]
                + [
                    pa.array(np.full(n, part, "int64")),
                    pa.array(ends - sizes),
                    pa.array(np.arange(place, place + n, dtype="int64")),
                ],
                names=["doc_id", "size", "text_crc32", "part", "before", "place"],
            )
            before, place = (int(ends[-1]), place + n) if n else (before, place)

    ordered = written(
        narrow.repartitionByRange(*rule)
        .sortWithinPartitions(*rule)
        .mapInArrow(run, "doc_id long, size long, text_crc32 long, part long, before long, place long")
    )
    totals = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("part").collect()
    if not totals:
        return ordered.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.col("place").alias("slot"))
    everything = sum(r["bytes"] for r in totals)
    starts = list(zip(accumulate((r["bytes"] for r in totals), initial=0), accumulate((r["n"] for r in totals), initial=0)))
    offsets = docs.sparkSession.createDataFrame(
        [(r["part"], b, n) for r, (b, n) in zip(totals, starts)], "part long, bytes_before long, rows_before long"
    )
    # the middle of a document decides, which keeps every cut within half a document
    middle = f"(2 * (before + bytes_before) + size) * {shards} div {2 * everything}"
    # one row per partition of the exchange: bounded by the number of its partitions
    placed = ordered.join(F.broadcast(offsets), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(F.expr(middle), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("place") + F.col("rows_before")).alias("row"),
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )
