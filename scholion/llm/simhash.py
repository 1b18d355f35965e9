"""SimHash near-dedup with BK-trees.

Fingerprints of 64 bits link when at most `distance` bits differ. They are dealt to shards: the
bits are cut into blocks, and two fingerprints with at most `distance` differing bits agree in
all but `distance` of the blocks, so each choice of the others is a key under which they meet.
Every shard is a BK-tree whose children hang at their integer Hamming distance from the parent;
a search follows only edges whose distance lies within the radius of the query's distance.

A tree goes to the tasks that hold its queries and to no others, as broadcasting all of them
would send the whole corpus everywhere. A shard of many fingerprints becomes several trees of
bounded size, and its members visit each of them. Trees report the joins of a spanning forest,
never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, slices, written
from scholion.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42

#: Fingerprints in one tree at most.
TREE_NODES = 2048
#: Rows of shards that a task holds, beside one tree.
HELD = 50_000

#: Shards hold so many fingerprints on average at most; beyond that there are more blocks.
MEAN_SHARD = 64

#: Pairs of query and node looked at together.
FRONTIER = 1 << 19


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the ASCII-lower-cased words' shingles; 0 without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [
            xxh64_intdigest(line[s:e], SEED)
            for s, e in zip(starts[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        ]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over_half = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over_half, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed long) for every row; null and blank texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            fps = [fingerprint_of(t or "", shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- BK-trees


class BkForest:
    """BK-trees over `fp`, one for each value of `shard`, as arrays. Roots and children are
    placed level by level: the first of a group becomes its node, the others form groups by
    their distance to it."""

    def __init__(self, fp, shard):
        import numpy as np

        self.fp = fp
        self.roots: dict[int, int] = {}
        at, key = np.arange(len(fp)), np.asarray(shard, np.int64)
        edges: list = []
        first = True
        while len(at):
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            heads = at[new]
            if first:
                self.roots = dict(zip(key[new].tolist(), heads.tolist(), strict=True))
                first = False
            else:
                edges.append((key[new], heads))
            node = heads[np.cumsum(new) - 1]
            rest = ~new
            at, node = at[rest], node[rest]
            key = node * 65 + np.bitwise_count(fp[at] ^ fp[node]).astype(np.int64)
        keys = np.concatenate([k for k, _ in edges]) if edges else np.zeros(0, np.int64)
        nodes = np.concatenate([n for _, n in edges]) if edges else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.edge_keys, self.children = keys[order], nodes[order]

    def within(self, queries, start, radius: int) -> Iterator[tuple]:
        """(query index, node, distance) of all nodes within the radius, level by level."""
        import numpy as np

        q, node = np.arange(len(queries)), start
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.fp[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near], d[near]
            low = np.searchsorted(self.edge_keys, node * 65 + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.edge_keys, node * 65 + np.minimum(d + radius, 64), "right")
            n = high - low
            q = np.repeat(q, n)
            begin = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else low
            node = self.children[begin + np.arange(len(q))]


def join_sets(parent, a, b):
    """Union of the pairs in a forest of smallest members, kept flat."""
    import numpy as np

    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def tree_links(fp, shard, in_tree, radius: int):
    """Pairs (i, j) that span what the shards' trees connect."""
    import numpy as np

    members = np.flatnonzero(in_tree)
    parent = np.arange(len(fp))
    if not len(members):
        return parent, parent
    forest = BkForest(fp[members], shard[members])
    sizes = np.bincount(np.searchsorted(np.unique(shard), shard)).max()
    step = max(1, FRONTIER // int(sizes))
    for at in range(0, len(fp), step):
        part = np.arange(at, min(at + step, len(fp)))
        start = np.array([forest.roots.get(s, -1) for s in shard[part].tolist()])
        part, start = part[start >= 0], start[start >= 0]
        for q, node, _ in forest.within(fp[part], start, radius):
            parent = join_sets(parent, part[q], members[node])
    low = np.flatnonzero(parent != np.arange(len(fp)))
    return low, parent[low]


# ---------------------------------------------------------------- shards


def blocks_for(n: int, distance: int) -> int:
    """The fewest blocks that keep shards small on average; the links found are the same."""
    for blocks in range(distance + 1, distance + 5):
        if n >> (64 * (blocks - distance) // blocks) <= MEAN_SHARD:
            break
    return blocks


def shard_keys(fp: Column, blocks: int, distance: int) -> Column:
    """array of struct(choice, value): the bits of every choice of blocks - distance blocks."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in pick) for pick in combinations(range(blocks), blocks - distance)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*(F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)))


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Distinct fp -> edges (a, b) of fingerprints with at most `distance` differing bits that
    connect whatever such pairs connect."""
    blocks = blocks_for(distinct.count(), distance)
    keyed = distinct.select("fp", F.explode(shard_keys(F.col("fp"), blocks, distance)).alias("k")).select("fp", "k.*")
    sizes = keyed.groupBy("choice", "value").agg(F.count("*").alias("n")).where("n > 1")
    trees = F.ceil(F.col("n") / tree_nodes).cast("int")
    home = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("trees")).cast("int")
    dealt = (
        keyed.join(sizes.select("choice", "value", trees.alias("trees")), ["choice", "value"])
        .select("fp", "choice", "value", home.alias("home"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"))
        .select("fp", F.xxhash64("choice", "value", "tree").alias("shard"), (F.col("home") == F.col("tree")).alias("in_tree"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def links(parts):
            fp = np.concatenate([p[0] for p in parts])
            shard = np.concatenate([p[1] for p in parts])
            in_tree = np.concatenate([p[2] for p in parts])
            a, b = tree_links(fp.view(np.uint64), shard, in_tree, distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "shard", "in_tree")])
            if sum(len(p[0]) for p in held) < HELD:
                continue
            fp, shard, in_tree = (np.concatenate(c) for c in zip(*held, strict=True))
            # the last shard may go on in the next batch
            open_from = np.searchsorted(shard, shard[-1], "left")
            if open_from:
                yield links([(fp[:open_from], shard[:open_from], in_tree[:open_from])])
            fp, shard, in_tree = fp[open_from:], shard[open_from:], in_tree[open_from:]
            if len(fp) >= HELD and not in_tree[-1]:
                # its tree came first; only that is kept for the queries that follow
                yield links([(fp, shard, in_tree)])
                fp, shard, in_tree = fp[in_tree], shard[in_tree], in_tree[in_tree]
            held = [[fp, shard, in_tree]]
        if held:
            yield links(held)

    # a shard's xxhash64 may meet another's: their trees then hold both, and only near pairs link
    return dealt.repartition("shard").sortWithinPartitions("shard", F.desc("in_tree")).mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id (smallest doc_id reachable by links).

    Null and blank texts have fingerprint 0 and link like any other. Copies share a fingerprint
    and enter the search once. Null doc_ids are never the smallest unless a group has no other.
    Repeated rows are one group; an empty table gives no rows; extra columns are ignored.
    """
    prints = written(fingerprints(docs, shingle))
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(fingerprint_links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp")
    named = written(
        distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    smallest = written(named.groupBy("root").agg(F.min("first").alias("component_id")))
    classes = named.join(broadcast_if_small(smallest), "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
