"""Near-duplicate embeddings by hashing to E8 lattice points.

A table projects the unit vectors to two seeded random 8-dimensional spaces and decodes each to
its nearest point of the E8 lattice; the two points name a cell. Two vectors are compared where
they share a cell of some table, or where one lies in a cell whose lattice point is next nearest
to the other. The cosine, in double precision, decides.

Copies enter once, with their number. Rows are dealt by cell; a cell of many vectors is compared
in blocks by as many tasks, each of which holds its block and a portion of the cell's other rows.
No pair is ever written out: every row knows its own and its probed cells in all tables, so two
rows that meet several times agree on the one meeting that counts, the first table in which both
are at home, else the first in which one probes the other's cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.llm.common import broadcast_if_small, slices, written
from scholion.llm.components import components
from scholion.llm.simhash import join_sets

COSINE = 0.9
TABLES = 8
#: Lattice points to a cell, and the fineness of the lattice; with 8 tables and 2 probes they
#: find over 0.97 of pairs at cosine 0.905 in 64 dimensions, and more of nearer ones.
BLOCKS = 2
SCALE = 3.0
PROBES = 2
SEED = 20_240_817

#: Vectors at home in a cell that one task compares with the cell's members.
CELL_BLOCK = 1024
#: Rows that a task holds while it compares them with a block.
PORTION = 8192


def roots():
    """The 240 shortest vectors of E8: the steps to its neighbouring points."""
    import numpy as np

    whole = [[(i == a) * s + (i == b) * t for i in range(8)] for a, b in combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    half = [[s / 2 for s in signs] for signs in product((1, -1), repeat=8) if signs.count(-1) % 2 == 0]
    return np.array(whole + half)


def _nearest_d8(y):
    """Nearest integer points with an even sum: round, and where the sum is odd, round the worst
    coordinate the other way."""
    import numpy as np

    near = np.rint(y)
    off = y - near
    worst = np.abs(off).argmax(axis=1)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    near[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1, -1)
    return near


def nearest_e8(y):
    """Nearest lattice points: E8 is D8 and D8 shifted by one half in every coordinate."""
    import numpy as np

    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


def cells(unit, tables: int, blocks: int, scale: float, probes: int):
    """Home cells (n, tables) and probed cells (n, tables * probes) as 32-bit hashes of lattice
    points. Points of one table with equal hashes are one cell."""
    import numpy as np

    n, d = unit.shape
    steps = roots()
    home, probed = [], []
    for t in range(tables):
        draw = np.random.default_rng([SEED, d, t])
        project = draw.standard_normal((d, 8 * blocks)) / np.sqrt(8)
        if 8 * blocks <= d:
            project = np.linalg.qr(project)[0] * np.sqrt(d / 8 / 8)
        factor = draw.integers(1 << 40, 1 << 62, (8 * blocks)) | 1
        y = unit @ project * scale
        x = np.concatenate([nearest_e8(y[:, 8 * b : 8 * b + 8]) for b in range(blocks)], axis=1)
        here = ((2 * x).astype(np.int64) * factor).sum(axis=1) + draw.integers(1 << 62)
        home.append(here)
        # stepping by r changes the squared distance by |r|^2 + 2 r (x - y)
        cost = np.concatenate([(x - y)[:, 8 * b : 8 * b + 8] @ steps.T for b in range(blocks)], axis=1)
        move = np.concatenate([((2 * steps).astype(np.int64) * factor[8 * b : 8 * b + 8]).sum(axis=1) for b in range(blocks)])
        if probes:
            best = np.argpartition(cost, probes, axis=1)[:, :probes]
            probed.append(here[:, None] + move[best])
    top = lambda x: (x >> 32).astype(np.int32)
    return top(np.stack(home, axis=1)), top(np.concatenate(probed, axis=1) if probed else np.zeros((n, 0), np.int64))


def _class_rows(width: str):
    """Batches of (vec_id, embedding) -> vec_id, class key (null: links with nothing), raw."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            keys, raws = [], []
            for vector in batch.column("embedding").to_pylist():
                key = raw = None
                if vector and None not in vector:
                    v = np.array(vector, width) + 0.0  # one zero
                    if np.isfinite(v).all() and v.any():
                        raw = v.tobytes()
                        key = hashlib.md5(raw).hexdigest()
                keys.append(key)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.string()), pa.array(raws, pa.binary())], names=["vec_id", "key", "raw"]
            )

    return run


def _unit(raws: list[bytes], width: str):
    import numpy as np

    v = np.frombuffer(b"".join(raws), width).reshape(len(raws), -1).astype("f8")
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _cell_rows(width: str, tables: int, blocks: int, scale: float, probes: int):
    """Class rows -> a row for each cell a class is at home in or probes."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000).to_pydict()
                by_size: dict[int, list[int]] = {}
                for i, raw in enumerate(part["raw"]):
                    by_size.setdefault(len(raw), []).append(i)
                for rows in by_size.values():
                    home, probed = cells(_unit([part["raw"][i] for i in rows], width), tables, blocks, scale, probes)
                    all_cells = np.concatenate([home, probed], axis=1)
                    times = all_cells.shape[1]
                    at_home = np.arange(times) < tables
                    t = np.concatenate([np.arange(tables), np.arange(tables * probes) // max(probes, 1)])
                    # a probed cell that is the home cell or probed already adds nothing
                    new = np.ones(all_cells.shape, bool)
                    for c in range(tables, times):
                        for earlier in np.flatnonzero(t[:c] == t[c]):
                            new[:, c] &= all_cells[:, c] != all_cells[:, earlier]
                    row, column = np.nonzero(new)
                    pick = [rows[r] for r in row.tolist()]
                    known = [c.astype("<i4").tobytes() for c in all_cells]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((t[column].astype(np.int64) << 32) | (all_cells[row, column].astype(np.int64) & 0xFFFFFFFF)),
                            pa.array(at_home[column]),
                            pa.array(t[column].astype("int32")),
                            pa.array([part["key"][i] for i in pick]),
                            pa.array([part["n"][i] for i in pick], pa.int64()),
                            pa.array([part["raw"][i] for i in pick], pa.binary()),
                            pa.array([known[r] for r in row.tolist()], pa.binary()),
                        ],
                        names=["cell", "at_home", "t", "key", "n", "raw", "cells"],
                    )

    return run


FOUND = "key string, other string, links long"


def _compare(width: str, cosine: float, tables: int, portion: int):
    """Rows of whole cells, sorted by cell with the block first -> links of a key, and edges
    (key, other) that connect what links connect."""
    import numpy as np

    def compared(rows: dict[str, list]):
        by_size: dict[int, list[int]] = {}
        for i, raw in enumerate(rows["raw"]):
            by_size.setdefault(len(raw), []).append(i)
        for members in by_size.values():
            block = np.flatnonzero([rows["in_block"][i] for i in members])
            fresh = np.flatnonzero([rows["fresh"][i] for i in members])
            if not len(block) or not len(fresh) or len(members) < 2:
                continue
            unit = _unit([rows["raw"][i] for i in members], width)
            known = np.frombuffer(b"".join(rows["cells"][i] for i in members), "<i4").reshape(len(members), -1)
            home, probed = known[:, :tables], known[:, tables:].reshape(len(members), tables, -1)
            t = np.array([rows["t"][i] for i in members])
            at_home = np.array([rows["at_home"][i] for i in members])
            n = np.array([rows["n"][i] for i in members])
            key = [rows["key"][i] for i in members]
            count = np.zeros(len(members), np.int64)
            parent = np.arange(len(members))
            for at in range(0, len(fresh), 1024):
                some = fresh[at : at + 1024]
                i, j = np.nonzero(unit[some] @ unit[block].T >= cosine)
                i, j = some[i], block[j]
                i, j = i[i != j], j[i != j]
                # pairs by the thousand, as each carries its cells in all tables
                for cut in range(0, len(i), 65_536):
                    x, y = i[cut : cut + 65_536], j[cut : cut + 65_536]
                    same = home[x] == home[y]
                    shared = same.any(axis=1)
                    # y is at home here; the pair comes again with the sides changed
                    here = shared & at_home[x] & (t[x] == same.argmax(axis=1))
                    np.add.at(count, x[here], n[y[here]])
                    parent = join_sets(parent, x[here], y[here])
                    x, y = x[~shared], y[~shared]
                    if not len(x):
                        continue
                    there = (probed[x] == home[y][:, :, None]).any(axis=2)
                    back = (probed[y] == home[x][:, :, None]).any(axis=2)
                    first = (there | back).argmax(axis=1)
                    here = t[x] == first
                    for p in np.flatnonzero(here & back[np.arange(len(x)), first]).tolist():
                        here[p] = key[x[p]] < key[y[p]]  # both probe: the lesser key's meeting counts
                    x, y = x[here], y[here]
                    np.add.at(count, x, n[y])
                    np.add.at(count, y, n[x])
                    parent = join_sets(parent, x, y)
            for i in np.flatnonzero(count).tolist():
                yield key[i], None, int(count[i])
            for i in np.flatnonzero(parent != np.arange(len(members))).tolist():
                yield key[i], key[parent[i]], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found):
            columns = list(zip(*found, strict=True)) or [()] * 3
            types = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=["key", "other", "links"])

        found: list[tuple] = []
        open_shard, rows = None, {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                part = batch.slice(low, high - low).to_pydict() | {"fresh": [True] * (high - low)}
                if shard[low] == open_shard:
                    for k, v in part.items():
                        rows[k] += v
                else:
                    if rows:
                        found += compared(rows)
                    open_shard, rows = shard[low], part
                if len(rows["key"]) >= portion and not rows["in_block"][-1]:
                    found += compared(rows)
                    block = [i for i, b in enumerate(rows["in_block"]) if b]
                    rows = {k: [v[i] for i in block] for k, v in rows.items()} | {"fresh": [False] * len(block)}
                if len(found) > 20_000:
                    yield packed(found)
                    found = []
        if rows:
            found += compared(rows)
        yield packed(found)

    return run


def vector_links(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    cell_block: int = CELL_BLOCK,
    portion: int = PORTION,
) -> DataFrame:
    """(vec_id, embedding) -> one row per row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    and so do vectors of different lengths. Equal vectors link with each other. n_links counts
    the other rows linked directly; component_id is the smallest vec_id reachable. An empty
    table gives no rows, extra columns are ignored.
    """
    element = vectors.schema["embedding"].dataType.elementType
    width = "<f4" if isinstance(element, T.FloatType) else "<f8"
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<float>" if width == "<f4" else "array<double>").alias("embedding"),
    )
    rows = written(plain.mapInArrow(_class_rows(width), "vec_id long, key string, raw binary"))
    classes = written(
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("raw").alias("raw"))
    )
    members = classes.select("key", "n", "raw").mapInArrow(
        _cell_rows(width, tables, blocks, scale, probes),
        "cell long, at_home boolean, t int, key string, n long, raw binary, cells binary",
    )
    sizes = (
        members.where("at_home").groupBy("cell").agg(F.count("*").alias("homes_here")).where(F.col("homes_here") > cell_block)
    )
    large = written(sizes.select("cell", F.ceil(F.col("homes_here") / cell_block).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        members.join(broadcast_if_small(large), "cell", "left")
        .select(
            "cell", "t", "key", "n", "raw", "cells", "at_home",
            F.pmod(F.xxhash64("key"), parts).cast("int").alias("own"),
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
        )
        .select(
            F.xxhash64("cell", "part").alias("shard"), "t", "key", "n", "raw", "cells", "at_home",
            (F.col("at_home") & (F.col("own") == F.col("part"))).alias("in_block"),
        )
    )
    found = written(
        dealt.repartition("shard")
        .sortWithinPartitions("shard", F.desc("in_block"))
        .mapInArrow(_compare(width, cosine, tables, portion), FOUND)
    )
    counts = found.where("other is null").groupBy("key").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
    roots_of = components(edges).withColumnRenamed("node", "key")
    named = written(
        classes.join(counts, "key", "left")
        .join(roots_of, "key", "left")
        .select("key", "first", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    )
    smallest = written(named.groupBy("root").agg(F.min("first").alias("smallest")))
    by_class = named.join(broadcast_if_small(smallest), "root").select("key", (F.col("links") + F.col("n") - 1).alias("links"), "smallest")
    component = F.coalesce("smallest", "vec_id")
    return rows.join(by_class, "key", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
