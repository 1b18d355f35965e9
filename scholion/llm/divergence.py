"""How sources of one language differ: exact divergence of their terms, with dominance skybands.

A term of a (lang, source) group scores by its share in the group, p, against its share in the
whole language, q: floor((p - q)^2 / q). The score never falls when the group's count grows, never
falls when the language's count shrinks, and the earlier name wins a tie. So a term that k others
dominate in all three (higher group count, lower language count, earlier UTF-8) is behind k
others in the ranking. Every partition keeps its k-skyband, the terms that fewer than k others
dominate; skybands are merged by the same rule, and the few that remain are scored and ranked.

Shares are integers, 1 + floor(10^9 (count + 1) / (N + V)), and all arithmetic is exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, byte_bounded, slices, written

#: Terms are runs of letters in the sense of the contract, in UTF-8: bytes of A-Z, a-z and above
#: ASCII. A text becomes lower case, and every other byte a space, by one table.
LETTERS = bytes(b if chr(b).isalpha() or b > 0x7F else 0x20 for b in range(256)).lower()

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200

#: A worker's tallies are handed on at so many entries or bytes of terms.
TALLY_ENTRIES = 600_000
TALLY_BYTES = 64 << 20

#: Numbers of a matrix of terms and sources, and of sums that a worker keeps.
MATRIX_CELLS = 1 << 20
SUM_CELLS = 1 << 22

#: Rows that are held against a skyband at once, and parts that a group is merged in first.
CHUNK = 256
MERGE_PARTS = 32

#: Above every total.
HIGHEST = np.iinfo("int64").max


# --- counting ----------------------------------------------------------------------


def tally_terms(batches: Iterator[pa.RecordBatch], ids: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (id, term, n, docs) of each group, summed within a bounded table."""
    seen: dict[int, Counter] = defaultdict(Counter)
    docs: dict[int, Counter] = defaultdict(Counter)
    entries = size = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for group, counts in seen.items():
            within = docs[group]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), group, "int32")),
                    pa.array(list(counts), pa.binary()).view(pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                    pa.array(list(map(within.__getitem__, counts)), pa.int64()),
                ],
                names=["id", "term", "n", "docs"],
            )
        seen.clear()
        docs.clear()

    for part in slices(batches, 100):
        columns = (part.column(c).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(*columns, strict=True):
            terms = text.translate(LETTERS).split()
            group, once = ids[lang, source], set(terms)
            known = seen[group]
            before = len(known)
            known.update(terms)
            docs[group].update(once)
            if len(known) > before:
                entries += len(known) - before
                size += sum(map(len, once))
        if entries > TALLY_ENTRIES or size > TALLY_BYTES:
            yield from handed_on()
            entries = size = 0
    yield from handed_on()


def named(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(
        *(F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source")),
        F.coalesce(F.col("text"), empty).cast("binary").alias("text"),
    )


def numbered_groups(docs: DataFrame) -> DataFrame:
    """(id, lang, source): the groups that occur, one row each, numbered in their order. A written
    table; the tasks that count know all groups, as those that add up pairs do."""
    found = sorted(map(tuple, named(docs).select("lang", "source").distinct().collect()))
    rows = [(i, *group) for i, group in enumerate(found)]
    return written(docs.sparkSession.createDataFrame(rows, "id int, lang string, source string"))


def kept_terms(docs: DataFrame, groups: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, counts: array<struct<source, n>>) of the terms that at least
    ``least_docs`` documents of the language hold. One exchange, of tallies, which carry the
    number of their group and not its names."""
    byte_bounded(docs.sparkSession)
    ids = {(r.lang, r.source): r.id for r in groups.collect()}
    tallies = named(docs).mapInArrow(lambda batches: tally_terms(batches, ids), "id int, term string, n long, docs long")
    # dealt by term, so both groupings work on this one exchange
    by_group = tallies.repartition("term").groupBy("term", "id")
    counts = by_group.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).join(broadcast_if_small(groups), "id")
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("total"),
            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"),
            F.sum("docs").alias("docs"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )


def group_sizes(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, size, vocabulary, lang_size): one row per group that occurs."""
    sizes = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_size"))
    return (
        groups.select("lang", "source")
        .join(sizes.agg(F.sum("c.n").alias("size")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["size", "vocabulary", "lang_size"])
    )


# --- scores ------------------------------------------------------------------------


def share(count: str, size: str, vocabulary: str = "vocabulary") -> Column:
    """1 + floor(10^9 (count + 1) / (size + vocabulary)), with 38 digits on the way."""
    return F.expr(
        f"1L + ({SCALE}BD * cast({count} + 1 as decimal(20, 0))) div cast({size} + {vocabulary} as decimal(20, 0))"
    )


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same for arrays: a long division by thousands stays within 64 bits."""
    quotient, rest = np.divmod(counts + 1, whole)
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // whole
        rest %= whole
    return quotient + 1


def score(p: str = "p", q: str = "q") -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


# --- pairs of sources --------------------------------------------------------------


def pair_sums(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language the sum of scores over all
    kept terms, also those that neither holds.

    Every task adds up its own terms, so no pair is made per term or document. The tasks know
    the groups, one row each; the result has the square of their number.
    """
    known: dict[str, tuple[list[str], np.ndarray]] = {}
    for r in groups.select("lang", "source", (F.col("size") + F.col("vocabulary")).alias("whole")).collect():
        names, whole = known.setdefault(r.lang, ([], []))
        names.append(r.source)
        whole.append(r.whole)
    places = {lang: {s: i for i, s in enumerate(names)} for lang, (names, _) in known.items()}
    wholes = {lang: np.array(whole, "int64") for lang, (_, whole) in known.items()}

    def rows(lang: str, sums: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
        names = known[lang][0]
        for i, line in enumerate(sums, first):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names)), pa.array([names[i]] * len(names)), pa.array(names), pa.array(line)],
                names=["lang", "source", "item", "value"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            counts = batch.column("counts")
            lengths = np.diff(counts.offsets.to_numpy())
            cells = counts.flatten()
            sources = cells.field("source").dictionary_encode()
            names, codes = sources.dictionary.to_pylist(), sources.indices.to_numpy()
            n, line = cells.field("n").to_numpy(), np.repeat(np.arange(batch.num_rows), lengths)
            for lang in sorted(set(langs)):
                place, whole = places[lang], wholes[lang]
                many = len(whole)
                column = np.array([place.get(s, -1) for s in names], "int64")
                lines = np.flatnonzero(langs == lang)
                for part in np.array_split(lines, -(-len(lines) * many // MATRIX_CELLS) or 1):
                    if not len(part):
                        continue
                    at = np.full(batch.num_rows, -1)
                    at[part] = np.arange(len(part))
                    own = at[line] >= 0
                    matrix = np.zeros((len(part), many), "int64")
                    matrix[at[line[own]], column[codes[own]]] = n[own]
                    # many terms have the same few counts
                    matrix, times = np.unique(matrix, axis=0, return_counts=True)
                    p = shares(matrix, whole)
                    for g in range(many):
                        gap = p[:, g : g + 1] - p
                        sums = times @ (gap * gap // p)
                        if many * many <= SUM_CELLS:
                            kept.setdefault(lang, np.zeros((many, many), "int64"))[g] += sums
                        else:
                            yield from rows(lang, sums[None], g)
            if sum(s.size for s in kept.values()) > 2 * SUM_CELLS:
                for lang, sums in kept.items():
                    yield from rows(lang, sums, 0)
                kept.clear()
        for lang, sums in kept.items():
            yield from rows(lang, sums, 0)

    found = terms.select("lang", "counts").mapInArrow(run, "lang string, source string, item string, value long")
    sums = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").where("source <> item")
    return pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])


# --- skybands ----------------------------------------------------------------------


class Band:
    """The skyband of one group's rows so far, as different (count, total) pairs with their number,
    and the stairs of dropped pairs: whatever one of these dominates is dropped as well."""

    def __init__(self, k: int):
        self.k = k
        self.n, self.total, self.times = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        self.step, self.floor = np.zeros(0, "int64"), np.full(1, HIGHEST)

    def _drop(self, n: np.ndarray, total: np.ndarray) -> None:
        n, total = np.append(self.step, n), np.append(self.floor[:-1], total)
        order = np.lexsort((total, -n))  # highest counts first
        n, floor = n[order], np.minimum.accumulate(total[order])
        new = np.append(True, floor[1:] < floor[:-1])
        self.step, self.floor = n[new][::-1], np.append(floor[new][::-1], HIGHEST)

    def _take(self, n: np.ndarray, total: np.ndarray) -> None:
        n, total = np.append(self.n, n), np.append(self.total, total)
        times = np.append(self.times, np.ones(len(n) - len(self.n)))
        order = np.lexsort((total, n))
        n, total = n[order], total[order]
        new = np.flatnonzero(np.append(True, (n[1:] != n[:-1]) | (total[1:] != total[:-1])))
        self.n, self.total, self.times = n[new], total[new], np.add.reduceat(times[order], new)

    def keep(self, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Which of these rows, which follow all rows so far, fewer than ``k`` others dominate."""
        keep = np.zeros(len(n), bool)
        at = np.flatnonzero(self.floor[np.searchsorted(self.step, n)] > total)
        if not len(at):
            return keep
        x, y = n[at], total[at]
        over = ((self.n >= x[:, None]) & (self.total <= y[:, None])).astype("float64") @ self.times
        over += np.tril((x >= x[:, None]) & (y <= y[:, None]), -1).sum(1)
        stays = over < self.k
        keep[at[stays]] = True
        if stays.any():
            self._take(x[stays], y[stays])
        if not stays.all():
            self._drop(x[~stays], y[~stays])
        return keep


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, n, total) that fewer than ``k`` others of their group *in
    their partition* dominate.

    Rows come sorted by group and term, so all that can dominate a row came before it, and a row
    is kept or dropped for good when it comes. What k others dominate need not be remembered:
    whatever it dominates, they do. A task holds the skyband of one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Band(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            a, b = batch.column("n").to_numpy(), batch.column("total").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for start, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                if keys[start] != group:
                    group, band = keys[start], Band(k)
                for at in range(start, end, CHUNK):
                    part = slice(at, min(at + CHUNK, end))
                    keep[part] = band.keep(a[part], b[part])
            yield batch.filter(pa.array(keep))

    ordered = rows.sortWithinPartitions("lang", "source", "term")
    return ordered.mapInArrow(run, "lang string, source string, term string, n long, total long")


def top_terms(terms: DataFrame, groups: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value): a superset of each group's k best terms among those whose share
    in the group is above that in the language; its best k are exact."""
    few = broadcast_if_small(groups)
    cells = terms.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.*")
    scored = lambda df: df.join(few, ["lang", "source"]).withColumns(
        {"p": share("n", "size"), "q": share("total", "lang_size")}
    )
    columns = ("lang", "source", "term", "n", "total")
    # whatever dominates a term above its language's share is above it too
    band = skyband(scored(cells).where("p > q").select(*columns), k)
    band = skyband(band.repartition("lang", "source", F.pmod(F.hash("term"), F.lit(MERGE_PARTS))), k)
    band = skyband(band.repartition("lang", "source"), k)
    return scored(band).select("lang", "source", F.col("term").alias("item"), score().alias("value"))


# --- the audit ---------------------------------------------------------------------


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' ranks all other sources of the language,
    part 'term' the ``top`` terms of the group; higher values first, ties by UTF-8.

    Null texts, langs and sources count as ''. Every row of ``docs`` is a document, repeated
    rows too. A language without kept terms has pairs of value 0 and no terms. An empty table gives
    no rows, extra columns are ignored. Kept terms and groups are written once to the shared folder.
    """
    names = numbered_groups(docs)
    terms = written(kept_terms(docs, names, least_docs))
    groups = written(group_sizes(names, terms))
    byte_bounded(docs.sparkSession)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_sums(terms, groups).withColumn("rank", F.row_number().over(order))
    best = top_terms(terms, groups, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    listed = [
        df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        for part, df in (("pair", pairs), ("term", best))
    ]
    return listed[0].unionByName(listed[1])
