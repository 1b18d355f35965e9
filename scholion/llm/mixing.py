"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source is to get its weight's share of the mix, but not more than `epochs` times its own
size. What a capped source leaves is shared by the others in proportion to their weights, until
none is above its cap. With w the weights and c the caps the targets are min(c, level * w). A
source reaches its cap at level c / w, so with the sources in that order the first k are capped
for one k, and level = (mix - caps of the first k) / weights of the rest: the fixed point of
clamping and sharing again, found in one pass over one row per source.

A target is met by whole repetitions of all documents of the source and one fractional one: the
documents in a seeded order until the fraction of the words is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, words_pattern, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"

#: Hex digits of the seeded order that name a slice of a source: 16 ** 3 slices.
SLICE_DIGITS = 3


def n_words(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(words_pattern())), F.lit(0)).cast("long")


def seeded_order(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """(no_source, source_key, size) per slice -> one row per source with its target.

    The windows run over one row per source. A source without words has target 0.
    """
    sources = sizes.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn(
        "weight",
        F.element_at(
            F.array(*(F.lit(w).cast("long") for w in weights)),
            ((F.row_number().over(Window.orderBy("no_source", "source_key")) - 1) % len(weights) + 1).cast("int"),
        ),
    )
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), "no_source", "source_key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    levels = ranked.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("mix"),
        (epochs * F.coalesce(F.sum("source_size").over(by_level), F.lit(0))).alias("capped_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0))).alias("weight_from"),
    ).withColumn("level", (F.col("mix") - F.col("capped_before")) / F.col("weight_from"))
    # the first source, in that order, whose cap the level does not reach, fixes the level
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * epochs
    level = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("capped_before"))).over(everything)
    cap = (F.col("source_size") * epochs).cast("double")
    return levels.select(
        "no_source",
        "source_key",
        "source_size",
        F.least(F.coalesce(level * F.col("weight"), cap), cap).alias("target"),
    )


def sized(docs: DataFrame, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, no_source, source_key, size, key (the seeded order), and the columns in `keep`."""
    return docs.select(
        "doc_id",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        n_words().alias("size"),
        seeded_order(F.col("doc_id"), seed).alias("key"),
        *keep,
    )


def mixing_plan(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """Rows of `sized` -> one row per source: source_size, target, whole, cut. A document is
    taken `whole` times, and once more if its key is not above `cut`.

    Words are summed per source and slice first. Only the one slice of each source in which the
    fraction ends is ordered key by key; rows of one id have one key and stay together.
    """
    group = ["no_source", "source_key"]
    slice_of = F.substring("key", 1, SLICE_DIGITS).alias("slice")
    slices = written(sizes.groupBy(*group, slice_of).agg(F.sum("size").alias("size")))
    so_far = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    repeats = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (
        source_targets(slices, weights, share, epochs)
        .withColumn("whole", F.floor(repeats))
        .withColumn("reached", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    last = (
        slices.withColumn("before", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        .join(plan, group)
        .where(F.col("before") <= F.col("reached"))
        .groupBy(*group)
        .agg(
            F.max(F.struct("slice", "before")).alias("last"),
            *(F.first(c).alias(c) for c in ("source_size", "target", "whole", "reached")),
        )
        .select(*group, "source_size", "target", "whole", "reached", "last.slice", F.col("last.before").alias("before"))
    )
    last = written(last)
    inside = Window.partitionBy(*group).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    keys = (
        sizes.withColumn("slice", slice_of)
        .join(broadcast_if_small(last.select(*group, "slice")), [*group, "slice"])
        .groupBy(*group, "key")
        .agg(F.sum("size").alias("size"))
        .withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    )
    cuts = (
        keys.join(last.select(*group, "before", "reached"), group)
        .where(F.col("before") + F.col("inside") + F.col("size") / F.lit(2.0) <= F.col("reached"))
        .groupBy(*group)
        .agg(F.max("key").alias("cut"))
    )
    return written(
        last.join(cuts, group, "left").select(
            *group, "source_size", "target", "whole", F.coalesce("cut", "slice").alias("cut")
        )
    )


def mixed(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of `sized` with source_size, target and copies."""
    more = F.when((F.col("size") > 0) & (F.col("key") <= F.col("cut")), 1).otherwise(0)
    return (
        sizes.join(broadcast_if_small(plan), ["no_source", "source_key"])
        .withColumn("copies", (F.col("whole") + more).cast("long"))
        .drop("no_source", "source_key", "key", "whole", "cut")
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken.

    Size: words of the text, none for null. Sources are ranked by code point, null last, and
    weigh `weights` in turn. copies says how often the mix holds the document: floor(target /
    source size), and once more for the first documents in the seeded order whose middle lies
    below the remaining fraction, so a source's words are within half a document of its
    target. Documents without words have only the whole repetitions. Rows of one doc_id are
    taken alike. An empty table gives no rows; extra columns are ignored.

    Texts are read once, to count words. Nothing is exchanged but sums per source and slice
    and the rows of one slice per source, so a source of any size is spread over its slices.
    """
    sizes = written(sized(docs, seed))
    out = mixed(sizes, mixing_plan(sizes, weights, share, epochs))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with its own columns."""
    columns = docs.columns
    seed = options.pop("seed", SEED)
    plan = mixing_plan(written(sized(docs, seed)), **options)
    row = F.struct(*(F.col(c) for c in columns)).alias("row")
    copies = mixed(sized(docs, seed, (row,)), plan).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
