"""Quality rules: decision lists learned by sequential covering.

Statistics of whole texts are computed in Spark. From labelled documents a list of rules is
grown, each a conjunction of thresholds that covers bad documents, then pruned on documents it
was not grown on, and its documents are taken out before the next. The list is emitted as
ordered Spark conditional expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from scholion.llm.common import slices, written

#: Labelled documents the list is learned from at most.
SAMPLE = 20_000

#: Thresholds tried for a statistic; conditions to a rule; rules to a list.
CUTS = 64
MOST_CONDITIONS = 4
MOST_RULES = 24
LEAST_COVER = 5
LEAST_PRECISION = 0.85

SPACE = " \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "n_long",
)

#: Shares the rules may test, next to n_words, as SQL over the counts.
SHARES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "long_share": "n_long / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}
FEATURES = ("n_words", *SHARES)


def counts_of(text: str) -> tuple[int, ...]:
    """COUNTS of one whole text. Words are runs without ASCII white space."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    among = lambda marks: len(raw) - len(raw.translate(None, marks))
    words = raw.split()
    n = len(words)
    ids: dict[bytes, int] = {}
    line = [ids.setdefault(w, len(ids)) for w in words]
    repeated = 0
    if n >= 3:
        w = np.array(line, np.int64)
        _, first = np.unique(w[:-2] * len(ids) + w[1:-1], return_inverse=True)
        _, window, times = np.unique(first * len(ids) + w[2:], return_inverse=True, return_counts=True)
        twice = times[window] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= twice
        repeated = int(covered.sum())
    seen: set[str] = set()
    lines = duplicates = 0
    for row in text.split("\n"):
        if row.strip(SPACE):
            lines += 1
            duplicates += row in seen
            seen.add(row)
    return (
        n,
        len(text) - sum(map(text.count, SPACE)),
        among(SYMBOLS),
        duplicates,
        repeated,
        lines,
        among(UPPER),
        among(b"0123456789"),
        among(b"!?"),
        len(ids),
        sum(len(w) > 24 for w in words),
    )


def quality_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS for every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            made = list(zip(*map(counts_of, batch.column("text").to_pylist()), strict=True)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in made)], names=["doc_id", *COUNTS]
            )

    schema = StructType().add("doc_id", LongType())
    for name in COUNTS:
        schema = schema.add(name, LongType())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(SHARES.get(self.feature, self.feature)).cast("double")
        return value >= self.cut if self.above else value < self.cut


Rules = tuple[tuple[Condition, ...], ...]


def _covered(x, conditions):
    import numpy as np

    out = np.ones(len(x), bool)
    for c in conditions:
        value = x[:, FEATURES.index(c.feature)]
        out &= value >= c.cut if c.above else value < c.cut
    return out


def _grown(x, bad, cuts) -> tuple[Condition, ...]:
    """Add the condition with the highest information gain until no good document is covered."""
    import numpy as np

    rule: list[Condition] = []
    here = np.ones(len(x), bool)
    while len(rule) < MOST_CONDITIONS:
        p0, n0 = (bad & here).sum(), (~bad & here).sum()
        if not n0 or not p0:
            break
        before, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for f, name in enumerate(FEATURES):
            value = x[:, f]
            for cut in cuts[f]:
                high = value >= cut
                for above, side in ((True, high), (False, ~high)):
                    p = (bad & here & side).sum()
                    if p < LEAST_COVER:
                        continue
                    n = (~bad & here & side).sum()
                    gain = p * (np.log2(p / (p + n)) - before)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(name, above, float(cut)))
        if best[1] is None:
            break
        rule.append(best[1])
        here &= _covered(x, [best[1]])
    return tuple(rule)


def _pruned(rule, x, bad) -> tuple[Condition, ...]:
    """The first conditions of the rule that do best on documents it was not grown on."""

    def worth(r):
        c = _covered(x, r)
        p, n = int((bad & c).sum()), int((~bad & c).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def learn_list(x, bad, fold) -> Rules:
    """x: (documents, FEATURES); bad: which are bad; fold: 0 to 2, the last one prunes."""
    import numpy as np

    rules: list[tuple[Condition, ...]] = []
    left = np.ones(len(x), bool)
    aside = np.zeros(len(x), bool)  # documents of rules that are no good; they still count against others
    while len(rules) < MOST_RULES and (bad & left & ~aside).sum() >= LEAST_COVER:
        grow, prune = left & ~aside & (fold < 2), left & (fold == 2)
        cuts = [np.unique(np.quantile(x[grow, f], np.linspace(0.002, 0.998, CUTS))) if grow.any() else [] for f in range(len(FEATURES))]
        bad_grow = bad[grow]
        if bad_grow.any():  # the bad documents' own quantiles find thresholds of rare kinds
            cuts = [np.union1d(c, np.quantile(x[grow][bad_grow, f], np.linspace(0, 1, CUTS))) for f, c in enumerate(cuts)]
        grown = rule = _grown(x[grow], bad_grow, cuts)
        if not rule:
            break
        if bad[prune].any():
            rule = _pruned(rule, x[prune], bad[prune])
        hit = _covered(x, rule) & left
        if (bad & hit).sum() < LEAST_COVER or (bad & hit).sum() < LEAST_PRECISION * hit.sum():
            aside |= _covered(x, grown) & left
            continue
        rules.append(rule)
        left &= ~hit
    return tuple(rules)


def train(counts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rules:
    """Rules from at most `sample` labelled documents, picked by a hash of the id. Ids labelled
    both ways count as good; null ids and labels are left out. Without labels of both kinds the
    list is empty and keeps everything."""
    import numpy as np

    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").alias("quality")
    )
    order = F.xxhash64("doc_id")
    picked = written(known.withColumn("order", order).orderBy("order", "doc_id").limit(sample).select("doc_id", "quality", "order"))
    # of an id with several texts the least row, so that a rerun learns the same
    least = F.min(F.struct("quality", "order", *(F.expr(SHARES.get(c, c)).alias(c) for c in FEATURES))).alias("least")
    rows = (
        counts.join(F.broadcast(picked), "doc_id")  # at most `sample` ids
        .groupBy("doc_id")
        .agg(least)
        .select("doc_id", "least.quality", F.pmod("least.order", F.lit(3)).alias("fold"), *(f"least.{c}" for c in FEATURES))
        .orderBy("doc_id")
        .collect()
    )
    if not rows:
        return ()
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    return learn_list(x, np.array([r["quality"] == 0 for r in rows]), np.array([r["fold"] for r in rows]))


def verdict(rules: Rules) -> Column:
    """The list as one ordered conditional: the number of the first rule that rejects, else null."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def judge(counts: DataFrame, rules: Rules) -> DataFrame:
    """Rows of quality_counts with base_failed, rule (the first that rejects) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counts.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, COUNTS, base_failed, rule, kept.

    Null and blank texts have no words and fail. Repeated rows are judged alike, an empty table
    gives no rows, extra columns are ignored. Texts are read once; the statistics are written,
    since learning and judging both need them.
    """
    counts = written(quality_counts(docs))
    return judge(counts, train(counts, labels, sample))
