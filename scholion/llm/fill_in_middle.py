"""Fill-in-the-middle transformation with a compressed set of boundaries.

A text is cut at two token boundaries into prefix, middle and suffix. The boundaries of a text
are a set of code-point positions in containers of 65,536 positions each: a sorted array where
few are set, a bitmap where many are, runs where they are neighbours. Cumulative cardinalities
over the containers find the one that holds the k-th boundary, a select inside it gives the
position. A container is made from its own slice of the text, so a very long text is never
widened as a whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import byte_bounded, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Positions of one container.
SPAN = 1 << 16
#: An array of more values than this is larger than a bitmap.
ARRAY_MOST = 4096

TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class ArrayContainer:
    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """Bits in words of 64; counts before each word lead to the word, a scan to the bit."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[values] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words).astype(np.int64))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, "right"))
        k -= int(self.upto[at - 1]) if at else 0
        word = int(self.words[at])
        for _ in range(k):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.upto = np.cumsum(lengths)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, "right"))
        return int(self.starts[at]) + k - (int(self.upto[at - 1]) if at else 0)


Container = ArrayContainer | BitmapContainer | RunContainer


def container(values: np.ndarray) -> Container:
    """The smallest container of ascending positions below SPAN."""
    starts = np.flatnonzero(np.diff(values, prepend=-2) > 1)
    # bytes: four for a run, two for a value, one for eight positions
    if 4 * len(starts) < min(2 * len(values), SPAN // 8):
        return RunContainer(values[starts], np.diff(starts, append=len(values)))
    return ArrayContainer(values) if len(values) <= ARRAY_MOST else BitmapContainer(values)


class BoundarySet:
    """Ascending positions, added slice by slice."""

    def __init__(self) -> None:
        self.bases: list[int] = []
        self.containers: list[Container] = []
        self.upto: list[int] = []

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def add(self, base: int, values: np.ndarray) -> None:
        """Positions relative to ``base``, which is a multiple of SPAN above all before."""
        if len(values):
            self.upto.append(len(self) + len(values))
            self.bases.append(base)
            self.containers.append(container(values))

    def select(self, k: int) -> int:
        """The k-th position, from 0."""
        at = bisect_right(self.upto, k)
        return self.bases[at] + self.containers[at].select(k - (self.upto[at - 1] if at else 0))


def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))


def token_ends(text: str) -> BoundarySet:
    """Positions of the last code point of each token: a word with the white space before it,
    or the white space at the end of the text."""
    ends = BoundarySet()
    for base in range(0, len(text), SPAN):
        # one more code point tells whether the last one ends a word
        part = text[base : base + SPAN + 1]
        space = is_space(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4"))
        if base + SPAN >= len(text):
            # nothing follows: a word ends here, and so does white space
            last = ~space & np.append(space[1:], True)
            last[-1] = True
            ends.add(base, np.flatnonzero(last))
        else:
            ends.add(base, np.flatnonzero(~space[:-1] & space[1:]))
    return ends


def character_ends(text: str) -> BoundarySet:
    """Every position: one run for each slice."""
    ends = BoundarySet()
    for base in range(0, len(text), SPAN):
        ends.add(base, np.arange(min(SPAN, len(text) - base)))
    return ends


UNITS = {"token": token_ends, "character": character_ends}


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers that depend on the id and the seed alone; a null id counts as 'null'."""
    name = "null" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(
    doc_id: int | None, text: str, seed: int, transformed_percent: int, spm_percent: int, unit: str
) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    ends = UNITS[unit](text)
    n = len(ends)
    first, second, chance, order = draws(doc_id, seed)
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not text or marked or chance % 100 >= transformed_percent:
        return n, PLAIN, None, None, text
    cuts = sorted((first % (n + 1), second % (n + 1)))
    a, b = (ends.select(k - 1) + 1 if k else 0 for k in cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < spm_percent:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, seed: int = 42, transformed_percent: int = 50, spm_percent: int = 80, unit: str = "token"
) -> DataFrame:
    """One row per document: doc_id, n (units of the text), form (plain, psm, spm), prefix_chars,
    middle_chars (null if plain), output.

    A null text counts as empty; an empty text and one that holds a marker stay plain. Cuts
    depend on the id and the seed alone, so rows that repeat an id and a text give equal rows, and
    a lost task gives the same rows again. Extra columns are ignored, an empty table gives no
    rows. One pass, no exchange; a task holds some texts of a bounded batch at a time.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 100):
            ids = part.column("doc_id").to_pylist()
            texts = part.column("text").to_pylist()
            made = [transform(i, t, seed, transformed_percent, spm_percent, unit) for i, t in zip(ids, texts, strict=True)]
            n, form, prefix, middle, output = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    byte_bounded(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(run, TRANSFORMED)


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone. No piece holds a marker, and a marker
    cannot arise where pieces meet, so splitting at the markers is exact."""
    piece = lambda i: F.get(F.split(output, "<[PSM]>", -1), F.lit(i))
    return (
        F.when(form == PSM, F.concat(piece(1), piece(3), piece(2)))
        .when(form == SPM, F.concat(piece(2), piece(3), piece(1)))
        .otherwise(output)
    )
