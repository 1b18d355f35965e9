"""Packing by power-of-two decomposition.

A document of n ids becomes n // 4096 pieces of 4096 ids and one piece for each bit set in the
rest, from the largest to the smallest. Each piece is a sequence of its own, so no sequence
crosses documents and none is padded: its length is a power of two. Pieces of one length form
a bucket, and a batch is taken from one bucket.

Tokens are those of the given tokenizer over the whole text. Encoding works chunk by chunk
between ASCII white space, which this tokenizer drops, so known chunks come from a bounded
table and only new ones are encoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import byte_bounded

MAX_LENGTH = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"

#: Entries and bytes of a worker's tables of chunks and of words, keys and values with what Python
#: adds to each entry; beyond either a table starts anew. Longer chunks are encoded each time.
KNOWN_CHUNKS = 1_000_000
KNOWN_WORDS = 1_000_000
CHUNK_BYTES = 160 << 20
WORD_BYTES = 160 << 20
ENTRY_BYTES = 200
LONGEST_KNOWN = 200

#: Texts that are encoded at once, and characters of them; a longer text is cut at white space.
TEXTS, CHARACTERS = 500, 1 << 22

#: A chunk of these letters and then these marks is encoded as two words.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:#*$%&|()-]*)")
SPACE = re.compile(r"[ \n\t\r]")

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, sequence_id long, offset long"
)

_ENCODERS: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.word_end[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Tables without an entry but the empty one."""
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}
        self.chunk_bytes = self.word_bytes = 0

    def _learn_words(self, words: list[str]) -> None:
        import numpy as np

        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(part):  # a mark that is no word of its own: one by one
                found = [self._plainly(word) for word in part]
            else:
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                found = [raw[begin:end] for begin, end in zip([0, *ends], ends)]
            self.words.update(zip(part, found, strict=True))
            self.word_bytes += sum(map(len, part)) + sum(map(len, found)) + ENTRY_BYTES * len(part)

    def _plainly(self, chunk: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that the table does not hold; it takes those that are not very long."""
        known, found, later, unknown = self.words.get, {}, [], set()
        split = PLAIN.fullmatch
        for chunk in chunks:
            parts = split(chunk) if len(chunk) <= LONGEST_KNOWN else None
            if parts is None:
                found[chunk] = self._plainly(chunk)
                continue
            letters, marks = parts.groups()
            letters = letters.lower()
            first, rest = known(letters), known(marks)
            if first is None or rest is None:
                later.append((chunk, letters, marks))
                unknown.update(w for w, ids in ((letters, first), (marks, rest)) if ids is None)
            else:
                found[chunk] = first + rest
        self._learn_words(list(unknown))
        words = self.words
        for chunk, letters, marks in later:
            found[chunk] = words[letters] + words[marks]
        kept = found if max(map(len, found)) <= LONGEST_KNOWN else {c: i for c, i in found.items() if len(c) <= LONGEST_KNOWN}
        self.chunks.update(kept)
        self.chunk_bytes += sum(map(len, kept)) + sum(map(len, kept.values())) + ENTRY_BYTES * len(kept)
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.chunk_bytes > CHUNK_BYTES or len(self.chunks) > KNOWN_CHUNKS:
            self.chunks, self.chunk_bytes = {"": b""}, 0
        if self.word_bytes > WORD_BYTES or len(self.words) > KNOWN_WORDS:
            self.words, self.word_bytes = {"": b""}, 0
        known = self.chunks.get
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        found = [list(map(known, chunks)) for chunks in split]
        gaps, new = [], set()
        for chunks, ids in zip(split, found, strict=True):
            if None in ids:
                holes = [i for i, v in enumerate(ids) if v is None]
                gaps.append((chunks, ids, holes))
                new.update(map(chunks.__getitem__, holes))
        if new:
            learned = self._learn(new)
            for chunks, ids, holes in gaps:
                for i in holes:
                    ids[i] = learned[chunks[i]]
        return [b"".join(ids) for ids in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if sum(map(len, texts)) <= 2 * CHARACTERS:
            return self._encode(texts)
        return [b"".join(ids for part in segments(t) for ids in self._encode([part])) for t in texts]


def segments(text: str, size: int = CHARACTERS) -> Iterator[str]:
    """The text in parts that begin at white space, which the tokenizer drops."""
    at = 0
    while len(text) - at > size:
        space = SPACE.search(text, at + size)
        if not space:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


def grouped(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of some rows at a time: few enough, or one very long text."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for at in range(0, batch.num_rows, TEXTS):
        part = batch.slice(at, TEXTS).to_pydict()
        for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
            if texts and (len(texts) >= TEXTS or size + len(text) > CHARACTERS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def encoder(path: str) -> ChunkEncoder:
    """One for each worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def binary_lengths(n: int, largest: int = MAX_LENGTH) -> list[int]:
    """Full pieces first, then the bits of the rest from high to low."""
    full, rest = divmod(n, largest)
    return [largest] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, max_length: int = MAX_LENGTH, end_id: int = END_ID,
    keep_tables: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, bucket (log2 of the length), sequence_id, offset.

    A null text counts as empty; an empty text gives the end id alone. Repeated rows and null
    ids are documents like any other, extra columns are ignored, an empty table gives no rows.
    sequence_id holds the partition in its upper bits and a running number in its lower 33, so
    it is unique without a pass over all pieces; a recomputed partition gives the same ids.
    One pass, no exchange; a task holds the ids of at most 500 documents and some four million
    characters at a time, or those of one longer document. Without keep_tables a task drops the
    encoder's tables at its end: workers outlive it, and other operators of a session need the memory.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    name = tokenizer

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from pyspark import TaskContext

        known = encoder(name or public_tokenizers.path(TOKENIZER))
        end, number = end_id.to_bytes(4, "little"), TaskContext.get().partitionId() << 33
        try:
            for batch in batches:
                for doc_ids, texts in grouped(batch):
                    rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "bucket")}
                    for doc_id, ids in zip(doc_ids, known.encode(texts), strict=True):
                        ids += end
                        n = len(ids) // 4
                        lengths = binary_lengths(n, max_length)
                        starts = list(accumulate(lengths, initial=0))[:-1]
                        rows["doc_id"] += [doc_id] * len(lengths)
                        rows["start"] += starts
                        rows["length"] += lengths
                        rows["ids"] += [ids[4 * a : 4 * (a + n)] for a, n in zip(starts, lengths, strict=True)]
                        rows["doc_tokens"] += [n] * len(lengths)
                        rows["bucket"] += [n.bit_length() - 1 for n in lengths]
                    made = len(rows["length"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[k], pa.int64()) for k in ("doc_id", "start", "length")]
                        + [pa.array(rows["ids"], pa.binary()), pa.array(rows["doc_tokens"], pa.int64())]
                        + [pa.array(rows["bucket"], pa.int32())]
                        + [pa.array(range(number, number + made), pa.int64()), pa.array([0] * made, pa.int64())],
                        names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"],
                    )
                    number += made
        finally:
            if not keep_tables:
                known.forget()
                pa.default_memory_pool().release_unused()

    byte_bounded(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(pieces, PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Files by bucket, so that a reader takes each batch from sequences of one length."""
    pieces.write.partitionBy("bucket").parquet(path)
