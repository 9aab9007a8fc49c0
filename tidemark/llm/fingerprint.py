"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the k smallest of the 64-bit hashes of a text's distinct five-word shingles (all of them if fewer).
Sketches of parts merge into the sketch of the whole, and any two estimate resemblance (Jaccard), containment and the
number of distinct shingles; all three are exact while the sketches involved hold every shingle.

Defined results: null counts as empty; a text of fewer than five words has one shingle of all its words, one without
words has none; texts of any length are sketched whole; equal hashes count once; two texts without words resemble each
other fully, one without and one with words not at all; rows that repeat have equal fingerprints, and of rows with one
doc_id that with the lesser text comes first; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_id_ranges, id_cuts, range_number, shuffle_width, table, text_batches, tidy, words_of

K, SHINGLE = 128, 5
#: Words whose hashes a worker keeps at most: the first it meets, among them all common ones.
KNOWN_WORDS = 300_000
ROWS = 500
_MUL = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of each word, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(self) < KNOWN_WORDS:
            self[word] = h
        return h


def shingle_hashes(words: list[bytes], known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """A hash for each run of ``size`` words; for fewer words one hash, for none no hash."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.array(list(map(known.__getitem__, words)), np.uint64)
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, np.uint64(n), np.uint64)
        for i in range(n):
            h = h * _MUL + w[i : len(w) - n + 1 + i]
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ h >> np.uint64(31)


class Sketch:
    """The ``k`` smallest hashes, in order."""

    __slots__ = ("hashes", "k")

    def __init__(self, hashes: np.ndarray, k: int = K):
        if len(hashes) > 8 * k:
            low = np.unique(np.partition(hashes, 4 * k)[: 4 * k])
            hashes = low if len(low) >= k else hashes
        self.hashes, self.k = np.unique(hashes)[:k], k

    @classmethod
    def of(cls, text: bytes, known: WordHashes, k: int = K) -> Sketch:
        return cls(shingle_hashes(words_of(text), known), k)

    @classmethod
    def read(cls, said: str) -> Sketch:
        k, _, data = said.partition(":")
        return cls(np.frombuffer(base64.b64decode(data), "<u8").astype(np.uint64), int(k))

    def __str__(self) -> str:
        return f"{self.k}:{base64.b64encode(self.hashes.astype('<u8').tobytes()).decode()}"

    def merge(self, *others: Sketch) -> Sketch:
        return Sketch(np.concatenate([self.hashes, *(o.hashes for o in others)]), min([self.k, *(o.k for o in others)]))

    def distinct(self) -> float:
        """Number of distinct shingles."""
        if len(self.hashes) < self.k:
            return float(len(self.hashes))
        return (self.k - 1) / (float(self.hashes[-1]) / 2**64)

    def _shared(self, other: Sketch) -> tuple[int, int]:
        union = self.merge(other).hashes
        return int(np.isin(union, self.hashes[np.isin(self.hashes, other.hashes)]).sum()), len(union)

    def resemblance(self, other: Sketch) -> float:
        both, n = self._shared(other)
        return both / n if n else 1.0

    def containment(self, other: Sketch) -> float:
        """Share of this text's shingles that the other has."""
        mine = self.distinct()
        return min(1.0, self.resemblance(other) * self.merge(other).distinct() / mine) if mine else 1.0


def merged(sketches: Iterable[str]) -> str:
    found = [Sketch.read(s) for s in sketches]
    return str(found[0].merge(*found[1:]))


def merge_fingerprints(rows: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """One sketch for each value of ``by``. Tasks merge what they hold first, so a hot value sends a sketch a task and not its rows."""
    kind = rows.schema[by].dataType.simpleString()
    schema = f"`{by}` {kind}, fingerprint string"

    def partial(batches):
        held: dict = {}
        for batch in batches:
            for value, said in zip(batch.column(by).to_pylist(), batch.column(fingerprint).to_pylist(), strict=True):
                if said is not None:
                    held[value] = merged([held[value], said]) if value in held else said
            if len(held) > 10_000:
                yield pa.RecordBatch.from_pylist([{by: v, "fingerprint": s} for v, s in held.items()], schema=made)
                held = {}
        yield pa.RecordBatch.from_pylist([{by: v, "fingerprint": s} for v, s in held.items()], schema=made)

    def final(group):
        return pa.Table.from_pylist([{by: group.column(by)[0].as_py(), "fingerprint": merged(group.column("fingerprint").to_pylist())}], schema=made)

    from pyspark.sql.pandas.types import to_arrow_schema

    made = to_arrow_schema(rows.select(by, F.lit("").alias("fingerprint")).schema)
    return rows.select(by, fingerprint).mapInArrow(partial, schema).groupBy(by).applyInArrow(final, schema)


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, fingerprint of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                said = [str(Sketch.of(t.encode(), known, k)) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(said)], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(make), "doc_id long, n_chars long, fingerprint string")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Documents in ranges of doc_id, highest first within each, and after them, marked _head, the first document of what follows.

    doc_ids are read alone first: they give the ranges and each range's highest id. So texts are shuffled once, and the
    only ones that travel twice are a range's first.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    cuts = id_cuts(docs, "doc_id", parts or shuffle_width(docs))
    part = range_number(F.col("doc_id"), cuts)
    tops = sorted(docs.groupBy(part.alias("part")).agg(F.max("doc_id")).collect())  # a row for each range
    order = [p for p, _ in tops]
    top = F.from_json(F.lit("[" + ",".join(str(dict(tops).get(p)).replace("None", "null") for p in range(len(cuts) + 1)) + "]"), "array<bigint>")
    # What follows range p, going down, is the next lower one; after the lowest comes the highest.
    before = {p: order[(i + 1) % len(order)] for i, p in enumerate(order)}
    to = F.from_json(F.lit("[" + ",".join(str(before.get(p, 0)) for p in range(len(cuts) + 1)) + "]"), "array<int>")
    first = F.col("doc_id").eqNullSafe(F.element_at(top, part + 1))
    own = F.struct(part.alias("_part"), F.lit(False).alias("_head"))
    sent = F.when(first, F.array(own, F.struct(F.element_at(to, part + 1).alias("_part"), F.lit(True).alias("_head")))).otherwise(F.array(own))
    rows = docs.select("doc_id", "text", F.explode(sent).alias("_to")).select("doc_id", "text", "_to.*")
    dealt = rows.repartitionById(len(cuts) + 1, F.col("_part"))
    return dealt.sortWithinPartitions("_head", F.col("doc_id").desc_nulls_last(), "text").select("doc_id", "text", "_head")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike they and the next document's are."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        out: list[tuple] = []
        last: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                for doc_id, text, head in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    if head and last is None:
                        continue
                    text = text or ""
                    sketch = Sketch.of(text.encode(), known, k)
                    if last is not None:
                        i, before, mine = last
                        changed = edited(before, text).encode()
                        other = Sketch.of(changed, known, k)
                        out.append((i, len(before), hashlib.sha256(changed).hexdigest(), str(mine), str(other), mine.resemblance(other), mine.resemblance(sketch)))
                    last = None if head else (doc_id, text, sketch)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out = []

    return with_next(docs).mapInArrow(tidy(make), schema)


def op5(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(table(text_batches(spark), sf_dir, "documents"))
