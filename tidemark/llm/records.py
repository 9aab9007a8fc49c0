"""Token ids in length-delimited binary records, with an offset index beside them.

One record frames one sequence::

    length of the body, 16 hex digits | masked crc of these digits, 8 hex digits | body | masked crc of the body, 8 hex digits | 0x0A

A masked crc is ((crc >> 15 | crc << 17) + 0xA282EAD8) mod 2**32 of the unsigned crc32. The body is the payload with
0x1B written as 0x1B 0x01 and 0x0A as 0x1B 0x02, so a line feed ends a record and stands nowhere else: files can be read
by length, by offset, or in parts of any size by whatever splits text at line feeds, as Spark does. The payload is, in
little-endian numbers: int64 id | uint8 flags (1: the id is null; 2: ids take 2 bytes, else 4) | uint64 ids before it in
its shard | uint64 byte offset of the record in its shard | the token ids.

Records stand in ascending id order through shards (null ids first, then equal ids by text). Shard i is the file whose
name begins with ``part-`` and the number i; the index has a row for each record: shard, id, byte offset, byte length.
Each shard ends in a footer, a frame whose length has its highest bit set: its number, the number of shards, and its
records, ids and bytes before the footer, as decimal text. Readers hold every shard against its footer before they return
a row, so a lost file, a tail cut off or a record taken out is an error and never a shorter result. ``RecordFiles`` takes
index rows in any order and fetches ``length`` bytes at ``offset``, and walks a shard by its lengths. Spark's text writer
commits whole files on any file system, so a lost executor leaves no half of one.

Texts are encoded by the tokenizer's own pieces where its file says that it works by the rules that ``PieceEncoder``
knows; by any other tokenizer they are encoded whole.

Defined results: null texts count as empty; an empty text has the end id only; texts of any length are one record; rows
that repeat are written as often as they occur; an empty table has no records; further columns are not written.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_id_ranges, fresh_path, id_cuts, shuffle_width, small_batches, table, tidy

END_ID = 2
MASK = 0xA282EAD8
#: Pieces of text whose ids a worker keeps at most: the first it meets, among them all common ones.
KNOWN_PIECES = 200_000
#: Rows that go to a worker at a time.
ROWS = 500


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


#: Bit of a length that marks a footer.
FOOTER = 1 << 63


def frame(payload: bytes, mark: int = 0) -> bytes:
    """A record, with its line feed."""
    body = payload.replace(b"\x1b", b"\x1b\x01").replace(b"\n", b"\x1b\x02")
    head = b"%016x" % (len(body) | mark)
    return b"%b%08x%b%08x\n" % (head, masked_crc(head), body, masked_crc(body))


def length_of(head: bytes, at: int = 0) -> tuple[int, bool]:
    """Bytes of a body, and whether it is a footer's, from a frame's first 24 bytes."""
    if len(head) < 24 or head[16:24] != b"%08x" % masked_crc(head[:16]):
        raise ValueError(f"damaged length at byte {at}")
    n = int(head[:16], 16)
    return n & ~FOOTER, bool(n & FOOTER)


def unframe(record: bytes) -> bytes:
    """The payload of one record, without or with its line feed; raises ValueError if it is cut off or damaged."""
    n, _ = length_of(record[:24])
    body, rest = record[24 : 24 + n], record[24 + n :].removesuffix(b"\n")
    if len(body) != n or rest != b"%08x" % masked_crc(body):
        raise ValueError("damaged body")
    return body.replace(b"\x1b\x02", b"\n").replace(b"\x1b\x01", b"\x1b")


def read_frames(file: BinaryIO) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, payload, whether it is a footer) of each frame of a file, going by lengths; holds one at a time."""
    at = 0
    while head := file.read(24):
        n, footer = length_of(head, at)
        rest = file.read(n + 9)
        if rest[-1:] != b"\n":
            raise ValueError(f"damaged end of the record at byte {at}")
        yield at, unframe(head + rest), footer
        at += 24 + n + 9


def frames(data: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each frame from a byte on."""
    for offset, payload, _ in read_frames(io.BytesIO(data[at:])):
        yield at + offset, payload


_HEAD, _HEAD_BYTES = "<qBQQ", 25


def payload_of(doc_id: int | None, ids: bytes, width: int, before: int = 0, offset: int = 0) -> bytes:
    return struct.pack(_HEAD, doc_id or 0, (doc_id is None) | (width == 2) << 1, before, offset) + ids


def read_payload(payload: bytes) -> tuple[int | None, np.ndarray, int, int]:
    """id, token ids, ids before it, offset."""
    doc_id, flags, before, offset = struct.unpack_from(_HEAD, payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, "<u2" if flags & 2 else "<u4", offset=_HEAD_BYTES), before, offset


# What a tokenizer file says of the rules that PieceEncoder cuts by.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECE_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PIECE_PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "truncation": None, "padding": None,
}


def _plain_text() -> tuple[re.Pattern, re.Pattern]:
    """Texts whose pieces this module cuts itself, and those pieces: ASCII and the Latin letters up to U+017E.

    There NFC changes nothing and every letter has a lower case of its own, so str.lower() is the tokenizer's.
    """
    chars = [chr(c) for c in (*range(33, 127), *range(0xA1, 0x17F)) if c not in (0xAD, 0x130, 0x149)]
    kind = {k: re.escape("".join(c for c in chars if unicodedata.category(c)[0] == k)) for k in "LN"}
    plain = re.compile(f"[\\t\\n\\r {re.escape(''.join(chars))}]*")
    return plain, re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kind['L']}]+|[{kind['N']}]|[^\\s{kind['L']}{kind['N']}]+")


class PieceEncoder:
    """Encodes texts as a tokenizer file says, keeping the ids of pieces it has met where the file has PIECE_RULES and a BPE model.

    Then plain texts are cut into pieces here and each new piece goes to the tokenizer's model. In other texts this holds
    for each plain chunk between blanks and line feeds, across which no piece goes; other chunks go to the tokenizer
    whole, and so do texts that spell an added token, and all texts where the file has other rules. Tests compare the ids
    with the tokenizer's.
    """

    def __init__(self, path: str):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        added = said.get("added_tokens") or []
        self.special = tuple(t["content"] for t in added)
        self.by_pieces = all(said.get(k) == v for k, v in PIECE_RULES.items()) and said["model"].get("type") == "BPE"
        self.by_pieces &= not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self.plain, self.pieces = _plain_text()
        whole = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.spelling = {b: b if b in whole else next(others) for b in range(256)}  # byte-level BPE's letters for bytes
        self.known: dict[str, bytes] = {}

    def _learn(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
        ids = np.array([t.id for t in self.model.tokenize(spelled)], self.kind).tobytes()
        if len(self.known) < KNOWN_PIECES:
            self.known[piece] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _cut(self, text: str) -> bytes:
        known, learn = self.known.get, self._learn
        return b"".join([known(p) or learn(p) for p in self.pieces.findall(text.lower())])

    def encode(self, text: str) -> bytes:
        if not self.by_pieces or any(s in text for s in self.special):
            return self._whole(text)
        if self.plain.fullmatch(text):
            return self._cut(text)
        return b"".join([self._cut(c) if self.plain.fullmatch(c) else self._whole(c) for c in text.replace("\n", " ").split(" ")])


#: The encoder that this worker process had last: its tasks share what it has learned of pieces.
_LATEST: dict[tuple, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    key = (path, os.stat(path).st_mtime_ns, os.stat(path).st_size)
    if key not in _LATEST:
        _LATEST.clear()
        _LATEST[key] = PieceEncoder(path)
    return _LATEST[key]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shards: int | None = None) -> int:
    """Writes the ids of every document's text to ``path``, a shard for each range of doc_id; returns the number of shards."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shards = shards or shuffle_width(docs)
    cuts = id_cuts(docs, "doc_id", shards)
    made = max(1, min(shards, len(cuts) + 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.kind).tobytes()
        number = before = offset = 0  # a partition is a shard
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder.encode(text or "") + end
                record = frame(payload_of(doc_id, ids, encoder.width, before, offset))
                number, before, offset = number + 1, before + len(ids) // encoder.width, offset + len(record)
                out.append(record[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
        footer = b"%d %d %d %d %d" % (TaskContext.get().partitionId(), made, number, before, offset)
        yield pa.RecordBatch.from_arrays([pa.array([frame(footer, FOOTER)[:-1]], pa.binary())], names=["record"])

    dealt = by_id_ranges(docs, "doc_id", shards, cuts).sortWithinPartitions("_part", F.col("doc_id").asc_nulls_first(), "text")
    records = dealt.select("doc_id", "text").mapInArrow(tidy(encode), "record binary")
    # The cast keeps the bytes as they are; the writer adds the line feed.
    with small_batches(docs.sparkSession, ROWS):
        records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)
    return made


INDEX = "shard int, doc_id long, before long, offset long, length long, n_tokens long, ids_crc32 long"


def _lines(spark, path: str) -> DataFrame:
    """shard, block (where the part of the file begins that a task reads), value, footer: a row for each frame."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "part-*").text(path)
    shard = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("shard")
    # The length of a footer, in hexadecimal, begins with an 8; no other is that long.
    return lines.select(shard, F.col("_metadata.file_block_start").alias("block"), "value", F.startswith("value", F.lit("8")).alias("footer"))


def checked_shards(spark, path: str) -> dict[int, int]:
    """The number of ids of each shard under ``path``; raises ValueError unless all shards are there whole, as their footers say."""
    lines = _lines(spark, path)
    size = F.octet_length("value").cast("long") + 1
    record = ~F.col("footer")
    sums = lines.groupBy("shard").agg(
        F.count(F.when(record, 1)).alias("records"), F.coalesce(F.sum(F.when(record, size)), F.lit(0)).alias("bytes"),
        F.count(F.when(F.col("footer"), 1)).alias("footers"), F.max(F.when(F.col("footer"), F.col("value").cast("binary"))).alias("said"),
    ).collect()
    found: dict[int, int] = {}
    shards = set()
    for r in sums:
        if r["footers"] != 1:
            raise ValueError(f"shard {r['shard']} has lost its end")
        shard, of, records, ids, size = map(int, unframe(bytes(r["said"])).split())
        if (shard, records, size) != (r["shard"], r["records"], r["bytes"]):
            raise ValueError(f"shard {r['shard']} has {r['records']} records in {r['bytes']} bytes, not {records} in {size}")
        found[shard] = ids
        shards.add(of)
    if len(shards) > 1 or shards and set(found) != set(range(shards.pop())):
        raise ValueError(f"shards are missing under {path}: there are {sorted(found)}")
    return found


def read_records(spark, path: str, with_ids: bool = False) -> DataFrame:
    """A row for each record: shard, doc_id, ids before it in the shard, byte offset and length, n_tokens, ids_crc32
    (of the ids as uint32), and the ids if asked for. Holds all shards against their footers first; reading the rows checks
    all checksums, and that records follow one another."""
    checked_shards(spark, path)
    return _records(spark, path, with_ids)


def _records(spark, path: str, with_ids: bool = False) -> DataFrame:
    kept = INDEX + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in kept.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = ()
        for batch in batches:
            rows = []
            for shard, block, record in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                doc_id, ids, before, offset = read_payload(unframe(record))
                if last[:2] == (shard, block) and last[2] != offset:
                    raise ValueError(f"shard {shard} lacks bytes {last[2]} to {offset}")
                length = len(record) + 1
                last = shard, block, offset + length
                rows.append((shard, doc_id, before, offset, length, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *([ids.tolist()] if with_ids else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    lines = _lines(spark, path).where(~F.col("footer"))
    return lines.select("shard", "block", F.col("value").cast("binary").alias("record")).mapInArrow(tidy(parse), kept)


class RecordFiles:
    """Records of a folder by their places, for shuffled reads, and shards in order; for trainers, without Spark."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.files, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        listed = self.files.get_file_info(fs.FileSelector(folder))
        self.paths = {int(m[1]): f.path for f in listed if (m := re.match(r"part-(\d+)", f.base_name))}

    def at(self, shard: int, offset: int, length: int) -> tuple[int | None, np.ndarray]:
        """id and token ids of the record that the index places there."""
        with self.files.open_input_file(self.paths[shard]) as file:
            data = file.read_at(length, offset)
        doc_id, ids, _, placed = read_payload(unframe(data))
        if placed != offset or len(data) != length:
            raise ValueError(f"shard {shard} has no record of {length} bytes at byte {offset}")
        return doc_id, ids

    def shard(self, number: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """All records of a shard, by their lengths; raises ValueError at its end if one is missing."""
        seen = 0
        with self.files.open_input_stream(self.paths[number]) as file:
            for _, payload, footer in read_frames(file):
                if footer:
                    if int(payload.split()[2]) != seen:
                        raise ValueError(f"shard {number} has {seen} records, not {int(payload.split()[2])}")
                    return
                seen += 1
                yield read_payload(payload)[:2]
        raise ValueError(f"shard {number} has lost its end")


def token_records(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes records and index under ``path`` (else the shared folder), reads them back and returns a row for each record:
    doc_id, start (ids before it, in record order), n_tokens, ids_crc32, shard, offset, length."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "records")
    write_records(docs, f"{path}/data", tokenizer, end_id)
    said = checked_shards(spark, f"{path}/data")
    with small_batches(spark, ROWS):
        _records(spark, f"{path}/data").write.parquet(f"{path}/index")
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    # The driver gets a sum for each shard, and sends back as many numbers.
    read = dict(index.groupBy("shard").agg(F.sum("n_tokens")).collect())
    if any(read.get(shard, 0) != n for shard, n in said.items()):
        raise ValueError(f"shards under {path} have other numbers of ids than their footers say")
    starts, before = [], 0
    for shard, n in sorted(said.items()):
        starts.append((shard, before))
        before += n
    base = spark.createDataFrame(starts, "shard int, _base long")
    return index.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("before") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset", "length"
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8(spark, sf_dir: str, tokenizer: Callable[[], str] = default_tokenizer) -> DataFrame:
    return token_records(table(spark, sf_dir, "documents"), tokenizer())
