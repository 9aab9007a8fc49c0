"""Benchmark decontamination by a generalised suffix automaton.

The automaton holds all substrings (in words) of the normalised test items. Each training text is streamed
through it once; at every word it knows the longest suffix of what was read that is a substring of an item.
Where that length reaches a window (``window`` words, or all words of a shorter item) the words are hit.

Defined results: a null or empty text has no words and no hits; null items and items without words are skipped;
rows that repeat are judged one by one; further columns of the documents are kept as they are, but for those named
like the operator's own, which it replaces; an item id that occurs on several rows owns the windows of all of them; an
empty benchmark hits nothing, and an empty table gives no rows. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SQL_WORDS, saved, small_batches, table, tidy, words_of

WINDOW = 10
#: Words of test items in one automaton; more items go to further automata, which a task loads one after another.
BLOCK_WORDS = 200_000
#: Bytes of texts that a task holds, where there are several automata, to load each once for all of them.
GROUP_BYTES = 32 << 20
#: A document with a larger share of hit words is dropped whole, others lose only the hit spans.
MAX_COVERAGE = 0.9

_SPELLED = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        numbered = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        for _, ws in numbered:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        #: By (state, length): the items that have that window.
        self.owners: dict[tuple[int, int], set[str]] = {}
        self.lengths = sorted({min(window, len(ws)) for _, ws in numbered})
        for i, ws in numbered:
            k = min(window, len(ws))
            for _, state, matched in self.walk(ws):
                if matched >= k:
                    self.owners.setdefault((self._holder(state, k), k), set()).add(i)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, w, q)
        cur = self._state(self.len[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, w, q)
        return cur

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.len.append(length)
        self.link.append(0)
        self.next.append(moves)
        return len(self.len) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _holder(self, state: int, k: int) -> int:
        """The state of the last k words, when at least k are matched."""
        while self.len[self.link[state]] >= k:
            state = self.link[state]
        return state

    def walk(self, numbers: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matched length) after each word."""
        state = matched = 0
        for at, w in enumerate(numbers):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.len[state]
            if w in self.next[state]:
                state = self.next[state][w]
                matched += 1
            yield at, state, matched

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word spans [start, end), sorted and disjoint, and the items with occurring windows."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.lengths or len(words) < self.lengths[0]:
            return spans, found
        least, number = self.lengths[0], self.vocab.get
        ids = [number(w, -1) for w in words]
        ids.append(-1)
        start = 0
        # A match never spans a word that no item has: only runs of known words are streamed.
        while start < len(words):
            end = ids.index(-1, start)
            if end - start >= least:
                for at, state, matched in self.walk(ids[start:end]):
                    for k in self.lengths:
                        if k > matched:
                            break
                        owners = self.owners.get((self._holder(state, k), k))
                        if owners:
                            found |= owners
                            a, b = start + at + 1 - k, start + at + 1
                            while spans and spans[-1][1] >= a:
                                a = min(a, spans.pop()[0])
                            spans.append((a, b))
            start = end + 1
        return spans, found


def _blocks(benchmark: DataFrame, window: int) -> Iterator[Automaton]:
    """Automata of BLOCK_WORDS words at most (a single longer item has its own); the driver holds one block at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).where("item_id is not null and text is not null")
    for item, text in rows.toLocalIterator():
        ws = words_of(bytes(text))
        if ws and block and held + len(ws) > BLOCK_WORDS:
            yield Automaton(block, window)
            block, held = [], 0
        if ws:
            block.append((item, ws))
            held += len(ws)
    if block:
        yield Automaton(block, window)


class Automata:
    """The automata of a benchmark, sent to the executors. A worker keeps a single one, and of several has one at a time."""

    def __init__(self, benchmark: DataFrame, window: int):
        sc = benchmark.sparkSession.sparkContext
        self.sent = [sc.broadcast(cloudpickle.dumps(a)) for a in _blocks(benchmark, window)]
        self.only: Automaton | None = None

    def __iter__(self) -> Iterator[Automaton]:
        if len(self.sent) == 1:
            self.only = self.only or cloudpickle.loads(self.sent[0].value)
            yield self.only
            return
        for b in self.sent:
            automaton = cloudpickle.loads(b.value)
            b.__dict__.pop("_value", None)  # a worker would keep the bytes of all
            yield automaton

    def find(self, texts: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Hit spans and items of each text, given as words."""
        spans, items = [[] for _ in texts], [set() for _ in texts]
        for automaton in self:
            for row, ws in enumerate(texts):
                s, found = automaton.hits(ws)
                if found:
                    spans[row] = _merged(spans[row] + s)
                    items[row] |= found
        return spans, items

    def groups(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches, with several automata put together up to GROUP_BYTES."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if len(self.sent) < 2 or size > GROUP_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches() if len(held) > 1 else held
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents' columns with n_words, n_hit, spans (hit words, [start, end)) and items (ids, sorted as strings)."""
    automata = Automata(benchmark, window)
    added = T.StructType.fromDDL("n_words long, n_hit long, spans array<struct<start:int,end:int>>, items array<string>")
    docs = docs.drop(*added.names)
    schema = T.StructType([*docs.schema.fields, *added.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in automata.groups(batches):
            split = [words_of(None if t is None else t.encode()) for t in batch.column("text").to_pylist()]
            spans, items = automata.find(split)
            columns = [
                pa.array([len(ws) for ws in split], pa.int64()),
                pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return docs.mapInArrow(tidy(scan), schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw = text.encode()
    places = [m.span() for m in _SPELLED.finditer(raw)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents with the hit spans cut out of ``text`` (``n_chars``, if there, follows), in the same columns.

    A document goes whole if more than ``max_coverage`` of its words are hit. Cutting can join words to a new
    window; so a text is cut until it has none. Untouched documents come out exactly as they went in.
    """
    automata = Automata(benchmark, window)
    schema = docs.schema
    text_at, chars_at = schema.names.index("text"), schema.names.index("n_chars") if "n_chars" in schema.names else None

    def clean(texts: list[str | None]) -> list[str | None]:
        """The texts without hits, None for those that go."""
        out, open_, first = list(texts), [i for i, t in enumerate(texts) if t is not None], True
        while open_:
            split = [words_of(out[i].encode()) for i in open_]
            spans, _ = automata.find(split)
            hit = [(i, s, len(ws)) for i, s, ws in zip(open_, spans, split, strict=True) if s]
            for i, s, n in hit:
                out[i] = None if first and sum(b - a for a, b in s) > max_coverage * n else cut_spans(out[i], s)
            open_, first = [i for i, _, _ in hit if out[i] is not None], False
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in automata.groups(batches):
            texts = batch.column(text_at).to_pylist()
            cleaned = clean(texts)
            keep = [t is None or c is not None for t, c in zip(texts, cleaned, strict=True)]
            columns = list(batch.columns)
            columns[text_at] = pa.array(cleaned, columns[text_at].type)
            if chars_at is not None:
                old = columns[chars_at].to_pylist()
                columns[chars_at] = pa.array([n if c == t else len(c or "") for n, c, t in zip(old, cleaned, texts, strict=True)], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(keep))

    return docs.mapInArrow(tidy(scan), schema)


def op1(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    out = found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
    with small_batches(spark):
        return saved(out, "contamination")


OP1_SQL = f"""
with item as (select cast(item_id as varchar) item_id, {SQL_WORDS} w from benchmark where item_id is not null and text is not null),
win as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') g
        from (select item_id, w, least(10, len(w)) k, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from item where len(w) > 0)),
doc as (select doc_id, {SQL_WORDS} w from documents),
gram as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') g
         from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from doc, (select distinct k from win) where len(w) >= k)),
hit as (select gram.doc_id, gram.i, gram.k, win.item_id from gram join win on gram.k = win.k and gram.g = win.g),
pos as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from (select distinct doc_id, i, k from hit)) group by 1),
ids as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) s from (select distinct doc_id, item_id from hit) group by 1)
select doc.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc left join pos using (doc_id) left join ids using (doc_id)
"""
