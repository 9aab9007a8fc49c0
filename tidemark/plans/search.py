"""Search queries as column expressions, scored where they match text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import saved

#: BM25 as published.
K1, B = 1.2, 0.75


def tokens(text: Column, pattern: str = r"[^\p{L}\p{N}]+") -> Column:
    """Lower-case words of a text, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), pattern), lambda w: w != "")


def _holds(c: Column, multi: bool, test) -> Column:
    return F.exists(c, test) if multi else test(c)


@dataclass(frozen=True)
class MatchAll:
    def predicate(self, index) -> Column:
        return F.lit(True)


#: A query that asks for nothing finds everything.
Empty = MatchAll


@dataclass(frozen=True)
class Term:
    """Whole value, case counts; a multi-valued field matches if any of its values does."""

    field: str
    value: str | float

    def predicate(self, index) -> Column:
        f = index.field(self.field)
        return F.coalesce(F.array_contains(f.name, self.value) if f.multi else F.col(f.name) == F.lit(self.value), F.lit(False))


@dataclass(frozen=True)
class TermInSet:
    """Any of some values; an empty set is an error."""

    field: str
    values: Sequence[str]

    def __post_init__(self) -> None:
        if not self.values:
            raise ValueError(f"a set of terms for '{self.field}' needs at least one")

    def predicate(self, index) -> Column:
        f = index.field(self.field)
        return F.coalesce(_holds(F.col(f.name), f.multi, lambda c: c.isin(list(self.values))), F.lit(False))


@dataclass(frozen=True)
class Match:
    """Any word of a text, analysed like the field. Only fields declared for search can be matched."""

    field: str
    text: str
    pattern: str = r"[^\p{L}\p{N}]+"

    def predicate(self, index) -> Column:
        f = index.field(self.field)
        if f.type != "TEXT" or not f.search:
            raise ValueError(f"field '{self.field}' isn't declared for text search")
        return F.arrays_overlap(tokens(F.col(f.name), self.pattern), tokens(F.lit(self.text), self.pattern))


@dataclass(frozen=True)
class Page:
    total: int
    hits: DataFrame


def bm25(docs: DataFrame, key: str, text: str, query: str, pattern: str = r"[^\p{L}\p{N}]+") -> DataFrame:
    """key and score of the documents that hold a word of the query.

    One pass over the texts counts the query's words in each document without exploding it; lengths and document
    frequencies, a number for each distinct word of the query, are summed from its counts.
    """
    asked = sorted({w for w in _analyse(docs, query, pattern)})
    if not asked:
        return docs.select(key, F.lit(0.0).alias("score")).limit(0)
    words = docs.select(key, tokens(F.col(text), pattern).alias("_w"))
    tf = [_times("_w", q).alias(f"_tf{i}") for i, q in enumerate(asked)]
    counted = saved(words.select(key, F.size("_w").alias("_len"), *tf), "term-counts")  # numbers only, read twice
    sums = counted.agg(F.count("*").alias("n"), F.avg("_len").alias("mean"), *[F.sum((F.col(f"_tf{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(asked))])
    scored = counted.crossJoin(F.broadcast(sums))  # one row
    norm = F.lit(K1) * (1 - B + B * F.col("_len") / F.col("mean"))
    score: Column = F.lit(0.0)
    for i in range(len(asked)):
        df, t = F.col(f"df{i}"), F.col(f"_tf{i}")
        score = score + F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)) * t * (K1 + 1) / (t + norm)
    hit = F.greatest(*[F.col(f"_tf{i}") for i in range(len(asked))], F.lit(0)) > 0
    return scored.where(hit).select(key, score.alias("score"))


def _times(words: str, asked: str) -> Column:
    return F.size(F.filter(words, lambda w: w == F.lit(asked)))


def _analyse(docs: DataFrame, query: str, pattern: str) -> list[str]:
    return docs.sparkSession.range(1).select(tokens(F.lit(query), pattern).alias("w")).first()["w"]


def search(index, query, start: int = 0, top: int = 10, fields: Sequence[str] | None = None) -> Page:
    """Hits ``start`` to ``top`` by falling score and then by id, with the asked-for stored fields, and the number of all hits."""
    schema, table = index.schema, index.table()
    hits = table.where(query.predicate(schema))
    names = list(fields) if fields is not None else [f.name for f in schema.fields if f.store]
    for n in names:
        if not schema.field(n).store:
            raise ValueError(f"field '{n}' isn't stored")
    if isinstance(query, Match):
        hits = hits.join(bm25(table, "_id", query.field, query.text, query.pattern), "_id")
    else:
        hits = hits.withColumn("score", F.lit(1.0))
    page = hits.orderBy(F.desc("score"), "_id").offset(start).limit(max(0, top - start))
    return Page(hits.count(), page.select("_id", "score", *[n for n in names if n != "_id"]))


def rendered(c: Column) -> Column:
    """A field's value as shown to a reader."""
    return c.cast("string")


def term_set_join(docs: DataFrame, terms: DataFrame, field: str) -> DataFrame:
    """Documents whose field is among the values of a table (column of the same name); for sets too long to write down."""
    return docs.join(terms.select(field).distinct(), field, "left_semi")
