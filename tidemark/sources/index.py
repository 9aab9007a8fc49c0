"""Indexes: document tables with declared fields, kept as versions on any file system that Hadoop reaches.

A version is a base and the deltas since: each write adds one delta, as large as the batch and not as the index, and
readers fold the deltas over the base. Deltas are merged into a new base when they have grown to MERGE_SHARE of it or to
MERGE_DELTAS, so a document is rewritten some few times in all. A version is published by one atomic rename of a small
pointer file; readers follow the newest pointer, so they see a version whole or not at all. A pointer carries the ids of
the batches that made it, and a batch that was published is not applied again.

Operations of a source keep their order (snapshot and sequence number, say) with the document they leave, deletions too:
an older operation that comes in a later batch changes nothing. Where another source wrote a document, or a write
without an order, what comes later counts.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changelog import ADD, DELETE, appended, fold
from ..plans.document import DOC_TYPE

TYPES = ("_ID", "ATOM", "TEXT", "DOUBLE")
MERGE_SHARE, MERGE_DELTAS = 0.5, 16
#: Rows of bases and deltas; ``at`` is null where a write had no order, and a row whose ``op`` is a deletion says that the id is gone.
ROWS = "op string, _id string, doc map<string,array<string>>, at array<bigint>, source string"


#: Kinds of deltas without an order: by id, and without ids.
MERGE, APPEND = "merge", "append"


def _number(c: Column, kind: T.DataType) -> Column:
    """A column of an order as a number that compares alike."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if not isinstance(kind, (T.IntegralType, T.DateType)):
        raise ValueError(f"operations are ordered by whole numbers or times, not by {kind.simpleString()}")
    return F.unix_date(c).cast("bigint") if isinstance(kind, T.DateType) else c.cast("bigint")


class MissingIndex(RuntimeError):
    """Documents came for an index that doesn't exist yet."""

    def __init__(self, name: str):
        super().__init__(f"index '{name}' does not exist, or isn't started")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    search: bool = False
    store: bool = True
    doc_values: bool = False
    multi: bool = False

    def __post_init__(self) -> None:
        if self.type not in TYPES:
            raise ValueError(f"field '{self.name}' is of unknown type '{self.type}'; there are {', '.join(TYPES)}")

    def column(self, doc: Column) -> Column:
        """The field's value in a document: text or number, an array of them if it is multi-valued."""
        values = F.try_element_at(doc, F.lit(self.name))
        if self.type == "DOUBLE":
            values = F.transform(values, lambda v: v.try_cast("double"))
        return values if self.multi else F.get(values, F.lit(0))


@dataclass(frozen=True)
class IndexSchema:
    fields: list[Field] = field(default_factory=list)

    @property
    def id_field(self) -> str | None:
        return next((f.name for f in self.fields if f.type == "_ID"), None)

    def field(self, name: str) -> Field:
        found = next((f for f in self.fields if f.name == name), None)
        if found is None:
            raise KeyError(f"the index has no field '{name}'")
        return found

    def typed(self, docs: DataFrame) -> DataFrame:
        """Documents (_id, doc) as a table with a column for each declared field."""
        return docs.select("_id", *[f.column(F.col("doc")).alias(f.name) for f in self.fields if f.name != "_id"])


class IndexCatalog:
    """Indexes below a folder: created, given fields, started, then written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _write(self, path, text: str) -> None:
        out = self._fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read(self, path) -> str:
        source = self._fs.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        finally:
            source.close()

    def _meta(self, name: str) -> dict:
        if not self._fs.exists(self._path(name, "meta.json")):
            raise MissingIndex(name)
        return json.loads(self._read(self._path(name, "meta.json")))

    def create(self, name: str) -> None:
        if self._fs.exists(self._path(name, "meta.json")):
            raise ValueError(f"index '{name}' exists")
        self._write(self._path(name, "meta.json"), json.dumps({"fields": [], "started": False}))

    def register(self, name: str, fields: Sequence[Field]) -> None:
        """Adds fields; a name that is there is refused, and so is a second _ID."""
        meta = self._meta(name)
        known = {f["name"] for f in meta["fields"]}
        for f in fields:
            if f.name in known:
                raise ValueError(f"index '{name}' has a field '{f.name}'")
            known.add(f.name)
        made = [*meta["fields"], *map(asdict, fields)]
        if sum(f["type"] == "_ID" for f in made) > 1:
            raise ValueError(f"index '{name}' can have one _ID field")
        self._write(self._path(name, "meta.json"), json.dumps(meta | {"fields": made}))

    def start(self, name: str) -> IndexTable:
        meta = self._meta(name)
        self._write(self._path(name, "meta.json"), json.dumps(meta | {"started": True}))
        return IndexTable(self, name)

    def open(self, name: str) -> IndexTable:
        if not self._meta(name)["started"]:
            raise MissingIndex(name)
        return IndexTable(self, name)


class IndexTable:
    """A started index."""

    def __init__(self, catalog: IndexCatalog, name: str):
        self.catalog, self.name, self.spark = catalog, name, catalog.spark
        self.schema = IndexSchema([Field(**f) for f in catalog._meta(name)["fields"]])

    @property
    def version(self) -> int:
        """Number of the newest version, 0 before the first write."""
        folder = self.catalog._path(self.name)
        found = [re.fullmatch(r"current-(\d+)\.json", s.getPath().getName()) for s in self.catalog._fs.listStatus(folder)]
        return max((int(m[1]) for m in found if m), default=0)

    def _pointer(self, version: int) -> dict:
        if not version:
            return {"applied": {}, "base": None, "deltas": []}
        return json.loads(self.catalog._read(self.catalog._path(self.name, f"current-{version}.json")))

    def _read(self, path: str | None) -> DataFrame:
        reader = self.spark.read.schema(ROWS)
        return reader.parquet(f"{self.catalog.root}/{self.name}/{path}") if path else self.spark.createDataFrame([], ROWS)

    def _bytes(self, path: str | None) -> int:
        return self.catalog._fs.getContentSummary(self.catalog._path(self.name, path)).getLength() if path else 0

    def _folded(self, pointer: Mapping) -> DataFrame:
        """The rows of a version. Neighbouring deltas of one kind are folded into one, so the base is joined once for all of them."""
        state, run, now = self._read(pointer["base"]), [], None

        def applied(state: DataFrame) -> DataFrame:
            if not run:
                return state
            rows = appended(*[self._read(path).withColumn("_v", F.lit(v)) for v, path in run])
            last = (fold(rows, "_id", ("_v",) if now == MERGE else ("at", "_v")) if len(run) > 1 else rows).drop("_v")
            run.clear()
            if now != MERGE:
                newer = state.where(F.col("at").isNotNull()).select("_id", F.col("at").alias("_at"), F.col("source").alias("_source"))
                last = last.join(newer.join(last.select("_id"), "_id", "left_semi"), "_id", "left").where("_at is null or _source <> source or _at <= at").select(*state.columns)
            return state.join(last.select("_id"), "_id", "left_anti").unionByName(last)

        for v, (kind, path) in enumerate(pointer["deltas"]):
            if kind != now:
                state, now = applied(state), kind
            if kind == APPEND:
                state = state.unionByName(self._read(path))
            else:
                run.append((v, path))
        return applied(state)

    def documents(self) -> DataFrame:
        """_id and doc of all live documents."""
        return self._folded(self._pointer(self.version)).where(F.col("op") == ADD).select("_id", "doc")

    def table(self) -> DataFrame:
        return self.schema.typed(self.documents())

    def _publish(self, delta: DataFrame, kind: str, version: int, batch: int | None = None, source: str = "") -> int:
        """Writes a delta (op, _id, doc, at) and makes it the newest version. Another writer that was faster makes the rename fail, and nothing is lost."""
        pointer, path = self._pointer(version), f"delta-{version + 1}-{uuid.uuid4().hex}"
        at = F.col("at") if "at" in delta.columns else F.lit(None).cast("array<bigint>")
        rows = delta.select("op", "_id", F.col("doc").cast(DOC_TYPE).alias("doc"), at.alias("at"), F.lit(source).alias("source"))
        rows.write.parquet(f"{self.catalog.root}/{self.name}/{path}")
        applied = pointer["applied"] | ({source: batch} if batch is not None else {})
        made = {"applied": applied, "base": pointer["base"], "deltas": [*pointer["deltas"], (kind, path)]}
        grown = sum(self._bytes(p) for _, p in made["deltas"])
        if len(made["deltas"]) >= MERGE_DELTAS or grown > MERGE_SHARE * self._bytes(made["base"]) > 0:
            made = self._merged(made, version)
        fs, new = self.catalog._fs, self.catalog._path(self.name, f"_new-{version + 1}-{uuid.uuid4().hex}.json")
        self.catalog._write(new, json.dumps(made))
        if not fs.rename(new, self.catalog._path(self.name, f"current-{version + 1}.json")):
            raise RuntimeError(f"index '{self.name}' got version {version + 1} from another writer")
        return version + 1

    def _merged(self, pointer: Mapping, version: int) -> dict:
        path = f"base-{version + 1}-{uuid.uuid4().hex}"
        self._folded(pointer).write.parquet(f"{self.catalog.root}/{self.name}/{path}")
        return {"applied": pointer["applied"], "base": path, "deltas": []}

    def applied(self, batch: int | None, source: str) -> bool:
        """Whether a batch of a source, or a later one, is in the index."""
        return batch is not None and self._pointer(self.version)["applied"].get(source, -1) >= batch

    def apply(self, ops: DataFrame, order: Sequence[str] = ("_snapshot_id", "_seq"), batch: int | None = None, source: str = "default") -> int:
        """Applies operations (op, _id, doc and the order's columns): of each id the last counts, of all that the source has sent. Returns the version."""
        version = self.version
        if self.applied(batch, source):
            return version
        last = fold(ops.select("op", "_id", "doc", *order), "_id", order)
        at = F.array(*[_number(F.col(c), last.schema[c].dataType) for c in order])
        return self._publish(last.withColumn("at", at), f"ordered {source}", version, batch, source)

    def append(self, docs: DataFrame, batch: int | None = None, source: str = "default") -> int:
        """Adds documents as they come: without an _ID field, documents that repeat stay."""
        version = self.version
        if self.applied(batch, source):
            return version
        return self._publish(docs.withColumn("op", F.lit(ADD)), APPEND, version, batch, source)

    def add(self, docs: DataFrame) -> int:
        """Adds or, by _id, replaces documents of which each id occurs once."""
        if self.schema.id_field is None:
            return self.append(docs)
        return self._publish(docs.withColumn("op", F.lit(ADD)), MERGE, self.version)

    def delete(self, ids: DataFrame | Sequence[str]) -> int:
        """Deletes the documents with these ids; an empty list is an error."""
        if not isinstance(ids, DataFrame):
            if not ids:
                raise ValueError("a delete needs at least one id")
            ids = self.spark.createDataFrame([(str(i),) for i in ids], "_id string")
        return self._publish(ids.select("_id", F.lit(DELETE).alias("op"), F.lit(None).alias("doc")).distinct(), MERGE, self.version)

    def expire(self, keep: int = 2) -> None:
        """Deletes all but the newest versions, and files that these don't name."""
        newest = self.version
        named = {p for v in range(max(1, newest - keep + 1), newest + 1) for p in ([f"current-{v}.json"] + [x for _, x in self._pointer(v)["deltas"]] + [self._pointer(v)["base"]])}
        for status in self.catalog._fs.listStatus(self.catalog._path(self.name)):
            name = status.getPath().getName()
            if name != "meta.json" and name not in named:
                self.catalog._fs.delete(status.getPath(), True)
