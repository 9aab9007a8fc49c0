"""Micro-batch ingestion into an index.

Spark's checkpoint holds the offsets. A micro-batch is read, converted, folded and published as one index version that
names the batch; if the driver dies between the publication and the commit of the offsets, the batch comes again and
finds itself applied. So every row counts once, though delivery is at least once.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import LakeConfig
from ..functions.encode import LAKE, TOPIC, Policy, id_text
from ..operators.changelog import ORDER, operations, quarantine, require_key
from ..operators.splits import Progress, bucket_of
from ..plans.document import compile_projection
from ..sources.index import IndexCatalog, IndexTable, MissingIndex
from ..sources.lake import stream_table
from ..sources.topic import records

log = logging.getLogger(__name__)
#: Seconds between two reports of progress.
REPORT_SECONDS = 300.0
META = ("_row_kind", "_bucket", "_snapshot_id", "_seq", "_partition")


def retry_missing(act: Callable[[], object], attempts: int = 3, delay: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """Runs ``act`` again while the index it writes to isn't there yet; other errors pass at once."""
    for attempt in range(1, attempts + 1):
        try:
            return act()
        except MissingIndex:
            if attempt == attempts:
                raise
            sleep(delay)
    raise ValueError(f"at least one attempt is needed, not {attempts}")


def retry_backoff(act: Callable[[], object], first: float = 0.1, most: float = 60.0, running: Callable[[], bool] = lambda: True, sleep: Callable[[float], None] = time.sleep) -> object:
    """Runs ``act`` until it succeeds or ``running`` ends; waits ``first`` seconds, then twice as long each time up to ``most``."""
    wait = first
    while True:
        try:
            return act()
        except Exception:
            if not running():
                raise
            log.exception("failed; again in %s s", wait)
            sleep(wait)
            wait = min(2 * wait, most)


@dataclass
class Ingest:
    """What turns the rows of a source into operations on an index."""

    catalog: IndexCatalog
    index: str
    rename: dict[str, str] = field(default_factory=dict)
    drop_prefixes: Sequence[str] = ()
    policy: Policy = LAKE
    #: An expression over source columns that is not null where a row can't be converted.
    error: Callable[[DataFrame], Column] | None = None
    #: Folder for rows that can't be converted; without one they are counted and passed over.
    quarantine_to: str | None = None
    order: Sequence[str] = ORDER
    update_before: str = "skip"
    progress: Progress = field(default_factory=Progress)
    _reported: float = field(default_factory=time.monotonic, repr=False)

    def _key(self, table: IndexTable, columns: Sequence[str]) -> str:
        """The source column that the index's _ID field comes from."""
        target = table.schema.id_field
        source = next((s for s, t in self.rename.items() if t == target), target)
        return require_key(columns, source)

    def _good(self, rows: DataFrame, batch: int | None = None, source: str = "") -> DataFrame:
        """Rows that can be converted. The others go to the quarantine, under the batch's number: one that comes again replaces its own."""
        if self.error is None:
            return rows
        good, bad = quarantine(rows, self.error(rows))
        if self.quarantine_to:
            name = uuid.uuid4().hex if batch is None else f"{source}-{batch}"
            bad.write.mode("overwrite").parquet(f"{self.quarantine_to.rstrip('/')}/_batch={name}")
        return good

    def changes(self, rows: DataFrame, table: IndexTable, batch: int | None = None, source: str = "") -> DataFrame:
        """op, _id, doc and the order's columns."""
        ops = operations(self._good(rows, batch, source), update_before=self.update_before)
        key = self._key(table, ops.columns)
        doc = compile_projection(rows.schema, self.rename, self.drop_prefixes, self.policy, META).document()
        return ops.select("op", id_text(F.col(f"`{key}`"), rows.schema[key].dataType, key).alias("_id"), doc.alias("doc"), *self.order)

    def apply_changes(self, rows: DataFrame, batch: int | None = None, source: str = "lake") -> int:
        """Applies a batch of a changelog; returns the index version."""

        def act(table: IndexTable) -> int:
            return table.apply(self.changes(rows, table, batch, source), self.order, batch, source)

        return self._once(rows, act, batch, source)

    def apply_records(self, rows: DataFrame, batch: int | None = None, source: str = "topic", attempts: int = 3, delay: float = 5.0) -> int:
        """Adds a batch of a topic's records; with an _ID field the last of each id counts, by partition and offset."""

        def act(table: IndexTable) -> int:
            values = self._good(rows.where("value is not null"), batch, source)
            doc = compile_projection(records(rows).schema, self.rename, self.drop_prefixes, self.policy)
            flat = values.select("value.*", F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))
            if table.schema.id_field is None:
                made = flat.select(F.concat_ws("-", "_partition", "_offset").alias("_id"), doc.document().alias("doc"))
                return table.append(made, batch, source)
            key = self._key(table, flat.columns)
            made = flat.select(F.lit("ADD").alias("op"), id_text(F.col(f"`{key}`"), flat.schema[key].dataType, key).alias("_id"), doc.document().alias("doc"), "_offset", "_partition")
            return table.apply(made, ("_offset", "_partition"), batch, source)

        return retry_missing(lambda: self._once(rows, act, batch, source), attempts, delay)

    def _once(self, rows: DataFrame, act: Callable[[IndexTable], int], batch: int | None, source: str) -> int:
        """Applies and counts a batch, unless the index has it."""
        table = self.catalog.open(self.index)
        if table.applied(batch, source):
            return table.version
        began = time.monotonic()
        buckets = [r[0] for r in rows.select(bucket_of(F.col("_bucket"))).distinct().collect()] if "_bucket" in rows.columns else []
        self.progress.begin(buckets)
        version = act(table)
        for bucket in buckets:  # a version has all buckets of its batch, or none
            self.progress.complete(bucket)
        self.progress.add(rows.count(), int((time.monotonic() - began) * 1000))
        self._report()
        return version

    def _report(self) -> None:
        """Logs the averages so far, once in REPORT_SECONDS."""
        now = time.monotonic()
        if now - self._reported >= REPORT_SECONDS and (said := self.progress.summary()):
            self._reported = now
            log.info("%s: %d rows in %d batches; %.1f rows a second, %.1f rows and %.0f ms a batch", self.index, self.progress.docs, self.progress.batches, *said.values())

    # -- streams --

    def start_lake(self, stream: DataFrame, checkpoint: str, scan_interval_ms: int = 30_000, once: bool = False, source: str = "lake", timeout_minutes: float = 0) -> StreamingQuery:
        """Follows a changelog; ``once`` ends after what is there now. A batch that fails is tried again, at longer and longer
        intervals, for ``timeout_minutes``; then the stream fails, and the batch isn't committed."""
        act = self._patiently(lambda df, batch: self.apply_changes(df, batch, source), 60 * timeout_minutes)
        return self._start(stream, checkpoint, act, f"{scan_interval_ms} milliseconds", once)

    def start_topic(self, stream: DataFrame, checkpoint: str, once: bool = False, source: str = "topic", delay: float = 5.0) -> StreamingQuery:
        if self.policy == LAKE:
            self.policy = TOPIC
        return self._start(stream, checkpoint, lambda df, batch: self.apply_records(df, batch, source, delay=delay), "1 second", once)

    @staticmethod
    def _patiently(act: Callable[[DataFrame, int], object], seconds: float) -> Callable[[DataFrame, int], object]:
        def run(df: DataFrame, batch: int) -> object:
            end = time.monotonic() + seconds
            return retry_backoff(lambda: act(df, batch), running=lambda: time.monotonic() < end, sleep=lambda wait: time.sleep(max(0.0, min(wait, end - time.monotonic()))))

        return run

    @staticmethod
    def _start(stream: DataFrame, checkpoint: str, act: Callable[[DataFrame, int], object], interval: str, once: bool) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, batch: act(df, batch) and None)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def follow(spark: SparkSession, catalog: IndexCatalog, config: LakeConfig, service: str, checkpoint: str, **more: object) -> Runner:
    """A runner for a lake table as its settings say: shard, renamed and dropped fields, scan interval, files a batch, and how long a failing batch is tried."""
    ingest = Ingest(catalog, config.index, rename=dict(config.rename), drop_prefixes=config.drop_prefixes, **more)
    return Runner(lambda: ingest.start_lake(stream_table(spark, config, service), checkpoint, config.scan_interval_ms, timeout_minutes=config.checkpoint_timeout_minutes))


class Runner:
    """Starts an ingestion once, starts it again ``delay`` seconds after an error, and stops it."""

    def __init__(self, start: Callable[[], StreamingQuery], delay: float = 5.0):
        self._begin, self.delay, self.restarts = start, delay, 0
        self._query: StreamingQuery | None = None
        self._watcher: threading.Thread | None = None
        self._stopped = threading.Event()

    @property
    def running(self) -> bool:
        return self._watcher is not None and self._watcher.is_alive()

    def start(self) -> StreamingQuery:
        if self.running:
            raise RuntimeError("it runs already")
        self._stopped.clear()
        self._query = self._begin()
        self._watcher = threading.Thread(target=self._watch, daemon=True)
        self._watcher.start()
        return self._query

    def _watch(self) -> None:
        while not self._stopped.is_set():
            try:
                if self._query is None:
                    self._query = self._begin()
                self._query.awaitTermination()
                return
            except Exception:
                if self._stopped.is_set():
                    return
                log.exception("the ingestion failed; again in %s s", self.delay)
                self._query = None
                if self._stopped.wait(self.delay):
                    return
                self.restarts += 1

    def stop(self, wait: float = 5.0) -> None:
        """Ends after the micro-batch at hand; what it doesn't commit comes again."""
        self._stopped.set()
        if self._query is not None:
            self._query.stop()
        if self._watcher is not None:
            self._watcher.join(wait)
