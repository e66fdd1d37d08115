"""Manifests watched one by one: state and timers look for late files until they arrive."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegrid.operators.tables import Lakehouse
from tidegrid.plans.medallion import Outcome
from tidegrid.schemas import MANIFEST
from tidegrid.sources.files import file_looker
from tidegrid.sources.manifest import parse_manifests
from tidegrid.streaming.manifests import (
    HANDLED, REJECTED, STATE, WAITING, bucket, identity, ingest_ready, manifest_stream, remember,
)

READY, REFUSED, GIVEN_UP = "ready", "refused", "given up"
PROGRESS = "manifests"
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
_EVENT = "source_filepath string, manifest_id string, manifest_path string, body string, reject_reason string, state string"


def _watcher(retry_ms: int, give_up_ms: int | None, remember_ms: int | None):
    """The processor of one manifest; built inside a function, so that it travels to the tasks by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    present = file_looker()
    waiting_, ready_, refused_, given_up_ = WAITING, READY, REFUSED, GIVEN_UP
    columns = ["source_filepath", "manifest_id", "manifest_path", "body", "reject_reason", "state"]

    class Watch(StatefulProcessor):
        """State of a manifest: its text and the time it came while it waits, or the fact that it was handled, kept for a
        time to live. A timer leads to the next look at its path."""

        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getValueState("waiting", "manifest_path string, body string, since long")
            self.handled = handle.getValueState("handled", "at long", remember_ms)

        def _event(self, key, path: str, body: str, state: str, reason: str | None = None):
            return pd.DataFrame([(key[0], key[1], path, body, reason, state)], columns=columns).astype({"reject_reason": object})

        def handleInputRows(self, key, rows, timerValues):
            now = timerValues.getCurrentProcessingTimeInMs()
            came = pd.concat(list(rows)).iloc[0]  # all rows of a key are the same manifest
            path, body, reason = came["manifest_path"], came["body"], came["reject_reason"]
            if isinstance(reason, str):
                yield self._event(key, path, body, refused_, reason)
            elif self.handled.exists() or self.waiting.exists():
                return
            elif present(key[0]):
                self.handled.update((now,))
                yield self._event(key, path, body, ready_)
            else:
                self.waiting.update((path, body, now))
                self.handle.registerTimer(now + retry_ms)
                yield self._event(key, path, body, waiting_)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentProcessingTimeInMs()
            if not self.waiting.exists():
                return
            path, body, since = self.waiting.get()
            if present(key[0]):
                self.waiting.clear()
                self.handled.update((now,))
                yield self._event(key, path, body, ready_)
            elif give_up_ms is not None and now - since >= give_up_ms:
                self.waiting.clear()
                yield self._event(key, path, body, given_up_)
            else:
                self.handle.registerTimer(now + retry_ms)

        def close(self) -> None:
            pass

    return Watch()


def watch_events(texts: DataFrame, dataset: str | None, retry: dt.timedelta, give_up: dt.timedelta | None, keep: dt.timedelta | None) -> DataFrame:
    """A stream of what became of each manifest: refused, waiting, ready or given up. Each state is told once."""

    def ms(span: dt.timedelta | None) -> int | None:
        return None if span is None else int(span.total_seconds() * 1000)

    parsed = parse_manifests(texts)
    if dataset:
        parsed = parsed.filter((F.col("dataset") == dataset) | F.col("reject_reason").isNotNull())
    refused = F.col("reject_reason").isNotNull()
    keyed = parsed.select(
        F.when(refused, F.col("manifest_path")).otherwise(F.col("source_filepath")).alias("source_filepath"),
        F.when(refused, F.sha2("manifest_text", 256)).otherwise(identity()).alias("manifest_id"), "manifest_path",
        F.when(refused, F.col("manifest_text")).otherwise(F.to_json(F.struct(*MANIFEST.names), _TIMES)).alias("body"), "reject_reason",
    )
    watcher = _watcher(ms(retry), ms(give_up), ms(keep))
    return keyed.groupBy("source_filepath", "manifest_id").transformWithStateInPandas(watcher, _EVENT, "Update", "ProcessingTime")


def handle_events(lake: Lakehouse, events: DataFrame, at: dt.datetime | None = None, publish: bool = False) -> Outcome | None:
    """One micro-batch of ``watch_events``: refused manifests to the side table, files that arrived into bronze (and on,
    with ``publish``), the rest into the state table. A replayed batch ends in the same tables."""
    outcome = None
    with lake.staged(events, "watched") as seen:  # written once, so the state store is asked once
        states = {r["state"] for r in seen.select("state").distinct().collect()}
        if REFUSED in states:
            bad = seen.filter(F.col("state") == REFUSED)
            lake.upsert(REJECTED, bad.select("manifest_path", F.col("body").alias("manifest_text"), "reject_reason", bucket("manifest_path")), F.lit(0))
        shape = MANIFEST.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
        named = seen.select("manifest_id", "state", F.from_json("body", shape, _TIMES).alias("m")).select("m.*", "manifest_id", "state")
        key = ["source_filepath", "manifest_id"]
        done = lake.read(STATE).filter(F.col("state") == HANDLED).select(*key)
        if states & {READY, WAITING, GIVEN_UP}:
            with lake.staged(named.join(done, key, "left_anti"), "news") as news:
                due = news.filter(F.col("state") == READY).drop("state")
                if READY in states and not due.isEmpty():
                    outcome = ingest_ready(lake, due, at, publish)
                    remember(lake, due, HANDLED)
                for state in sorted(states & {WAITING, GIVEN_UP}):
                    remember(lake, news.filter(F.col("state") == state).drop("state"), state)
    return outcome


class Watching(StreamingQuery):
    """A stream whose ``stop`` lets the batch under way finish.

    Spark's own ``stop`` kills the tasks of that batch, and a state task that is killed before its Python worker has connected
    takes its executor along, with all that is cached there. Besides, a stream that was stopped between two triggers looks at its
    timers only after the next manifest; one that was stopped in a batch begins with that batch.
    """

    def __init__(self, writer: DataStreamWriter, handle: Callable[[DataFrame], object]):
        self._closed, self._begun, self._held = threading.Event(), threading.Event(), threading.Event()

        def batch_function(batch: DataFrame, _: int) -> None:
            if self._closed.is_set():
                self._hold(batch)
            self._begun.set()
            handle(batch)

        super().__init__(writer.foreachBatch(batch_function).start()._jsq)

    def _hold(self, batch: DataFrame) -> None:
        """Keep a batch from its first task until the stop interrupts it; it comes again after a restart. The wait is in Spark's
        thread of the stream, which takes an interrupt there for a stop and not for a failure."""
        jvm = batch.sparkSession._jvm
        self._held.set()
        try:
            while self.isActive:
                jvm.java.lang.Thread.sleep(1000)
        except Py4JJavaError as error:  # Spark searches its text by a recursive pattern, which a whole stack trace overflows
            error.java_exception.setStackTrace(batch.sparkSession.sparkContext._gateway.new_array(jvm.java.lang.StackTraceElement, 0))
            raise
        raise InterruptedError("the stream was stopped before this batch")

    def stop(self, patience: float = 600) -> None:
        """End the stream at the start of its next batch, which the timers bring with the next trigger; a batch that takes more than
        ``patience`` seconds from now is killed. Without a batch so far there is none to wait for."""
        limit = time.monotonic() + patience
        self._closed.set()
        while self.isActive and not self._held.is_set() and time.monotonic() < limit:
            if not self._begun.is_set() and not self.status["isTriggerActive"]:
                break
            time.sleep(0.1)
        super().stop()


def told(stream: StreamingQuery, state: str) -> int:
    """How many manifests the finished batches of a running stream told to be in a state."""
    seen = (p.observedMetrics.get(PROGRESS) for p in stream.recentProgress)
    return sum(row[state.replace(" ", "_")] for row in seen if row is not None)


def watch_stream(
    lake: Lakehouse, folder: str, checkpoint: str, glob: str = "*.manifest.json", dataset: str | None = None, every: str = "30 seconds",
    retry: dt.timedelta = dt.timedelta(minutes=1), give_up: dt.timedelta | None = None, keep: dt.timedelta | None = dt.timedelta(days=90),
    files_per_batch: int = 500, publish: bool = False,
) -> Watching:
    """Ingestion that finds late files by itself: no new manifest and no separate retry job is needed.

    ``lake`` lives in a session of ``state_session``. Each manifest has a state of its own and a timer for its next look after
    ``retry``; looks happen in tasks, by path. Timers survive a restart from the same checkpoint. After ``give_up`` a manifest
    isn't looked for any more. Handled manifests stay known for ``keep`` here and for good in the state table, which a
    fresh checkpoint asks before it ingests. Runs until it is stopped, which happens at the start of a batch; each batch's progress has the counts of
    ``refused``, ``waiting``, ``ready`` and ``given_up`` manifests as the observed metrics ``PROGRESS``.
    """
    for spec in (REJECTED, STATE):
        lake.create(spec)
    events = watch_events(manifest_stream(lake.spark, folder, glob, files_per_batch), dataset, retry, give_up, keep)
    counts = [F.count_if(F.col("state") == state).alias(state.replace(" ", "_")) for state in (REFUSED, WAITING, READY, GIVEN_UP)]
    writer = events.observe(PROGRESS, *counts).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(processingTime=every)
    return Watching(writer, lambda batch: handle_events(lake, batch, publish=publish))
