"""Manifest stream driving exactly-once ingestion, with rejects and retries kept as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.operators.tables import Lakehouse
from tidegrid.plans.medallion import Outcome, bronze_ingest, run_month, utc
from tidegrid.schemas import MANIFEST, TableSpec, ddl
from tidegrid.sources.files import present_paths
from tidegrid.sources.manifest import parse_manifests

BUCKETS = 32  # partitions of a keyed state table, fixed, by path
REJECTED = TableSpec(
    "audit.rejected_manifests",
    ddl("manifest_path string, manifest_text string, reject_reason string, bucket int"),
    partition_by=("bucket",),
    keys=("manifest_path",),
)
# One row per announced file version: waiting for its file, or handled.
STATE = TableSpec(
    "audit.manifest_state",
    ddl(
        "dataset string, source_filepath string, source_filename string, source_year int, source_month int, "
        "file_size_bytes long, discovered_at_utc timestamp, manifest_id string, state string, bucket int"
    ),
    partition_by=("bucket",),
    keys=("source_filepath", "manifest_id"),
)
WAITING, HANDLED = "waiting", "handled"


def manifest_stream(
    spark: SparkSession, folder: str, glob: str = "*.manifest.json", files_per_batch: int = 500
) -> DataFrame:
    """Whole manifest files as text rows: existing ones first, sub-folders included, each once."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("value", F.col("_metadata.file_path").alias("manifest_path"))
    )


def _existing(manifests: DataFrame) -> DataFrame:
    """Manifests whose data file is there, looked up by path inside tasks."""
    return manifests.join(present_paths(manifests, "source_filepath"), "source_filepath", "left_semi")


def bucket(path: str) -> Column:
    return F.pmod(F.hash(F.col(path)), F.lit(BUCKETS)).alias("bucket")


def identity() -> Column:
    """A manifest's identity: a second manifest of a known path, for corrected content, is
    another one, while a replayed text is the same."""
    return F.sha2(F.to_json(F.struct(*MANIFEST.names), {"ignoreNullFields": "false"}), 256)


def identified(manifests: DataFrame) -> DataFrame:
    return manifests.select(*MANIFEST.names, identity().alias("manifest_id"))


def waiting(lake: Lakehouse) -> DataFrame:
    """The manifests still waiting for their file."""
    return lake.read(STATE).filter(F.col("state") == WAITING)


def remember(lake: Lakehouse, manifests: DataFrame, state: str) -> None:
    rows = manifests.select(*MANIFEST.names, "manifest_id", F.lit(state).alias("state"), bucket("source_filepath"))
    lake.upsert(STATE, rows, F.lit(0))


def ingest_ready(lake: Lakehouse, ready: DataFrame, at: dt.datetime | None, publish: bool) -> Outcome:
    """Ready files under a run id of their contents; known checksums are skipped there. With ``publish`` their
    months go on through silver and gold; a replayed batch has the same run id and finishes what is open."""
    files = ready.select(F.col("source_filepath").alias("path"), "source_filename", "source_year", "source_month").distinct()
    return run_month(lake, files, None, utc(at))[0] if publish else bronze_ingest(lake, files, None, utc(at))


def handle_manifests(
    lake: Lakehouse, texts: DataFrame, dataset: str | None = None, at: dt.datetime | None = None, publish: bool = False
) -> Outcome | None:
    """One micro-batch: reject bad manifests, ingest the files that are there (and publish their months), keep the rest waiting.

    State is keyed by path and manifest identity and doesn't know batch numbers, so a replayed batch and
    a fresh checkpoint end in the same state.
    """
    for spec in (REJECTED, STATE):
        lake.create(spec)
    with lake.staged(parse_manifests(texts), "manifests") as parsed:
        bad = parsed.filter(F.col("reject_reason").isNotNull())
        if not bad.isEmpty():
            lake.upsert(REJECTED, bad.withColumn("bucket", bucket("manifest_path")), F.lit(0))
        good = parsed.filter(F.col("reject_reason").isNull())
        if dataset:
            good = good.filter(F.col("dataset") == dataset)
        handled = lake.read(STATE).filter(F.col("state") == HANDLED).select("source_filepath", "manifest_id")
        candidates = (
            identified(good).unionByName(waiting(lake).select(*MANIFEST.names, "manifest_id"))
            .dropDuplicates(["source_filepath", "manifest_id"])
            .join(handled, ["source_filepath", "manifest_id"], "left_anti")
        )
        with lake.staged(candidates, "candidates") as due, lake.staged(_existing(due), "ready") as ready:
            outcome = None if ready.isEmpty() else ingest_ready(lake, ready, at, publish)
            still = due.join(ready.select("source_filepath", "manifest_id"), ["source_filepath", "manifest_id"], "left_anti")
            for rows, state in ((still, WAITING), (ready, HANDLED)):
                if not rows.isEmpty():
                    remember(lake, rows, state)
    return outcome


def ingest_stream(
    lake: Lakehouse, folder: str, checkpoint: str, glob: str = "*.manifest.json", dataset: str | None = None,
    continuous: str | None = None, files_per_batch: int = 500, publish: bool = False,
) -> StreamingQuery:
    """Start the manifest-driven ingestion: everything available now, or on a fixed interval. With ``publish``
    each batch goes on through silver and gold."""
    writer = (
        manifest_stream(lake.spark, folder, glob, files_per_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: handle_manifests(lake, batch, dataset, publish=publish))
    )
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def retry_pending(lake: Lakehouse, at: dt.datetime | None = None, publish: bool = False) -> Outcome | None:
    """Look again for files of waiting manifests, without waiting for a new manifest to arrive."""
    with lake.staged(waiting(lake).select(*MANIFEST.names, "manifest_id"), "retry") as due:
        with lake.staged(_existing(due), "ready") as ready:
            if ready.isEmpty():
                return None
            outcome = ingest_ready(lake, ready, at, publish)
            remember(lake, ready, HANDLED)
    return outcome
