"""Session settings and the scratch location for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(app_name: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Every timestamp rule here is stated in UTC, so pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def state_session(spark: SparkSession) -> SparkSession:
    """A session over the same tables whose streams keep their state in RocksDB, which ``transformWithState`` needs.

    Settings of ``spark`` itself stay as they are, so streams of other sessions don't change under way.
    """
    out = spark.newSession()
    out.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out.conf.set("spark.sql.session.timeZone", "UTC")
    out.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return out


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.TemporaryDirectory(prefix="tidegrid-")
    return _LOCAL_SCRATCH[app].name


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once below the scratch root, so later jobs and lost executors read it again."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()
