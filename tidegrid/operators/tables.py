"""Declared Parquet tables with append, slice replace, keyed upsert, purge and a commit log.

Every mutation is one ``INSERT OVERWRITE`` of the partitions it touches (dynamic mode): Spark writes
the new files aside and swaps them in at job commit, so a lost executor or a failed job leaves the
old slice in place and a re-run ends in the same state.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.schemas import ALL_TABLES, COMMIT_LOG, TableSpec
from tidegrid.session import use_utc

#: Partitions that a task may write side by side instead of sorting its rows by partition; an input split of 128 MiB packs so many files.
OPEN_WRITERS = 32


class Lakehouse:
    """Tables below one warehouse root. ``prefix`` separates several lakes in one catalog."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        use_utc(spark)

    # ---- names and definitions ------------------------------------------------------

    def _split(self, spec: TableSpec | str) -> tuple[str, str]:
        namespace, table = (spec if isinstance(spec, str) else spec.name).split(".")
        return namespace, table

    def name(self, spec: TableSpec | str) -> str:
        namespace, table = self._split(spec)
        return f"`{self.prefix}{namespace}`.`{table}`"

    def location(self, spec: TableSpec | str) -> str:
        namespace, table = self._split(spec)
        return f"{self.root}/{namespace}/{table}"

    def _create_database(self, namespace: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{namespace}` LOCATION '{self.root}/{namespace}'"
        )

    def create(self, spec: TableSpec) -> None:
        """Create if absent, with the declared columns, partitioning and properties.

        A catalog that does not know the table yet learns the partitions already in its folder.
        """
        if self.exists(spec):
            return
        namespace, _ = self._split(spec)
        self._create_database(namespace)
        types = {f.name: f.dataType.simpleString() for f in spec.schema}
        columns = ", ".join(f"`{c}` {types[c]}" for c in spec.columns)
        partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_by)})" if spec.partition_by else ""
        properties = ", ".join(f"'{k}'='{v}'" for k, v in spec.properties.items())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(spec)} ({columns}) USING parquet {partitions} "
            f"LOCATION '{self.location(spec)}' {f'TBLPROPERTIES ({properties})' if properties else ''}"
        )
        if spec.partition_by:
            try:
                self.spark.catalog.recoverPartitions(self.name(spec))
            except Py4JJavaError as error:  # a table that is new altogether has no folder yet
                if "FileNotFoundException" not in str(error.java_exception):
                    raise

    def create_all(self) -> Lakehouse:
        for spec in ALL_TABLES:
            self.create(spec)
        return self

    def exists(self, spec: TableSpec) -> bool:
        namespace, table = self._split(spec)
        return self.spark.catalog.tableExists(f"`{self.prefix}{namespace}`.`{table}`")

    def drop(self, spec: TableSpec) -> None:
        """Drop the table and empty its location (tables with a LOCATION keep their files otherwise)."""
        if self.exists(spec):
            self._overwrite(self.spark.createDataFrame([], self.read(spec).schema), spec, dynamic=False)
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(spec)}")

    def read(self, spec: TableSpec) -> DataFrame:
        return self.spark.table(self.name(spec))

    # ---- writes ---------------------------------------------------------------------

    def _arrange(self, df: DataFrame, spec: TableSpec, balance: bool) -> DataFrame:
        """Columns in table order; rows grouped by partition with AQE splitting the large ones."""
        out = df.select(*[F.col(c).cast(spec.schema[c].dataType).alias(c) for c in spec.columns])
        if balance and spec.partition_by:
            out = out.hint("rebalance", *[F.col(c) for c in spec.partition_by])
        return out

    def _insert(self, df: DataFrame, spec: TableSpec, overwrite: bool, dynamic: bool = False, balance: bool = True) -> None:
        """Without ``balance`` a task keeps a file open per partition instead of sorting all its rows; beyond ``OPEN_WRITERS``
        partitions it sorts the rest."""
        conf = df.sparkSession.conf  # a stream batch has its own
        wanted = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if dynamic else "static"} if overwrite else {}
        if not balance and spec.partition_by:
            wanted["spark.sql.maxConcurrentOutputFileWriters"] = str(OPEN_WRITERS)
        before = {key: conf.get(key) for key in wanted}
        for key, value in wanted.items():
            conf.set(key, value)
        try:
            df.write.insertInto(self.name(spec), overwrite=overwrite)
        finally:
            for key, value in before.items():
                conf.set(key, value)

    def _overwrite(self, df: DataFrame, spec: TableSpec, dynamic: bool, balance: bool = True) -> None:
        self._insert(df, spec, True, dynamic, balance)

    def append(self, spec: TableSpec, df: DataFrame, balance: bool = True) -> None:
        """Add rows. ``balance=False`` skips the shuffle when each input split feeds one partition."""
        self._insert(self._arrange(df, spec, balance), spec, False, balance=balance)

    def replace_slices(self, spec: TableSpec, df: DataFrame, balance: bool = True) -> None:
        """Replace exactly the partitions present in ``df``; the others are untouched."""
        if not spec.partition_by:
            raise ValueError(f"{spec.name} has no partitions to replace")
        self._overwrite(self._arrange(df, spec, balance), spec, dynamic=True, balance=balance)

    def replace_counted(self, spec: TableSpec, df: DataFrame, balance: bool = True) -> int:
        """``replace_slices`` that also reports the rows written, counted during the write."""
        seen = Observation()
        self.replace_slices(spec, df.observe(seen, F.count(F.lit(1)).alias("rows")), balance)
        try:
            return seen.get["rows"]
        except Py4JJavaError:  # a plan folded to an empty relation reports no metrics
            return 0

    def replace_slice(self, spec: TableSpec, values: dict, df: DataFrame, balance: bool = False) -> int:
        """Make the partition ``values`` hold exactly ``df``, also when that is nothing."""
        rows = self.replace_counted(spec, df.withColumns({k: F.lit(v) for k, v in values.items()}), balance)
        if rows == 0:
            self.drop_partition(spec, values)
        return rows

    def upsert(self, spec: TableSpec, new: DataFrame, version: Column, keep_known: tuple[str, ...] = ()) -> None:
        """Insert or overwrite by key, rewriting only the partitions that ``new`` touches.

        ``new`` may repeat a key: the highest ``version`` wins. ``keep_known`` columns
        keep their stored value where the new row has null. The new rows are staged once, so that
        scoring is not repeated for finding the partitions and for merging.
        """
        keys, parts = list(spec.keys), list(spec.partition_by)
        incoming = newest_per_key(new.select(*spec.columns), keys, version)
        with self.staged(incoming, f"upsert_{spec.name}") as fresh:
            touched = fresh.select(*parts).distinct().collect()  # partition folders, not rows
            old = _of_partitions(self.read(spec), parts, touched)
            merged = merge_by_key(old, fresh, keys, keep_known)
            self._overwrite(self._arrange(merged, spec, True), spec, dynamic=True)

    def purge(self, spec: TableSpec, doomed: Column) -> None:
        """Delete the rows meeting ``doomed``; partitions without such rows are not rewritten."""
        kept = ~F.coalesce(doomed, F.lit(False))
        if not spec.partition_by:
            with self.staged(self.read(spec).filter(kept), f"purge_{spec.name}") as survivors:
                self._overwrite(self._arrange(survivors, spec, False), spec, dynamic=False)
            return
        parts = list(spec.partition_by)
        hit = (
            self.read(spec)
            .groupBy(*parts)
            .agg(F.count_if(~kept).alias("doomed"), F.count_if(kept).alias("kept"))
            .filter("doomed > 0")
            .collect()  # one row per partition folder
        )
        partly = [r for r in hit if r["kept"]]
        if partly:
            remaining = _of_partitions(self.read(spec), parts, partly).filter(kept)
            self._overwrite(self._arrange(remaining, spec, True), spec, dynamic=True)
        for row in hit:
            if not row["kept"]:
                self.drop_partition(spec, {p: row[p] for p in parts})

    def drop_partition(self, spec: TableSpec, values: dict) -> None:
        """Empty one whole partition."""
        plain = [c for c in spec.columns if c not in values]
        view = f"_empty_{uuid.uuid4().hex[:8]}"
        nothing = self.spark.createDataFrame([], T.StructType([spec.schema[c] for c in plain]))
        nothing.createOrReplaceTempView(view)
        static = ", ".join(f"`{k}`={_sql_literal(v)}" for k, v in values.items())
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(spec)} PARTITION ({static}) "
            f"SELECT {', '.join(f'`{c}`' for c in plain)} FROM {view}"
        )
        self.spark.catalog.dropTempView(view)

    @contextmanager
    def staged(self, df: DataFrame, label: str) -> Iterator[DataFrame]:
        """Write ``df`` to a staging table, hand back its contents, and drop it in any case.

        Staging tables are managed, so dropping one removes its files.
        """
        self._create_database("staging")
        name = self.name(f"staging.{label.replace('.', '_')}_{uuid.uuid4().hex[:8]}")
        try:
            df.write.saveAsTable(name)
            yield self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # ---- commit log -----------------------------------------------------------------

    def log(self, at: dt.datetime, *entries: tuple[TableSpec, str, str, int]) -> None:
        """One line per published change ``(table, operation, slice, rows)``.

        The log stands in for a table format's snapshot history.
        """
        self.create(COMMIT_LOG)
        rows = [(at, spec.name, operation, slice_, count) for spec, operation, slice_, count in entries]
        self.append(COMMIT_LOG, self.spark.createDataFrame(rows, COMMIT_LOG.schema).coalesce(1))

    def history(self, spec: TableSpec | None = None) -> DataFrame:
        log = self.read(COMMIT_LOG)
        if spec is not None:
            log = log.filter(F.col("table_name") == spec.name)
        return log.orderBy("committed_at", "table_name", "operation", "slice")


def _of_partitions(df: DataFrame, columns: list[str], rows: list) -> DataFrame:
    """The rows of the listed partitions. One value set per column prunes folders, however many
    partitions there are; a semi-join with the list keeps only their combinations."""
    if not rows:
        return df.limit(0)
    pruned = df
    for c in columns:
        values = {row[c] for row in rows}
        found = F.col(c).isin([v for v in values if v is not None])
        pruned = pruned.filter(found | F.col(c).isNull() if None in values else found)
    if len(columns) == 1:
        return pruned
    listed = df.sparkSession.createDataFrame([tuple(row[c] for c in columns) for row in rows], T.StructType([df.schema[c] for c in columns]))
    named = listed.toDF(*(f"_p{i}" for i in range(len(columns))))
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & pruned[c].eqNullSafe(named[f"_p{i}"])
    return pruned.join(named, same, "left_semi")


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def newest_per_key(df: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """The row of the highest ``version`` per key.

    An aggregate with map-side combine: many copies of one key shrink to one per task before the shuffle.
    Of rows with equal versions the greatest by its other columns wins, so a re-run picks the same one.
    """
    others = [c for c in df.columns if c not in keys]
    tie = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
    newest = F.max_by(F.struct(*others), F.struct(version, tie)).alias("_row")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def merge_by_key(old: DataFrame, new: DataFrame, keys: list[str], keep_known: tuple[str, ...] = ()) -> DataFrame:
    """``new`` over ``old`` by key, in one full outer join on the key.

    ``keep_known`` columns fall back to the old value where the new one is null.
    """
    o = old.select(*keys, F.struct(*old.columns).alias("_old"))
    n = new.select(*keys, F.struct(*new.columns).alias("_new"))

    def pick(c: str) -> Column:
        fresh, stored = F.col(f"_new.{c}"), F.col(f"_old.{c}")
        if c in keep_known:
            return F.coalesce(fresh, stored).alias(c)
        return F.when(F.col("_new").isNotNull(), fresh).otherwise(stored).alias(c)

    return o.join(n, keys, "full_outer").select(*[pick(c) for c in old.columns])


def fingerprint(df: DataFrame, order: list[str], sample: int = 5) -> tuple[DataFrame, DataFrame]:
    """Order-free content summary (rows, hash sum) and the first rows in a fixed order."""
    summary = df.agg(
        F.count("*").alias("row_count"),
        F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("content_hash"),
    )
    return summary, df.orderBy(*order).limit(sample)


def compare_by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison: rows missing on either side and rows whose other columns differ (null-safe)."""
    values = [c for c in left.columns if c not in keys]
    l = left.select(*keys, F.struct(*values).alias("_l"))
    r = right.select(*keys, F.struct(*[F.col(c).cast(left.schema[c].dataType).alias(c) for c in values]).alias("_r"))
    state = (
        F.when(F.col("_l").isNull(), "only_right")
        .when(F.col("_r").isNull(), "only_left")
        .when(~F.col("_l").eqNullSafe(F.col("_r")), "different")
        .otherwise("equal")
    )
    return l.join(r, keys, "full_outer").select(*keys, state.alias("state"))


def bounded_rows(df: DataFrame, limit: int = 10_000):
    """Bring a small result to the driver as pandas; refuse anything larger than ``limit`` rows."""
    frame = df.limit(limit + 1).toPandas()
    if len(frame) > limit:
        raise ValueError(f"more than {limit} rows; write the frame to a table instead")
    return frame
