"""What several operators share: column picking, checkpoints, let-bindings, words and a bounded memo."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A word is a run of anything but these ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

#: A table of one row per range and group is broadcast up to so many rows, and shuffled beyond.
OFFSET_ROWS = 50_000

_OWN_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Exactly these columns, matched by exact case, so other columns may clash in any way."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{df.columns.index(c)}").alias(c) for c in columns))


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only on a local master that names none."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder:
        return folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        own = _OWN_FOLDERS.setdefault(sc.applicationId, tempfile.TemporaryDirectory(prefix="checkpoints-"))
        configured = own.name
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder: computed once, and read again after a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row: a column that the optimiser inlines into a
    lambda would be evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """A (checkpointed) side marked for broadcast only if it has at most ``most_rows`` rows."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (checkpointed) with ``pos``, their place from 0 within their group, and ``total``, its size.

    Rows are dealt to ranges of (group, order, row number) and sorted there, so neither a large group nor a
    repeated key makes a large task; counts of (range, group) give the offsets. Nulls come first.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "uid")]
    ranged = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = checkpoint(ranged.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    per = placed.groupBy(F.col(group).alias("g"), F.col("range").alias("r")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpoint(per.select("g", "r", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total")))
    here = (F.col("range") == F.col("r")) & F.col(group).eqNullSafe(F.col("g"))
    return placed.join(small_side(offsets, OFFSET_ROWS), here).select(
        *rows.columns, (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "total"
    )


def join_hot(rows: DataFrame, side: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``side`` (checkpointed, one row for every value of ``key``, ``count`` rows each).

    Values that at least a thousandth of all rows have are at most 1000, so they are joined by broadcast;
    the other rows are shuffled, where no value fills a task.
    """
    total = side.agg(F.sum(count)).first()[0] or 0
    often = F.col(count) * 1000 >= F.lit(total)
    hot = F.broadcast(side.where(often).withColumnRenamed(key, "hot_key").drop(count))
    names = [c for c in side.columns if c not in (key, count)]
    split = rows.join(hot, F.col(key).eqNullSafe(F.col("hot_key")), "left")
    met = split.where(F.col("hot_key").isNotNull()).drop("hot_key")
    rest = split.where(F.col("hot_key").isNull()).drop("hot_key", *names)
    return met.unionByName(rest.join(side.where(~often).drop(count), key))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def text_slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text (one row at least), to bound the arrays made from them."""
    start = size = 0
    for i, t in enumerate(batch.column(column)):
        n = t.as_buffer().size if t.is_valid else 0
        if size and size + n > most_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield start, batch.num_rows


class Memo:
    """What ``learn`` says of each word, kept in two generations of ``limit`` words, so frequent words
    stay and memory is bounded; forgetting changes speed, never a result."""

    def __init__(self, learn: Callable[[list[bytes]], Iterable], limit: int = 200_000):
        self.learn, self.limit = learn, limit
        self.young: dict = {}
        self.old: dict = {}

    def of(self, wanted: set) -> dict:
        """A mapping that has every one of ``wanted``."""
        missing = wanted.difference(self.young)
        if len(self.young) + len(missing) > self.limit:
            self.young, self.old, missing = {}, self.young, wanted
        unknown = []
        for w in missing:
            known = self.old.get(w)
            if known is None:
                unknown.append(w)
            else:
                self.young[w] = known
        if unknown:
            self.young.update(zip(unknown, self.learn(unknown), strict=True))
        return self.young
