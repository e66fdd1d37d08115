"""Parquet / CSV access, Hive-partitioned layout, and facts about files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.clock import day_parts
from tidegrid.functions.text import base_name

WHOLE_FILE_LIMIT = 512 * 1024 * 1024  # larger files are hashed in blocks instead of as one value
HASH_BLOCK = 1024 * 1024


CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"  # the default would cut microseconds


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with declared types; a declared schema avoids the inference pass."""
    return spark.read.options(header=True, timestampFormat=CSV_TIMESTAMP).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header=True, timestampFormat=CSV_TIMESTAMP).csv(path)


def write_day_partitioned(df: DataFrame, path: str, ts: str) -> None:
    """``year=/month=/day=`` folders, rows sorted by time inside every file.

    The rebalance lets adaptive execution split a hot day over several files and merge small ones.
    """
    parts = day_parts(F.col(ts))
    (
        df.withColumns(parts)
        .hint("rebalance", *[F.col(c) for c in parts])
        .sortWithinPartitions(*parts, ts)
        .write.partitionBy(*parts)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Partition columns come back from the folder names."""
    return spark.read.parquet(path)


def day_range_predicate(ts: str, start: Column, end: Column) -> Column:
    """Half-open time filter plus the folder predicate it implies, so that partitions prune."""
    day_number = F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")

    def number(x: Column) -> Column:
        return F.date_format(x, "yyyyMMdd").cast("int")

    return (F.col(ts) >= start) & (F.col(ts) < end) & day_number.between(number(start), number(end))


def file_inventory(df: DataFrame, column: str, *partitions: str) -> DataFrame:
    """Rows and column range per data file of a file-backed frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path"), *partitions).agg(
        F.count("*").alias("row_count"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )


def file_bounds_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Typed lower and upper bounds per file, shown as column -> text maps."""

    def bounds(fn) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]), F.array(*[fn(c).cast("string") for c in columns])
        )

    shown = lambda m: F.transform_values(m, lambda _, v: F.coalesce(v, F.lit("None")))
    return (
        df.groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count("*").alias("record_count"), bounds(F.min).alias("lo"), bounds(F.max).alias("hi"))
        .select(
            base_name(F.col("file_path")).alias("file_name"),
            "record_count",
            shown(F.col("lo")).alias("lower_bounds"),
            shown(F.col("hi")).alias("upper_bounds"),
        )
    )


def table_layout(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Files, bytes and rows per partition of a file-backed table."""
    per_file = df.groupBy("_metadata.file_path", *partitions).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.groupBy(*partitions).agg(
        F.count("*").alias("file_count"), F.sum("rows").alias("row_count"), F.sum("bytes").alias("total_bytes")
    )


# ---- listing, hashing, footers ------------------------------------------------------


def list_files(spark: SparkSession, *paths: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Path, size and modification time; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(list(paths))
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    )


def _locator():
    """A function from a listed URI to Arrow's file system and the path in it.

    Task functions are built inside functions, imports included, so that they travel to the executors
    by value and this package need not be installed there.
    """

    def locate(path: str):
        from pyarrow import fs

        if "://" not in path:
            path = "file://" + path.removeprefix("file:")
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))

    return locate


def file_opener():
    """A function that opens a listed URI through Arrow."""
    locate = _locator()

    def open_uri(path: str):
        filesystem, inner = locate(path)
        return filesystem.open_input_file(inner)

    return open_uri


def file_looker():
    """A function for tasks that tells whether a file is there; its folder need not be."""
    locate = _locator()

    def present(path: str) -> bool:
        filesystem, inner = locate(path)
        return filesystem.get_file_info(inner).is_file

    return present


def present_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """The distinct paths of ``files`` (one column) whose file exists, looked up one by one inside tasks; no folder is listed."""
    present = file_looker()

    def look(frames):
        for frame in frames:
            yield frame[[present(p) for p in frame[path]]]

    return files.filter(F.col(path).isNotNull()).select(path).distinct().mapInPandas(look, f"`{path}` string")


def _block_hasher(block_size: int = HASH_BLOCK):
    open_uri = file_opener()

    def hash_files(batches):
        import hashlib

        for frame in batches:
            digests = []
            for path in frame["path"]:
                digest = hashlib.sha256()
                with open_uri(path) as stream:
                    while block := stream.read(block_size):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield frame.assign(file_checksum=digests)

    return hash_files


def fingerprints(
    spark: SparkSession, *paths: str, glob: str = "*", recursive: bool = False, whole_limit: int = WHOLE_FILE_LIMIT
) -> DataFrame:
    """SHA-256 of every file, one task per file slice.

    Files up to 512 MiB are hashed as one value in the JVM; larger ones are streamed in blocks,
    because a row cannot hold them. SHA-256 is sequential, so one file is always one task's work.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(list(paths))
    )
    small = listed.filter(F.col("length") <= whole_limit).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("file_checksum")
    )
    large = (
        listed.filter(F.col("length") > whole_limit)
        .select("path", F.col("length").alias("size_bytes"))
        .repartition(F.col("path"))
        .mapInPandas(_block_hasher(), "path string, size_bytes long, file_checksum string")
    )
    return small.unionByName(large)


def _footer_reader():
    open_uri = file_opener()

    def read_footers(batches):
        import json

        import pyarrow.parquet as pq

        for frame in batches:
            found = []
            for path in frame["path"]:
                with open_uri(path) as stream:
                    schema = pq.read_schema(stream)
                found.append(json.dumps([[f.name, str(f.type)] for f in schema]))
            yield frame.assign(footer=found)

    return read_footers


def footers(files: DataFrame) -> DataFrame:
    """Column names and physical types from each Parquet footer (``path`` in, ``path, footer`` out)."""
    return files.select("path").mapInPandas(_footer_reader(), "path string, footer string")
