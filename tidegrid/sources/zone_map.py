"""Row-group ranges from Parquet footers: an inventory, and scans that open only the files whose ranges match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.sources.files import file_opener

#: Types whose footer bounds are exact. Bounds of text may be cut by the writer, so text gets none.
BOUNDED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def _range_reader(column: str, kind: T.DataType):
    """Footers to row groups; built inside a function, so that it travels to the tasks by value."""
    open_uri, bound = file_opener(), to_arrow_type(kind)
    bounded = kind.simpleString() in BOUNDED

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                with open_uri(path) as stream:
                    footer = pq.read_metadata(stream)
                place = {footer.schema.column(i).path: i for i in range(footer.num_columns)}.get(column)
                for number in range(footer.num_row_groups):
                    group = footer.row_group(number)
                    # a column that the file lacks is null in all rows
                    seen = None if place is None else group.column(place).statistics
                    nulls = group.num_rows if place is None else seen.null_count if seen is not None and seen.has_null_count else None
                    low, high = (seen.min, seen.max) if bounded and seen is not None and seen.has_min_max else (None, None)
                    rows.append((path, number, group.num_rows, group.total_byte_size, nulls, low, high))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), bound, bound)
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["path", "row_group", "row_count", "total_bytes", "null_count", "min_value", "max_value"],
            )

    return read


def row_groups(files: DataFrame, column: str, kind: str) -> DataFrame:
    """(path, row_group, row_count, total_bytes, null_count, min_value, max_value) of every row group of ``files`` (``path``).

    ``kind`` is the column's type. Footers are read in tasks, data pages not at all. Bounds are null where the file has none
    (no statistics, the old 96-bit timestamps, text); ``null_count`` is null where it isn't known.
    """
    parsed = T.DataType.fromDDL(kind)
    named = parsed.simpleString()
    shape = "path string, row_group int, row_count long, total_bytes long, null_count long"
    return files.select("path").mapInArrow(_range_reader(column, parsed), f"{shape}, min_value {named}, max_value {named}")


def may_hold(low: Column, high: Column) -> Column:
    """Whether a row group can hold a value in [low, high). Unknown bounds can, unless all values are null or there are none."""
    inside = (F.col("min_value") < high) & (F.col("max_value") >= low)
    return F.coalesce(inside, F.col("row_count") > F.coalesce("null_count", F.lit(0)))


def scan_range(spark: SparkSession, zones: DataFrame, schema: T.StructType, column: str, low: Column, high: Column) -> DataFrame:
    """The rows with ``column`` in [low, high), out of the files whose row groups may hold such rows.

    ``zones`` is a ``row_groups`` table, usually written once and kept next to the data. The driver holds the paths
    of the matching files; the others are neither listed nor opened.
    """
    paths = [r["path"] for r in zones.filter(may_hold(low, high)).select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(paths)).filter((F.col(column) >= low) & (F.col(column) < high))
