"""Drop manifests: deriving them from landed files and reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.clock import year_month_ok
from tidegrid.functions.text import base_name
from tidegrid.schemas import MANIFEST

NAME_PATTERN = r"^([a-z_]+)_tripdata_(\d{4})-(\d{2}).*\.parquet$"  # fixed naming scheme of monthly files
CORRUPT = "_corrupt"


def derive_manifests(files: DataFrame, pattern: str = NAME_PATTERN) -> DataFrame:
    """Dataset, year and month from each listed file's name, plus size and discovery time."""
    name = base_name(F.col("path"))
    return (
        files.withColumn("source_filename", name)
        .filter(F.col("source_filename").rlike(pattern))
        .select(
            F.concat(F.regexp_extract("source_filename", pattern, 1), F.lit("_taxi")).alias("dataset"),
            F.col("path").alias("source_filepath"),
            "source_filename",
            F.regexp_extract("source_filename", pattern, 2).cast("int").alias("source_year"),
            F.regexp_extract("source_filename", pattern, 3).cast("int").alias("source_month"),
            F.col("size_bytes").alias("file_size_bytes"),
            F.col("modified_at").alias("discovered_at_utc"),
        )
    )


def to_manifest_json(manifests: DataFrame) -> DataFrame:
    """One JSON text per manifest."""
    return manifests.select(
        F.to_json(F.struct(*MANIFEST.names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}).alias("value")
    )


def parse_manifests(texts: DataFrame, text: str = "value") -> DataFrame:
    """Manifest columns plus ``reject_reason``: null when accepted, else why it was refused."""
    schema = MANIFEST.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    parsed = F.from_json(
        text, f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    out = texts.withColumn("_m", parsed).select(
        *[c for c in texts.columns if c != text], F.col(text).alias("manifest_text"), "_m.*"
    )
    missing: Column = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in MANIFEST.names])
    )
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(~year_month_ok(F.col("source_year"), F.col("source_month")), F.lit("year or month out of range"))
    )
    return out.withColumn("reject_reason", reason).drop(CORRUPT)
