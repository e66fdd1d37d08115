"""Labels, display text, lenient parsing and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.schemas import CLASS_CAPTIONS, CLASS_LABELS, PENDING_CAPTION, UNSETTLED_TEXT


def _lookup(mapping: dict[int, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, key.cast("int"))


def class_label(cls: Column) -> Column:
    return _lookup(CLASS_LABELS, cls)


def class_caption(cls: Column) -> Column:
    """Dashboard wording; an unlisted class shows as its number, null as pending."""
    return F.coalesce(_lookup(CLASS_CAPTIONS, cls), cls.cast("string"), F.lit(PENDING_CAPTION))


def penalty_text(value: Column) -> Column:
    return F.coalesce(F.concat(F.format_number(value, 0), F.lit(" Units")), F.lit(UNSETTLED_TEXT))


def confidence_text(value: Column) -> Column:
    return F.concat(F.format_number(value * 100, 2), F.lit("%"))


def lenient_number(text: Column) -> Column:
    return text.try_cast("double")


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def run_hash(run_id: Column) -> Column:
    """First 16 hex digits of the SHA-256 of a run id."""
    return F.substring(F.sha2(run_id, 256), 1, 16)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
