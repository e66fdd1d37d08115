"""Row-group ranges against the data, and scans that leave files out."""

import datetime as dt

import __spark_entry__ as contract
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegrid.sources.files import list_files
from tidegrid.sources.zone_map import row_groups, scan_range


@pytest.fixture
def folder(tmp_path):
    """Files of several row groups; one without statistics, one without the column, one all null, one empty."""
    def put(name, values, size=4, **options):
        pq.write_table(pa.table({"k": pa.array(values, pa.int64()), "t": [f"x{v}" for v in values]}), tmp_path / name, row_group_size=size, **options)

    put("a.parquet", list(range(10)))
    put("b.parquet", [20, None, 25, 22, 29])
    put("c.parquet", [40, 41], write_statistics=False)
    put("d.parquet", [None, None])
    put("e.parquet", [])
    pq.write_table(pa.table({"t": ["y"]}), tmp_path / "f.parquet")
    return str(tmp_path)


def test_row_groups_are_those_of_the_footers(spark, folder):
    got = row_groups(list_files(spark, folder, glob="*.parquet"), "k", "bigint").collect()
    sql = f"""SELECT regexp_extract(file_name, '[a-f].parquet'), row_group_id, row_group_num_rows, stats_null_count, stats_min_value::BIGINT, stats_max_value::BIGINT
        FROM parquet_metadata('{folder}/*.parquet') WHERE path_in_schema = 'k' AND file_name NOT LIKE '%/c.%'"""
    want = sorted(map(str, duckdb.sql(sql).fetchall()))
    found = [(r["path"][-9:], r["row_group"], r["row_count"], r["null_count"], r["min_value"], r["max_value"]) for r in got]
    assert sorted(map(str, (f for f in found if f[0][0] not in "cf"))) == want
    assert [f[3:] for f in found if f[0][0] == "c"] == [(None, None, None)] and [f[3] for f in found if f[0][0] == "f"] == [1]


@pytest.mark.parametrize("low, high, files", [(3, 5, "ac"), (22, 23, "bc"), (100, 200, "c"), (30, 40, "c"), (29, 41, "bc"), (-5, 0, "c")])
def test_scan_opens_files_that_may_match(spark, folder, low, high, files):
    every = spark.read.schema("k bigint, t string").parquet(folder)
    zones = row_groups(list_files(spark, folder, glob="*.parquet"), "k", "bigint")
    got = scan_range(spark, zones, every.schema, "k", F.lit(low), F.lit(high))
    assert sorted(p[-9] for p in got.inputFiles()) == list(files)
    assert sorted(got.collect()) == sorted(every.filter((F.col("k") >= low) & (F.col("k") < high)).collect())


def test_text_has_no_bounds_and_nothing_matches_no_file(spark, folder):
    files = list_files(spark, folder, glob="[ab].parquet")
    assert {(r["min_value"], r["max_value"]) for r in row_groups(files, "t", "string").collect()} == {(None, None)}
    zones = row_groups(files, "k", "bigint")
    none = scan_range(spark, zones, spark.read.parquet(f"{folder}/a.parquet").schema, "k", F.lit(1000), F.lit(2000))
    assert none.isEmpty() and none.columns == ["k", "t"]


def test_time_range_leaves_most_files_out(spark, small):
    scan = contract.queries()["f8_zone_map_scan"](spark, small)
    assert 1 <= len(scan.inputFiles()) <= 3  # of twelve
    times = [r["ts"] for r in scan.collect()]
    assert times == sorted(times) and min(times) >= dt.datetime(2024, 1, 10, 6)
