import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import tables
from tidegrid.schemas import TableSpec, ddl

MARKS = TableSpec("gold.marks", ddl("id int, note string, known int, slot int"), ("slot",), ("id",))
PLAIN = TableSpec("audit.plain", ddl("id int, note string"))


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, note string, known int, slot int")


def state(lake, spec=MARKS):
    return sorted(tuple(r) for r in lake.read(spec).collect())


@pytest.fixture
def marks(spark, lake):
    lake.create(MARKS)
    lake.append(MARKS, rows(spark, (1, "a", 1, 1), (2, "b", 2, 1), (3, "c", 3, 2)))
    return lake


def test_declared_layout(marks):
    assert marks.read(MARKS).columns == ["id", "note", "known", "slot"]
    described = {r["col_name"] for r in marks.spark.sql(f"DESCRIBE {marks.name(MARKS)}").collect()}
    assert "# Partition Information" in described


def test_slice_replace_touches_only_its_slice(spark, marks):
    for _ in range(2):
        marks.replace_slices(MARKS, rows(spark, (9, "z", 9, 1)))
        assert state(marks) == [(3, "c", 3, 2), (9, "z", 9, 1)]


def test_slice_can_become_empty(spark, marks):
    nothing = rows(spark, (0, "", 0, 0)).filter("id = 1").drop("slot")
    assert marks.replace_slice(MARKS, {"slot": 1}, nothing) == 0
    assert state(marks) == [(3, "c", 3, 2)]
    assert marks.replace_slice(MARKS, {"slot": 1}, rows(spark, (4, "d", 4, 0)).drop("slot")) == 1
    assert state(marks) == [(3, "c", 3, 2), (4, "d", 4, 1)]


def test_upsert_newest_wins_and_known_values_stay(spark, marks):
    new = rows(spark, (2, "a old", 7, 1), (2, "new", None, 1), (5, "e", 5, 1))
    for _ in range(2):
        marks.upsert(MARKS, new, F.col("note"), keep_known=("known",))
        assert state(marks) == [(1, "a", 1, 1), (2, "new", 2, 1), (3, "c", 3, 2), (5, "e", 5, 1)]


def test_upsert_of_nothing_changes_nothing(spark, marks):
    before = state(marks)
    marks.upsert(MARKS, rows(spark, (1, "x", 1, 1)).filter("id > 5"), F.col("note"))
    assert state(marks) == before


def test_purge(spark, marks):
    marks.purge(MARKS, F.col("id").isin(1, 3))
    assert state(marks) == [(2, "b", 2, 1)]
    marks.purge(MARKS, F.col("note") == "nobody")
    assert state(marks) == [(2, "b", 2, 1)]
    marks.create(PLAIN)
    marks.append(PLAIN, spark.createDataFrame([(1, "a"), (2, None)], "id int, note string"))
    marks.purge(PLAIN, F.col("note") == "a")  # a null comparison keeps its row
    assert state(marks, PLAIN) == [(2, None)]


def test_staging_is_dropped_on_failure(spark, marks):
    with pytest.raises(RuntimeError):
        with marks.staged(rows(spark, (1, "a", 1, 1)), "candidate") as frame:
            assert frame.count() == 1
            raise RuntimeError("gate")
    assert spark.catalog.listTables(f"{marks.prefix}staging") == []


def test_drop_removes_the_files(spark, marks):
    marks.drop(MARKS)
    assert not marks.exists(MARKS)
    marks.create(MARKS)
    assert marks.read(MARKS).isEmpty()


def test_table_survives_a_new_catalog_entry(spark, marks):
    other = tables.Lakehouse(spark, marks.root, prefix=f"{marks.prefix}again_")
    other.create(MARKS)
    assert state(other) == state(marks)


def test_fingerprint_ignores_order_and_sees_changes(spark, marks):
    frame = marks.read(MARKS)
    one = tables.fingerprint(frame, ["id"])[0].first()
    assert tables.fingerprint(frame.orderBy(F.desc("id")), ["id"])[0].first() == one
    assert tables.fingerprint(frame.withColumn("id", F.col("id") + 1), ["id"])[0].first() != one


def test_comparison_is_null_safe(spark):
    schema = "k int, v int"
    left = spark.createDataFrame([(1, None), (2, 2), (3, 3)], schema)
    right = spark.createDataFrame([(1, None), (2, 9), (4, 4)], schema)
    got = {r["k"]: r["state"] for r in tables.compare_by_key(left, right, ["k"]).collect()}
    assert got == {1: "equal", 2: "different", 3: "only_left", 4: "only_right"}


def test_commit_log(marks):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    marks.log(at, (MARKS, "append", "s", 3))
    assert [tuple(r)[1:] for r in marks.history(MARKS).collect()] == [("gold.marks", "append", "s", 3)]


def test_bounded_export(spark):
    assert len(tables.bounded_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        tables.bounded_rows(spark.range(6), 5)


def test_partition_lists_of_any_length(spark):
    from tidegrid.operators.tables import _of_partitions

    frame = spark.range(6000).selectExpr("cast(id as int) as day", "cast(id % 7 as string) as run", "id")
    rows = frame.where("id % 6 <> 0").select("day", "run").collect()
    assert len(rows) == 5000
    got = _of_partitions(frame, ["day", "run"], rows)
    assert got.count() == 5000 and got.where("id % 6 = 0").isEmpty()
    assert _of_partitions(frame, ["day"], [{"day": 3}, {"day": None}]).count() == 1
    assert _of_partitions(frame, ["day"], []).isEmpty()


def test_equal_versions_have_one_winner(spark):
    from tidegrid.operators.tables import newest_per_key

    frame = spark.createDataFrame([(1, "b", 2), (1, "c", 2), (1, "z", 1), (2, None, 1)], "k int, name string, v int")
    for parts in (1, 3, 4):
        got = {r["k"]: r["name"] for r in newest_per_key(frame.repartition(parts), ["k"], F.col("v")).collect()}
        assert got == {1: "c", 2: None}
