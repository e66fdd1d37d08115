"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import checkpoint, count_words, pick, small_side

#: Bits of one histogram level; two levels leave about N / 2^28 rows of a source in its boundary bucket.
LEVEL_BITS = 14
HASH_BITS = 60
#: Tables of one row per source are broadcast up to so many rows, and shuffled beyond.
BROADCAST_SOURCES = 10_000


def row_hash(key: Column, text: Column) -> Column:
    """60 bits of md5 over key and text: the same in any run, and in SQL engines that have md5."""
    tagged = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(tagged), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes dealt by weight, stopped at ``cap`` times a
    source's size, what is over dealt again until none is above.

    That end state is a water level: with sources ordered by cap / weight, the level over the sources
    not yet capped settles the first source that stays below its cap, and so all after it. One row per
    source is sorted; sources are a small, fixed set.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_code_point) - 1) % F.lit(len(weights)))
    limits = sizes.withColumn("weight", weigh).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = limits.withColumn("level", level).withColumn("free", F.col("most") > F.col("level") * F.col("weight"))
    settled = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(everything)
    target = F.coalesce(F.least(F.col("most"), settled * F.col("weight")), F.col("most"))
    return levels.select("source", "source_size", target.alias("target"))


def _boundary(rows: DataFrame, goal: DataFrame, bucket: Column) -> DataFrame:
    """Per source the bucket in which the running size passes the goal, with the size before it."""
    histogram = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("taken_before") + F.coalesce(F.sum("held").over(running), F.lit(0))
    cut = histogram.join(goal, histogram["source"].eqNullSafe(goal["goal_source"])).withColumn("before", before)
    first = F.min_by(F.struct("bucket", "before", "held"), "bucket")
    return (
        cut.where(F.col("before") + F.col("held") > F.col("wanted"))
        .groupBy("goal_source", "wanted").agg(first.alias("hit"))
        .select("goal_source", "wanted", F.col("hit.bucket").alias("edge"), F.col("hit.before").alias("taken_before"), F.col("hit.held").alias("held"))
    )


def mixing_law(docs: DataFrame, weights: Sequence[int], share: float, cap: float, key: str, source: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The staged rows (doc_id, source, size, hash) and, per source, (law_source, source_size, target,
    whole, threshold): every document is taken ``whole`` times, and once more below the threshold."""
    plain = pick(docs, key, source, text).toDF("doc_id", "source", "text")
    staged = checkpoint(plain.select("doc_id", "source", count_words(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash")))
    sizes = staged.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpoint(source_targets(sizes, weights, share, cap))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.select(F.col("source").alias("law_source"), "source_size", "target", whole.cast("int").alias("whole"))
    wanted = F.col("target") - F.col("whole") * F.col("source_size")
    # a source whose target is a whole multiple has no boundary: its threshold is 0
    goal = plan.where(wanted > 0).select(F.col("law_source").alias("goal_source"), wanted.alias("wanted"), F.lit(0).cast("long").alias("taken_before"))
    rows, shift = staged, HASH_BITS
    for level in range(3):
        shift = max(0, shift - LEVEL_BITS) if level < 2 else 0
        bucket = F.shiftright("hash", shift)
        goal = checkpoint(_boundary(rows, small_side(goal.select("goal_source", "wanted", "taken_before"), BROADCAST_SOURCES), bucket))
        if shift:
            inside = small_side(goal.select("goal_source", "edge"), BROADCAST_SOURCES)
            here = rows["source"].eqNullSafe(inside["goal_source"]) & (F.shiftright(rows["hash"], shift) == inside["edge"])
            rows = rows.join(inside, here, "left_semi")
    nearer = F.col("taken_before") + F.col("held") - F.col("wanted") < F.col("wanted") - F.col("taken_before")
    edges = goal.select("goal_source", (F.col("edge") + F.when(nearer, 1).otherwise(0)).alias("threshold"))
    law = plan.join(edges, plan["law_source"].eqNullSafe(edges["goal_source"]), "left")
    return staged, checkpoint(law.select("law_source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold")))


def _copies(hash_: Column) -> Column:
    return (F.col("whole") + F.when(hash_ < F.col("threshold"), 1).otherwise(0)).cast("int")


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """(key, size, source_size, target, taken, copies) per row: every document is taken
    floor(target / source_size) times, and once more if its hash lies below the source's threshold.

    The threshold is found from above: sizes are summed by source and hash bucket, the bucket where the
    running sum passes the target is refined with the next bits, and the last bucket by whole hashes;
    rows are then filtered by comparing hashes, never sorted. Of the two thresholds around the
    target the nearer one is taken (the lower on a tie), so a source misses its target by at most half a
    document. Rows equal in key and text share a hash and are taken together. A null source is a source
    of its own, last in order; null and empty texts have size 0 and are taken like their source's others, never more
    often than ``cap``, rounded up; without any size all targets are 0. Repeated rows are taken alike. An empty table gives no rows.

    A source's histogram has at most 2^14 buckets a level, so the windows over it are bounded however large the source is.
    """
    staged, law = mixing_law(docs, weights, share, cap, key, source, text)
    law = small_side(law, BROADCAST_SOURCES)
    copies = _copies(F.col("hash"))
    return staged.join(law, staged["source"].eqNullSafe(law["law_source"])).select(
        F.col("doc_id").alias(key), "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"),
    )


def mixed_rows(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as it is taken (perhaps never).
    Nulls, ties, repeated rows and empty tables count as in ``mix``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: names[docs.columns.index(c)] for c in (key, source, text)}
    _, law = mixing_law(docs, weights, share, cap, key, source, text)
    law = small_side(law, BROADCAST_SOURCES)
    plain = docs.toDF(*names)
    times = F.explode(F.array_repeat(F.lit(0), _copies(row_hash(F.col(at[key]), F.col(at[text]))))).alias("time")
    return plain.join(law, plain[at[source]].eqNullSafe(law["law_source"])).select(*names, times).drop("time").toDF(*docs.columns)
