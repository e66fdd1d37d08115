"""Exact quantiles of every group at once, by narrowing histograms instead of sorting or collecting groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import checkpointed

BINS = 4096
#: Brackets (one row per group and rank) are broadcast up to so many, and joined by a shuffle beyond.
BROADCAST_ROWS = 100_000


def _place(value: Column, lo: Column, hi: Column) -> Column:
    """Equal-width bin of a value within its bracket: the lower end is in the first, the upper in the last, so they part."""
    width = hi / 2 - lo / 2
    place = F.floor((value / 2 - lo / 2) / width * F.lit(BINS))
    return F.when(width > 0, F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1))).otherwise(F.when(value > lo, 1).otherwise(0)).cast("int")


def _narrowed(rows: DataFrame, open_: DataFrame, group: list[str]) -> DataFrame:
    """Each bracket cut down to the extremes of the bin that holds its rank."""
    small = open_.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    held = rows.join(F.broadcast(open_) if small else open_, group).filter(F.col("v").between(F.col("lo"), F.col("hi")))
    bins = held.groupBy(*group, "rank", "below", _place(F.col("v"), F.col("lo"), F.col("hi")).alias("bin")).agg(
        F.count(F.lit(1)).alias("in_bin"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    run = Window.partitionBy(*group, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reached = bins.withColumn("before", F.col("below") + F.coalesce(F.sum("in_bin").over(run), F.lit(0)))
    here = reached.filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("in_bin")))
    return here.select(*group, "rank", F.col("before").alias("below"), "lo", "hi")


def grouped_quantiles(df: DataFrame, group: list[str], value: str, probs: list[float]) -> DataFrame:
    """(group columns, n, quantiles): the linearly interpolated quantiles of every group, exact.

    One pass counts the groups and finds their extremes. Each further pass histograms all rows within their groups' brackets, every wanted rank of every
    group in one aggregate that is combined in the tasks, and cuts each bracket to the extremes of one bin, until
    it is a single value. At most ``BINS`` rows per group and rank are shuffled by a task, whatever a group holds, so one
    group may have nearly all rows. Nothing but an end test passes the driver. Null, NaN and infinite values are left out; a group without others
    isn't in the result; a null group is a group.
    """
    names = [f"g{i}" for i in range(len(group))]
    number = F.col(value).cast("double")
    known = df.filter(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))
    # nulls equal each other in the joins below
    rows = known.select(*(F.struct(F.col(g)).alias(n) for g, n in zip(group, names)), number.alias("v"))
    facts = checkpointed(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    ranks = []
    for p in probs:
        position = F.lit(float(p)) * (F.col("n") - 1)
        ranks += [F.floor(position) + 1, F.ceil(position) + 1]
    wanted = F.explode(F.array_distinct(F.array(*ranks))).alias("rank")
    brackets = checkpointed(facts.select(*names, wanted, F.lit(0).cast("long").alias("below"), "lo", "hi"))
    while not (open_ := brackets.filter("lo < hi")).isEmpty():
        brackets = checkpointed(_narrowed(rows, open_, names).unionByName(brackets.filter("lo = hi")))
    found = brackets.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("at"))
    out = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n") - 1)
        lower, upper = F.element_at("at", ranks[2 * i]), F.element_at("at", ranks[2 * i + 1])
        share = position - F.floor(position)
        out.append(F.when((lower == upper) | (share == 0), lower).otherwise(lower + (upper - lower) * share))
    joined = facts.select(*names, "n").join(found, names)
    return joined.select(*(F.col(n)[g].alias(g) for g, n in zip(group, names)), "n", F.array(*out).alias("quantiles"))
