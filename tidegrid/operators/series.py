"""Window features, chronological split and class thresholds for every zone at once.

All windows are partitioned by zone over hourly rows, so a partition holds one row per calendar hour
of one zone however many trips were aggregated into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.clock import add_hours, with_calendar, with_cycles
from tidegrid.functions.cost import demand_class
from tidegrid.operators.group_quantile import grouped_quantiles
from tidegrid.schemas import FEATURES, TRAIN_FRACTION, VALIDATION_FRACTION

LAG_HOURS = (1, 2, 24, 168)
ROLLING_HOURS = (6, 24)
HISTORY_HOURS = max(LAG_HOURS)
MIN_SPLIT_ROWS = 10


def _by_hour(zone: str, ts: str):
    return Window.partitionBy(zone).orderBy(ts)


def with_lags(df: DataFrame, zone: str = "pickup_location_id", ts: str = "pickup_hour_ts") -> DataFrame:
    w = _by_hour(zone, ts)
    return df.withColumns({f"lag_{k}h": F.lag("ride_count", k).over(w).cast("double") for k in LAG_HOURS})


def with_rolling(df: DataFrame, zone: str = "pickup_location_id", ts: str = "pickup_hour_ts") -> DataFrame:
    """Mean and sample deviation of the w hours before each row; null until the window is full."""
    count = F.col("ride_count")
    columns = {}
    for hours in ROLLING_HOURS:
        w = _by_hour(zone, ts).rowsBetween(-hours, -1)
        full = F.count(count).over(w) == hours
        columns[f"rolling_{hours}h_mean"] = F.when(full, F.avg(count).over(w))
        columns[f"rolling_{hours}h_std"] = F.when(full, F.stddev_samp(count).over(w))
    return df.withColumns(columns)


def with_features(df: DataFrame, zone: str = "pickup_location_id", ts: str = "pickup_hour_ts") -> DataFrame:
    """All model features; a row never sees its own or a later count."""
    return with_cycles(with_calendar(with_rolling(with_lags(df, zone, ts), zone, ts), ts))


def complete_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=FEATURES)


def with_split(
    df: DataFrame,
    zone: str = "pickup_location_id",
    ts: str = "pickup_hour_ts",
    train: float = TRAIN_FRACTION,
    validation: float = VALIDATION_FRACTION,
) -> DataFrame:
    """Label each zone's rows train / val / test by position in time.

    A zone with fewer than ten rows gets a null label, so callers can refuse or skip it.
    """
    position = F.row_number().over(_by_hour(zone, ts)) - 1
    size = F.count("*").over(Window.partitionBy(zone))
    train_end = F.floor(size * F.lit(float(train)))
    val_end = F.floor(size * F.lit(float(train + validation)))
    label = F.when(position < train_end, "train").when(position < val_end, "val").otherwise("test")
    return df.withColumn("split", F.when(size >= MIN_SPLIT_ROWS, label))


def fit_thresholds(train: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Interpolated 25 % and 75 % quantiles of the hourly counts, overall or per group. Groups are searched all at once,
    so none has to fit into a task."""
    if by:
        found = grouped_quantiles(train, by, "ride_count", [0.25, 0.75])
        return found.select(*by, F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("q75"))
    quartiles = F.percentile("ride_count", F.array(F.lit(0.25), F.lit(0.75)))
    return train.agg(quartiles.alias("q")).select(F.col("q")[0].alias("q25"), F.col("q")[1].alias("q75"))


def with_zone_thresholds(df: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    """Each zone's own training quartiles attached as a window aggregate.

    The rows are partitioned by zone already, so unlike fit-and-join this neither recomputes the
    features nor shuffles again.
    """
    counts = F.when(F.col("split") == "train", F.col("ride_count"))
    q = F.percentile(counts, F.array(F.lit(0.25), F.lit(0.75))).over(Window.partitionBy(zone))
    return df.withColumn("_q", q).withColumns({"q25": F.col("_q")[0], "q75": F.col("_q")[1]}).drop("_q")


def with_thresholds(df: DataFrame, thresholds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Attach thresholds: one row for all, or one per zone (the planner picks the join by size)."""
    if by:
        return df.join(thresholds, by, "left")
    return df.crossJoin(F.broadcast(thresholds))


def with_demand_class(df: DataFrame, source: str = "ride_count", target: str = "demand_class") -> DataFrame:
    return df.withColumn(target, demand_class(F.col(source), F.col("q25"), F.col("q75")))


def history_until(df: DataFrame, end: Column, zone: int | None = None) -> DataFrame:
    """Rows up to and including ``end``, for one zone or for all."""
    kept = df.filter(F.col("pickup_hour_ts") <= end)
    return kept if zone is None else kept.filter(F.col("pickup_location_id") == zone)


def features_at(observations: DataFrame, window_end: Column) -> DataFrame:
    """Features for the hour after ``window_end``, one row per zone, from the last 168 hours only.

    One filtered scan and one combined aggregate, no sort. A lag whose hour is absent is null and
    ``history_complete`` is false.
    """
    target = add_hours(window_end, 1)
    hour, count = F.col("pickup_hour_ts"), F.col("ride_count")
    recent = observations.filter((hour <= window_end) & (hour >= add_hours(target, -HISTORY_HOURS)))
    aggs = {f"lag_{k}h": F.max(F.when(hour == add_hours(target, -k), count)).cast("double") for k in LAG_HOURS}
    for hours in ROLLING_HOURS:
        inside = F.when(hour >= add_hours(target, -hours), count)
        full = F.count(inside) == hours
        aggs[f"rolling_{hours}h_mean"] = F.when(full, F.avg(inside))
        aggs[f"rolling_{hours}h_std"] = F.when(full, F.stddev_samp(inside))
    row = recent.groupBy("pickup_location_id").agg(*[c.alias(n) for n, c in aggs.items()])
    row = with_cycles(with_calendar(row.withColumn("pickup_hour_ts", target), "pickup_hour_ts"))
    complete = F.lit(True)
    for name in FEATURES:
        complete = complete & F.col(name).isNotNull()
    return row.withColumns({"feature_window_end_ts": add_hours(F.col("pickup_hour_ts"), -1), "history_complete": complete})


def features_between(observations: DataFrame, first: Column, last: Column) -> DataFrame:
    """Features for every hour in [first, last] of every zone, including hours not observed yet.

    Needs the counts of the 168 hours before ``first`` only; the spine supplies unobserved hours.
    """
    hour = F.col("pickup_hour_ts")
    start = add_hours(first, -HISTORY_HOURS)
    history = observations.filter((hour >= start) & (hour <= last)).select(
        "pickup_location_id", "pickup_hour_ts", "ride_count"
    )
    zones = history.select("pickup_location_id").distinct()
    span = F.sequence(start, last, F.make_dt_interval(hours=F.lit(1)))
    # calendar-bounded hour list, replicated once per zone
    spine = zones.select("pickup_location_id", F.explode(span).alias("pickup_hour_ts"))
    dense = spine.join(history, ["pickup_location_id", "pickup_hour_ts"], "left")
    return with_features(dense).filter(hour.between(first, last)).withColumn(
        "feature_window_end_ts", add_hours(hour, -1)
    )


def latest_rows(df: DataFrame, zone: str, ts: str) -> DataFrame:
    """The newest row of every series, by a combined aggregate instead of a sort; equal times go to the largest other columns."""
    others = [c for c in df.columns if c != zone]
    newest = F.max_by(F.struct(*others), F.struct(ts, *[c for c in others if c != ts])).alias("r")
    return df.groupBy(zone).agg(newest).select(zone, *[F.col(f"r.{c}").alias(c) for c in others])


def within_lookback(df: DataFrame, days: int | None, zone: str, ts: str) -> DataFrame:
    """Rows at most ``days`` older than their series' newest row; ``None`` keeps all history.

    The newest rows come from a combined aggregate joined back, not from a window, so that a series
    holding a large share of all rows is never one task's partition.
    """
    if days is None:
        return df
    newest = df.groupBy(zone).agg(F.max(ts).alias("_newest"))
    kept = df.join(newest, zone).filter(F.col(ts) >= add_hours(F.col("_newest"), -24 * days))
    return kept.select(*df.columns)


def zone_totals(observations: DataFrame) -> DataFrame:
    return observations.groupBy("pickup_location_id").agg(F.sum("ride_count").alias("total_rides"))


def busiest_zones(observations: DataFrame, k: int = 1) -> DataFrame:
    """Top zones by rides; the smaller zone number wins a tie."""
    return zone_totals(observations).orderBy(F.desc("total_rides"), "pickup_location_id").limit(k)
