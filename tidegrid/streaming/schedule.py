"""The hourly schedule as a stream: features of every zone's next hour as soon as its last hour is complete."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.clock import add_hours, next_hour, with_calendar, with_cycles
from tidegrid.operators.series import HISTORY_HOURS, LAG_HOURS, ROLLING_HOURS
from tidegrid.operators.tables import Lakehouse
from tidegrid.plans import scoring
from tidegrid.plans.medallion import utc
from tidegrid.schemas import FEATURES, OBSERVATIONS, TableSpec, ddl
from tidegrid.streaming.counts import run_available

ZONE = "pickup_location_id"
UNKNOWN = -1  # an hour that nobody counted, unlike one without trips
LIVE_FEATURES = TableSpec(
    "gold.live_features",
    ddl(
        "pickup_location_id int, pickup_hour_ts timestamp, feature_window_end_ts timestamp, "
        + ", ".join(f"{c} {'int' if c == 'is_weekend' else 'double'}" for c in FEATURES) + ", version long, pickup_date date"
    ),
    partition_by=("pickup_date",),
    keys=(ZONE, "pickup_hour_ts"),
)
_WINDOWS = [f"{kind}_{k}h{part}" for kind, hours, parts in (("lag", LAG_HOURS, [""]), ("rolling", ROLLING_HOURS, ["_mean", "_std"])) for k in hours for part in parts]


def _hour_number(ts: Column) -> Column:
    """Hours since the epoch."""
    return F.floor(F.unix_seconds(ts) / 3600).cast("long")


def seed_windows(observations: DataFrame, end: Column) -> DataFrame:
    """(zone, target, counts) per zone: the counts of the 168 hours up to ``end``, oldest first, and the hour after it,
    which is the first that the stream predicts. Hours that aren't observed count as unknown."""
    last = _hour_number(end)
    start = add_hours(end, 1 - HISTORY_HOURS)
    recent = observations.filter(F.col("pickup_hour_ts").between(start, end))
    by_hour = F.map_from_entries(F.collect_list(F.struct(_hour_number(F.col("pickup_hour_ts")), F.col("ride_count").cast("int"))))
    held = recent.groupBy(F.col(ZONE).cast("int").alias(ZONE)).agg(by_hour.alias("held"))
    span = F.sequence(last - (HISTORY_HOURS - 1), last)
    return held.select(ZONE, (last + 1).alias("target"), F.transform(span, lambda h: F.coalesce(F.col("held")[h], F.lit(UNKNOWN))).alias("counts"))


def _partial_counts(trips: DataFrame, ts: str) -> DataFrame:
    """(zone, hour, n, event_ts): trips counted within every batch of a task, so that a hot zone shuffles a row an hour
    and batch instead of its trips. ``event_ts`` is the newest of them."""

    def count(frames):
        for frame in frames:
            yield frame.groupby([ZONE, "hour"], as_index=False).agg(n=("event_ts", "size"), event_ts=("event_ts", "max"))[[ZONE, "hour", "n", "event_ts"]]

    known = trips.filter(F.col(ZONE).isNotNull() & F.col(ts).isNotNull())
    plain = known.select(F.col(ZONE).cast("int").alias(ZONE), _hour_number(F.col(ts)).alias("hour"), F.col(ts).alias("event_ts"))
    return plain.mapInPandas(count, f"{ZONE} int, hour long, n long, event_ts timestamp")


def _schedule(history: int, lags: tuple[int, ...], windows: tuple[int, ...], zone: str, names: list[str], unknown: int):
    """The processor of a zone's clock. Classes of tasks are built inside functions, so that they travel by value."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    hour_ms = 3_600_000

    class Schedule(StatefulProcessor):
        """State: ``counts[i]`` is the count of hour ``first + i``; ``target`` is the next hour to predict. Every hour has its
        own slot, so trips may come in any order until the watermark has passed their hour; slots older
        than the history of the target are given up, so the state is as long as the history and what the watermark holds back."""

        def init(self, handle) -> None:
            self.handle = handle
            self.held = handle.getValueState("held", "first long, target long, counts array<int>")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            row = initialState.iloc[0]
            target = int(row["target"])
            self._keep(target - history, target, np.asarray(row["counts"], np.int64), None)

        def _keep(self, first: int, target: int, counts, before: int | None) -> None:
            self.held.update((first, target, [int(c) for c in counts]))
            if before != target:
                self.handle.registerTimer(target * hour_ms)

        def handleInputRows(self, key, rows, timerValues):
            seen = pd.concat(list(rows))
            hours, n = seen["hour"].to_numpy(np.int64), seen["n"].to_numpy(np.int64)
            held = self.held.get() if self.held.exists() else None
            if held is None:  # a zone that no seed knows: its hours begin with its first trip
                first = int(hours.min())
                target, counts, before = max(first, timerValues.getCurrentWatermarkInMs() // hour_ms) + 1, np.zeros(0, np.int64), None
            else:
                first, target, counts = held[0], held[1], np.asarray(held[2], np.int64)
                before = target
                earlier = max(int(hours.min()), target - history)
                if earlier < first:
                    counts, first = np.concatenate([np.zeros(first - earlier, np.int64), counts]), earlier
            useful = hours >= first
            hours, n = hours[useful] - first, n[useful]
            if len(hours):
                counts = np.concatenate([counts, np.zeros(max(int(hours.max()) + 1 - len(counts), 0), np.int64)])
                counts[hours[counts[hours] == unknown]] = 0
                np.add.at(counts, hours, n)
            self._keep(first, target, counts, before)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            first, target, counts = self.held.get()
            last = timerValues.getCurrentWatermarkInMs() // hour_ms  # the hour before it is complete
            if last < target:
                self.handle.registerTimer(target * hour_ms)
                return
            known = np.asarray(counts, np.float64)
            known[known == unknown] = np.nan
            begin = target - history
            line = np.zeros(last - begin)
            line[: max(first - begin, 0)] = np.nan
            overlap = known[max(begin - first, 0) : last - first]
            line[max(first - begin, 0) : max(first - begin, 0) + len(overlap)] = overlap
            seen = np.lib.stride_tricks.sliding_window_view(line, history)
            columns = [seen[:, history - k] for k in lags]
            for w in windows:
                columns += [seen[:, history - w :].mean(axis=1), seen[:, history - w :].std(axis=1, ddof=1)]
            out = pd.DataFrame(dict(zip(names, columns, strict=True)))
            out.insert(0, "hour", np.arange(target, last + 1))
            out.insert(0, zone, key[0])
            start = max(first, last + 1 - history)
            self._keep(start, last + 1, np.asarray(counts, np.int64)[start - first :], target)
            yield out

        def close(self) -> None:
            pass

    return Schedule()


def next_hour_features(trips: DataFrame, seed: DataFrame, lateness: str = "2 hours", ts: str = "pickup_datetime") -> DataFrame:
    """A stream of model features, one row per zone and hour, given out when the hour before is complete.

    ``trips`` is a stream of (zone, ``ts``) in a session of ``state_session``; ``seed`` (``seed_windows``) gives the history before
    the stream begins and the zones that get a row although nothing happens in them. A zone's clock is the watermark:
    trips at most ``lateness`` older than the newest one always reach their hour. Hours without trips count zero; a
    zone without a seed has no features until its history is long enough. The watermark follows the newest
    time, so feed validated trips: one far in the future ends the hours before it.
    """
    counted = _partial_counts(trips, ts).withWatermark("event_ts", lateness)
    shape = f"{ZONE} int, hour long, " + ", ".join(f"{c} double" for c in _WINDOWS)
    processor = _schedule(HISTORY_HOURS, LAG_HOURS, ROLLING_HOURS, ZONE, _WINDOWS, UNKNOWN)
    found = counted.groupBy(ZONE).transformWithStateInPandas(processor, shape, "Append", "EventTime", seed.groupBy(ZONE))
    timed = found.withColumn("pickup_hour_ts", F.timestamp_seconds(F.col("hour") * 3600)).drop("hour")
    return with_cycles(with_calendar(timed, "pickup_hour_ts")).withColumn("feature_window_end_ts", add_hours(F.col("pickup_hour_ts"), -1))


def publish_features(lake: Lakehouse, features: DataFrame, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Keep a keyed table of the features; a replayed batch replaces its rows."""
    lake.create(LIVE_FEATURES)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"version": F.lit(batch_id), "pickup_date": F.to_date("pickup_hour_ts")})
        lake.upsert(LIVE_FEATURES, rows, F.col("version"))

    return run_available(features, checkpoint, write, "append", continuous)


def score_schedule(
    lake: Lakehouse, features: DataFrame, model_path: str, checkpoint: str, at: dt.datetime | None = None, continuous: str | None = None
) -> StreamingQuery:
    """Score every hour with the champion at ``model_path`` as its features come, and publish the predictions by key."""

    def write(batch: DataFrame, _: int) -> None:
        with lake.staged(batch, "live_features") as rows:  # written once: its rows come out of the state
            hours = rows.agg(F.min("pickup_hour_ts"), F.max("pickup_hour_ts")).first()
            if hours[0] is None:
                return
            observed = lake.read(OBSERVATIONS).filter(scoring.month_window(F.lit(hours[0]), next_hour(F.lit(hours[1]))))
            scoring.publish_predictions(lake, scoring.score_features(lake, rows, observed, model_path, utc(at)))

    return run_available(features, checkpoint, write, "append", continuous)
