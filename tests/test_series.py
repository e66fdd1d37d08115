import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.clock import utc_literal
from tidegrid.operators import evaluation, grid, series
from tidegrid.plans import report, training
from tidegrid.schemas import FEATURES

START = dt.datetime(2024, 1, 1)


def hourly(spark, hours: int, zones=(2, 3), seed: int = 7, start=START):
    rng = np.random.default_rng(seed)
    rows = [
        (z, start + dt.timedelta(hours=h), int(n))
        for z in zones
        for h, n in enumerate(rng.integers(0, 60, hours))
    ]
    frame = spark.createDataFrame(rows, "pickup_location_id int, t timestamp_ntz, ride_count int")
    return frame.select("pickup_location_id", F.col("t").cast("timestamp").alias("pickup_hour_ts"), "ride_count")


def test_windows_match_pandas(spark):
    frame = hourly(spark, 240)
    got = series.with_features(frame).orderBy("pickup_location_id", "pickup_hour_ts").toPandas()
    for _, g in got.groupby("pickup_location_id"):
        s = g["ride_count"]
        past = s.shift(1)
        for k in (1, 2, 24, 168):
            np.testing.assert_allclose(g[f"lag_{k}h"], s.shift(k), equal_nan=True)
        for w in (6, 24):
            np.testing.assert_allclose(g[f"rolling_{w}h_mean"], past.rolling(w, min_periods=w).mean(), equal_nan=True)
            np.testing.assert_allclose(
                g[f"rolling_{w}h_std"], past.rolling(w, min_periods=w).std(), equal_nan=True, atol=1e-9
            )
        assert g["rolling_24h_mean"].isna().sum() == 24
        hour = pd.to_datetime(g["pickup_hour_ts"]).dt.hour
        np.testing.assert_allclose(g["hour_of_day_sin"], np.sin(2 * np.pi * hour / 24), atol=1e-12)


def test_features_do_not_see_the_future(spark):
    frame = hourly(spark, 220, zones=(2,))
    cut = START + dt.timedelta(hours=200)
    changed = frame.withColumn(
        "ride_count", F.when(F.col("pickup_hour_ts") >= utc_literal(cut), 999).otherwise(F.col("ride_count")).cast("int")
    )
    until = F.col("pickup_hour_ts") <= utc_literal(cut)
    a, b = (series.with_features(f).filter(until).select("pickup_hour_ts", *FEATURES) for f in (frame, changed))
    assert a.exceptAll(b).isEmpty()


def test_online_features_equal_training_features(spark):
    frame = hourly(spark, 300)
    end = START + dt.timedelta(hours=250)
    online = series.features_at(frame, utc_literal(end)).orderBy("pickup_location_id").toPandas()
    target = utc_literal(end + dt.timedelta(hours=1))
    trained = series.with_features(frame).filter(F.col("pickup_hour_ts") == target).orderBy("pickup_location_id").toPandas()
    ranged = series.features_between(frame, target, target).orderBy("pickup_location_id").toPandas()
    for other in (trained, ranged):
        np.testing.assert_allclose(online[FEATURES].astype(float), other[FEATURES].astype(float), atol=1e-9)
    assert online["history_complete"].all()


def test_missing_history_is_flagged(spark):
    frame = hourly(spark, 300).filter(F.col("pickup_hour_ts") != utc_literal(START + dt.timedelta(hours=200)))
    row = series.features_at(frame, utc_literal(START + dt.timedelta(hours=201))).first()
    assert row["lag_2h"] is None and not row["history_complete"]


def test_gap_month_stays_unknown(spark):
    first = hourly(spark, 48, zones=(2,))
    later = hourly(spark, 48, zones=(2,), start=START + dt.timedelta(hours=96))
    spine = grid.series_spine(first.unionByName(later))
    assert spine.count() == 144
    assert spine.filter("ride_count is null").count() == 48
    lagged = series.with_lags(spine)
    after_gap = lagged.filter(F.col("pickup_hour_ts") == utc_literal(START + dt.timedelta(hours=96))).first()
    assert after_gap["lag_1h"] is None


def test_split_positions(spark):
    frame = spark.range(12_216).select(F.lit(1).alias("z"), F.col("id").alias("t"))
    sizes = {r["split"]: r["count"] for r in series.with_split(frame, "z", "t").groupBy("split").count().collect()}
    assert sizes == {"train": 8551, "val": 1832, "test": 1833}
    few = series.with_split(spark.range(9).select(F.lit(1).alias("z"), F.col("id").alias("t")), "z", "t")
    assert few.filter("split is not null").isEmpty()


def test_zone_thresholds_agree_with_fit(spark):
    frames = training.feature_frames(hourly(spark, 400))
    fitted = series.fit_thresholds(frames.filter("split = 'train'"), ["pickup_location_id"])
    carried = training.thresholds_of(series.with_zone_thresholds(frames))
    assert sorted(fitted.collect()) == sorted(carried.select(*fitted.columns).collect())


def predictions(spark, rows):
    schema = (
        "pickup_location_id int, h int, predicted_class int, actual_class int, model_penalty double, baseline_penalty double"
    )
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumn("prediction_hour_ts", F.expr("timestamp'2024-01-01' + make_dt_interval(0, h)"))


@pytest.mark.parametrize(
    "costs, verdict, percent",
    [
        ([(5.0, 10.0)], "reduced", 50.0),
        ([(15.0, 10.0)], "increased", -50.0),
        ([(10.0, 10.0)], "matched", 0.0),
        ([(0.0, 0.0)], "no_cost", None),
        ([(10.0, 0.0)], "cost_without_baseline", None),
        ([(None, None)], "awaiting_settlement", None),
    ],
)
def test_savings_verdicts(spark, costs, verdict, percent):
    rows = [(1, i, 1, 1, m, b) for i, (m, b) in enumerate(costs)]
    row = evaluation.net_savings(predictions(spark, rows)).first()
    assert (row["verdict"], row["savings_percent"]) == (verdict, percent)


def test_signed_split_adds_up(spark):
    rows = [(1, h, h % 3, (h // 3) % 3, float(h), 0.0) for h in range(60)] + [(1, 99, 1, None, None, None)]
    pred = predictions(spark, rows).withColumn(
        "model_penalty", F.when(F.col("actual_class") != F.col("predicted_class"), F.col("model_penalty")).otherwise(
            F.when(F.col("actual_class").isNotNull(), 0.0))
    )
    bars = evaluation.signed_costs(pred)
    total = bars.agg(
        F.sum(F.col("underprediction_penalty") - F.col("overprediction_penalty")).alias("bars"),
        F.sum("model_penalty").alias("cost"),
    ).first()
    assert total["bars"] == total["cost"]


def test_report_requires_columns(spark):
    with pytest.raises(ValueError):
        report.report_rows(spark.createDataFrame([(1,)], "pickup_location_id int"))


def test_unseen_class_scores_zero(spark):
    frame = spark.createDataFrame([(1, 1), (2, 1), (1, 0)], "a int, p int")
    row = evaluation.classification_scores(frame, "a", "p").first()
    # precision: class 0 -> 0, class 1 -> 1/2, class 2 -> 0
    assert row["precision_macro"] == pytest.approx(1 / 6)
    assert row["accuracy"] == pytest.approx(1 / 3)


def test_grouped_quantiles_are_exact_with_a_hot_group(spark):
    from tidegrid.operators.group_quantile import grouped_quantiles

    value = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 7.0).otherwise(F.hash("id") % 100000 / 7)
    group = F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, None).otherwise((F.col("id") % 70).cast("string"))
    rows = spark.range(0, 20000, 1, 6).select(group.alias("g"), value.alias("x"))
    odd = spark.createDataFrame([("one", 5.0), ("same", 2.0), ("same", 2.0), ("far", -1e308), ("far", 1e308), ("far", 3.0), ("none", None), ("none", float("nan")), ("none", float("inf"))], "g string, x double")
    rows = rows.union(odd)
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in grouped_quantiles(rows, ["g"], "x", probs).collect()}
    usable = rows.where("x is not null and not isnan(x) and abs(x) < double('inf')")
    want = {r["g"]: (r["n"], r["q"]) for r in usable.groupBy("g").agg(F.count("*").alias("n"), F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert set(got) == set(want) and "none" not in got and None in got
    for g in want:
        assert got[g][0] == want[g][0] and got[g][1] == pytest.approx(want[g][1], rel=1e-12)
