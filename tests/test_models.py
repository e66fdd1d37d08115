import pytest
from pyspark.sql import functions as F

from tidegrid.ml import experiments, models, search
from tidegrid.schemas import FEATURES


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    """Labelled rows whose class follows lag_1h, over two zones and three splits."""
    rows = spark.range(900).select(
        (F.col("id") % 2).cast("int").alias("pickup_location_id"),
        (F.col("id") % 3).cast("int").alias("demand_class"),
        F.when(F.col("id") < 600, "train").when(F.col("id") < 750, "val").otherwise("test").alias("split"),
        *[(F.hash("id", F.lit(i)) % 100 / 10.0).alias(f) for i, f in enumerate(FEATURES)],
    )
    frame = rows.withColumn("lag_1h", F.col("demand_class") * 50.0 + F.col("lag_2h"))
    path = str(tmp_path_factory.mktemp("frames") / "f")
    frame.write.parquet(path)
    return spark.read.parquet(path)


PARAMS = {
    models.LOGISTIC: {"max_iter": 20, "class_weight": "balanced"},
    models.FOREST: {"n_estimators": 30, "max_depth": 6},
    models.BOOSTED: {"n_estimators": 20, "max_depth": 3},
}


@pytest.mark.parametrize("family", models.FAMILIES)
def test_families_learn_and_reload(spark, frames, tmp_path, family):
    train, test = frames.filter("split = 'train'"), frames.filter("split = 'test'")
    model = models.fit(family, PARAMS[family], train)
    scores = experiments.evaluate(model, test, "test")
    assert scores["test_accuracy"] > 0.9
    meta = models.ChampionMetadata(
        pickup_location_id=None, model_name=family, mlflow_run_id="r", run_name="n", tuned=False,
        best_params=PARAMS[family], q25=1.0, q75=2.0, features=FEATURES, test_metrics=scores, classes=list(model.classes),
    )
    models.save_champion(spark, model, meta, str(tmp_path / "m"))
    loaded, again = models.load_champion(spark, str(tmp_path / "m"))
    assert again == meta
    columns = [*models.PROBABILITIES, "predicted_class"]
    a, b = (m.predict(models.as_model_input(test)).select(*columns) for m in (model, loaded))
    assert sorted(a.collect()) == sorted(b.collect())
    sums = a.select(sum(F.col(p) for p in models.PROBABILITIES).alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).isEmpty()


def test_absent_class_is_null_and_never_chosen_by_probability(frames):
    model = models.fit(models.FOREST, PARAMS[models.FOREST], frames.filter("demand_class < 2"))
    row = model.predict(models.as_model_input(frames)).agg(
        F.count("prob_class_2").alias("known"), F.max("predicted_class").alias("top")
    ).first()
    assert row["known"] == 0 and row["top"] <= 1


def test_search_is_seeded_and_in_range():
    import random

    for space in experiments.SEARCH_SPACES.values():
        a, b = (search.draw_parameters(space, random.Random(1)) for _ in range(2))
        assert a == b and set(a) == set(space)
        for name, (kind, *args) in space.items():
            assert a[name] in args[0] if kind == "choice" else args[0] <= a[name] <= args[1]


def test_nulls_are_filled_with_exact_medians(frames):
    train = frames.filter("split = 'train'")
    model = models.fit(models.FOREST, {"n_estimators": 3}, train)
    want = train.agg(F.percentile("lag_2h", 0.5)).first()[0]
    assert model.medians["lag_2h"] == pytest.approx(want)
    row = models.as_model_input(frames.limit(1))
    blank, filled = row.withColumn("lag_2h", F.lit(None).cast("double")), row.withColumn("lag_2h", F.lit(want))
    assert model.predict(blank).first()["prob_class_0"] == model.predict(filled).first()["prob_class_0"]


def test_a_batch_is_scored_like_one_by_one(frames):
    train, val = frames.filter("split = 'train'"), frames.filter("split = 'val'")
    ready = models.TrainingSet(train)
    fitted = [*models.fit_all(models.FOREST, [{"n_estimators": 2}, {"n_estimators": 4, "max_depth": 2}], ready), models.fit(models.LOGISTIC, {"max_iter": 5}, ready)]
    assert experiments.penalties(fitted, val) == pytest.approx([experiments.evaluate(m, val, "v")["v_mean_penalty"] for m in fitted])


def test_first_of_equal_runs_is_champion():
    def run(order, loss):
        return experiments.Experiment(f"r{order}", order, f"n{order}", models.FOREST, False, {}, {"val_mean_penalty": loss})

    assert experiments.choose_champion([run(1, 2.0), run(2, 1.0), run(3, 1.0)]).run_order == 2
    with pytest.raises(ValueError):
        experiments.choose_champion([])
