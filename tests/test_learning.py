"""The experiment matrix at full settings, run once for the whole session."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidegrid.ml import experiments, models, search
from tidegrid.registry import learning
from tidegrid.registry.views import Views

QUERIES = contract.queries()


@pytest.fixture(scope="module")
def log(spark, small):
    return learning.run_log(Views(spark, small)).collect()


def test_the_whole_plan_is_run(log):
    runs = [(r["run_name"], r["model_family"], r["tuned"]) for r in log if r["phase"] == "validation"]
    assert sorted(runs) == sorted(experiments.EXPERIMENT_PLAN)
    tested = [r for r in log if r["phase"] == "test"]
    best = min((r for r in log if r["phase"] == "validation"), key=lambda r: (r["metrics"]["val_mean_penalty"], r["run_order"]))
    assert [r["run_name"] for r in tested] == [best["run_name"]]


def test_tuned_parameters_lie_in_the_whole_spaces(log):
    for r in log:
        params = json.loads(r["params"])
        if not r["tuned"]:
            assert params == {}
            continue
        space = experiments.SEARCH_SPACES[r["model_family"]]
        assert set(params) == set(space)
        for name, (kind, *args) in space.items():
            assert params[name] in args[0] if kind == "choice" else args[0] <= params[name] <= args[1]


def test_queries_read_the_one_matrix(spark, small, log, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("fitted again")

    monkeypatch.setattr(models, "fit_all", refuse)
    assert QUERIES["k7_parameter_search"](spark, small).count() == 3
    assert QUERIES["k8_experiment_matrix"](spark, small).count() == 6
    assert QUERIES["f6_champion_choice"](spark, small).count() == 1
    assert {r["metric"] for r in QUERIES["k9_retrain_and_test"](spark, small).collect()} == {f"test_{m}" for m in experiments.METRICS}
    assert QUERIES["l6_train_champion"](spark, small).where("phase = 'test'").count() == 1
    assert QUERIES["k10_champion_round_trip"](spark, small).first()["features"] == 13


def test_every_family_draws_twenty_trials(spark, small, monkeypatch):
    """Counted with stand-in losses; the real fits are those of the matrix."""
    drawn = Counter()

    def fit_all(family, trials, train, parallel=4):
        drawn[family] += len(trials)
        return trials

    monkeypatch.setattr(models, "fit_all", fit_all)
    monkeypatch.setattr(experiments, "penalties", lambda fitted, frame: [float(i) for i, _ in enumerate(fitted)])
    for family in models.FAMILIES:
        experiments.tune(family, None, None)
    assert drawn == {f: 20 for f in models.FAMILIES} and search.STARTUP == 10


def test_the_winning_trial_is_not_fitted_again(monkeypatch):
    """A family's two runs fit 20 trials and the defaults, and the tuned run is scored with the model of its best trial."""

    class Ready:
        def __init__(self, train):
            pass

    fitted = []

    def fit_all(family, trials, train, parallel=4):
        made = [(family, len(fitted) + i, p) for i, p in enumerate(trials)]
        fitted.extend(made)
        return made

    monkeypatch.setattr(models, "TrainingSet", Ready)
    monkeypatch.setattr(models, "fit_all", fit_all)
    monkeypatch.setattr(experiments, "penalties", lambda batch, frame: [abs(m[1] - 12) // 2 + 1.0 for m in batch])
    monkeypatch.setattr(experiments, "evaluate", lambda model, frame, prefix: {"model": model})
    tuned_only = [("only", models.BOOSTED, True)]
    [run] = experiments.run_experiments(None, None, plan=tuned_only)
    assert len(fitted) == 20 and run.metrics["model"] == fitted[11] and run.params == fitted[11][2]  # 11, 12 and 13 are equal
    fitted.clear()
    both = experiments.run_experiments(None, None, plan=[("plain", models.FOREST, False), ("tuned", models.FOREST, True)])
    assert [(r.run_order, r.run_name, r.tuned) for r in both] == [(1, "plain", False), (2, "tuned", True)] and len(fitted) == 21


def test_champion_scores_like_its_run(spark, small, log):
    """The reloaded champion, refitted on train and validation rows, has the logged test penalty."""
    v = Views(spark, small)
    model, _ = models.load_champion(spark, learning.trained(v).champion)
    frames = learning.labelled(v).filter(F.col("split") == "test")
    [tested] = [r for r in log if r["phase"] == "test"]
    assert experiments.penalties([model], frames) == pytest.approx([tested["metrics"]["test_mean_penalty"]])
