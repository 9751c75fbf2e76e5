from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import folds, runs
from vitrine.operators.registry import promote
from vitrine.session import fresh_dir


def curves(spark, losses: dict):
    rows = [(run, epoch, float(loss)) for run, values in losses.items() for epoch, loss in enumerate(values, 1)]
    return spark.createDataFrame(rows, "run_id string, epoch int, val_loss double")


def brute_stop(losses, patience, delta):
    best, best_epoch, counter = float("inf"), None, 0
    for epoch, loss in enumerate(losses, 1):
        if loss < best - delta:
            best, best_epoch, counter = loss, epoch, 0
        else:
            counter += 1
            if counter >= patience:
                return best, best_epoch, epoch
    return best, best_epoch, None


def stops(frame):
    return {r.run_id: (r.best_loss, r.best_epoch, r.stop_epoch) for r in frame.collect()}


def test_early_stopping_examples(spark):
    none, nan = None, float("nan")
    losses = {"sinking": [4.0, 2.5, 1.0, 0.5], "level": [3.0] * 6, "gaps": [1.0, 2.0, none, 2.0, 2.0],
              "late": [1.0, none, none, none, none], "empty": [none, nan, nan], "nan": [nan, 2.0, nan, 1.5]}
    rows = [(run, epoch, loss) for run, values in losses.items() for epoch, loss in enumerate(values, 1)]
    frame = spark.createDataFrame(rows, "run_id string, epoch int, val_loss double")
    assert stops(folds.early_stopping(frame, patience=2, min_delta=0.0)) == {
        "sinking": (0.5, 4, None), "level": (3.0, 1, 3), "gaps": (1.0, 1, 3), "late": (1.0, 1, 3),
        "empty": (float("inf"), None, 2), "nan": (1.5, 4, None)}


@pytest.mark.parametrize(("patience", "delta"), [(1, 0.0), (3, 0.05), (7, 1e-4), (7, 0.3)])
def test_early_stopping_equals_brute_force(spark, monkeypatch, patience, delta):
    monkeypatch.setattr(folds, "BLOCK", 8)
    rng = random.Random(5)
    losses = {f"noise{i}": [round(rng.random(), 2) for _ in range(rng.randint(1, 60))] for i in range(20)}
    losses |= {f"falling{i}": [1 - 0.01 * e + rng.random() * 0.05 for e in range(50)] for i in range(10)}
    losses["steady"] = [1 - 0.001 * e for e in range(200)]
    frame = curves(spark, losses)
    got = stops(folds.early_stopping(frame, patience, delta))
    assert got == {run: brute_stop(values, patience, delta) for run, values in losses.items()}


def test_learning_rates(spark):
    losses = [1.0, 0.9, 0.9, 0.9, 0.9, 0.9, 0.8, 0.8]
    got = folds.learning_rates(curves(spark, {"a": losses, "b": [1.0]})).orderBy("run_id", "epoch").collect()
    assert [r.learning_rate for r in got] == [1e-3] * 5 + [5e-4] * 3 + [1e-3]


def test_best_epoch_first_on_ties_and_none_at_zero(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0.5, .1, 1.0), ("a", 2, 0.7, .2, 0.9), ("a", 3, 0.7, .3, 0.8), ("b", 1, 0.0, .4, 1.0)],
        "run_id string, epoch int, val_f1 double, val_acc double, val_loss double")
    assert {(r.run_id, r.epoch) for r in runs.best_epochs(rows).collect()} == {("a", 2)}
    final = {r.run_id: r for r in runs.final_metrics(rows).collect()}
    assert (final["a"].final_val_acc, final["a"].final_val_f1_macro, final["a"].best_val_loss) == (.2, 0.7, 0.8)


def test_trials(spark):
    rows = spark.createDataFrame(
        [(0, 0.5, "COMPLETE", "p0"), (1, 0.7, "COMPLETE", "p1"), (2, 0.7, "COMPLETE", "p2"),
         (3, 0.9, "PRUNED", "p3"), (4, float("-inf"), "COMPLETE", "p4")],
        "trial int, value double, state string, params string")
    got = runs.trial_summary(rows).first()
    assert (got.n_trials_completed, got.best_value, got.best_trial, got.best_params) == (4, 0.7, 1, "p1")


def test_median_pruning(spark):
    trials = spark.createDataFrame([(i, "COMPLETE") for i in range(10)] + [(10, "PRUNED"), (11, "COMPLETE")],
                                   "trial int, state string")
    reports = spark.createDataFrame(
        [(t, s, 0.5 + 0.01 * t) for t in range(10) for s in range(20)]
        + [(10, s, 0.1) for s in range(20)] + [(11, s, 0.9) for s in range(20)],
        "trial int, step int, value double")
    cut = {(r.trial, r.step) for r in runs.median_pruning(reports, trials).where("pruned").collect()}
    assert cut == {(10, s) for s in range(15, 20)}


def registry(spark, rows):
    return spark.createDataFrame(rows, "name string, version int, run_id string, stage string")


def history(spark, rows):
    return spark.createDataFrame(rows, "run_id string, final_val_f1_macro double")


def challenger(spark):
    return spark.createDataFrame([("m", "new")], "name string, run_id string")


def test_better_challenger_is_promoted(spark):
    versions = registry(spark, [("m", 1, "r1", "Archived"), ("m", 2, "r2", "Production"), ("m", 3, "r3", "None"),
                                ("other", 1, "r2", "Production")])
    f1 = history(spark, [("r1", 0.1), ("r2", 0.5), ("r3", 0.2), ("new", 0.6)])
    got = {tuple(r) for r in promote(versions, challenger(spark), f1).collect()}
    assert got == {("m", 3, "r3", "None"), ("m", 4, "new", "Production"), ("other", 1, "r2", "Production")}


@pytest.mark.parametrize("score", [0.5, 0.4])
def test_equal_or_worse_challenger_is_only_registered(spark, score):
    versions = registry(spark, [("m", 1, "r1", "Archived"), ("m", 2, "r2", "Production")])
    f1 = history(spark, [("r1", 0.1), ("r2", 0.5), ("new", score)])
    got = {tuple(r) for r in promote(versions, challenger(spark), f1).collect()}
    assert got == {("m", 1, "r1", "Archived"), ("m", 2, "r2", "Production"), ("m", 3, "new", "None")}


def test_first_model_needs_an_f1_above_zero(spark):
    none = registry(spark, [])
    assert promote(none, challenger(spark), history(spark, [("new", 0.1)])).first().stage == "Production"
    assert promote(none, challenger(spark), history(spark, [("new", 0.0)])).first().stage == "None"


def test_run_log(spark):
    path = fresh_dir(spark, "runs")
    runs.log_run(spark, path, {"run_id": "b1", "nb_images": 3, "quality_passed": True})
    runs.log_run(spark, path, {"run_id": "b2"})
    rows = {r.run_id: r for r in spark.read.parquet(path).collect()}
    assert rows["b1"].nb_images == 3 and rows["b1"].quality_passed and rows["b2"].nb_images is None


def test_history_table_keeps_epochs(spark):
    path = fresh_dir(spark, "epochs")
    schema = "run_id string, epoch int, train_loss double, val_loss double, val_acc double, val_f1_macro double"
    for epoch in range(3):
        runs.append_row(spark, path, {"run_id": "r", "epoch": epoch, "val_loss": 1.0 - epoch / 10}, schema)
    assert spark.read.parquet(path).agg(F.min("val_loss")).first()[0] == pytest.approx(0.8)
