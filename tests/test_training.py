"""Training in steps, the search and the chain from search to registered model."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import evaluation, labels, stepwise
from vitrine.operators.folds import early_stopping
from vitrine.operators.runs import best_epochs
from vitrine.plans import training
from vitrine.plans.ingest import Store
from vitrine.plans.training import train_and_register
from vitrine.session import fresh_dir

SMALL = {"hidden_l1": 4600, "hidden_l2": 3400, "hidden_l3": 2300, "epochs": 30}


def points(spark, n=160):
    """Two features, three classes that lie apart; one class is rare."""
    rng = random.Random(8)
    centres = {0: (0.0, 0.0), 1: (4.0, 0.0), 2: (0.0, 4.0)}
    rows = []
    for i in range(n):
        label = 2 if i % 10 == 0 else i % 2
        x, y = centres[label]
        rows.append((i, [x + rng.gauss(0, 0.4), y + rng.gauss(0, 0.4)], label))
    return spark.createDataFrame(rows, "product_id long, features array<float>, label int").coalesce(1)


@pytest.fixture(scope="module")
def split(spark):
    frame = labels.stratified_split(points(spark), "product_id", "label")
    parts = [frame.where(F.col("split") == name) for name in ("train", "val")]
    return stepwise.store_split(*parts, 3)


def test_steps_learn_and_are_measured(spark, split):
    run = stepwise.train_in_steps(split, SMALL)
    assert [r["epoch"] for r in run.curve] == list(range(1, len(run.curve) + 1)) and 1 <= len(run.curve) <= 6
    assert run.curve[-1]["train_loss"] < run.curve[0]["train_loss"]
    assert run.best["val_f1_macro"] == max(r["val_f1_macro"] for r in run.curve) > 0.8
    # The kept model is that of the best step.
    assert stepwise.validation_measures(run.model, split) == {k: run.best[k] for k in ("val_loss", "val_acc", "val_f1_macro")}
    curve = run.rows(spark, run_id="r")
    assert best_epochs(curve.withColumnRenamed("val_f1_macro", "val_f1")).first()["epoch"] == run.best_epoch
    assert curve.columns == ["run_id", "epoch", "train_loss", "val_loss", "val_acc", "val_f1_macro"]


def test_a_step_goes_on_where_the_last_one_ended(split):
    one = stepwise.train_in_steps(split, {**SMALL, "epochs": 5})
    two = stepwise.train_in_steps(split, {**SMALL, "epochs": 10})
    assert two.curve[0] == one.curve[0] and two.curve[1]["train_loss"] < one.curve[0]["train_loss"]


def test_early_stop_by_the_loss(spark, split):
    run = stepwise.train_in_steps(split, {**SMALL, "epochs": 200, "min_delta": 100.0, "patience_es": 7})
    # No fall is large enough after the first, so two further steps of five iterations end it.
    assert len(run.curve) == 3
    stop = early_stopping(run.rows(spark, run_id="r").select("run_id", "epoch", "val_loss"), 2, 100.0).first()
    assert stop["stop_epoch"] == 3


def test_layers_follow_the_features():
    params = {"hidden_l1": 1024, "hidden_l2": 512, "hidden_l3": 128}
    assert stepwise.hidden_sizes(params, 1152) == [1024, 512, 128] and stepwise.hidden_sizes(params, 4000) == [1024, 512, 128]
    assert stepwise.hidden_sizes(params, 64) == [57, 28, 7] and stepwise.hidden_sizes(params, 2) == [2, 2, 2]


def test_search_survives_bad_draws_but_not_bugs(spark, split):
    drawn = [SMALL | {"epochs": 5}, SMALL | {"batch_size": -1}, SMALL | {"epochs": 10, "learning_rate": 0.5}, SMALL | {"epochs": 0}]
    trials, curves = stepwise.search_in_steps(split, drawn, 3)
    found = {r["trial"]: r for r in trials.collect()}
    assert [found[i]["state"][:8] for i in range(4)] == ["COMPLETE", "FAIL: Il", "COMPLETE", "FAIL: Va"]
    assert found[1]["value"] == float("-inf") and found[2]["params"]["learning_rate"] == "0.5"
    steps = {r["trial"]: r["n"] for r in curves.groupBy("trial").agg(F.count("*").alias("n")).collect()}
    assert set(steps) == {0, 2} and steps[0] == 1
    with pytest.raises(KeyError):
        stepwise.search_in_steps(split, [{}], 1, lambda s, p: p["typo"])


def test_one_pass_measures_equal_the_separate_ones(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(4), [rng.gauss(0, 1) for _ in range(5)]) for _ in range(60)]
    frame = spark.createDataFrame(rows, "label int, logits array<double>").withColumn(
        "prediction", F.array_position("logits", F.array_max("logits")).cast("int") - 1)
    weights = F.lit([0.5, 1.0, 2.0, 0.0, 1.5])
    found = evaluation.loss_accuracy_and_f1(frame, weights).first()
    separate = evaluation.accuracy_and_macro_f1(frame).first()
    loss = evaluation.weighted_smoothed_loss(frame, weights).first()["loss"]
    assert found["accuracy"] == pytest.approx(separate["accuracy"]) and found["macro_f1"] == pytest.approx(separate["macro_f1"])
    assert found["loss"] == pytest.approx(loss)


def test_search_then_training_with_its_best(spark):
    store = Store(spark, fresh_dir(spark, "store"))
    rows = points(spark).select(
        "product_id", F.slice("features", 1, 1).alias("embedding_image"), F.slice("features", 2, 1).alias("embedding_text"),
        ((F.col("label") + 1) * 10).alias("prdtypecode"), F.lit("r").alias("run_id"))
    store.embeddings.write(rows)
    store.categories.write(spark.createDataFrame([("10", "a"), ("20", "b"), ("30", "c")], "code string, label string"))
    drawn = [SMALL | {"epochs": 5, "seed": 3, "hidden_l1": 1152}, SMALL | {"epochs": 15, "seed": 4}]
    result = train_and_register(store, data_run_id="b1", trials=drawn, parallelism=2)
    trials = {r["trial"]: r["value"] for r in store.read("trials").collect()}
    best = max(trials, key=lambda n: (trials[n], -n))
    run = store.read("training_runs").first()
    assert run["params"]["hidden_l1"] == str(drawn[best]["hidden_l1"]) and run["final_val_f1_macro"] == trials[best] == result["macro_f1"]
    curve = store.read("epoch_metrics").collect()
    assert all(v is not None and not (isinstance(v, float) and math.isnan(v)) for r in curve for v in r)
    assert run["best_val_loss"] == min(r["val_loss"] for r in curve) and result["stage"] == "Production"
    # The same batch again: nothing is searched or trained.
    assert train_and_register(store, data_run_id="b1", trials=drawn)["skipped"] and store.read("trials").count() == 2


def test_rows_are_split_and_decoded_once_for_search_and_training(spark, monkeypatch):
    made, kept = [], []

    def store_split(*args, **named):
        made.append(stepwise.store_split(*args, **named))
        return made[-1]

    def measures(model, split):
        kept.append((split.train.storageLevel.useMemory, split.val.storageLevel.useMemory))
        return stepwise_measures(model, split)

    stepwise_measures = stepwise.validation_measures
    monkeypatch.setattr(training, "store_split", store_split)
    monkeypatch.setattr(stepwise, "validation_measures", measures)
    store = Store(spark, fresh_dir(spark, "store"))
    store.embeddings.write(points(spark).select(
        "product_id", F.slice("features", 1, 1).alias("embedding_image"), F.slice("features", 2, 1).alias("embedding_text"),
        ((F.col("label") + 1) * 10).alias("prdtypecode"), F.lit("r").alias("run_id")))
    store.categories.write(spark.createDataFrame([("10", "a"), ("20", "b"), ("30", "c")], "code string, label string"))
    train_and_register(store, data_run_id="b", trials=[SMALL | {"epochs": 5}, SMALL | {"epochs": 10}], parallelism=2)
    assert len(made) == 1 and len(kept) >= 4 and all(a and b for a, b in kept)
    assert not made[0].train.storageLevel.useMemory and not made[0].val.storageLevel.useMemory
    with pytest.raises(RuntimeError):
        train_and_register(store, data_run_id="c", trials=[SMALL | {"epochs": 0}])
    assert not made[-1].train.storageLevel.useMemory
