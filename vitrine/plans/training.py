"""Training flow: embeddings to a registered, compared model."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext
from datetime import datetime, timezone

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.evaluation import accuracy_and_macro_f1, loss_accuracy_and_f1
from vitrine.operators.labels import class_index, class_weights, encode_labels, index_to_label, stratified_split
from vitrine.operators.model import DEFAULT_PARAMS, model_probabilities, sample_params, scorer_of, search, train_logistic
from vitrine.operators.quality import training_needed
from vitrine.operators.registry import promote
from vitrine.operators.runs import append_row, newest_run, trial_summary
from vitrine.operators.stepwise import StoredSplit, held, search_in_steps, store_split, train_in_steps
from vitrine.operators.vectors import as_ml_vector, with_fused
from vitrine.plans.ingest import Store
from vitrine.plans.reports import cumulative_stats
from vitrine.plans.scoring import label_lookup, rank_probabilities

MODEL_NAME = "product-classifier"
TRAINING_RUN = (
    "run_id string, params map<string,string>, final_val_acc double, final_val_f1_macro double, "
    "best_val_loss double, data_run_id string, git_sha string, start_time timestamp_ntz, end_time timestamp_ntz"
)
EPOCH_METRICS = ("run_id string, epoch int, train_loss double, val_loss double, val_acc double, "
                 "val_f1_macro double")
MODEL_VERSION = "name string, version int, run_id string, stage string"


def training_frame(embeddings: DataFrame, categories: DataFrame) -> DataFrame:
    """product_id, features, label, split from the embeddings table and the class map."""
    index = class_index(categories)
    labelled = encode_labels(with_fused(embeddings), index).withColumnRenamed("class_index", "label")
    return stratified_split(labelled, "product_id", "label").select("product_id", "features", "label", "split")


def split_parts(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "val")


def train_and_measure(frame: DataFrame, fit: Callable[[DataFrame], Model] = train_logistic) -> tuple[Model, dict]:
    """(model, measures on the validation rows)."""
    train, val = split_parts(frame)
    model = fit(train)
    scored = scorer_of(model).transform(as_ml_vector(val))
    predictions = scored.select("label", F.col("prediction").cast("int").alias("prediction"))
    return model, accuracy_and_macro_f1(predictions).first().asDict()


def data_statistics(frame: DataFrame) -> DataFrame:
    """Sample, class and split counts stored with a run."""
    return frame.agg(
        F.count("*").alias("data_nb_samples"),
        F.countDistinct("label").alias("data_nb_classes"),
        F.count_if(F.col("split") == "train").alias("data_nb_train"),
        F.count_if(F.col("split") == "val").alias("data_nb_val"))


def tune(store: Store, frame: DataFrame, fit: Callable[[DataFrame, dict], Model] | None = None,
         params: list[dict] | None = None, parallelism: int = 4, split: StoredSplit | None = None) -> dict:
    """Search parameters, keep the trials, return the best ones; an error when every trial failed.

    Without ``fit`` the trials are trained in steps, side by side, and their curves are kept too; ``split`` holds the
    parts of ``frame`` if they are stored already.
    """
    train, val = split_parts(frame)
    drawn = sample_params() if params is None else params
    study = uuid.uuid4().hex
    if fit is None:
        with nullcontext(split) if split else held(store_split(train, val, class_count(frame))) as stored:
            trials, curves = search_in_steps(stored, drawn, parallelism)
        curves.withColumn("study", F.lit(study)).write.mode("append").parquet(store.path("trial_curves"))
    else:
        trials = search(train, val, fit, drawn)
    trials.withColumn("study", F.lit(study)).write.mode("append").parquet(store.path("trials"))
    best = trial_summary(trials.where(F.col("value") > float("-inf"))).first()
    if not best["n_trials_completed"]:
        raise RuntimeError("no trial completed")
    return dict(best["best_params"])


def class_count(frame: DataFrame) -> int:
    """Classes a head needs for the labels of a training frame."""
    return frame.agg(F.max("label")).first()[0] + 1


def measured_curve(model: Model, frame: DataFrame, measures: dict) -> list[dict]:
    """Curve of a head that was fitted in one go: its losses, and the validation measures at its end."""
    losses = []
    if getattr(model, "hasSummary", False):
        summary = model.summary
        losses = list((summary() if callable(summary) else summary).objectiveHistory)
    train, val = split_parts(frame)
    known = {r["label"]: r["weight"] for r in class_weights(train, "label").collect()}
    scored = scorer_of(model).transform(as_ml_vector(val)).select("label", F.col("prediction").cast("int").alias("prediction"),
                                                       vector_to_array("rawPrediction").alias("logits"))
    outputs = scored.select(F.size("logits")).first()[0]
    loss = loss_accuracy_and_f1(scored, F.lit([float(known.get(i, 0.0)) for i in range(outputs)])).first()["loss"]
    rows = [{"epoch": i + 1, "train_loss": float(x), "val_loss": None, "val_acc": None, "val_f1_macro": None}
            for i, x in enumerate(losses or [float("nan")])]
    rows[-1] |= {"val_loss": loss, "val_acc": measures["accuracy"], "val_f1_macro": measures["macro_f1"]}
    return rows


def train_and_register(store: Store, fit: Callable[[DataFrame], Model] | None = None, params: dict | None = None,
                       git_sha: str | None = None, data_run_id: str | None = None, trials: list[dict] | None = None,
                       parallelism: int = 4) -> dict:
    """Train on the stored embeddings, keep the run, register and compare the model.

    Skipped when the production model was trained on the same data batch. The
    batch is the newest one of the run log unless named. Without ``fit`` the head
    is trained in steps with ``params``, and every step's measures are kept; with
    ``trials`` (see ``sample_params``) these are searched first, on the same
    rows, and the head is trained with the best of them.
    """
    spark = store.spark
    runs = store.read("runs")
    if data_run_id is None and runs is not None:
        newest = newest_run(runs.withColumn("start_time", F.col("dt_ingested"))).first()
        data_run_id = newest["run_id"] if newest else None
    versions = store.model_versions.read()
    history = store.read("training_runs")
    if versions is not None and history is not None and not training_needed(data_run_id, versions, history):
        return {"skipped": True, "data_run_id": data_run_id}

    begin = datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = uuid.uuid4().hex
    embeddings = store.embeddings.read()
    # Written once: the fits read its rows many times and must see the same ones.
    training_frame(embeddings, store.categories.read()).write.parquet(store.path(f"training_data/{run_id}"))
    frame = spark.read.parquet(store.path(f"training_data/{run_id}"))
    if fit is None:
        # One split, decoded once, serves the search and the training after it.
        with held(store_split(*split_parts(frame), class_count(frame))) as split:
            if trials is not None:
                params = {**(params or {}), **tune(store, frame, None, trials, parallelism, split)}
            params = {**DEFAULT_PARAMS, **(params or {})}
            run = train_in_steps(split, params)
        model, curve = run.model, run.curve
        measures = {"accuracy": run.best["val_acc"], "macro_f1": run.best["val_f1_macro"]}
    else:
        if trials is not None:
            params = {**(params or {}), **tune(store, frame, None, trials, parallelism)}
        model, measures = train_and_measure(frame, fit)
        curve = measured_curve(model, frame, measures)
    model.write().save(store.path(f"models/{run_id}"))
    # The model's own class map: codes that come later don't shift its indices.
    categories = store.categories.read()
    index_to_label(class_index(categories), categories).write.parquet(store.path(f"class_maps/{run_id}"))

    statistics = {k: str(v) for k, v in data_statistics(frame).first().asDict().items()}
    stats = cumulative_stats(embeddings).first()
    if stats:
        statistics |= {"data_total_products": str(stats["total_products"]),
                       "data_imbalance_ratio": str(stats["imbalance_ratio"])}
    spark.createDataFrame([{"run_id": run_id, **r} for r in curve], EPOCH_METRICS).write.mode("append").parquet(
        store.path("epoch_metrics"))
    append_row(spark, store.path("training_runs"), {
        "run_id": run_id, "params": {k: str(v) for k, v in (params or {}).items()} | statistics,
        "final_val_acc": measures["accuracy"], "final_val_f1_macro": measures["macro_f1"],
        "best_val_loss": min((r["val_loss"] for r in curve if r["val_loss"] is not None), default=None),
        "data_run_id": data_run_id, "git_sha": git_sha, "start_time": begin,
        "end_time": datetime.now(timezone.utc).replace(tzinfo=None)}, TRAINING_RUN)

    challengers = spark.createDataFrame([(MODEL_NAME, run_id)], "name string, run_id string")
    known = versions if versions is not None else spark.createDataFrame([], MODEL_VERSION)
    after = promote(known, challengers, store.read("training_runs"))
    store.model_versions.write(after.withColumn("version", F.col("version").cast("int")))
    stage = store.model_versions.read().where(F.col("run_id") == run_id).first()["stage"]
    return {"run_id": run_id, "data_run_id": data_run_id, "stage": stage, **measures}


def production_scorer(store: Store, name: str = MODEL_NAME) -> tuple[Callable[[DataFrame], DataFrame], int]:
    """(function that scores frames with both vectors, version) of the model in production.

    It uses the class map stored with the run that made the model. The function works on tables and streams.
    """
    versions = store.model_versions.read()
    current = None if versions is None else (
        versions.where((F.col("name") == name) & (F.col("stage") == "Production")).orderBy(F.desc("version")).first())
    if current is None:
        raise LookupError(f"no production version of {name}")
    run_id = current["run_id"]
    model = DefaultParamsReader.loadParamsInstance(store.path(f"models/{run_id}"), store.spark.sparkContext)
    labels = label_lookup(store.spark.read.parquet(store.path(f"class_maps/{run_id}")))

    def score(df: DataFrame) -> DataFrame:
        return rank_probabilities(model_probabilities(with_fused(df), model), labels)

    return score, current["version"]
