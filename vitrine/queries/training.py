"""Training queries: search, curve of a run, and scoring with the model in production."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.operators.folds import early_stopping
from vitrine.operators.model import DEFAULT_PARAMS, sample_params
from vitrine.operators.runs import best_epochs
from vitrine.operators.vectors import as_ml_vector
from vitrine.plans.ingest import Store
from vitrine.plans.training import production_scorer, train_and_register
from vitrine.queries.adapters import Tables, with_tables
from vitrine.queries.registry import query
from vitrine.session import fresh_dir

PARALLEL = 8
_DRAWN = list(sample_params()[0])


def _trials_sql() -> str:
    rows = ", ".join("(" + ", ".join([str(n), *(f"'{p[name]}'" for name in _DRAWN)]) + ")" for n, p in enumerate(sample_params()))
    return f"""
    WITH drawn(trial, {", ".join(_DRAWN)}) AS (VALUES {rows})
    SELECT *, 'COMPLETE' AS state, true AS value_in_range, true AS stepped, true AS best_is_trained FROM drawn"""


def _stored(t: Tables) -> Store:
    """A store that holds the given vectors and their class map."""
    store = Store(t.spark, fresh_dir(t.spark, "store"))
    store.embeddings.write(t.embeddings)
    codes = t.embeddings.select(F.col("prdtypecode").cast("string").alias("code")).distinct()
    store.categories.write(codes.select("code", F.concat(F.lit("category_"), "code").alias("label")))
    return store


@query("search_trials", _trials_sql())
def search_trials(t: Tables):
    """The whole search, then a training with the best trial's parameters.

    ``best_is_trained``: the registered run has the parameters of the trial with the highest F1, the earlier on ties.
    """
    store = _stored(t)
    result = train_and_register(store, data_run_id="all", trials=sample_params(), parallelism=PARALLEL)
    run = store.read("training_runs").where(F.col("run_id") == result["run_id"]).first()
    steps = store.read("trial_curves").groupBy("trial").agg(
        F.count("*").alias("steps"), F.max("val_f1_macro").alias("highest"), F.max("epoch").alias("last"))
    place = F.row_number().over(Window.orderBy(F.desc("value"), "trial"))  # 20 trials
    trained = F.lit(True)
    for name in _DRAWN:
        trained &= F.col("params")[name] == run["params"][name]
    return (store.read("trials").withColumn("place", place).join(steps, "trial").select(
        "trial", *(F.col("params")[name].alias(name) for name in _DRAWN), "state",
        F.col("value").between(0, 1).alias("value_in_range"),
        ((F.col("steps") == F.col("last")) & (F.col("last") <= 10) & (F.col("highest") == F.col("value"))).alias("stepped"),
        (trained == (F.col("place") == 1)).alias("best_is_trained")))


@query("epoch_metrics", with_tables("emb") + f"""
    SELECT true AS curve_is_whole, {DEFAULT_PARAMS["epochs"]} AS iterations_set, true AS best_epoch_is_kept, true AS best_loss_is_kept,
           true AS stop_agrees, count(*) AS data_nb_samples, count(DISTINCT prdtypecode) AS data_nb_classes FROM emb""")
def epoch_metrics(t: Tables):
    """One run trained in steps with the usual parameters; its stored curve goes through the epoch operators."""
    store = _stored(t)
    result = train_and_register(store, data_run_id="all")
    curve = store.read("epoch_metrics")
    run = store.read("training_runs")
    measured = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("train_loss", "val_loss", "val_acc", "val_f1_macro")]
    whole = curve.agg(F.bool_and(measured[0] & measured[1] & measured[2] & measured[3]).alias("all"), F.count("*").alias("n"),
                      F.max("epoch").alias("last"), F.min("val_loss").alias("lowest")).first()
    best = best_epochs(curve.withColumnRenamed("val_f1_macro", "val_f1")).first()
    patience = -(-DEFAULT_PARAMS["patience_es"] // 5)  # a step is five iterations
    stop = early_stopping(curve.select("run_id", "epoch", "val_loss"), patience, DEFAULT_PARAMS["min_delta"]).first()
    # Training ended where the operator says, or when its iterations were used up.
    agrees = stop["stop_epoch"] == whole["last"] if stop["stop_epoch"] is not None else whole["last"] == DEFAULT_PARAMS["epochs"] // 5
    return run.select(
        F.lit(whole["all"] and whole["n"] == whole["last"]).alias("curve_is_whole"),
        F.col("params")["epochs"].cast("int").alias("iterations_set"),
        ((F.col("final_val_f1_macro") == best["val_f1"]) & (F.col("final_val_acc") == best["val_acc"])
         & F.lit(result["macro_f1"] == best["val_f1"])).alias("best_epoch_is_kept"),
        (F.col("best_val_loss") == whole["lowest"]).alias("best_loss_is_kept"), F.lit(agrees).alias("stop_agrees"),
        F.col("params")["data_nb_samples"].cast("long").alias("data_nb_samples"),
        F.col("params")["data_nb_classes"].cast("long").alias("data_nb_classes"))


@query("production_scores", with_tables("ranked", "emb").rstrip() + """,
    codes AS (SELECT prdtypecode AS code, row_number() OVER (ORDER BY prdtypecode) - 1 AS i
              FROM (SELECT DISTINCT prdtypecode FROM emb))
    SELECT product_id, place, class_index, coalesce('category_' || code, 'class_' || class_index) AS label,
           round(p, 5) AS confidence
    FROM ranked LEFT JOIN codes ON i = class_index WHERE place <= 5""")
def production_scores(t: Tables):
    """A model stored, promoted, loaded by its stage and used with its own class map.

    Its coefficients are fixed: the output of a class is the component of the vector with that number.
    """
    store = _stored(t)
    parts = t.embeddings.select(F.size("embedding_text"), F.size("embedding_image")).first()

    def fixed(train):
        # Fused vectors hold the image part first, as the given ones do.
        width = sum(parts)
        weights = np.eye(width)
        # Without iterations the learner hands back the weights it was given; the last ones are added to every output.
        learner = MultilayerPerceptronClassifier(
            layers=[width, width], featuresCol="vector", labelCol="label", maxIter=0,
            initialWeights=Vectors.dense([*weights.ravel(order="F"), *np.zeros(width)]))
        return learner.fit(as_ml_vector(train))

    train_and_register(store, fixed, data_run_id="all")
    # A code that comes later moves no label of the model in use.
    store.categories.write(store.categories.read().union(
        t.spark.createDataFrame([("1", "newcomer")], "code string, label string")))
    score, _ = production_scorer(store)
    return score(t.embeddings).select("product_id", F.posexplode("top5").alias("pos", "s")).select(
        "product_id", (F.col("pos") + 1).cast("long").alias("place"), F.col("s.class_index").cast("long").alias("class_index"),
        F.col("s.label").alias("label"), F.round("s.confidence", 5).alias("confidence"))
