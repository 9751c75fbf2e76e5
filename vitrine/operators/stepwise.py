"""Heads trained in warm-started steps, measured on validation rows after every step, and their search.

A step is a few L-BFGS iterations of ``MultilayerPerceptronClassifier`` that begin at the weights of the step before.
After it the validation rows give loss, accuracy and macro F1; the step with the best F1 gives the model, and training
ends when the loss has not fallen for ``patience_es`` iterations. Rows are Spark's all the way: the driver keeps the
curve and the weights, whose number depends on the layers alone.

Of the parameters the learner reads: ``hidden_l1..3`` (sizes for ``FULL_WIDTH`` features, narrower input has narrower
layers in proportion), ``batch_size`` (rows stacked to one block), ``epochs`` (iterations in all), ``seed``,
``patience_es`` and ``min_delta`` (early stop), and ``learning_rate`` with ``weight_decay`` (weights shrink by their product
at every iteration, as decoupled weight decay does). L-BFGS finds its own step lengths and Spark's layers are sigmoid
without dropout, so ``dropout`` and ``activation`` are kept with a trial but change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from vitrine.functions.common import MAX_CLASSES
from vitrine.operators.evaluation import loss_accuracy_and_f1
from vitrine.operators.labels import class_weights, with_class_weight
from vitrine.operators.model import DEFAULT_PARAMS, TRIAL_ERRORS, oversample, scorer_of
from vitrine.operators.vectors import as_ml_vector
from vitrine.session import fresh_dir

FULL_WIDTH = 1152
STEP_ITERATIONS = 5
TRIALS = "trial int, params map<string,string>, value double, state string"
CURVE = "epoch int, train_loss double, val_loss double, val_acc double, val_f1_macro double"


@dataclass
class StepRun:
    """A finished training: the model of the best step, its number, and the measures after every step."""

    model: Model
    best_epoch: int
    curve: list[dict] = field(repr=False)

    @property
    def best(self) -> dict:
        return self.curve[self.best_epoch - 1]

    def rows(self, spark: SparkSession, **ids) -> DataFrame:
        """The curve as a frame; ``ids`` are columns put in front."""
        frame = spark.createDataFrame([tuple(r[k] for k in _CURVE_NAMES) for r in self.curve], CURVE)
        return frame.select(*(F.lit(v).alias(k) for k, v in ids.items()), "*")


_CURVE_NAMES = [part.split()[0] for part in CURVE.split(", ")]


def hidden_sizes(params: dict, width: int) -> list[int]:
    """Layer sizes in proportion to the features."""
    return [max(2, round(float(params[name]) * min(width, FULL_WIDTH) / FULL_WIDTH)) for name in ("hidden_l1", "hidden_l2", "hidden_l3")]


@dataclass(frozen=True)
class StoredSplit:
    """Training and validation rows as the learner reads them, stored once for all trainings on them."""

    train: DataFrame
    val: DataFrame
    width: int
    classes: int
    weights: list[float]


def store_split(train: DataFrame, val: DataFrame, classes: int, label: str = "label", features: str = "features",
                key: str = "product_id", seed: int = 42) -> StoredSplit:
    """Write both parts to the shared folder, training rows repeated in proportion to their class weight.

    One number per class, at most ``MAX_CLASSES``, comes to the driver.
    """
    spark = train.sparkSession
    known = {r[label]: r["weight"] for r in class_weights(train, label).limit(MAX_CLASSES + 1).collect()}
    if max(len(known), classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    root = fresh_dir(spark, "split")
    rows = oversample(with_class_weight(train, label), key=key, seed=seed)
    for name, part in (("train", rows), ("val", val)):
        as_ml_vector(part, features).select(F.col(label).alias("label"), "vector").write.parquet(f"{root}/{name}")
    stored = spark.read.parquet(f"{root}/train")
    first = stored.first()
    if first is None:
        raise ValueError("no rows to train on")
    return StoredSplit(stored, spark.read.parquet(f"{root}/val"), len(first["vector"]), classes,
                       [float(known.get(i, 0.0)) for i in range(classes)])


@contextmanager
def held(split: StoredSplit) -> Iterator[StoredSplit]:
    """The split with both parts decoded once and kept by the executors, in memory or on their disks, until the block ends.

    Every step reads the training rows several times and the validation rows once; a search does so for each trial.
    """
    parts = [split.train.persist(), split.val.persist()]
    try:
        yield split
    finally:
        for part in parts:
            part.unpersist()


def validation_measures(model: Model, split: StoredSplit) -> dict:
    """Loss, accuracy and macro F1 of a model on the validation rows, by one pass."""
    scored = scorer_of(model).transform(split.val).select(
        "label", F.col("prediction").cast("int").alias("prediction"), vector_to_array("rawPrediction").alias("logits"))
    found = loss_accuracy_and_f1(scored, F.lit(split.weights)).first()
    return {"val_loss": found["loss"], "val_acc": found["accuracy"], "val_f1_macro": found["macro_f1"]}


def train_in_steps(split: StoredSplit, params: dict | None = None, step_iterations: int = STEP_ITERATIONS) -> StepRun:
    """Train on stored rows until the iterations are used up or the loss has stopped falling.

    ``params`` are put over the usual ones; numbers may be text, as run histories keep them.
    """
    chosen = {**DEFAULT_PARAMS, **(params or {})}
    learner = MultilayerPerceptronClassifier(
        layers=[split.width, *hidden_sizes(chosen, split.width), split.classes], featuresCol="vector", labelCol="label",
        solver="l-bfgs", blockSize=int(chosen.get("batch_size", 128)), seed=int(chosen["seed"]))
    shrink = 1 - float(chosen["learning_rate"]) * float(chosen["weight_decay"])
    run, lowest, waited, left = None, float("inf"), 0, int(chosen["epochs"])
    while left > 0 and waited < float(chosen["patience_es"]):
        iterations = min(step_iterations, left)
        left -= iterations
        model = learner.setMaxIter(iterations).fit(split.train)
        measures = {"train_loss": float(model.summary().objectiveHistory[-1]), **validation_measures(model, split)}
        run = run or StepRun(model, 1, [])
        run.curve.append({"epoch": len(run.curve) + 1, **measures})
        if measures["val_f1_macro"] > run.best["val_f1_macro"]:
            run.model, run.best_epoch = model, len(run.curve)
        improved = measures["val_loss"] < lowest - float(chosen["min_delta"])
        lowest, waited = (measures["val_loss"], 0) if improved else (lowest, waited + iterations)
        learner = learner.setInitialWeights(Vectors.dense(model.weights.toArray() * shrink ** iterations))
    if run is None:
        raise ValueError("no iterations to train")
    return run


def search_in_steps(split: StoredSplit, params: list[dict], parallelism: int = 4,
                    fit: Callable[[StoredSplit, dict], StepRun] = train_in_steps) -> tuple[DataFrame, DataFrame]:
    """(trials, curves): every parameter set is trained on the same stored rows, ``parallelism`` of them at a time.

    A trial's jobs go to a scheduler pool of their own, so that with ``spark.scheduler.mode=FAIR`` trials share the
    executors evenly. ``value`` is the best macro F1. A trial whose parameters can't be trained scores minus infinity
    and the search goes on; a bug in the program ends it. ``curves`` has a row per trial and step.
    """
    spark = split.train.sparkSession

    def attempt(number: int) -> tuple[str, float, StepRun | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{number}")
        try:
            run = fit(split, params[number])
        except TRIAL_ERRORS as error:
            return f"FAIL: {type(error).__name__}", float("-inf"), None
        return "COMPLETE", float(run.best["val_f1_macro"]), run

    with ThreadPoolExecutor(parallelism) as pool:
        # Threads take the session's local properties along.
        pending = [pool.submit(inheritable_thread_target(spark)(attempt), n) for n in range(len(params))]
        done = [p.result() for p in pending]
    trials = [(n, {k: str(v) for k, v in chosen.items()}, value, state)
              for n, (chosen, (state, value, _)) in enumerate(zip(params, done, strict=True))]
    steps = [(n, *(r[k] for k in _CURVE_NAMES)) for n, (_, _, run) in enumerate(done) if run for r in run.curve]
    return spark.createDataFrame(trials, TRIALS), spark.createDataFrame(steps, f"trial int, {CURVE}")
