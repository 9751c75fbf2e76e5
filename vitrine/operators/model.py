"""Classifier heads: batch forward pass, training and search."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.errors import PySparkException
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from vitrine.operators.evaluation import MacroF1Evaluator
from vitrine.operators.labels import with_class_weight
from vitrine.operators.vectors import as_ml_vector

# --- fixed values: training defaults and search space ------------------------
DEFAULT_PARAMS = {
    "learning_rate": 1e-3, "epochs": 50, "dropout": 0.3, "weight_decay": 0.05,
    "patience_es": 7, "patience_lr": 3, "min_delta": 1e-4, "seed": 42,
    "hidden_l1": 1024, "hidden_l2": 512, "hidden_l3": 256, "activation": "SiLU",
}
SEARCH_SPACE = {
    "learning_rate": ("log", 1e-5, 1e-2),
    "dropout": ("uniform", 0.2, 0.6),
    "weight_decay": ("log", 0.01, 0.1),
    "batch_size": ("choice", 64, 128, 256),
    "hidden_l1": ("step", 512, 2048, 256),
    "hidden_l2": ("step", 256, 1024, 128),
    "hidden_l3": ("step", 128, 512, 64),
    "activation": ("choice", "ReLU", "GELU", "SiLU"),
}
N_TRIALS = 20
# ------------------------------------------------------------------------------

#: What a bad draw can cause. Errors of the program itself are none of these and end a search.
TRIAL_ERRORS = (PySparkException, Py4JError, ValueError, ArithmeticError)

_erf = np.vectorize(math.erf, otypes=[np.float64])

ACTIVATIONS = {
    "ReLU": lambda x: np.maximum(x, 0.0),
    "GELU": lambda x: 0.5 * x * (1.0 + _erf(x / math.sqrt(2.0))),
    "SiLU": lambda x: x / (1.0 + np.exp(-x)),
}


@dataclass
class BatchNorm:
    gamma: np.ndarray
    beta: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    eps: float = 1e-5

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / np.sqrt(self.var + self.eps) * self.gamma + self.beta


@dataclass
class Dense:
    weight: np.ndarray
    bias: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight.T + self.bias


@dataclass
class MlpHead:
    """Weights of a trained head: input norm, hidden (dense, norm) blocks, output.

    Evaluation form: norms use stored statistics and dropout does nothing.
    """

    input_norm: BatchNorm
    blocks: list[tuple[Dense, BatchNorm]]
    output: Dense
    activation: str = "ReLU"

    def arrays(self) -> list[list[np.ndarray]]:
        """Plain arrays in layer order."""
        def parts(layer):
            return ([layer.weight, layer.bias] if isinstance(layer, Dense)
                    else [layer.gamma, layer.beta, layer.mean, layer.var])

        layers = [self.input_norm, *(layer for block in self.blocks for layer in block), self.output]
        return [parts(layer) for layer in layers]

    @classmethod
    def from_arrays(cls, arrays: list[list[np.ndarray]], activation: str) -> MlpHead:
        first, *hidden, last = arrays
        blocks = [(Dense(*dense), BatchNorm(*norm)) for dense, norm in zip(hidden[::2], hidden[1::2], strict=True)]
        return cls(BatchNorm(*first), blocks, Dense(*last), activation)

    def forward(self, x: np.ndarray) -> np.ndarray:
        act = ACTIVATIONS[self.activation]
        h = self.input_norm(x)
        for dense, norm in self.blocks:
            h = act(norm(dense(h)))
        return self.output(h)


def random_head(input_dim: int, classes: int, hidden: Iterable[int] = (1024, 512, 256),
                activation: str = "ReLU", seed: int = 42) -> MlpHead:
    """An untrained head of the given shape."""
    rng = np.random.default_rng(seed)

    def dense(n_in, n_out):
        bound = 1.0 / math.sqrt(n_in)
        return Dense(rng.uniform(-bound, bound, (n_out, n_in)), rng.uniform(-bound, bound, n_out))

    def norm(n):
        return BatchNorm(np.ones(n), np.zeros(n), np.zeros(n), np.ones(n))

    blocks, width = [], input_dim
    for size in hidden:
        blocks.append((dense(width, size), norm(size)))
        width = size
    return MlpHead(norm(input_dim), blocks, dense(width, classes), activation)


def head_logits(df: DataFrame, head: MlpHead, features: str = "features", out: str = "logits",
                batch_size: int = 1024) -> DataFrame:
    """Add the logits of a head. Its weights, a few megabytes whatever the data, are broadcast once."""
    shared = df.sparkSession.sparkContext.broadcast(head.arrays())
    activation = head.activation

    def load():
        model = MlpHead.from_arrays(shared.value, activation)

        def predict(x: np.ndarray) -> np.ndarray:
            return model.forward(x.astype(np.float64)).astype(np.float32)

        return predict

    width = len(head.input_norm.gamma)
    udf = predict_batch_udf(load, return_type=ArrayType(FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[width]])
    return df.withColumn(out, udf(F.col(features)))


def oversample(df: DataFrame, weight: str = "weight", key: str = "product_id", seed: int = 42) -> DataFrame:
    """Repeat rows in proportion to their weight, for learners without one.

    The smallest weight gives one copy. A broken weight's last copy is decided
    by a hash of the key, so a retried task gives the same rows.
    """
    scaled = F.col(weight) / df.agg(F.min(weight)).scalar()
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / 1_000_000
    copies = (F.floor(scaled) + (chance < scaled - F.floor(scaled)).cast("int")).cast("int")
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def train_logistic(train: DataFrame, label: str = "label", features: str = "features",
                   max_iter: int = 50, reg: float = 0.0, tol: float = 1e-6) -> Model:
    """Class-balanced multinomial logistic head."""
    data = as_ml_vector(with_class_weight(train, label), features)
    return LogisticRegression(featuresCol="vector", labelCol=label, weightCol="weight", family="multinomial",
                              maxIter=max_iter, regParam=reg, tol=tol).fit(data)


def train_mlp(train: DataFrame, classes: int, hidden: Iterable[int], label: str = "label",
              features: str = "features", key: str = "product_id", max_iter: int = 50, seed: int = 42,
              step_size: float = 0.03) -> Model:
    """Multilayer head with the hidden sizes of the search, balanced by oversampling."""
    data = oversample(with_class_weight(train, label), key=key, seed=seed)
    width = data.select(F.max(F.size(features))).first()[0]
    return MultilayerPerceptronClassifier(
        layers=[width, *hidden, classes], featuresCol="vector", labelCol=label, maxIter=max_iter,
        seed=seed, stepSize=step_size).fit(as_ml_vector(data, features))


def scorer_of(model: Model) -> Model:
    """The model without its training summary, which holds the session: that can't be sent to tasks once it has observed a frame."""
    if not getattr(model, "hasSummary", False):
        return model
    scorer = model.copy()
    scorer._java_obj.setSummary(SparkContext.getOrCreate()._jvm.scala.Option.empty())
    return scorer


def model_probabilities(df: DataFrame, model: Model, features: str = "features",
                        out: str = "probabilities") -> DataFrame:
    """Class probabilities of a ``pyspark.ml`` head as an array column."""
    scored = scorer_of(model).transform(as_ml_vector(df, features))
    return (scored.withColumn(out, vector_to_array("probability"))
            .drop("vector", "rawPrediction", "probability"))


def sample_params(n: int = N_TRIALS, seed: int = 42, space: dict = SEARCH_SPACE) -> list[dict]:
    """Seeded random draws from the search space."""
    rng = random.Random(seed)

    def draw(kind, *args):
        if kind == "log":
            return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        if kind == "uniform":
            return rng.uniform(*args)
        if kind == "step":
            return rng.randrange(args[0], args[1] + 1, args[2])
        return rng.choice(args)

    return [{name: draw(*rule) for name, rule in space.items()} for _ in range(n)]


def search(train: DataFrame, val: DataFrame, fit, params: list[dict], label: str = "label") -> DataFrame:
    """Try every parameter set and keep the trials: trial, params, value, state.

    ``fit(train, params)`` gives a model; a trial that fails scores minus
    infinity and the search goes on.
    """
    spark = train.sparkSession
    evaluator = MacroF1Evaluator(label, "prediction")
    trials = []
    for number, chosen in enumerate(params):
        try:
            scored = scorer_of(fit(train, chosen)).transform(as_ml_vector(val))
            value = evaluator.evaluate(scored.withColumn("prediction", F.col("prediction").cast("int")))
            state = "COMPLETE"
        except TRIAL_ERRORS as error:  # one bad draw must not end the search
            value, state = float("-inf"), f"FAIL: {type(error).__name__}"
        trials.append((number, {k: str(v) for k, v in chosen.items()}, float(value), state))
    return spark.createDataFrame(trials, "trial int, params map<string,string>, value double, state string")
