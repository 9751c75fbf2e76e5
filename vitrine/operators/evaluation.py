"""Classifier measures from (true, predicted) pairs and from logits."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.scores import array_total, log_softmax

LABEL_SMOOTHING = 0.1


def accuracy(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(truth) == F.col(predicted)).cast("int")).alias("accuracy"))


def confusion(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    return (df.groupBy(F.col(truth).alias("label"), F.col(predicted).alias("prediction"))
            .agg(F.count("*").alias("n")))


def class_scores(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    """tp, fp, fn and f1 of every class that occurs as truth or as prediction.

    Each confusion cell counts once for its true class and once for the
    predicted one, so one more grouping replaces a full outer join.
    """
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("long")
    cells = confusion(df, truth, predicted).select(F.explode(F.array(
        F.struct(F.col("label").alias("class"),
                 F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("fp"),
                 F.when(hit, zero).otherwise(F.col("n")).alias("fn")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(F.col("n")).alias("fp"), zero.alias("fn")),
    )).alias("c")).select("c.*")
    per_class = cells.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    spread = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return per_class.withColumn(
        "f1", F.when(spread > 0, 2.0 * F.col("tp") / spread).otherwise(F.lit(0.0)))


def macro_f1(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    """Unweighted mean of the per-class F1; a class without hits counts as 0."""
    return class_scores(df, truth, predicted).agg(F.avg("f1").alias("macro_f1"))


def accuracy_and_macro_f1(df: DataFrame, truth: str = "label", predicted: str = "prediction") -> DataFrame:
    """Both measures from one confusion table: accuracy = sum(tp) / sum(tp + fn)."""
    return class_scores(df, truth, predicted).agg(
        (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.count("*").alias("classes"))


def weighted_smoothed_loss(df: DataFrame, weights: Column, logits: str = "logits",
                           label: str = "label", smoothing: float = LABEL_SMOOTHING) -> DataFrame:
    """Mean class-weighted cross-entropy with label smoothing over the whole frame.

    ``weights`` is an array of one weight per class index, 0 for absent classes.
    """
    nll = df.select(F.col(label).alias("_y"), log_softmax(F.col(logits)).alias("_logp"),
                    weights.alias("_w"))
    of_label = F.element_at("_w", F.col("_y") + 1)
    weighted = F.zip_with("_w", "_logp", lambda w, lp: -w * lp)
    sums = nll.select(
        of_label.alias("w"),
        (of_label * -F.element_at("_logp", F.col("_y") + 1)).alias("hard"),
        array_total(weighted).alias("soft"),
        F.size("_logp").alias("k"),
    ).agg(F.sum("w").alias("w"), F.sum("hard").alias("hard"), F.sum("soft").alias("soft"),
          F.max("k").alias("k"))
    return sums.select(((1 - smoothing) * F.col("hard") / F.col("w")
                        + smoothing / F.col("k") * F.col("soft") / F.col("w")).alias("loss"))


def loss_accuracy_and_f1(df: DataFrame, weights: Column, logits: str = "logits", truth: str = "label",
                         predicted: str = "prediction", smoothing: float = LABEL_SMOOTHING) -> DataFrame:
    """loss, accuracy and macro_f1 in one pass over the rows.

    The terms of ``weighted_smoothed_loss`` are summed by confusion cell, so that all three come from the cells.
    """
    terms = df.select(F.col(truth).alias("label"), F.col(predicted).alias("prediction"), weights.alias("_w"),
                      log_softmax(F.col(logits)).alias("_logp"))
    own = F.element_at("_w", F.col("label") + 1)
    all_classes = array_total(F.zip_with("_w", "_logp", lambda w, lp: -w * lp)) / F.size("_logp")
    loss = (1 - smoothing) * own * -F.element_at("_logp", F.col("label") + 1) + smoothing * all_classes
    cells = terms.groupBy("label", "prediction").agg(F.count("*").alias("n"), F.sum(own).alias("w"), F.sum(loss).alias("loss"))
    hit = F.col("label") == F.col("prediction")
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("t"),
                 F.lit(0).cast("long").alias("p"), "w", "loss"),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("t"),
                 F.col("n").alias("p"), F.lit(0.0).alias("w"), F.lit(0.0).alias("loss")))).alias("c")).select("c.*")
    classes = sides.groupBy("class").agg(*(F.sum(k).alias(k) for k in ("tp", "t", "p", "w", "loss")))
    return classes.agg((F.sum("loss") / F.sum("w")).alias("loss"), (F.sum("tp") / F.sum("t")).alias("accuracy"),
                       F.avg(2.0 * F.col("tp") / (F.col("t") + F.col("p"))).alias("macro_f1"))


class MacroF1Evaluator(Evaluator):
    """Macro F1 for model selection; the built-in "f1" metric is the weighted one."""

    def __init__(self, label: str = "label", predicted: str = "prediction"):
        super().__init__()
        self.label = label
        self.predicted = predicted

    def _evaluate(self, dataset: DataFrame) -> float:
        value = macro_f1(dataset, self.label, self.predicted).first()[0]
        return float(value) if value is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
