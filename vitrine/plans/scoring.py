"""From product text and image to label, confidence and top five, batch or stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.common import class_map
from vitrine.functions.scores import (
    argmax, class_label, label_top_classes, scores_map, softmax, top_classes,
)

TOP_K = 5


def label_lookup(labels: DataFrame) -> Column:
    """The class labels as one map value, read by a scalar subquery.

    ``labels`` (class_index, label) has at most one row per model output, so the
    map is never wider than the score array every row already carries; it is checked.
    """
    return class_map(labels, "class_index", "label")


def rank_probabilities(df: DataFrame, labels: Column, probabilities: str = "probabilities",
                       k: int = TOP_K) -> DataFrame:
    """Add predicted_class_index, predicted_label, confidence, top5 and all_scores.

    ``labels`` is a map column or value, class index to label.
    """
    known = F.col("_labels")
    ranked = df.withColumn("_labels", labels).withColumns({
        "predicted_class_index": argmax(F.col(probabilities)),
        "confidence": F.array_max(probabilities).cast("double"),
        "_top": top_classes(F.col(probabilities), k),
    })
    named = ranked.withColumns({
        "predicted_label": class_label(known, F.col("predicted_class_index")),
        "top5": label_top_classes(F.col("_top"), known),
    })
    return named.withColumn("all_scores", scores_map(F.col("top5"))).drop("_labels", "_top")


def rank_logits(df: DataFrame, labels: Column, logits: str = "logits", k: int = TOP_K) -> DataFrame:
    return rank_probabilities(df.withColumn("probabilities", softmax(F.col(logits))), labels, k=k)


def score_products(df: DataFrame, add_features: Callable[[DataFrame], DataFrame],
                   add_probabilities: Callable[[DataFrame], DataFrame], labels: Column) -> DataFrame:
    """Clean, embed, fuse, classify and label products.

    ``add_features`` turns text and image columns into ``features``;
    ``add_probabilities`` turns these into ``probabilities``.
    """
    return rank_probabilities(add_probabilities(add_features(df)), labels)


def to_prediction_rows(scored: DataFrame, model_version: str | None = None, has_image: Column | None = None) -> DataFrame:
    """Rows for the predictions table."""
    return scored.select(
        F.uuid().alias("id"),
        F.col("designation"),
        F.nullif(F.col("description"), F.lit("")).alias("description"),
        F.col("predicted_label").alias("predicted_class"),
        F.col("confidence"),
        F.col("all_scores"),
        F.lit(model_version).cast("string").alias("model_version"),
        (F.lit(True) if has_image is None else has_image).alias("has_image"),
        F.current_timestamp().cast("timestamp_ntz").alias("dt_predicted"))


def save_predictions(rows: DataFrame, path: str) -> None:
    """Append prediction rows; one folder per day keeps recent reads short."""
    (rows.withColumn("day", F.to_date("dt_predicted"))
     .write.mode("append").partitionBy("day").parquet(path))
