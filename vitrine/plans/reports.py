"""The catalogue gallery and the prediction monitor as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import floor_hour, minute_text, to_report_zone
from vitrine.functions.scores import HIGH_CONFIDENCE, confidence_band
from vitrine.functions.text import ellipsis, percent
from vitrine.operators.ranking import latest_per_product, sample_per_class

HISTOGRAM_BINS = 20
LATEST_PREDICTIONS = 200


def global_stats(processed: DataFrame) -> DataFrame:
    latest = latest_per_product(processed)
    return latest.agg(
        F.count("*").alias("total_products"),
        F.countDistinct("prdtypecode").alias("total_classes"),
        F.round(F.lit(100.0) * F.count_if("image_exists") / F.count("*"), 1).alias("pct_with_image"),
        F.max("batch_id").alias("last_batch"),
        F.max("dt_processed").alias("last_batch_date"))


def batch_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch_id").agg(F.count("*").alias("rows"))


def class_distribution(processed: DataFrame) -> DataFrame:
    return (latest_per_product(processed).groupBy("prodtype").agg(F.count("*").alias("nb"))
            .orderBy(F.col("nb").desc(), "prodtype"))


def imbalance_ratio(distribution: DataFrame) -> DataFrame:
    """Largest over smallest class, one decimal; null when there is no class."""
    return distribution.agg(
        F.when(F.min("nb") > 0, F.round(F.max("nb") / F.min("nb"), 1)).alias("imbalance_ratio"))


def cumulative_stats(embeddings: DataFrame) -> DataFrame:
    """Classes, products and imbalance of the stored embeddings; no row when empty."""
    per_class = embeddings.groupBy("prdtypecode").agg(F.count("*").alias("nb"))
    totals = per_class.agg(
        F.count("*").alias("nb_classes"),
        F.sum("nb").alias("total_products"),
        F.round(F.max("nb") / F.greatest(F.min("nb"), F.lit(1)), 2).alias("imbalance_ratio"))
    return totals.where(F.col("nb_classes") > 0)


def class_list(processed: DataFrame) -> DataFrame:
    return processed.select("prdtypecode", "prodtype").distinct().orderBy("prodtype", "prdtypecode")


def products_for_class(processed: DataFrame, prdtypecode: int, n: int = 12) -> DataFrame:
    """Gallery page of one class. The filter sits above the view, as a class code
    may change between batches."""
    return (latest_per_product(processed).where(F.col("prdtypecode") == prdtypecode)
            .orderBy("productid").limit(n))


def gallery(processed: DataFrame, n: int = 12) -> DataFrame:
    """The gallery pages of all classes at once."""
    return sample_per_class(latest_per_product(processed), "prdtypecode", n)


def similar_products(predictions: DataFrame, processed: DataFrame, n: int = 6) -> DataFrame:
    """n catalogue products with the predicted label of each distinct label."""
    labels = predictions.select(F.col("predicted_class").alias("prodtype")).distinct()
    sample = sample_per_class(latest_per_product(processed), "prodtype", n)
    return sample.join(labels, "prodtype", "left_semi")


def latest_predictions(predictions: DataFrame, n: int = LATEST_PREDICTIONS) -> DataFrame:
    return predictions.orderBy(F.col("dt_predicted").desc(), F.col("id").desc()).limit(n)


def prediction_kpis(predictions: DataFrame) -> DataFrame:
    """Total, mean confidence, share of sure predictions and the commonest class.

    Counting per class first lets one more grouping give all four; equal counts
    go to the class first in the alphabet.
    """
    per_class = predictions.groupBy("predicted_class").agg(
        F.count("*").alias("n"), F.sum("confidence").alias("c"),
        F.count_if(F.col("confidence") >= HIGH_CONFIDENCE).alias("high"))
    top = F.min_by("predicted_class", F.struct((-F.col("n")).alias("n"), "predicted_class"))
    return per_class.agg(
        F.sum("n").alias("total"),
        (F.sum("c") / F.sum("n")).alias("avg_confidence"),
        (F.sum("high") / F.sum("n")).alias("pct_high"),
        top.alias("dominant_class"))


def top_predicted_classes(predictions: DataFrame, n: int = 10) -> DataFrame:
    return (predictions.groupBy("predicted_class").agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), "predicted_class").limit(n))


def confidence_histogram(predictions: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Count per bin of equal width over [0, 1]; 1.0 falls into the last bin."""
    bin_no = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return (predictions.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("count"))
            .select("bin", (F.col("bin") / bins).alias("low"), "count"))


def hourly_predictions(predictions: DataFrame) -> DataFrame:
    """Predictions and mean confidence per hour of Paris time."""
    hour = floor_hour(to_report_zone(F.col("dt_predicted")))
    return (predictions.groupBy(hour.alias("hour"))
            .agg(F.count("id").alias("count"), F.avg("confidence").alias("avg_conf")))


def predictions_table(predictions: DataFrame, n: int = LATEST_PREDICTIONS) -> DataFrame:
    """The newest predictions as shown on the monitor."""
    return latest_predictions(predictions, n).select(
        "id",
        confidence_band(F.col("confidence"), "🟢", "🟡", "🔴").alias("band"),
        minute_text(to_report_zone(F.col("dt_predicted"))).alias("date_paris"),
        "predicted_class",
        percent(F.col("confidence")).alias("confidence"),
        "has_image",
        ellipsis(F.col("designation"), 80, "…", always=True).alias("designation"))
