"""Model registry: champion against challenger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import duration_minutes, minute_text, to_report_zone

# Run parameters shown for the production model.
CARD_PARAMS = (
    "data_nb_samples", "data_nb_classes", "data_nb_train", "data_nb_val", "data_imbalance_ratio",
    "learning_rate", "batch_size", "weight_decay", "epochs", "activation", "hidden_l1", "hidden_l2", "hidden_l3",
)


def promote(versions: DataFrame, challengers: DataFrame, runs: DataFrame) -> DataFrame:
    """Registry after the challengers are registered and compared.

    ``versions``: name, version, run_id, stage. ``challengers``: name, run_id,
    at most one per name. A challenger whose F1 is strictly above that of the
    production version (0 if there is none) takes its place; then the archived
    versions of that name are deleted. Otherwise it is only registered.
    """
    f1 = runs.select("run_id", F.coalesce(F.col("final_val_f1_macro"), F.lit(0.0)).alias("_f1"))
    production = F.col("stage") == "Production"
    champions = (versions.join(f1, "run_id", "left").groupBy("name").agg(
        F.max("version").alias("_last"),
        F.max_by("_f1", F.when(production, F.col("version"))).alias("_champion")))
    duel = (challengers.join(f1, "run_id", "left").withColumnRenamed("_f1", "_challenger")
            .join(champions, "name", "left")
            .withColumn("_wins", F.coalesce("_challenger", F.lit(0.0)) > F.coalesce("_champion", F.lit(0.0))))
    entered = duel.select(
        "name", (F.coalesce("_last", F.lit(0)) + 1).alias("version"), "run_id",
        F.when(F.col("_wins"), F.lit("Production")).otherwise(F.lit("None")).alias("stage"))
    wins = F.coalesce(F.col("_wins"), F.lit(False))
    kept = (versions.join(duel.select("name", "_wins"), "name", "left")
            .where(~(wins & F.col("stage").isin("Production", "Archived")))
            .select("name", "version", "run_id", "stage"))
    return kept.unionByName(entered)


def production_info(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """The production version with the record of the run that trained it."""
    return versions.where(F.col("stage") == "Production").join(runs, "run_id")


def production_card(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """What the model page shows of the production version; a dash for what is unknown."""
    def or_dash(value):
        return F.coalesce(value.cast("string"), F.lit("—"))

    params = F.col("params")
    return production_info(versions, runs).select(
        "name", "version", "run_id",
        F.coalesce("final_val_f1_macro", F.lit(0.0)).alias("f1"),
        F.coalesce("final_val_acc", F.lit(0.0)).alias("acc"),
        or_dash(F.col("data_run_id")).alias("data_run_id"),
        or_dash(F.col("git_sha")).alias("git_sha"),
        duration_minutes(F.col("start_time"), F.col("end_time")).alias("duration_min"),
        or_dash(minute_text(to_report_zone(F.col("end_time")))).alias("trained_at"),
        or_dash(F.round(F.try_element_at(params, F.lit("dropout")).cast("double"), 4)).alias("dropout"),
        *[or_dash(F.try_element_at(params, F.lit(name))).alias(name) for name in CARD_PARAMS])
