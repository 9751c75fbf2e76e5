"""Order-dependent folds over the epochs of a run."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4_096


def fold_sorted(df: DataFrame, key: str, order: str, start: Callable[[], dict],
                step: Callable[[dict, dict], dict], schema: str) -> DataFrame:
    """One output row per input row from a state that runs along ``order`` within ``key``.

    Rows stream through in Arrow batches; only the state of the current key is
    held, never the key's rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = object(), {}
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if row[key] != current:
                    current, state = row[key], start()
                out.append(step(state, row))
            yield pd.DataFrame(out)

    return df.repartition(key).sortWithinPartitions(key, order).mapInPandas(run, schema)


def early_stopping(curves: DataFrame, patience: int = 7, min_delta: float = 1e-4) -> DataFrame:
    """Where early stopping would end each run.

    ``curves``: run_id, epoch, val_loss. Result: run_id, best_loss, best_epoch,
    stop_epoch (null when the run was never stopped). A loss is accepted when
    it is below the best one by more than ``min_delta``; ``patience`` epochs in
    a row without acceptance stop the run. A loss that is null or not a number
    is never accepted and counts as an epoch; a run without any accepted loss has
    best_loss infinity and no best_epoch.

    Only new minima can be accepted, so these are found first. A run is cut into
    blocks of epochs; block minima give every block the lowest loss before it,
    and the new minima of all blocks are found in parallel. A gap of more than
    ``patience`` epochs between two minima ends the run for sure, so later ones
    are dropped before the fold.
    """
    block = F.floor(F.col("epoch") / BLOCK)
    loss = F.nanvl(F.col("val_loss").cast("double"), F.lit(None).cast("double"))
    rows = curves.select("run_id", "epoch", loss.alias("loss"), block.alias("_block"))
    so_far = Window.partitionBy("run_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = (rows.groupBy("run_id", "_block").agg(F.min("loss").alias("_min"), F.count("*").alias("_n"))
             .withColumns({"_low": F.min("_min").over(so_far),
                           "_before": F.coalesce(F.sum("_n").over(so_far), F.lit(0))})
             .drop("_min", "_n"))
    inside = Window.partitionBy("run_id", "_block").orderBy("epoch")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.join(heads, ["run_id", "_block"])
              .withColumns({"pos": F.col("_before") + F.row_number().over(inside),
                            "_prior": F.least("_low", F.min("loss").over(earlier))}))
    minima = placed.where(F.col("loss").isNotNull() & (F.col("_prior").isNull() | (F.col("loss") < F.col("_prior"))))
    along = Window.partitionBy("run_id").orderBy("pos")
    ended = F.sum((F.col("_gap") > patience).cast("int")).over(
        along.rowsBetween(Window.unboundedPreceding, -1))
    minima = (minima.withColumn("_gap", F.lead("pos").over(along) - F.col("pos"))
              .withColumn("_ended", F.coalesce(ended, F.lit(0)))
              .where(F.col("_ended") == 0)
              .select("run_id", "pos", "epoch", "loss"))

    def start():
        return {"best": float("inf"), "pos": 0, "epoch": None, "done": False}

    def step(state, row):
        if not state["done"] and row["pos"] - state["pos"] > patience:
            state["done"] = True
        if not state["done"] and row["loss"] < state["best"] - min_delta:
            state.update(best=row["loss"], pos=row["pos"], epoch=row["epoch"])
        return {"run_id": row["run_id"], "pos": row["pos"], "best_loss": state["best"],
                "best_pos": state["pos"], "best_epoch": state["epoch"]}

    run_type = curves.schema["run_id"].dataType.simpleString()
    accepted = (fold_sorted(minima, "run_id", "pos", start, step,
                            f"run_id {run_type}, pos long, best_loss double, best_pos long, best_epoch long")
                .groupBy("run_id").agg(F.max_by(F.struct("best_loss", "best_pos", "best_epoch"), "pos").alias("b"))
                .select("run_id", "b.*"))
    lengths = heads.groupBy("run_id").agg(F.max("_before").alias("_length"))
    accepted = lengths.join(accepted, "run_id", "left").select(
        "run_id", F.coalesce("best_loss", F.lit(float("inf"))).alias("best_loss"),
        F.coalesce("best_pos", F.lit(0)).alias("best_pos"), "best_epoch")
    stops = (placed.select("run_id", "pos", F.col("epoch").cast("long").alias("stop_epoch"))
             .join(accepted.select("run_id", (F.col("best_pos") + patience).alias("pos")), ["run_id", "pos"]))
    return (accepted.join(stops.select("run_id", "stop_epoch"), "run_id", "left")
            .select("run_id", "best_loss", "best_epoch", "stop_epoch"))


def learning_rates(curves: DataFrame, initial: float = 1e-3, factor: float = 0.5, patience: int = 3,
                   threshold: float = 1e-4, smallest_change: float = 1e-8) -> DataFrame:
    """Learning rate after every epoch when a plateau of the loss lowers it.

    A loss counts as better when it is below the best by the relative
    ``threshold``; more than ``patience`` epochs without one lower the rate.
    """
    def start():
        return {"best": float("inf"), "bad": 0, "lr": initial}

    def step(state, row):
        if row["val_loss"] < state["best"] * (1 - threshold):
            state.update(best=row["val_loss"], bad=0)
        else:
            state["bad"] += 1
        if state["bad"] > patience:
            lower = state["lr"] * factor
            if state["lr"] - lower > smallest_change:
                state["lr"] = lower
            state["bad"] = 0
        return {"run_id": row["run_id"], "epoch": row["epoch"], "learning_rate": state["lr"]}

    kinds = {f.name: f.dataType.simpleString() for f in curves.schema.fields}
    return fold_sorted(curves.select("run_id", "epoch", "val_loss"), "run_id", "epoch", start, step,
                       f"run_id {kinds['run_id']}, epoch {kinds['epoch']}, learning_rate double")
