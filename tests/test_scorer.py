from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from vitrine.operators.model import scorer_of, train_logistic
from vitrine.plans.training import train_and_measure


def test_a_session_that_has_observed_a_frame_still_scores(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = [(i, [float(i % 2), 1.0, 1.0], i % 2, "val" if i % 5 == 0 else "train") for i in range(40)]
    frame = spark.createDataFrame(rows, "product_id long, features array<float>, label int, split string").repartition(2).cache()
    model, measures = train_and_measure(frame, lambda train: train_logistic(train, max_iter=5))
    assert measures["accuracy"] == 1.0
    assert model.hasSummary and not scorer_of(model).hasSummary  # the curve is still there to be kept
    assert scorer_of(model).coefficientMatrix == model.coefficientMatrix
