"""Class scores and vectors held as arrays, one row at a time, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.common import let

HIGH_CONFIDENCE = 0.75
MODERATE_CONFIDENCE = 0.5


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def softmax(logits: Column) -> Column:
    """Probabilities, shifted by the largest logit so that exp cannot overflow."""
    def shifted(raw: Column) -> Column:
        return let(F.array_max(raw), lambda top: F.transform(raw, lambda x: F.exp(x - top)))

    return let(
        shifted(logits.cast("array<double>")),
        lambda powers: let(array_total(powers), lambda total: F.transform(powers, lambda x: x / total)),
    )


def log_softmax(logits: Column) -> Column:
    def shifted(raw: Column) -> Column:
        return let(F.array_max(raw), lambda top: F.transform(raw, lambda x: x - top))

    return let(
        shifted(logits.cast("array<double>")),
        lambda low: let(
            F.log(array_total(F.transform(low, lambda x: F.exp(x)))),
            lambda norm: F.transform(low, lambda x: x - norm),
        ),
    )


def argmax(values: Column) -> Column:
    """Zero-based index of the largest value, the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def indexed(values: Column) -> Column:
    """array<struct<class_index, confidence>>"""
    return F.transform(
        values, lambda v, i: F.struct(i.cast("int").alias("class_index"), v.alias("confidence"))
    )


def top_classes(probabilities: Column, k: int = 5) -> Column:
    """The min(k, n) best classes, best first, lower index first on ties.

    Sorting on the negated score keeps the natural struct order, which is
    cheaper than a comparator lambda.
    """
    ranked = F.array_sort(F.transform(
        probabilities,
        lambda v, i: F.struct((-v).alias("rank"), i.cast("int").alias("class_index"), v.alias("confidence")),
    ))
    return F.transform(
        F.slice(ranked, 1, k),
        lambda s: F.struct(s["class_index"].alias("class_index"), s["confidence"].alias("confidence")),
    )


def class_label(labels: Column, index: Column) -> Column:
    """Label of a class index, ``class_<i>`` when the map does not know it."""
    return F.coalesce(F.try_element_at(labels, index), F.concat(F.lit("class_"), index.cast("string")))


def label_top_classes(top: Column, labels: Column) -> Column:
    return F.transform(top, lambda s: F.struct(
        s["class_index"].alias("class_index"),
        class_label(labels, s["class_index"]).alias("label"),
        s["confidence"].alias("confidence"),
    ))


def scores_map(top: Column) -> Column:
    """label -> confidence of the listed classes.

    Two classes may carry one label; then the later, weaker one stands, as
    when the pairs are put into a dictionary in order.
    """
    def pairs(entries: Column) -> Column:
        last_of_label = F.filter(entries, lambda s, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["label"] == s["label"]))
        return F.map_from_entries(F.transform(last_of_label, lambda s: F.struct(s["label"], s["confidence"])))

    return let(top, pairs)


def l2_normalise(vector: Column) -> Column:
    """Unit vector in float32; a zero vector stays zero."""
    def scaled(raw: Column) -> Column:
        return let(
            F.greatest(F.sqrt(array_total(F.transform(raw, lambda x: x * x))), F.lit(1e-12)),
            lambda norm: F.transform(raw, lambda x: x / norm),
        )

    return scaled(vector.cast("array<double>")).cast("array<float>")


def fuse(image: Column, text: Column) -> Column:
    """Model input: image vector first, then text vector, in float32."""
    return F.concat(image, text).cast("array<float>")


def confidence_band(confidence: Column, high="high", moderate="moderate", low="low") -> Column:
    return (F.when(confidence >= HIGH_CONFIDENCE, F.lit(high))
            .when(confidence >= MODERATE_CONFIDENCE, F.lit(moderate))
            .otherwise(F.lit(low)))
