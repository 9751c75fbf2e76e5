"""Helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body``.

    Repeating a Column repeats its whole expression tree, so a value needed
    by every element of an array would be recomputed per element.
    """
    return F.transform(F.array(value), body)[0]


def safe_share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


#: Classes of a catalogue. Whatever gathers one entry per class into a row or a task raises beyond it.
MAX_CLASSES = 10_000


def within_classes(number: Column) -> Column:
    """``number``, or an error where it counts more classes than a catalogue may have."""
    too_many = F.raise_error(F.lit(f"more than {MAX_CLASSES} classes"))
    return F.when(number <= MAX_CLASSES, number).otherwise(too_many.cast("int"))


def class_map(rows: DataFrame, key: str, value: str) -> Column:
    """``rows``, one per class, as a map value read by a scalar subquery.

    Looking a class up in it moves no row, so a class that holds most rows is no
    hot key. More than ``MAX_CLASSES`` rows are an error.
    """
    known = rows.where(F.col(key).isNotNull()).limit(MAX_CLASSES + 1)
    pairs = F.collect_list(F.struct(key, value))
    checked = F.when(within_classes(F.count("*").cast("int")).isNotNull(), F.map_from_entries(pairs))
    return known.agg(checked.alias("map")).scalar()
