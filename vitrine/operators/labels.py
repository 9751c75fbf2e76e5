"""Class indices, class weights and the stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.common import class_map, within_classes
from vitrine.session import shared_dir

SPLIT_SEED = 42
VALIDATION_SHARE = 0.2
HASH_DIGITS = 4


def class_index(categories: DataFrame, code: str = "code") -> DataFrame:
    """Dense index of all known class codes in numeric order: code, class_index.

    One row per class, numbered in one task; too many classes are an error.
    """
    codes = categories.select(F.col(code).cast("int").alias("code")).distinct()
    place = F.row_number().over(Window.orderBy("code"))
    return codes.withColumn("class_index", (within_classes(place) - 1).cast("int"))


def encode_labels(df: DataFrame, index: DataFrame, code: str = "prdtypecode") -> DataFrame:
    """Add ``class_index``; a code the map does not know is an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown class code "), F.col(code).cast("string")))
    found = F.try_element_at(class_map(index, "code", "class_index"), F.col(code).cast("int"))
    return df.withColumn("class_index", F.coalesce(found, unknown.cast("int")))


def index_to_label(index: DataFrame, categories: DataFrame) -> DataFrame:
    labels = categories.select(F.col("code").cast("int").alias("code"), "label")
    return index.join(labels, "code").select("class_index", "label")


def class_weights(df: DataFrame, label: str = "prdtypecode") -> DataFrame:
    """Balanced weight n / (k * n_c) per class present: label, n_c, weight."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_c"))
    # Scalar totals, not a window: the class table may stay distributed.
    totals = counts.agg(F.sum("n_c").alias("n"), F.count("*").alias("k"))
    n, k = totals.select("n").scalar(), totals.select("k").scalar()
    return counts.withColumn("weight", n / (k * F.col("n_c")))


def with_class_weight(df: DataFrame, label: str = "prdtypecode") -> DataFrame:
    """Rows that have a label, with the weight of their class."""
    weights = class_map(class_weights(df, label), label, "weight")
    return df.where(F.col(label).isNotNull()).withColumn("weight", F.element_at(weights, F.col(label)))


def split_quotas(counts: DataFrame, label: str, share: float = VALIDATION_SHARE) -> DataFrame:
    """Validation rows per class by largest remainder, ceil(share * n) in total.

    ``counts`` has one row per class. A class of one row cannot be on both
    sides and is an error.
    """
    too_small = F.raise_error(F.concat(
        F.lit("the least populated class has only one row: "), F.col(label).cast("string")))
    whole = counts.withColumn("n_c", F.when(F.col("n_c") < 2, too_small.cast("bigint")).otherwise(F.col("n_c")))
    n = whole.agg(F.sum("n_c").alias("n")).scalar()
    goal = F.ceil(n * F.lit(share))
    ideal = goal * F.col("n_c") / n
    parts = whole.withColumns({"goal": goal, "base": F.floor(ideal), "rest": ideal - F.floor(ideal)})
    missing = parts.agg((F.max("goal") - F.sum("base")).alias("missing")).scalar()
    place = F.row_number().over(Window.orderBy(F.col("rest").desc(), F.col(label).asc()))
    return (parts.withColumn("place", within_classes(place))
            .withColumn("quota", (F.col("base") + F.when(F.col("place") <= missing, 1).otherwise(0)).cast("long"))
            .select(label, "n_c", "quota"))


def stratified_split(df: DataFrame, key: str = "product_id", label: str = "prdtypecode",
                     share: float = VALIDATION_SHARE, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split``: the first quota rows of every class by md5(seed-key) validate.

    Ranking a whole class would put a hot class into one task. Instead the hash
    space is cut into 16^HASH_DIGITS even buckets; bucket counts tell in which
    bucket the quota of a class ends, only that bucket is ranked, and its last
    accepted row becomes the class's limit. The rows themselves are then
    labelled in place by comparing with the limit: vectors are not shuffled.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")).cast("binary"))
    keyed = df.select(F.col(key), F.col(label), digest.alias("_hash"))
    keyed = keyed.withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))
    # A few bytes per bucket and class; kept, as counts and bucket ends both need it.
    shared_dir(df.sparkSession)
    fill = keyed.groupBy(label, "_bucket").agg(F.count("*").alias("_n")).checkpoint()
    counts = fill.groupBy(label).agg(F.sum("_n").alias("n_c"))
    quotas = split_quotas(counts, label, share).select(label, "quota")

    upto = F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket"))
    ends = (fill.withColumn("_upto", upto)
            .join(quotas, label)
            .where((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
            .select(label, F.struct("_bucket", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_need")).alias("_end")))
    in_bucket = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", key))
    limits = (keyed.withColumn("_end", F.try_element_at(class_map(ends, label, "_end"), F.col(label)))
              .where(F.col("_bucket") == F.col("_end._bucket"))
              .withColumn("_place", in_bucket)
              .where(F.col("_place") == F.col("_end._need"))
              .select(label, F.struct("_hash", F.col(key).alias("_key")).alias("_limit")))
    mine = F.struct(digest.alias("_hash"), F.col(key).alias("_key"))
    limit = F.try_element_at(class_map(limits, label, "_limit"), F.col(label))
    return (df.withColumn("_limit", limit)
            .withColumn("split", F.when(mine <= F.col("_limit"), F.lit("val")).otherwise(F.lit("train")))
            .drop("_limit"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("rows"))
