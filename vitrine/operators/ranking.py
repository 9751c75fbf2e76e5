"""Keep-first, keep-latest, top-n and global numbering.

``row_number() <= n`` right above the window lets Spark cut every group to n
rows before the shuffle, so a key that holds a third of the table still sends
only n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import shared_dir


def first_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def drop_duplicates_keep_first(df: DataFrame, key: str = "productid", order: str = "row_pos") -> DataFrame:
    """One row per key, the earliest in file order."""
    return first_n_per_key(df, [key], [F.col(order).asc()])


def latest_per_product(processed: DataFrame) -> DataFrame:
    """Newest processed row per product; equal times go to the later batch id."""
    return first_n_per_key(
        processed, ["productid"], [F.col("dt_processed").desc(), F.col("batch_id").desc()])


def sample_per_class(latest: DataFrame, class_column: str, n: int) -> DataFrame:
    """n products of every class, by product id so that a rerun shows the same."""
    return first_n_per_key(latest, [class_column], [F.col("productid").asc()], n)


def global_row_number(df: DataFrame, order: list[str], name: str = "ordinal",
                      partitions: int | None = None) -> DataFrame:
    """1, 2, 3, ... over the whole frame in ``order`` (which must be unique).

    A window without a partition key would sort everything in one task. Here the
    rows are range partitioned on the full key, sorted locally and written to
    the checkpoint folder, so their places are fixed; the only global step is a
    running sum over one count per partition.
    """
    spark = df.sparkSession
    shared_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(parts, *order)
              .sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id())
              .checkpoint())
    part = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(within) + 1).alias("_size"))
    # One row per range partition: bounded by ``parts``, never by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_before") + within + 1).cast("long"))
            .drop("_part", "_before", "_place"))
