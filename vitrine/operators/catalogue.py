"""Typing, image checks and paths of a product batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW_COLUMNS = (
    "productid", "imageid", "prdtypecode", "prodtype",
    "product_designation", "product_description",
)
PROCESSED_COLUMNS = (
    "productid", "imageid", "prdtypecode", "prodtype", "designation",
    "description", "path_image", "image_exists", "batch_id",
)
# Fixed format of an image file name.
IMAGE_NAME = "image_%d_product_%d.jpg"
IMAGE_NAME_PATTERN = r"image_(\d+)_product_(\d+)\.jpg$"
IMAGE_PREFIX = "images/"
IMAGE_KEY = ["imageid", "productid"]


def _typed(cast) -> dict[str, Column]:
    return {
        "productid": cast("productid", "bigint"),
        "imageid": cast("imageid", "bigint"),
        "prdtypecode": cast("prdtypecode", "int"),
        "prodtype": F.col("prodtype").cast("string"),
        "product_designation": F.coalesce(F.col("product_designation").cast("string"), F.lit("")),
        "product_description": F.coalesce(F.col("product_description").cast("string"), F.lit("")),
    }


def cast_types(df: DataFrame) -> DataFrame:
    """Typed batch. A value that is no number stops the job, as untyped ids must."""
    return df.withColumns(_typed(lambda name, kind: F.col(name).cast(kind)))


def split_castable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows as they came) for sources nobody vouches for."""
    good = F.lit(True)
    for name, kind in (("productid", "bigint"), ("imageid", "bigint"), ("prdtypecode", "int")):
        good = good & F.col(name).try_cast(kind).isNotNull()
    return cast_types_leniently(df.where(good)), df.where(~good)


def cast_types_leniently(df: DataFrame) -> DataFrame:
    return df.withColumns(_typed(lambda name, kind: F.col(name).try_cast(kind)))


def split_blank_designation(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a designation, rows without) for scoring requests."""
    filled = F.coalesce(F.trim("designation") != "", F.lit(False))
    return df.where(filled), df.where(~filled)


def image_name(imageid: Column, productid: Column) -> Column:
    return F.format_string(IMAGE_NAME, imageid, productid)


def image_path(batch_id: Column, imageid: Column, productid: Column, prefix: str = IMAGE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), batch_id, F.lit("/"), image_name(imageid, productid))


def parse_image_listing(listing: DataFrame, path: str = "path") -> DataFrame:
    """Distinct (imageid, productid) keys of the product images in a listing."""
    named = listing.where(F.col(path).rlike(IMAGE_NAME_PATTERN))
    return named.select(
        F.regexp_extract(path, IMAGE_NAME_PATTERN, 1).cast("bigint").alias("imageid"),
        F.regexp_extract(path, IMAGE_NAME_PATTERN, 2).cast("bigint").alias("productid"),
    ).distinct()


def check_images(df: DataFrame, image_keys: DataFrame, on: list[str] = IMAGE_KEY) -> DataFrame:
    """Add ``image_exists``: does the listing hold this product's image?

    ``image_keys`` are distinct, so the left join keeps one row per product. The
    keys are two longs and are hashed on both; no product key is hot after the
    duplicates are gone.
    """
    marked = image_keys.withColumn("_found", F.lit(True))
    return (df.join(marked, on, "left")
            .withColumn("image_exists", F.col("_found").isNotNull())
            .drop("_found"))


def with_image_path(df: DataFrame, prefix: str = IMAGE_PREFIX) -> DataFrame:
    path = image_path(F.col("batch_id"), F.col("imageid"), F.col("productid"), prefix)
    return df.withColumn("path_image", F.when(F.col("image_exists"), path))


def image_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("image_exists").alias("found"), F.count("*").alias("total"))


def valid_products(processed: DataFrame) -> DataFrame:
    """Only products with an image are embedded."""
    return processed.where(F.col("image_exists"))


def new_category_pairs(df: DataFrame, order: str = "row_pos") -> DataFrame:
    """(code, label) of a batch, first label per code in file order.

    ``min_by`` folds on the map side, so a class with most of the rows sends
    one row per task.
    """
    return (df.groupBy(F.col("prdtypecode").cast("string").alias("code"))
            .agg(F.min_by("prodtype", order).alias("label")))
