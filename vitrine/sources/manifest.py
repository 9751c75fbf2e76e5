"""Content manifest of dataset folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/+"


def file_digests(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """dataset, file (its place below ``path``), size and md5 of every file below ``path``."""
    root = re.sub(_SCHEME, "/", path).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    place = F.substr(F.regexp_replace("path", _SCHEME, "/"), F.lit(len(root) + 2))
    return files.select(F.lit(dataset).alias("path"), place.alias("file"),
                        F.col("length").alias("size"), F.md5("content").alias("md5"))


def _folder_digest(digests: str = "md5"):
    """Digest of a folder from its entries: that of the sums of the entries' hashes, each taken with its name.

    Sums need no ordered list of entries and merge on the map side, however many a folder has.
    """
    named = F.md5(F.concat_ws(":", "name", digests).cast("binary"))
    sums = [F.sum(F.conv(F.substring(named, start, 8), 16, 10).cast("decimal(38,0)")).cast("string") for start in (1, 9, 17, 25)]
    return F.md5(F.concat_ws("-", *sums).cast("binary"))


def manifest(digests: DataFrame) -> DataFrame:
    """path, md5, size, nfiles per dataset, the digest being that of a Merkle tree over its folders.

    Level by level, from the deepest, the files and folders of a folder are folded into its digest, so a file that moves to
    another folder changes the digest. One number reaches the driver, the depth of the deepest file.
    """
    depth = F.size(F.split("file", "/"))
    files = digests.withColumn("depth", depth).select("path", "file", "depth", "md5", "size", F.lit(1).cast("long").alias("nfiles"))
    deepest = files.agg(F.max("depth")).first()[0] or 1
    name, folder = F.substring_index("file", "/", -1), F.regexp_replace("file", r"/?[^/]*$", "")
    level = files.where(F.col("depth") == deepest).drop("depth")
    for at in range(deepest, 0, -1):
        folders = (level.select("path", folder.alias("folder"), name.alias("name"), "md5", "size", "nfiles")
                   .groupBy("path", "folder").agg(_folder_digest().alias("md5"), F.sum("size").alias("size"), F.sum("nfiles").alias("nfiles"))
                   .withColumnRenamed("folder", "file"))
        level = folders if at == 1 else folders.unionByName(files.where(F.col("depth") == at - 1).drop("depth"))
    return level.select("path", "md5", "size", "nfiles")
