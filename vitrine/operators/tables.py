"""Keyed writes: insert-ignore, latest-wins upsert, first-wins map, bucketed and versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from vitrine.operators.ranking import first_n_per_key

ROW_KEY = ["productid", "batch_id"]
VERSION_LOG = "version int, kind string, committed_at timestamp"


def rows_to_insert(batch: DataFrame, stored: DataFrame | None, keys: list[str] = ROW_KEY,
                   order: str = "row_pos") -> DataFrame:
    """Batch rows whose key is new: first of its key in the batch, absent from the store."""
    firsts = first_n_per_key(batch, keys, [F.col(order).asc()])
    return firsts if stored is None else firsts.join(stored.select(*keys), keys, "left_anti")


def insert_ignore(batch: DataFrame, stored: DataFrame | None, keys: list[str] = ROW_KEY,
                  order: str = "row_pos") -> DataFrame:
    """The table after the insert; rows already stored are left alone."""
    fresh = rows_to_insert(batch, stored, keys, order).drop(order)
    return fresh if stored is None else stored.unionByName(fresh)


def upsert_latest_wins(stored: DataFrame | None, batch: DataFrame, key: str = "product_id") -> DataFrame:
    """Stored rows without those the batch replaces, plus the batch.

    Only the ids of the batch are compared; where they are few, adaptive
    execution broadcasts them and the stored vectors are not shuffled.
    """
    if stored is None:
        return batch
    return stored.join(batch.select(key), key, "left_anti").unionByName(batch)


def upsert_counts(stored: DataFrame, batch: DataFrame, key: str = "product_id") -> DataFrame:
    """replaced, new, total after the upsert, from key columns alone.

    The key is unique in the store, so the rows that find their id in the batch
    are the replaced ones.
    """
    ids = batch.select(key).distinct()
    rows, stored_rows = (f.agg(F.count("*")).scalar() for f in (ids, stored))
    hits = stored.select(key).join(ids, key, "left_semi")
    return (hits.agg(F.count("*").alias("replaced"))
            .select("replaced", (rows - F.col("replaced")).alias("new"),
                    (stored_rows + rows - F.col("replaced")).alias("total")))


def category_map_first_wins(stored: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """Known codes keep their label; new codes are added. Columns code, label."""
    if stored is None:
        return pairs
    return stored.unionByName(pairs.join(stored.select("code"), "code", "left_anti"))


def read_if_there(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_batches(spark: SparkSession, path: str, names: list[str], schema: StructType | str) -> DataFrame | None:
    """Columns ``schema`` of some batches of a table partitioned by ``batch_id``, which is text; None if it holds none of them.

    Only the folders of these batches are listed: the cost does not grow with the batches the table holds already.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{path}/batch_id={escape(name)}" for name in names]
    there = [f for f in folders if files.exists(hadoop(f))]
    if not there:
        return None
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else StructType([*schema])
    # The folders' names are no patterns.
    return (spark.read.schema(kinds.add("batch_id", "string")).option("basePath", path).option("__globPaths__", "false")
            .parquet(*there))


def batch_rows(spark: SparkSession, path: str, batch_id: str) -> int:
    """Stored rows of one batch; answered from the Parquet footers of its partition."""
    table = read_if_there(spark, path)
    return 0 if table is None else table.where(F.col("batch_id") == batch_id).count()


def append_new_rows(batch: DataFrame, path: str, batch_id: str, order: str = "row_pos") -> int:
    """Insert-ignore one batch into the Parquet table at ``path``; rows inserted.

    The table is partitioned by ``batch_id`` and the key holds it, so only this
    batch's partition is read for the comparison. A replayed batch adds nothing.
    The rows are counted as they are written.
    """
    stored = read_if_there(batch.sparkSession, path)
    if stored is not None:
        stored = stored.where(F.col("batch_id") == batch_id)
    written = Observation()
    fresh = rows_to_insert(batch, stored, ROW_KEY, order).drop(order).observe(written, F.count(F.lit(1)).alias("rows"))
    fresh.write.mode("append").partitionBy("batch_id").parquet(path)
    return written.get["rows"]


def replace_batch(df: DataFrame, path: str) -> None:
    """Write the batches in ``df`` anew, leaving other batches' partitions alone."""
    (by_batch(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def by_batch(df: DataFrame) -> DataFrame:
    """Rows of a batch side by side, so that a write by batch leaves few files a batch, not one for every task.

    Adaptive execution splits a batch that is large.
    """
    return df.hint("rebalance", F.col("batch_id"))


class KeyedTable:
    """A keyed Parquet table in ``buckets`` folders by the hash of its key.

    An upsert reads and rewrites only the buckets that its keys fall into; all other files stay as they are, and a
    reader just reads. A failed upsert may leave some buckets done and others not: repeated, it ends in the same
    table. One writer at a time. The number of buckets is part of the path and stays for the life of the table.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "product_id", buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.path = f"{self.root}/buckets={buckets}"
        self.key = key
        self.buckets = buckets

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> DataFrame | None:
        table = read_if_there(self.spark, self.path)
        if table is None and read_if_there(self.spark, self.root) is not None:
            raise ValueError(f"{self.root} has another number of buckets than {self.buckets}")
        return table

    def read(self) -> DataFrame | None:
        table = self._stored()
        return None if table is None else table.drop("bucket")

    def upsert(self, batch: DataFrame) -> dict:
        """Latest-wins upsert of ``batch``, whose keys are unique; counts of replaced and new rows and rewritten buckets."""
        stored, fresh = self._stored(), self._bucketed(batch)
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return {"replaced": 0, "new": 0, "buckets": 0}
        arrived, after = Observation(), Observation()
        rows, before = fresh.observe(arrived, F.count(F.lit(1)).alias("n")), 0
        if stored is not None:
            # A partition filter: no other bucket is listed, read or written. Rows are counted from the footers.
            here = stored.where(F.col("bucket").isin(touched))
            before = here.count()
            keys = fresh.select(F.col(self.key).alias("_key"))
            rows = here.join(keys, F.col(self.key).eqNullSafe(F.col("_key")), "left_anti").unionByName(rows)
        (rows.observe(after, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))
        new = after.get["n"] - before
        return {"replaced": arrived.get["n"] - new, "new": new, "buckets": len(touched)}


class VersionedTable:
    """A keyed Parquet table that is never changed in place.

    ``<root>/v=<n>`` holds what version n added: a whole table ("base") or just
    the rows of an upsert ("layer"). ``<root>/_versions`` lists the committed
    versions, and readers go by it, so a failed write leaves the old state.
    An upsert writes its own rows only; a reader takes the newest row of a key.
    An upsert never copies the table; ``fold`` does, when its owner wants fewer layers to read.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "product_id"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key

    def _state(self) -> tuple[int, int] | None:
        """(last base, last version); every version after the base is a layer on it."""
        log = read_if_there(self.spark, f"{self.root}/_versions", VERSION_LOG)
        if log is None:
            return None
        last = log.agg(F.max(F.when(F.col("kind") == "base", F.col("version"))), F.max("version")).first()
        return last[0], last[1]

    def version(self) -> int | None:
        state = self._state()
        return state[1] if state else None

    def read(self) -> DataFrame | None:
        state = self._state()
        if state is None:
            return None
        base, last = state
        rows = self.spark.read.parquet(f"{self.root}/v={base}")
        layers = range(base + 1, last + 1)
        if not layers:
            return rows
        added = (self.spark.read.schema(StructType([*rows.schema, StructField("v", IntegerType())])).option("basePath", self.root)
                 .parquet(*[f"{self.root}/v={n}" for n in layers]))
        newest = added.groupBy(self.key).agg(F.max("v").alias("v"))
        live = added.join(newest, [self.key, "v"], "left_semi") if len(layers) > 1 else added
        return upsert_latest_wins(rows, live.drop("v"), self.key)

    def _commit(self, df: DataFrame, kind: str) -> int:
        number = (self.version() or 0) + 1
        # Left-overs of a failed attempt at this number were never committed.
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.root}/v={number}")
        (self.spark.range(1).select(F.lit(number).alias("version"), F.lit(kind).alias("kind"),
                                    F.current_timestamp().alias("committed_at"))
         .coalesce(1).write.mode("append").parquet(f"{self.root}/_versions"))
        return number

    def write(self, df: DataFrame) -> int:
        """Replace the whole table; returns the version number."""
        return self._commit(df, "base")

    def upsert(self, batch: DataFrame) -> dict:
        """Latest-wins upsert of ``batch``; counts of new, replaced and total rows."""
        stored = self.read()
        if stored is None:
            rows = self.spark.read.parquet(f"{self.root}/v={self.write(batch)}").count()
            return {"replaced": 0, "new": rows, "total": rows}
        counts = upsert_counts(stored, batch, self.key).first().asDict()
        self._commit(batch, "layer")
        return counts

    def layers(self) -> int:
        """Upserts since the last base."""
        base, last = self._state() or (0, 0)
        return last - base

    def fold(self) -> int:
        """Write base and layers as a new base; returns the version number."""
        return self.write(self.read())
