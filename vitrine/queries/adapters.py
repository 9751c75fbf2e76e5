"""The given tables seen as catalogue, predictions, embeddings and run history.

Every adapter exists twice, as a DataFrame and as a common table expression, so
that a query and its SQL start from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.catalogue import image_path

REDELIVERED = 1_000_000_000_000


def as_products(documents: DataFrame) -> DataFrame:
    """Documents as products: first line is the designation, the rest the description."""
    code = (F.when(F.col("lang") == "de", 10).when(F.col("lang") == "en", 20)
            .when(F.col("lang") == "es", 30).when(F.col("lang") == "fr", 40))
    line_end = F.instr("text", "\n")
    return documents.select(
        F.col("doc_id").alias("productid"),
        (F.col("doc_id") + 1_000_000).alias("imageid"),
        code.alias("prdtypecode"),
        F.col("lang").alias("prodtype"),
        F.substring_index("text", "\n", 1).alias("product_designation"),
        F.when(line_end > 0, F.substr("text", line_end + 1)).alias("product_description"),
        F.col("source").alias("batch_id"),
        F.col("doc_id").alias("row_pos"),
        "n_chars")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """A table as a file stream. It may be one file or a folder of files: a pattern, here of one name, takes either."""
        return self.spark.readStream.schema(self.table(name).schema).parquet(f"{self.dir}/{name}.parque[t]")

    @property
    def parallelism(self) -> int | None:
        """Tasks for the text queries, as the session asks for; none by default."""
        asked = self.spark.conf.get("spark.vitrine.textParallelism", None)
        return int(asked) if asked else None

    @cached_property
    def raw(self) -> DataFrame:
        return as_products(self.table("documents"))

    def redelivered(self, raw: DataFrame) -> DataFrame:
        """The labelled documents once more, in a later batch under upper-case labels."""
        labelled = self.table("labels").select(F.col("doc_id").alias("productid"))
        return raw.join(labelled, "productid", "left_semi").withColumns({
            "prodtype": F.upper("prodtype"), "batch_id": F.lit("redelivery"),
            "row_pos": F.col("row_pos") + REDELIVERED})

    @cached_property
    def deliveries(self) -> DataFrame:
        first = self.raw.withColumn("dt_processed", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        again = self.redelivered(self.raw).withColumn("dt_processed", F.lit("2024-02-01 12:30:00").cast("timestamp_ntz"))
        return first.unionByName(again)

    @cached_property
    def processed(self) -> DataFrame:
        return self.deliveries.select(
            "productid", "imageid", "prdtypecode", "prodtype",
            F.col("product_designation").alias("designation"),
            F.coalesce("product_description", F.lit("")).alias("description"),
            (F.col("n_chars") >= 400).alias("image_exists"), "batch_id", "dt_processed")

    @cached_property
    def image_listing(self) -> DataFrame:
        """File paths of the product images: documents of at least 400 characters have one."""
        path = image_path(F.col("batch_id"), F.col("imageid"), F.col("productid"))
        return self.raw.where(F.col("n_chars") >= 400).select(path.alias("path"))

    @cached_property
    def embeddings(self) -> DataFrame:
        """First half of a vector is the image part, second half the text part."""
        half = F.floor(F.size("embedding") / 2).cast("int")
        return self.table("embeddings").select(
            F.col("vec_id").alias("product_id"),
            F.slice("embedding", half + 1, half).alias("embedding_text"),
            F.slice("embedding", F.lit(1), half).alias("embedding_image"),
            (F.col("label") * 10 + 10).alias("prdtypecode"),
            F.concat(F.lit("run_"), F.col("label").cast("string")).alias("run_id"))

    @cached_property
    def embedding_batch(self) -> DataFrame:
        """Labelled vectors again with the parts exchanged; those of quality 0 as new products."""
        labels = self.table("labels").select(F.col("doc_id").alias("product_id"), "quality")
        return self.embeddings.join(labels, "product_id").select(
            F.when(F.col("quality") == 0, F.col("product_id") + 1_000_000)
            .otherwise(F.col("product_id")).alias("product_id"),
            F.col("embedding_image").alias("embedding_text"),
            F.col("embedding_text").alias("embedding_image"),
            "prdtypecode", F.lit("redelivery").alias("run_id"))

    @cached_property
    def logits(self) -> DataFrame:
        """All values of a vector as scores of as many classes."""
        return self.table("embeddings").select(
            F.col("vec_id").alias("product_id"), F.col("embedding").alias("logits"), "label")

    @cached_property
    def class_labels(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("label").alias("class_index"),
            F.concat(F.lit("category_"), F.col("label").cast("string")).alias("label")).distinct()

    @cached_property
    def predictions(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("props").alias("designation"),
            F.col("event_type").alias("predicted_class"),
            F.least(F.col("value") / 500, F.lit(1.0)).alias("confidence"),
            (F.col("event_type") != "error").alias("has_image"),
            F.col("ts").cast("timestamp_ntz").alias("dt_predicted"))

    @cached_property
    def curves(self) -> DataFrame:
        """Orders as training runs, line numbers as epochs."""
        return self.table("lineitem").groupBy(
            F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("epoch"),
        ).agg((F.max("l_extendedprice") / 10000).alias("val_loss"),
              (F.max("l_discount") * 10).alias("val_f1"),
              (F.max("l_quantity") / 50).alias("val_acc"))

    @cached_property
    def runs(self) -> DataFrame:
        begin = F.col("o_orderdate").cast("timestamp_ntz")
        return self.table("orders").select(
            F.col("o_orderkey").alias("run_id"), begin.alias("start_time"),
            (begin + F.make_dt_interval(secs=(F.col("o_custkey") * 37).cast("decimal(18,6)"))).alias("end_time"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 600000).alias("final_val_f1_macro"),
            F.col("o_orderpriority").alias("data_run_id"),
            F.create_map(F.lit("epochs"), F.col("o_custkey").cast("string"),
                         F.lit("dropout"), (F.col("o_custkey") / 7).cast("string"),
                         F.lit("activation"), F.col("o_orderstatus")).alias("params"))

    @cached_property
    def trials(self) -> DataFrame:
        state = (F.when(F.col("o_orderstatus") == "F", "COMPLETE")
                 .when(F.col("o_orderstatus") == "P", "FAIL").otherwise("PRUNED"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("trial"), (F.col("o_totalprice") / 600000).alias("value"),
            state.alias("state"), F.col("o_orderpriority").alias("params"))

    @cached_property
    def model_orders(self) -> DataFrame:
        """Orders as model versions of their customer, with the customer's first and last one."""
        ends = self.table("orders").groupBy("o_custkey").agg(
            F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
        return self.table("orders").join(ends, "o_custkey").select(
            F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"),
            F.col("o_orderkey").alias("version"), F.col("o_orderkey").alias("run_id"),
            F.when(F.col("o_orderkey") == F.col("first_key"), "Production")
            .when(F.col("o_orderstatus") == "F", "Archived").otherwise("None").alias("stage"),
            (F.col("o_orderkey") == F.col("last_key")).alias("is_last"))

    @cached_property
    def versions(self) -> DataFrame:
        return self.model_orders.where(~F.col("is_last")).drop("is_last")

    @cached_property
    def challengers(self) -> DataFrame:
        return self.model_orders.where("is_last").select("name", "run_id")


CTE = {
    "raw": """
        SELECT doc_id AS productid, doc_id + 1000000 AS imageid,
               CASE lang WHEN 'de' THEN 10 WHEN 'en' THEN 20 WHEN 'es' THEN 30 WHEN 'fr' THEN 40 END AS prdtypecode,
               lang AS prodtype, split_part(text, chr(10), 1) AS product_designation,
               CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END
                   AS product_description,
               source AS batch_id, doc_id AS row_pos, n_chars
        FROM documents""",
    "deliveries": """
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS dt_processed FROM raw
        UNION ALL
        SELECT productid, imageid, prdtypecode, upper(prodtype), product_designation, product_description,
               'redelivery', row_pos + 1000000000000, n_chars, TIMESTAMP '2024-02-01 12:30:00'
        FROM raw WHERE productid IN (SELECT doc_id FROM labels)""",
    "processed": """
        SELECT productid, imageid, prdtypecode, prodtype, product_designation AS designation,
               coalesce(product_description, '') AS description, n_chars >= 400 AS image_exists,
               batch_id, dt_processed
        FROM deliveries""",
    "latest": """
        SELECT * FROM processed
        QUALIFY row_number() OVER (PARTITION BY productid ORDER BY dt_processed DESC, batch_id DESC) = 1""",
    "emb": """
        SELECT vec_id AS product_id, embedding[(len(embedding) // 2 + 1):len(embedding)] AS embedding_text,
               embedding[1:(len(embedding) // 2)] AS embedding_image, label * 10 + 10 AS prdtypecode,
               'run_' || label AS run_id
        FROM embeddings""",
    "emb_batch": """
        SELECT CASE WHEN quality = 0 THEN product_id + 1000000 ELSE product_id END AS product_id,
               embedding_image AS embedding_text, embedding_text AS embedding_image, prdtypecode,
               'redelivery' AS run_id
        FROM emb JOIN labels ON product_id = doc_id""",
    "scores": """
        SELECT vec_id AS product_id, label, unnest(range(len(embedding))) AS class_index,
               unnest(embedding)::DOUBLE AS logit
        FROM embeddings""",
    "probs": """
        SELECT product_id, label, class_index,
               exp(logit - m) / sum(exp(logit - m)) OVER (PARTITION BY product_id) AS p
        FROM (SELECT *, max(logit) OVER (PARTITION BY product_id) AS m FROM scores)""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY p DESC, class_index) AS place,
               CASE WHEN class_index IN (SELECT label FROM embeddings)
                    THEN 'category_' || class_index ELSE 'class_' || class_index END AS class_label
        FROM probs""",
    "preds": """
        SELECT event_id AS id, props AS designation, event_type AS predicted_class,
               least(value / 500, 1.0) AS confidence, event_type <> 'error' AS has_image, ts AS dt_predicted
        FROM events""",
    "curves": """
        SELECT l_orderkey AS run_id, l_linenumber AS epoch, max(l_extendedprice) / 10000 AS val_loss,
               max(l_discount) * 10 AS val_f1, max(l_quantity) / 50 AS val_acc
        FROM lineitem GROUP BY ALL""",
    "runs": """
        SELECT o_orderkey AS run_id, o_orderdate AS start_time, o_orderdate + to_seconds(o_custkey * 37) AS end_time,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 600000 END AS final_val_f1_macro,
               o_orderpriority AS data_run_id, o_custkey, o_orderstatus
        FROM orders""",
    "trials": """
        SELECT o_orderkey AS trial, o_totalprice / 600000 AS value,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'P' THEN 'FAIL' ELSE 'PRUNED' END AS state,
               o_orderpriority AS params
        FROM orders""",
    "model_orders": """
        SELECT 'model_' || o_custkey AS name, o_orderkey AS version, o_orderkey AS run_id,
               CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) THEN 'Production'
                    WHEN o_orderstatus = 'F' THEN 'Archived' ELSE 'None' END AS stage,
               o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS is_last
        FROM orders""",
    "versions": "SELECT name, version, run_id, stage FROM model_orders WHERE NOT is_last",
    "challengers": "SELECT name, run_id FROM model_orders WHERE is_last",
}
NEEDS = {
    "deliveries": ["raw"], "processed": ["raw", "deliveries"], "latest": ["raw", "deliveries", "processed"],
    "emb_batch": ["emb"], "probs": ["scores"], "ranked": ["scores", "probs"],
    "versions": ["model_orders"], "challengers": ["model_orders"],
}


def with_tables(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause that defines the named adapters and what they stand on."""
    wanted: list[str] = []
    for name in names:
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    body = ",\n".join(f"{name} AS ({CTE[name]})" for name in wanted)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n"
