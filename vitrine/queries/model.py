"""Vector, label, scoring and training queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.common import class_map
from vitrine.functions.scores import array_total, fuse, l2_normalise
from vitrine.functions.text import with_input_text
from vitrine.operators import evaluation, labels, vectors
from vitrine.operators.model import head_logits, model_probabilities, random_head, train_logistic
from vitrine.operators.tables import KeyedTable, VersionedTable, upsert_counts, upsert_latest_wins
from vitrine.plans import reports
from vitrine.plans.scoring import label_lookup, rank_logits, rank_probabilities
from vitrine.plans.training import data_statistics, split_parts, training_frame
from vitrine.queries.adapters import Tables, with_tables
from vitrine.queries.registry import query
from vitrine.session import fresh_dir, shared_dir
from vitrine.streaming.jobs import start_scoring


def digits(vector):
    """A vector as text of whole numbers, so that engines can be compared exactly."""
    return F.array_join(F.transform(vector, lambda x: F.round(x.cast("double") * 10000).cast("bigint").cast("string")), " ")


def digits_sql(vector: str) -> str:
    return f"array_to_string(list_transform({vector}, lambda x: round(x::DOUBLE * 10000)::BIGINT), ' ')"


def _categories(t: Tables):
    return t.embeddings.select(
        F.col("prdtypecode").cast("string").alias("code"),
        F.concat(F.lit("category_"), F.col("prdtypecode").cast("string")).alias("label")).distinct()


@query("upsert_latest_wins", with_tables("emb", "emb_batch") + f"""
    SELECT product_id, run_id, prdtypecode, {digits_sql("embedding_text")} AS text_digits
    FROM (SELECT * FROM emb WHERE product_id NOT IN (SELECT product_id FROM emb_batch)
          UNION ALL SELECT * FROM emb_batch)""")
def upsert_query(t: Tables):
    return upsert_latest_wins(t.embeddings, t.embedding_batch).select(
        "product_id", "run_id", "prdtypecode", digits(F.col("embedding_text")).alias("text_digits"))


@query("keyed_upsert", with_tables("emb", "emb_batch") + f"""
    SELECT product_id, run_id, {digits_sql("embedding_image")} AS image_digits,
           (SELECT count(*) FROM emb WHERE product_id IN (SELECT product_id FROM emb_batch)) AS replaced,
           (SELECT count(*) FROM emb_batch WHERE product_id NOT IN (SELECT product_id FROM emb)) AS "new"
    FROM (SELECT * FROM emb WHERE product_id NOT IN (SELECT product_id FROM emb_batch)
          UNION ALL SELECT * FROM emb_batch)""")
def keyed_upsert(t: Tables):
    """All vectors stored in buckets, then the labelled ones changed, with the counts of that upsert."""
    table = KeyedTable(t.spark, fresh_dir(t.spark, "embeddings"))
    table.upsert(t.embeddings)
    counts = table.upsert(t.embedding_batch)
    return table.read().select("product_id", "run_id", digits(F.col("embedding_image")).alias("image_digits"),
                               F.lit(counts["replaced"]).cast("long").alias("replaced"), F.lit(counts["new"]).cast("long").alias("new"))


@query("versioned_upsert", with_tables("emb", "emb_batch") + f"""
    SELECT product_id, run_id, {digits_sql("embedding_image")} AS image_digits
    FROM (SELECT * FROM emb WHERE product_id NOT IN (SELECT product_id FROM emb_batch)
          UNION ALL SELECT * FROM emb_batch)""")
def versioned_upsert(t: Tables):
    """Three batches through the versioned table: all vectors, the labelled ones as they are,
    and the labelled ones changed. The reader sees the newest row of each product."""
    table = VersionedTable(t.spark, fresh_dir(t.spark, "embeddings"))
    labelled = t.table("labels").select(F.col("doc_id").alias("product_id"))
    table.upsert(t.embeddings)
    table.upsert(t.embeddings.join(labelled, "product_id", "left_semi"))
    table.upsert(t.embedding_batch)
    return table.read().select("product_id", "run_id", digits(F.col("embedding_image")).alias("image_digits"))


@query("upsert_counts", with_tables("emb", "emb_batch") + """
    SELECT (SELECT count(*) FROM emb WHERE product_id IN (SELECT product_id FROM emb_batch)) AS replaced,
           (SELECT count(*) FROM emb_batch WHERE product_id NOT IN (SELECT product_id FROM emb)) AS "new",
           (SELECT count(*) FROM emb) + (SELECT count(*) FROM emb_batch
                WHERE product_id NOT IN (SELECT product_id FROM emb)) AS total""")
def upsert_counts_query(t: Tables):
    return upsert_counts(t.embeddings, t.embedding_batch)


@query("run_ids_present", with_tables("emb") + "SELECT DISTINCT run_id FROM emb")
def run_ids_present(t: Tables):
    return t.embeddings.select("run_id").distinct()


@query("cumulative_stats", with_tables("emb") + """
    SELECT count(*) AS nb_classes, sum(nb)::BIGINT AS total_products,
           round(max(nb) / greatest(min(nb), 1), 2) AS imbalance_ratio
    FROM (SELECT prdtypecode, count(*) AS nb FROM emb GROUP BY prdtypecode)""")
def cumulative_stats(t: Tables):
    return reports.cumulative_stats(t.embeddings)


@query("fuse_vectors", with_tables("emb") + f"""
    SELECT product_id, len(embedding_image) + len(embedding_text) AS width,
           {digits_sql("list_concat(embedding_image, embedding_text)")} AS fused_digits FROM emb""")
def fuse_vectors(t: Tables):
    fused = t.embeddings.withColumn("fused", fuse(F.col("embedding_image"), F.col("embedding_text")))
    return fused.select("product_id", F.size("fused").cast("bigint").alias("width"),
                        digits(F.col("fused")).alias("fused_digits"))


@query("join_vectors", with_tables("emb") + f"""
    SELECT product_id, {digits_sql("list_concat(embedding_image, embedding_text)")} AS fused_digits FROM emb""")
def join_vectors(t: Tables):
    """Image and text vectors from two tables, fused through the ML vector type and back."""
    images = t.embeddings.select("product_id", "embedding_image")
    texts = t.embeddings.select("product_id", "embedding_text")
    fused = vectors.with_fused(vectors.join_vectors(images, texts))
    back = vectors.as_array(vectors.as_ml_vector(fused), out="again")
    return back.select("product_id", digits(F.col("again")).alias("fused_digits"))


@query("l2_normalise", with_tables("emb") + f"""
    SELECT product_id, {digits_sql("list_transform(embedding_image, lambda x: (x / norm)::FLOAT)")} AS unit_digits
    FROM (SELECT *, greatest(sqrt(list_sum(list_transform(embedding_image, lambda x: x::DOUBLE * x::DOUBLE))), 1e-12)
                 AS norm FROM emb)""")
def l2_query(t: Tables):
    return t.embeddings.select("product_id", digits(l2_normalise(F.col("embedding_image"))).alias("unit_digits"))


@query("class_index", with_tables("emb") + """
    SELECT code, (row_number() OVER (ORDER BY code) - 1)::INT AS class_index
    FROM (SELECT DISTINCT prdtypecode AS code FROM emb)""")
def class_index(t: Tables):
    return labels.class_index(_categories(t))


@query("encode_labels", with_tables("emb") + """
    SELECT product_id, prdtypecode, (dense_rank() OVER (ORDER BY prdtypecode) - 1)::INT AS class_index,
           'category_' || prdtypecode AS label FROM emb""")
def encode_labels(t: Tables):
    categories = _categories(t)
    index = labels.class_index(categories)
    encoded = labels.encode_labels(t.embeddings.select("product_id", "prdtypecode"), index)
    return encoded.join(labels.index_to_label(index, categories), "class_index")


@query("class_weights", with_tables("emb") + """
    SELECT prdtypecode, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight
    FROM (SELECT prdtypecode, count(*) AS n_c FROM emb GROUP BY prdtypecode)""")
def class_weights(t: Tables):
    return labels.class_weights(t.embeddings).withColumn("weight", F.round("weight", 6))


@query("row_weights", """
    SELECT l_orderkey, l_linenumber, round(n / (k * n_c), 6) AS weight
    FROM lineitem
    JOIN (SELECT l_returnflag, count(*) AS n_c, sum(count(*)) OVER () AS n, count(*) OVER () AS k
          FROM lineitem GROUP BY l_returnflag) USING (l_returnflag)""")
def row_weights(t: Tables):
    return labels.with_class_weight(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag",
    ).select("l_orderkey", "l_linenumber", F.round("weight", 6).alias("weight"))


def split_sql(source: str, key: str, label: str) -> str:
    return f"""
    counts AS (SELECT {label}, count(*) AS n_c FROM {source} GROUP BY {label}),
    total AS (SELECT sum(n_c)::BIGINT AS n, ceil(sum(n_c) * 0.2::DOUBLE)::BIGINT AS goal FROM counts),
    ideal AS (SELECT {label}, n_c, goal, floor(goal * n_c / n) AS base, goal * n_c / n - floor(goal * n_c / n) AS rest
              FROM counts, total),
    quotas AS (SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label})
                      <= (SELECT max(goal) - sum(base) FROM ideal) THEN 1 ELSE 0 END AS quota FROM ideal),
    split AS (SELECT {key}, {label},
                     CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5('42-' || {key}), {key}) <= quota
                          THEN 'val' ELSE 'train' END AS split
              FROM {source} JOIN quotas USING ({label}))"""


@query("stratified_split", with_tables("emb").rstrip() + "," + split_sql("emb", "product_id", "prdtypecode") + """
    SELECT product_id, prdtypecode, split FROM split""")
def stratified_split(t: Tables):
    return labels.stratified_split(t.embeddings).select("product_id", "prdtypecode", "split")


@query("stratified_split_events", "WITH" + split_sql("events", "event_id", "event_type") + """
    SELECT event_id, event_type, split FROM split""")
def stratified_split_events(t: Tables):
    events = t.table("events").select("event_id", "event_type")
    return labels.stratified_split(events, "event_id", "event_type")


@query("split_counts", with_tables("emb").rstrip() + "," + split_sql("emb", "product_id", "prdtypecode") + """
    SELECT split, count(*) AS rows FROM split GROUP BY split""")
def split_counts(t: Tables):
    return labels.split_counts(labels.stratified_split(t.embeddings))


@query("training_statistics", with_tables("emb").rstrip() + "," + split_sql("emb", "product_id", "prdtypecode") + """
    SELECT count(*) AS data_nb_samples, count(DISTINCT prdtypecode) AS data_nb_classes,
           sum((split = 'train')::INT)::BIGINT AS data_nb_train, sum((split = 'val')::INT)::BIGINT AS data_nb_val
    FROM split""")
def training_statistics(t: Tables):
    index = labels.class_index(_categories(t))
    encoded = labels.encode_labels(t.embeddings, index).withColumnRenamed("class_index", "label")
    return data_statistics(labels.stratified_split(encoded, "product_id", "label"))


def _ranked(t: Tables):
    return rank_logits(t.logits, label_lookup(t.class_labels))


@query("softmax_top5", with_tables("ranked") + """
    SELECT product_id, place, class_index, class_label AS label, round(p, 6) AS confidence
    FROM ranked WHERE place <= 5""")
def softmax_top5(t: Tables):
    return _ranked(t).select("product_id", F.posexplode_outer("top5").alias("pos", "s")).select(
        "product_id", (F.col("pos") + 1).cast("bigint").alias("place"),
        F.col("s.class_index").cast("bigint").alias("class_index"), F.col("s.label").alias("label"),
        F.round("s.confidence", 6).alias("confidence"))


@query("predicted_class", with_tables("ranked") + """
    SELECT product_id, class_index AS predicted_class_index, class_label AS predicted_label,
           round(p, 6) AS confidence
    FROM ranked WHERE place = 1""")
def predicted_class(t: Tables):
    return _ranked(t).select(
        "product_id", F.col("predicted_class_index").cast("bigint").alias("predicted_class_index"),
        "predicted_label", F.round("confidence", 6).alias("confidence"))


@query("scoring_stream", with_tables("ranked") + """
    SELECT product_id, class_index AS predicted_class_index, class_label AS predicted_label, round(p, 6) AS confidence
    FROM ranked WHERE place = 1""")
def scoring_stream(t: Tables):
    """Scores from a file stream over the vectors, appended to a prediction table and read back."""
    out = fresh_dir(t.spark, "scores")
    stream = t.stream("embeddings").select(F.col("vec_id").alias("product_id"), F.col("embedding").alias("logits"))
    labels_known = label_lookup(t.class_labels)

    def score(df):
        return rank_logits(df, labels_known).select(
            "product_id", F.col("predicted_class_index").cast("bigint").alias("predicted_class_index"),
            "predicted_label", F.round("confidence", 6).alias("confidence"))

    start_scoring(stream, score, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{out}/table")


@query("score_maps", with_tables("ranked") + """
    SELECT product_id, class_label AS label, round(p, 6) AS confidence FROM ranked WHERE place <= 5""")
def score_maps(t: Tables):
    return _ranked(t).select("product_id", F.explode_outer("all_scores").alias("label", "confidence")).withColumn(
        "confidence", F.round("confidence", 6))


@query("accuracy_macro_f1", with_tables("ranked").rstrip() + """,
    pairs AS (SELECT label, class_index AS prediction FROM ranked WHERE place = 1),
    classes AS (SELECT label AS c FROM pairs UNION SELECT prediction FROM pairs),
    per_class AS (
        SELECT c, (SELECT count(*) FROM pairs WHERE label = c AND prediction = c) AS tp,
               (SELECT count(*) FROM pairs WHERE label = c) AS t, (SELECT count(*) FROM pairs WHERE prediction = c) AS p
        FROM classes)
    SELECT round((SELECT avg((label = prediction)::INT) FROM pairs), 6) AS accuracy,
           round(avg(CASE WHEN t + p > 0 THEN 2.0::DOUBLE * tp / (t + p) ELSE 0 END), 6) AS macro_f1,
           count(*) AS classes
    FROM per_class""")
def accuracy_macro_f1(t: Tables):
    scored = _ranked(t).select("label", F.col("predicted_class_index").alias("prediction"))
    return evaluation.accuracy_and_macro_f1(scored).select(
        F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"), "classes")


@query("label_agreement", """
    WITH classes AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels),
    per_class AS (
        SELECT c, (SELECT count(*) FROM labels WHERE quality = c AND toxic = c) AS tp,
               (SELECT count(*) FROM labels WHERE quality = c) AS t, (SELECT count(*) FROM labels WHERE toxic = c) AS p
        FROM classes)
    SELECT round(avg(CASE WHEN t + p > 0 THEN 2.0::DOUBLE * tp / (t + p) ELSE 0 END), 6) AS macro_f1 FROM per_class""")
def label_agreement(t: Tables):
    return evaluation.macro_f1(t.table("labels"), "quality", "toxic").select(F.round("macro_f1", 6).alias("macro_f1"))


@query("weighted_loss", with_tables("probs").rstrip() + """,
    counts AS (SELECT label AS c, count(*) AS n_c FROM embeddings GROUP BY label),
    weights AS (SELECT c, sum(n_c) OVER () / (count(*) OVER () * n_c) AS w FROM counts),
    terms AS (SELECT label, class_index, -ln(p) AS nll, coalesce(w, 0) AS w
              FROM probs LEFT JOIN weights ON class_index = c)
    SELECT round(0.9::DOUBLE * sum(CASE WHEN class_index = label THEN w * nll END)
                     / sum(CASE WHEN class_index = label THEN w END)
                 + 0.1::DOUBLE / count(DISTINCT class_index) * sum(w * nll)
                     / sum(CASE WHEN class_index = label THEN w END), 5) AS loss
    FROM terms""")
def weighted_loss(t: Tables):
    weight = labels.class_weights(t.logits, "label")
    known = class_map(weight, "label", "weight")
    per_index = F.transform(F.sequence(F.lit(0), F.size("logits") - 1),
                            lambda i: F.coalesce(F.try_element_at("_known", i), F.lit(0.0)))
    weighted = t.logits.withColumn("_known", known).withColumn("weights", per_index)
    return evaluation.weighted_smoothed_loss(weighted, F.col("weights")).select(F.round("loss", 5).alias("loss"))


@query("text_embedding")
def text_embedding(t: Tables):
    embedded = vectors.hashed_text_vectors(with_input_text(
        t.raw.select("productid", "product_designation", "product_description"), parallelism=t.parallelism))
    norm = F.sqrt(array_total(F.transform("embedding_text", lambda x: x.cast("double") * x)))
    return embedded.select("productid", F.size("embedding_text").alias("width"),
                           F.round(norm, 5).alias("norm"), "embedding_text")


def _stored_training_frame(t: Tables):
    """Written once, as every fit reads it several times."""
    shared_dir(t.spark)
    return training_frame(t.embeddings, _categories(t)).checkpoint()


@query("batch_embeddings", """
    WITH bytes AS (
        SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents),
    pixels AS (
        SELECT doc_id, string_split(regexp_replace(h, '(..)', '\\1 ', 'g'), ' ') AS hexes, n, (n + 2) // 3 AS pixels FROM bytes),
    colours AS (
        SELECT doc_id, [CASE WHEN 3 * p + k <= n THEN CAST('0x' || hexes[3 * p + k] AS INT) ELSE 32 END FOR k IN [1, 2, 3]] AS bgr
        FROM pixels, LATERAL (SELECT unnest(range(0, pixels)) AS p)),
    cells AS (
        SELECT doc_id, bgr[3] * 8 // 256 * 48 + bgr[2] * 8 // 256 * 6 + bgr[1] * 6 // 256 AS cell, count(*) AS n
        FROM colours GROUP BY ALL),
    images AS (
        SELECT doc_id, count(*) AS n_colours, round(max(n) / sqrt(sum(n * n)), 4) AS most FROM cells GROUP BY doc_id),
    deliveries AS (
        SELECT doc_id, source AS run_id, n_chars, text FROM documents
        UNION ALL SELECT doc_id, 'redelivery', n_chars, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
    SELECT d.doc_id AS product_id, run_id, 768 AS text_width, 384 AS image_width,
           CAST(coalesce(n_colours, 1) AS BIGINT) AS n_colours, coalesce(most, 1.0) AS most, 1.0 AS image_norm
    FROM deliveries d LEFT JOIN images USING (doc_id) WHERE n_chars >= 400""")
def batch_embeddings(t: Tables):
    """The embedding job on all deliveries. The bytes of a text serve as the pixels of its image."""
    batch = t.deliveries.withColumn("image_exists", F.col("n_chars") >= 400)
    pixels = F.floor((F.octet_length(F.col("text").cast("binary")) + 2) / 3).cast("int")
    data = F.rpad(F.col("text").cast("binary"), pixels * 3, F.lit(b" "))
    pictures = t.table("documents").select(
        F.col("doc_id").alias("productid"), (F.col("doc_id") + 1_000_000).alias("imageid"),
        F.struct(F.lit("").alias("origin"), F.lit(1).alias("height"), pixels.alias("width"),
                 F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data")).alias("image"))
    embedded = vectors.batch_embeddings(batch, pictures, designation="product_designation",
                                        description="product_description", parallelism=t.parallelism)
    image = F.transform("embedding_image", lambda x: x.cast("double"))
    return embedded.select(
        "product_id", "run_id", F.size("embedding_text").alias("text_width"), F.size("embedding_image").alias("image_width"),
        F.size(F.filter("embedding_image", lambda x: x > 0)).cast("long").alias("n_colours"),
        F.round(F.array_max(image), 4).alias("most"),
        F.round(F.sqrt(array_total(F.transform(image, lambda x: x * x))), 4).alias("image_norm"))


@query("head_scores")
def head_scores(t: Tables):
    """Forward pass of an untrained head over all fused vectors."""
    fused = vectors.with_fused(t.embeddings)
    scored = head_logits(fused, random_head(64, 27, (128, 64, 32), "GELU"))
    return rank_logits(scored, label_lookup(t.class_labels)).select(
        "product_id", "predicted_class_index", "predicted_label", F.round("confidence", 5).alias("confidence"))


@query("train_and_score", with_tables("emb").rstrip() + "," + split_sql("emb", "product_id", "prdtypecode") + """
    SELECT product_id, (SELECT count(DISTINCT e.prdtypecode) FROM emb e WHERE e.prdtypecode < split.prdtypecode) AS label,
           true AS known_label, true AS in_range FROM split WHERE split = 'val'""")
def train_and_score(t: Tables):
    """Split, train a balanced logistic head on the train part, score the validation part."""
    categories = _categories(t)
    train, val = split_parts(_stored_training_frame(t))
    model = train_logistic(train)
    lookup = label_lookup(labels.index_to_label(labels.class_index(categories), categories))
    scored = rank_probabilities(model_probabilities(val, model), lookup)
    return scored.select(
        "product_id", F.col("label").cast("long").alias("label"),
        F.col("predicted_label").startswith("category_").alias("known_label"),
        F.col("confidence").between(0, 1).alias("in_range"))
