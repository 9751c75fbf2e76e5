"""Catalogue queries: cleaning, transformation, keyed writes and gallery reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.functions.text import (
    clean_text, ellipsis, first_filled, input_text, spread, thousands, with_clean_columns, with_input_text,
)
from vitrine.operators import catalogue as ops
from vitrine.operators.quality import embedding_guard, judge_batches, measure_batches
from vitrine.operators.ranking import drop_duplicates_keep_first, latest_per_product
from vitrine.operators.tables import append_new_rows, category_map_first_wins, insert_ignore, replace_batch
from vitrine.plans import reports
from vitrine.plans.ingest import transform
from vitrine.queries.adapters import Tables, with_tables
from vitrine.queries.registry import query
from vitrine.session import fresh_dir
from vitrine.sources.batches import (
    category_json, file_stem, parse_category_json, read_processed, read_raw_csv,
)
from vitrine.sources.images import unpublished_images
from vitrine.sources.manifest import manifest

REFERENCE_WORDS_SQL = "ref|réf|reference|référence|fabricant|model|modèle|sku|asin|ean|isbn|gtin"
BLANK_SQL = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WORD_SQL = r"[\p{L}\p{N}_]"


def clean_sql(text: str, entities: bool = False) -> str:
    """The cleaning steps for an SQL engine whose regexes have no look-around."""
    out = f"coalesce({text}, '')"
    if entities:
        # These names count as entities without their semicolon too.
        for entity, sign in (("&copy", "©"), ("&middot", "·"), ("&quot", '"'), ("&amp", "&")):
            out = f"regexp_replace({out}, '{entity};?', '{sign}', 'g')"
    out = f"lower({out})"
    address = r"[\p{L}\p{N}_.\-]"
    for pattern in (
        "<[^>]+>",
        rf"https?://[^{BLANK_SQL}]+|www\.[^{BLANK_SQL}]+",
        rf"\b{address}+@{address}+\.{WORD_SQL}+\b",
        rf"\b(?:{REFERENCE_WORDS_SQL})[{BLANK_SQL}.:_\-]*[a-z0-9][a-z0-9\-_.]{{2,}}\b",
        r"[a-zA-Z]{2,}-\p{Nd}+(?:-[a-zA-Z]{2,})?",
        r"\b\p{Nd}{6,}\b",
        r"[^\p{L}\p{N}_]+",
    ):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"trim({out})"


@query("gallery_global_stats", with_tables("latest") + """
    SELECT count(*) AS total_products, count(DISTINCT prdtypecode) AS total_classes,
           round(100.0 * sum(CASE WHEN image_exists THEN 1 ELSE 0 END) / count(*), 1)::DOUBLE AS pct_with_image,
           max(batch_id) AS last_batch, max(dt_processed) AS last_batch_date
    FROM latest""")
def gallery_global_stats(t: Tables):
    return reports.global_stats(t.processed)


@query("class_distribution", with_tables("latest") + """
    SELECT prodtype, count(*) AS nb FROM latest GROUP BY prodtype ORDER BY nb DESC, prodtype""")
def class_distribution(t: Tables):
    return reports.class_distribution(t.processed)


@query("class_imbalance", with_tables("latest") + """
    SELECT CASE WHEN min(nb) > 0 THEN round(max(nb) / min(nb), 1) END AS imbalance_ratio
    FROM (SELECT prodtype, count(*) AS nb FROM latest GROUP BY prodtype)""")
def class_imbalance(t: Tables):
    return reports.imbalance_ratio(reports.class_distribution(t.processed))


@query("class_list", with_tables("processed") + "SELECT DISTINCT prdtypecode, prodtype FROM processed")
def class_list(t: Tables):
    return reports.class_list(t.processed)


@query("latest_products", with_tables("latest") + """
    SELECT productid, prdtypecode, prodtype, designation, batch_id, dt_processed FROM latest""")
def latest_products(t: Tables):
    return latest_per_product(t.processed).select(
        "productid", "prdtypecode", "prodtype", "designation", "batch_id", "dt_processed")


@query("products_for_class", with_tables("latest") + """
    SELECT productid, prodtype, designation, batch_id FROM latest WHERE prdtypecode = 20
    ORDER BY productid LIMIT 12""")
def products_for_class(t: Tables):
    return reports.products_for_class(t.processed, 20).select("productid", "prodtype", "designation", "batch_id")


@query("gallery_all_classes", with_tables("latest") + """
    SELECT prdtypecode, productid, batch_id FROM latest
    QUALIFY row_number() OVER (PARTITION BY prdtypecode ORDER BY productid) <= 12""")
def gallery_all_classes(t: Tables):
    return reports.gallery(t.processed).select("prdtypecode", "productid", "batch_id")


@query("similar_products", with_tables("latest") + """
    SELECT prodtype, productid FROM latest WHERE prodtype IN (SELECT DISTINCT upper(lang) FROM documents)
    QUALIFY row_number() OVER (PARTITION BY prodtype ORDER BY productid) <= 6""")
def similar_products(t: Tables):
    predicted = t.table("documents").select(F.upper("lang").alias("predicted_class"))
    return reports.similar_products(predicted, t.processed).select("prodtype", "productid")


@query("clean_documents", with_tables("raw") + f"""
    SELECT productid, {clean_sql("product_designation")} AS designation,
           {clean_sql("product_description")} AS description FROM raw""")
def clean_documents(t: Tables):
    raw = t.raw.select("productid", "product_designation", "product_description")
    return with_clean_columns(raw, parallelism=t.parallelism).select("productid", "designation", "description")


@query("clean_pages", f"SELECT page_id, {clean_sql('html', entities=True)} AS cleaned FROM pages")
def clean_pages(t: Tables):
    return spread(t.table("pages").select("page_id", "html"), t.parallelism).select("page_id", clean_text(F.col("html")).alias("cleaned"))


@query("clean_conversations", f"SELECT conv_id, turn, {clean_sql('text')} AS cleaned FROM conversations")
def clean_conversations(t: Tables):
    return t.table("conversations").select("conv_id", "turn", clean_text(F.col("text")).alias("cleaned"))


@query("input_text", with_tables("raw") + f"""
    SELECT productid, trim({clean_sql("product_designation")} || ' ' || {clean_sql("product_description")})
        AS input_text FROM raw""")
def input_text_query(t: Tables):
    raw = t.raw.select("productid", "product_designation", "product_description")
    return with_input_text(raw, parallelism=t.parallelism).select("productid", "input_text")


@query("input_text_requests", f"""
    SELECT p_partkey, trim({clean_sql("p_name")} || ' ' || {clean_sql("p_brand || ' ' || p_type")})
        AS input_text FROM part""")
def input_text_requests(t: Tables):
    described = F.concat_ws(" ", "p_brand", "p_type")
    return t.table("part").select("p_partkey", input_text(F.col("p_name"), described).alias("input_text"))


@query("dedupe_first", with_tables("deliveries") + """
    SELECT productid, batch_id, prodtype FROM deliveries
    QUALIFY row_number() OVER (PARTITION BY productid ORDER BY row_pos) = 1""")
def dedupe_first(t: Tables):
    return drop_duplicates_keep_first(t.deliveries).select("productid", "batch_id", "prodtype")


def _as_text(t: Tables):
    """Raw rows as a text file gives them; documents under 400 characters lack an image id."""
    image = F.when(F.col("n_chars") >= 400, F.col("imageid").cast("string")).otherwise(F.lit("n/a"))
    return t.raw.withColumns({"productid": F.col("productid").cast("string"), "imageid": image,
                              "prdtypecode": F.col("prdtypecode").cast("string")})


@query("cast_types", with_tables("raw") + """
    SELECT productid, imageid, prdtypecode, prodtype, product_designation,
           coalesce(product_description, '') AS product_description
    FROM raw WHERE n_chars >= 400""")
def cast_types(t: Tables):
    typed, _ = ops.split_castable(_as_text(t))
    return typed.select(*ops.RAW_COLUMNS)


@query("cast_rejects", with_tables("raw") + """
    SELECT productid::VARCHAR AS productid, 'n/a' AS imageid FROM raw WHERE NOT n_chars >= 400""")
def cast_rejects(t: Tables):
    _, rejected = ops.split_castable(_as_text(t))
    return rejected.select("productid", "imageid")


@query("image_check", with_tables("raw") + """
    SELECT productid, n_chars >= 400 AS image_exists,
           CASE WHEN n_chars >= 400 THEN 'images/' || batch_id || '/image_' || imageid || '_product_' || productid
                || '.jpg' END AS path_image
    FROM raw""")
def image_check(t: Tables):
    checked = ops.check_images(t.raw, ops.parse_image_listing(t.image_listing))
    return ops.with_image_path(checked).select("productid", "image_exists", "path_image")


@query("image_counts", "SELECT sum((n_chars >= 400)::INT)::BIGINT AS found, count(*) AS total FROM documents")
def image_counts(t: Tables):
    return ops.image_counts(ops.check_images(t.raw, ops.parse_image_listing(t.image_listing)))


@query("transform_deliveries", with_tables("deliveries") + f"""
    SELECT productid, imageid, prdtypecode, prodtype, {clean_sql("product_designation")} AS designation,
           {clean_sql("product_description")} AS description,
           CASE WHEN n_chars >= 400 THEN 'images/' || batch_id || '/image_' || imageid || '_product_' || productid
                || '.jpg' END AS path_image,
           n_chars >= 400 AS image_exists, batch_id
    FROM (SELECT * FROM deliveries
          QUALIFY row_number() OVER (PARTITION BY productid ORDER BY row_pos) = 1)""")
def transform_deliveries(t: Tables):
    return transform(t.deliveries, ops.parse_image_listing(t.image_listing)).select(*ops.PROCESSED_COLUMNS)


@query("quality_gates", with_tables("deliveries") + f"""
    SELECT batch_id, rows, images_matched, empty_designations, round(image_rate, 6) AS image_rate,
           CASE WHEN rows < 100 THEN 'volume' WHEN image_rate < 0.9 THEN 'image_match_rate' END AS failed_gate,
           rows >= 100 AND image_rate >= 0.9 AS passed, empty_designations > 0 AS warning
    FROM (SELECT batch_id, count(*) AS rows, sum((n_chars >= 400)::INT)::BIGINT AS images_matched,
                 sum(({clean_sql("product_designation")} = '')::INT)::BIGINT AS empty_designations,
                 sum((n_chars >= 400)::INT) / count(*) AS image_rate
          FROM deliveries GROUP BY batch_id)""")
def quality_gates(t: Tables):
    checked = ops.check_images(t.deliveries, ops.parse_image_listing(t.image_listing))
    cleaned = checked.withColumn("designation", clean_text(F.col("product_designation")))
    return (judge_batches(measure_batches(cleaned))
            .withColumn("image_rate", F.round("image_rate", 6)))


@query("valid_products", with_tables("processed") + """
    SELECT productid, batch_id FROM processed WHERE image_exists""")
def valid_products(t: Tables):
    return ops.valid_products(t.processed).select("productid", "batch_id")


@query("insert_ignore", with_tables("raw") + """
    SELECT productid, batch_id, upper(prodtype) AS prodtype FROM raw
    WHERE productid IN (SELECT doc_id FROM labels WHERE quality = 0)
    UNION ALL
    SELECT productid, batch_id, prodtype FROM raw
    WHERE productid NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def insert_ignore_query(t: Tables):
    """Products of quality 0 are stored already; the batch holds all, labelled ones twice."""
    poor = t.table("labels").where("quality = 0").select(F.col("doc_id").alias("productid"))
    stored = (t.raw.join(poor, "productid", "left_semi").withColumn("prodtype", F.upper("prodtype"))
              .drop("row_pos"))
    twice = t.redelivered(t.raw).drop("batch_id").join(t.raw.select("productid", "batch_id"), "productid")
    batch = t.raw.unionByName(twice)
    return insert_ignore(batch, stored).select("productid", "batch_id", "prodtype")


@query("batch_counts", with_tables("deliveries") + """
    SELECT batch_id, count(*) AS rows FROM deliveries GROUP BY batch_id""")
def batch_counts(t: Tables):
    return reports.batch_counts(t.deliveries)


def _fine_categories(t: Tables, frame):
    """Class per language and source."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    base = (F.when(F.col("lang") == "de", 10).when(F.col("lang") == "en", 20)
            .when(F.col("lang") == "es", 30).when(F.col("lang") == "fr", 40))
    return frame.select((base * 100 + number).alias("prdtypecode"),
                        F.concat("lang", F.lit("/"), "source").alias("prodtype"), F.col("doc_id").alias("row_pos"))


FINE_SQL = """
    WITH fine AS (
        SELECT ((CASE lang WHEN 'de' THEN 10 WHEN 'en' THEN 20 WHEN 'es' THEN 30 WHEN 'fr' THEN 40 END) * 100
                + regexp_extract(source, '(\\d+)$', 1)::INT)::VARCHAR AS code,
               lang || '/' || source AS label, doc_id
        FROM documents),
    stored AS (
        SELECT code, upper(min_by(label, doc_id)) AS label FROM fine
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0 AND toxic = 1) GROUP BY code),
    fresh AS (SELECT code, min_by(label, doc_id) AS label FROM fine GROUP BY code),
    merged AS (
        SELECT code, label FROM stored
        UNION ALL SELECT code, label FROM fresh WHERE code NOT IN (SELECT code FROM stored))
"""


def _merged_categories(t: Tables):
    documents = t.table("documents")
    early = t.table("labels").where("quality = 0 AND toxic = 1").select("doc_id")
    stored = ops.new_category_pairs(_fine_categories(t, documents.join(early, "doc_id", "left_semi")))
    stored = stored.withColumn("label", F.upper("label"))
    return category_map_first_wins(stored, ops.new_category_pairs(_fine_categories(t, documents)))


@query("category_map_first_wins", FINE_SQL + "SELECT code, label FROM merged")
def category_map(t: Tables):
    return _merged_categories(t)


@query("category_json", FINE_SQL + """
    SELECT '{' || string_agg('"' || code || '":"' || label || '"', ',' ORDER BY code) || '}' AS value FROM merged""")
def category_json_query(t: Tables):
    return category_json(_merged_categories(t))


@query("category_json_rows", FINE_SQL + "SELECT code, label FROM merged")
def category_json_rows(t: Tables):
    return parse_category_json(category_json(_merged_categories(t)))


@query("raw_csv_round_trip", with_tables("raw") + """
    SELECT productid::VARCHAR AS productid, prodtype, product_designation,
           product_description, batch_id FROM raw""")
def raw_csv_round_trip(t: Tables):
    """All products written as a raw CSV batch and read back, texts with quotes and line ends included."""
    path = fresh_dir(t.spark, "raw-csv")
    (t.raw.select(*ops.RAW_COLUMNS, "batch_id").write.option("sep", ";").option("header", True)
     .option("quote", '"').option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_raw_csv(t.spark, path).select(
        "productid", "prodtype", "product_designation", "product_description", "batch_id")


@query("split_csv_round_trip", with_tables("raw") + """
    SELECT productid::VARCHAR AS productid, prodtype, product_designation, product_description, 'b1' AS batch_id,
           true AS in_order FROM raw""")
def split_csv_round_trip(t: Tables):
    """All products written in the order of their ids, read back in ranges as one batch with their places."""
    path = fresh_dir(t.spark, "raw-csv")
    (t.raw.select(*ops.RAW_COLUMNS).repartitionByRange("productid").sortWithinPartitions("productid")
     .write.option("sep", ";").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    rows = read_raw_csv(t.spark, path, "b1", split=True)
    number = F.col("productid").cast("long")
    before = F.lag(number).over(Window.partitionBy("row_pos.file").orderBy("row_pos"))
    return rows.select("productid", "prodtype", "product_designation", "product_description", "batch_id",
                       F.coalesce(before < number, F.lit(True)).alias("in_order"))


@query("processed_scan", with_tables("processed") + """
    SELECT productid, prdtypecode, prodtype, designation FROM processed WHERE batch_id = 'redelivery'""")
def processed_scan(t: Tables):
    """One batch out of the partitioned table of all batches."""
    path = fresh_dir(t.spark, "processed")
    replace_batch(t.processed, path)
    return read_processed(t.spark, path, "redelivery").select("productid", "prdtypecode", "prodtype", "designation")


@query("append_replayed", with_tables("deliveries") + """
    SELECT productid, prodtype, batch_id FROM deliveries WHERE batch_id = 'redelivery'""")
def append_replayed(t: Tables):
    """The second delivery inserted twice into the stored table; the replay adds nothing."""
    path = fresh_dir(t.spark, "raw")
    rows = t.redelivered(t.raw).select("productid", "prodtype", "batch_id", "row_pos")
    for _ in range(2):
        append_new_rows(rows, path, "redelivery")
    return t.spark.read.parquet(path).select("productid", "prodtype", "batch_id")


@query("unpublished_images", with_tables("raw") + """
    SELECT productid, 'images/' || batch_id || '/image_' || imageid || '_product_' || productid || '.jpg' AS path_image
    FROM raw WHERE n_chars >= 400 AND productid NOT IN (SELECT doc_id FROM labels)""")
def unpublished_images_query(t: Tables):
    """Images of labelled products are published already."""
    batch = ops.with_image_path(ops.check_images(t.raw, ops.parse_image_listing(t.image_listing)))
    published = t.table("labels").select(F.col("doc_id").alias("productid")).join(
        t.raw, "productid").select(
            ops.image_path(F.col("batch_id"), F.col("imageid"), F.col("productid")).alias("path_image"))
    return unpublished_images(batch, published).select("productid", "path_image")


@query("embed_guard", with_tables("emb") + """
    SELECT sum((product_id IS NULL)::INT)::BIGINT AS new_products,
           sum((product_id IS NOT NULL)::INT)::BIGINT AS known_products, count(*) > 0 AS embed
    FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN emb ON doc_id = product_id""")
def embed_guard(t: Tables):
    return embedding_guard(t.raw, t.embeddings)


@query("new_products", """
    SELECT doc_id AS productid FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def new_products(t: Tables):
    known = t.embeddings.select(F.col("product_id").alias("productid"))
    return t.raw.select("productid").join(known, "productid", "left_anti")


@query("known_products", """
    SELECT doc_id AS productid FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)""")
def known_products(t: Tables):
    known = t.embeddings.select(F.col("product_id").alias("productid"))
    return t.raw.select("productid").join(known, "productid", "left_semi")


@query("batch_ids", r"""
    SELECT DISTINCT regexp_replace(split_part(url, '/', -1), '(.)\.[^.]+$', '\1') AS batch_id FROM pages""")
def batch_ids(t: Tables):
    return t.table("pages").select(file_stem(F.col("url")).alias("batch_id")).distinct()


@query("display_texts", with_tables("raw") + """
    SELECT productid,
           CASE WHEN length(d) > 100 THEN substr(d, 1, 100) || '...' ELSE d END AS card,
           CASE WHEN length(d) > 80 THEN substr(d, 1, 80) || '...' ELSE d END AS tile,
           substr(d, 1, 80) || '…' AS line,
           replace(format('{:,}', n_chars), ',', ' ') AS size
    FROM (SELECT productid, n_chars,
                 coalesce(nullif(product_description, ''), nullif(product_designation, ''), '') AS d FROM raw)""")
def display_texts(t: Tables):
    shown = t.raw.withColumn("d", first_filled(F.col("product_description"), F.col("product_designation")))
    text = F.col("d")
    return shown.select("productid", ellipsis(text, 100).alias("card"), ellipsis(text, 80).alias("tile"),
                        ellipsis(text, 80, "…", always=True).alias("line"),
                        thousands(F.col("n_chars")).alias("size"))


@query("dataset_manifest", """
    SELECT path, md5(s1 || '-' || s2 || '-' || s3 || '-' || s4) AS md5, size, nfiles
    FROM (SELECT source AS path, sum(octet_length(encode(text)))::BIGINT AS size, count(*) AS nfiles,
                 sum(('0x' || substr(h, 1, 8))::BIGINT)::VARCHAR AS s1,
                 sum(('0x' || substr(h, 9, 8))::BIGINT)::VARCHAR AS s2,
                 sum(('0x' || substr(h, 17, 8))::BIGINT)::VARCHAR AS s3,
                 sum(('0x' || substr(h, 25, 8))::BIGINT)::VARCHAR AS s4
          FROM (SELECT *, md5(doc_id || '.txt:' || md5(text)) AS h FROM documents)
          GROUP BY source)""")
def dataset_manifest(t: Tables):
    """Every document is a file of its source."""
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    content = F.col("text").cast("binary")
    return manifest(t.table("documents").select(
        F.col("source").alias("path"), file.alias("file"),
        F.octet_length(content).cast("bigint").alias("size"), F.md5(content).alias("md5")))


@query("folder_manifest", """
    WITH files AS (SELECT source AS path, lang AS folder, doc_id || '.txt' AS name, md5(text) AS d,
                          octet_length(encode(text)) AS size FROM documents),
    folders AS (
        SELECT path, folder, sum(size) AS size, count(*) AS nfiles, md5(concat_ws('-',
                   sum(('0x' || substr(h, 1, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(h, 9, 8))::BIGINT)::VARCHAR,
                   sum(('0x' || substr(h, 17, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(h, 25, 8))::BIGINT)::VARCHAR)) AS d
        FROM (SELECT *, md5(name || ':' || d) AS h FROM files) GROUP BY path, folder)
    SELECT path, sum(size)::BIGINT AS size, sum(nfiles)::BIGINT AS nfiles, md5(concat_ws('-',
               sum(('0x' || substr(h, 1, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(h, 9, 8))::BIGINT)::VARCHAR,
               sum(('0x' || substr(h, 17, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(h, 25, 8))::BIGINT)::VARCHAR)) AS md5
    FROM (SELECT *, md5(folder || ':' || d) AS h FROM folders) GROUP BY path""")
def folder_manifest(t: Tables):
    """Every document is a file in the folder of its language."""
    content = F.col("text").cast("binary")
    return manifest(t.table("documents").select(
        F.col("source").alias("path"), F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"),
        F.octet_length(content).cast("bigint").alias("size"), F.md5(content).alias("md5")))
