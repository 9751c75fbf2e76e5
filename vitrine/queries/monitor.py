"""Prediction monitor queries, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.dates import millis_duration_minutes
from vitrine.functions.text import percent
from vitrine.plans import reports
from vitrine.plans.scoring import save_predictions
from vitrine.queries.adapters import Tables, with_tables
from vitrine.queries.registry import query
from vitrine.session import fresh_dir
from vitrine.streaming.jobs import hourly_by_class, read_hourly_partials, start_append_once, start_hourly_partials

PARIS_SQL = "dt_predicted AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris'"


@query("prediction_kpis", with_tables("preds") + """
    SELECT count(*) AS total, round(avg(confidence), 10) AS avg_confidence,
           round(avg((confidence >= 0.75)::INT), 6) AS pct_high,
           (SELECT predicted_class FROM preds GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant_class
    FROM preds""")
def prediction_kpis(t: Tables):
    kpis = reports.prediction_kpis(t.predictions)
    return kpis.withColumns({"avg_confidence": F.round("avg_confidence", 10), "pct_high": F.round("pct_high", 6)})


@query("monitor_kpis", with_tables("preds").rstrip() + """,
    newest AS (SELECT * FROM preds ORDER BY dt_predicted DESC, id DESC LIMIT 200)
    SELECT count(*) AS total, format('{:.1f}%', avg(confidence) * 100) AS avg_confidence,
           format('{:.0f}%', avg((confidence >= 0.75)::INT) * 100) AS pct_high,
           (SELECT predicted_class FROM newest GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant_class
    FROM newest""")
def monitor_kpis(t: Tables):
    """The figures of the monitor page, over the newest 200 predictions."""
    kpis = reports.prediction_kpis(reports.latest_predictions(t.predictions))
    return kpis.withColumns({"avg_confidence": percent(F.col("avg_confidence")),
                             "pct_high": percent(F.col("pct_high"), 0)})


@query("top_predicted_classes", with_tables("preds") + """
    SELECT predicted_class, count(*) AS count FROM preds GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_predicted_classes(t: Tables):
    return reports.top_predicted_classes(t.predictions)


@query("confidence_histogram", with_tables("preds") + """
    SELECT bin, bin / 20 AS low, count(*) AS count
    FROM (SELECT least(floor(confidence * 20), 19)::INT AS bin FROM preds) GROUP BY bin""")
def confidence_histogram(t: Tables):
    return reports.confidence_histogram(t.predictions)


@query("hourly_predictions", with_tables("preds") + f"""
    SELECT date_trunc('hour', {PARIS_SQL}) AS hour, count(id) AS count, round(avg(confidence), 10) AS avg_conf
    FROM preds GROUP BY 1""")
def hourly_predictions(t: Tables):
    return reports.hourly_predictions(t.predictions).withColumn("avg_conf", F.round("avg_conf", 10))


@query("latest_predictions", with_tables("preds") + f"""
    SELECT id, CASE WHEN confidence >= 0.75 THEN '🟢' WHEN confidence >= 0.5 THEN '🟡' ELSE '🔴' END AS band,
           strftime({PARIS_SQL}, '%Y-%m-%d %H:%M') AS date_paris, predicted_class,
           format('{{:.1f}}%', confidence * 100) AS confidence, has_image,
           substr(designation, 1, 80) || '…' AS designation
    FROM preds ORDER BY dt_predicted DESC, id DESC LIMIT 200""")
def latest_predictions(t: Tables):
    return reports.predictions_table(t.predictions)


@query("saved_predictions", with_tables("preds") + """
    SELECT dt_predicted::DATE AS day, count(*) AS predictions, sum(has_image::INT)::BIGINT AS with_image
    FROM preds GROUP BY 1""")
def saved_predictions(t: Tables):
    """All predictions appended to the day-partitioned table and counted from it."""
    path = fresh_dir(t.spark, "predictions")
    save_predictions(t.predictions, path)
    return t.spark.read.parquet(path).groupBy("day").agg(
        F.count("*").alias("predictions"), F.count_if("has_image").alias("with_image"))


@query("prediction_spans", """
    SELECT user_id, first_ms, last_ms,
           CASE WHEN last_ms > first_ms THEN round((last_ms - first_ms) / 60000.0::DOUBLE, 1) END AS minutes
    FROM (SELECT user_id, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms
          FROM events GROUP BY user_id)""")
def prediction_spans(t: Tables):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    spans = t.table("events").groupBy("user_id").agg(F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"))
    return spans.withColumn("minutes", millis_duration_minutes(F.col("first_ms"), F.col("last_ms")))


HOURLY_SQL = with_tables("preds") + """
    SELECT date_trunc('hour', dt_predicted) AS hour, predicted_class, count(*) AS count,
           round(avg(confidence), 10) AS avg_conf
    FROM preds GROUP BY 1, 2"""


@query("hourly_by_class", HOURLY_SQL)
def hourly_batch(t: Tables):
    totals = hourly_by_class(t.predictions)
    return totals.select("hour", "predicted_class", "count",
                         F.round(F.col("confidence_sum") / F.col("count"), 10).alias("avg_conf"))


@query("hourly_by_class_stream", HOURLY_SQL)
def hourly_stream(t: Tables):
    """The same figures from a file stream over the events table."""
    predictions = t.stream("events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("predicted_class"),
        F.least(F.col("value") / 500, F.lit(1.0)).alias("confidence"), F.col("ts").alias("dt_predicted"))
    out = fresh_dir(t.spark, "hourly")
    start_hourly_partials(predictions, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return read_hourly_partials(t.spark, f"{out}/table").withColumn("avg_conf", F.round("avg_conf", 10))


@query("events_appended_once", "SELECT event_id, user_id, event_type, 1 AS copies FROM events")
def events_appended_once(t: Tables):
    """All events arrive twice, the second time in a later micro-batch; each is stored once."""
    root = fresh_dir(t.spark, "events")
    rows = t.table("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for number in range(2):
        rows.write.parquet(f"{root}/in/delivery={number}")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        start_append_once(stream.select(*rows.columns), f"{root}/out", f"{root}/check", ["event_id"], "ts").awaitTermination()
    stored = t.spark.read.schema(rows.schema).parquet(f"{root}/out")
    return stored.groupBy("event_id", "user_id", "event_type").agg(F.count("*").alias("copies"))
