from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vitrine.operators import catalogue, quality
from vitrine.operators.ranking import drop_duplicates_keep_first, global_row_number, latest_per_product
from vitrine.operators.tables import (
    VersionedTable, append_new_rows, category_map_first_wins, insert_ignore, replace_batch,
    upsert_counts, upsert_latest_wins,
)
from vitrine.session import fresh_dir


def test_keep_first_in_file_order(spark):
    rows = spark.createDataFrame([(7, "b", 2), (7, "a", 1), (8, "c", 3)], "productid long, v string, row_pos long")
    assert {(r.productid, r.v) for r in drop_duplicates_keep_first(rows).collect()} == {(7, "a"), (8, "c")}


def test_latest_row_and_tie(spark):
    rows = spark.createDataFrame(
        [(1, "b1", "2024-01-01"), (1, "b2", "2024-01-02"), (2, "b1", "2024-01-01"), (2, "b0", "2024-01-01")],
        "productid long, batch_id string, d string").withColumn("dt_processed", F.col("d").cast("timestamp_ntz"))
    assert {(r.productid, r.batch_id) for r in latest_per_product(rows).collect()} == {(1, "b2"), (2, "b1")}


def test_hot_key_is_cut_before_the_shuffle(spark, sf_dir):
    from vitrine.queries.adapters import Tables
    plan = latest_per_product(Tables(spark, sf_dir).processed)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(productid") < plan.index("Partial")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_numbers_are_gapless(spark, parts):
    rows = spark.range(500).select((F.col("id") % 5).alias("k"), F.pmod(F.hash("id"), F.lit(1000)).alias("h"), "id")
    got = global_row_number(rows, ["k", "h", "id"], partitions=parts).collect()
    expected = sorted((r.k, r.h, r.id) for r in got)
    assert [(r.k, r.h, r.id) for r in sorted(got, key=lambda r: r.ordinal)] == expected
    assert sorted(r.ordinal for r in got) == list(range(1, 501))


def test_global_numbers_of_nothing(spark):
    assert global_row_number(spark.range(0), ["id"]).count() == 0


def raw(spark, rows):
    return spark.createDataFrame(rows, "productid string, imageid string, prdtypecode string, prodtype string, "
                                       "product_designation string, product_description string")


def test_types(spark):
    good = raw(spark, [("1", "2", "10", "Livre", "A", None), ("2", "3", "10", "Livre", None, "d")])
    rows = catalogue.cast_types(good).orderBy("productid").collect()
    assert rows[0].productid == 1 and rows[0].product_description == ""
    assert rows[1].product_designation == ""
    bad = raw(spark, [("1", "x", "10", "Livre", "A", "B")])
    with pytest.raises(PySparkException):
        catalogue.cast_types(bad).collect()
    typed, rejected = catalogue.split_castable(good.unionByName(bad))
    assert typed.count() == 2 and [r.imageid for r in rejected.collect()] == ["x"]


def test_blank_designations_are_kept_apart(spark):
    rows = spark.createDataFrame([("a",), ("  ",), (None,)], "designation string")
    filled, blank = catalogue.split_blank_designation(rows)
    assert filled.count() == 1 and blank.count() == 2


def test_images_and_paths(spark):
    rows = spark.createDataFrame([(1, 11, "b"), (2, 12, "b")], "productid long, imageid long, batch_id string")
    listing = spark.createDataFrame([("x/images/b/image_11_product_1.jpg",), ("x/image_11_product_1.jpg",),
                                     ("x/other.jpg",)], "path string")
    out = catalogue.with_image_path(catalogue.check_images(rows, catalogue.parse_image_listing(listing)))
    got = {r.productid: (r.image_exists, r.path_image) for r in out.collect()}
    assert got == {1: (True, "images/b/image_11_product_1.jpg"), 2: (False, None)}


def batch(spark, n, found, empty=0):
    return spark.range(n).select(
        (F.col("id") < found).alias("image_exists"),
        F.when(F.col("id") < empty, "").otherwise("x").alias("designation"), F.lit("b").alias("batch_id"))


@pytest.mark.parametrize(("rows", "found", "failed"), [
    (99, 99, "volume"), (100, 89, "image_match_rate"), (100, 90, None), (0, 0, "volume")])
def test_gates(spark, rows, found, failed):
    frame = batch(spark, rows, found)
    if failed:
        with pytest.raises(quality.QualityGateError, match=failed):
            quality.run_quality_checks(frame, "b")
    else:
        assert quality.run_quality_checks(frame, "b")["passed"]


def test_empty_designation_only_warns(spark):
    verdict = quality.run_quality_checks(batch(spark, 100, 100, empty=3), "b")
    assert verdict["passed"] and verdict["warning"] and verdict["empty_designations"] == 3


def test_no_rows_have_rate_zero(spark):
    with pytest.raises(quality.QualityGateError, match="image_match_rate"):
        quality.run_quality_checks(batch(spark, 0, 0), "b", min_rows=0)


def test_embedding_guard(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,)], "productid long")
    stored = spark.createDataFrame([(2,), (3,)], "product_id long")
    row = quality.embedding_guard(ids, stored).first()
    assert (row.new_products, row.known_products, row.embed) == (1, 1, True)
    assert quality.has_new_products(ids.limit(0), None)
    assert not quality.has_new_products(ids.limit(0), stored)


def test_batch_guard(spark):
    processed = spark.createDataFrame([("b1",)], "batch_id string")
    runs = spark.createDataFrame([("b1", None), ("b2", None)], "run_id string, dt_embeddings timestamp")
    assert not quality.is_batch_done("b1", None, runs)
    assert not quality.is_batch_done("b1", processed, runs)
    done = runs.withColumn("dt_embeddings", F.current_timestamp())
    assert quality.is_batch_done("b1", processed, done)
    assert not quality.is_batch_done("b2", processed, done)


def test_training_guard(spark):
    versions = spark.createDataFrame([("m", 1, "r1", "Production")], "name string, version int, run_id string, stage string")
    runs = spark.createDataFrame([("r1", "b1")], "run_id string, data_run_id string")
    assert not quality.training_needed("b1", versions, runs)
    assert quality.training_needed("b2", versions, runs)
    assert quality.training_needed(None, versions, runs)


def test_insert_ignore(spark):
    schema = "productid long, batch_id string, v string, row_pos long"
    first = spark.createDataFrame([(7, "b", "first", 1), (7, "b", "second", 2)], schema)
    table = insert_ignore(first, None)
    assert [r.v for r in table.collect()] == ["first"]
    assert insert_ignore(first, table).count() == 1
    other = spark.createDataFrame([(7, "c", "other", 1)], schema)
    assert insert_ignore(other, table).count() == 2


def test_append_is_idempotent(spark):
    path = fresh_dir(spark, "raw")
    schema = "productid long, batch_id string, v string, row_pos long"
    rows = spark.createDataFrame([(7, "b", "x", 1), (7, "b", "y", 2), (8, "b", "z", 3)], schema)
    assert append_new_rows(rows, path, "b") == 2
    assert append_new_rows(rows, path, "b") == 0
    assert append_new_rows(rows.withColumn("batch_id", F.lit("c")), path, "c") == 2
    assert spark.read.parquet(path).count() == 4


def test_replaced_batch_leaves_others(spark):
    path = fresh_dir(spark, "processed")
    replace_batch(spark.createDataFrame([(1, "a"), (2, "b")], "productid long, batch_id string"), path)
    replace_batch(spark.createDataFrame([(3, "b")], "productid long, batch_id string"), path)
    assert {(r.productid, r.batch_id) for r in spark.read.parquet(path).collect()} == {(1, "a"), (3, "b")}


def test_upsert(spark):
    stored = spark.createDataFrame([(i, "old") for i in (1, 2, 3)], "product_id long, run_id string")
    new = spark.createDataFrame([(i, "new") for i in (2, 3, 4)], "product_id long, run_id string")
    expected = {(1, "old"), (2, "new"), (3, "new"), (4, "new")}
    assert {tuple(r) for r in upsert_latest_wins(stored, new).collect()} == expected
    assert upsert_counts(stored, new).first().asDict() == {"replaced": 2, "new": 1, "total": 4}
    table = VersionedTable(spark, fresh_dir(spark, "embeddings"))
    assert table.read() is None and table.version() is None
    assert table.upsert(stored) == {"replaced": 0, "new": 3, "total": 3}
    assert table.upsert(new) == {"replaced": 2, "new": 1, "total": 4}
    assert table.upsert(new) == {"replaced": 3, "new": 0, "total": 4}
    assert {tuple(r) for r in table.read().collect()} == expected and table.version() == 3


@pytest.mark.parametrize("folded_after", [(), (1,), (0, 3)])
def test_layers_and_folding_give_the_same_table(spark, folded_after):
    table = VersionedTable(spark, fresh_dir(spark, "embeddings"))
    expected = {}
    for n, ids in enumerate([range(10), range(5, 15), range(0, 3), [2, 14, 20], range(9, 12)]):
        expected |= {i: f"run{n}" for i in ids}
        counts = table.upsert(spark.createDataFrame([(i, f"run{n}") for i in ids], "product_id long, run_id string"))
        assert counts["total"] == len(expected) and counts["new"] + counts["replaced"] == len(ids)
        if n in folded_after:
            table.fold()
            assert table.layers() == 0
        assert {r.product_id: r.run_id for r in table.read().collect()} == expected


def test_upsert_writes_only_its_own_rows(spark):
    table = VersionedTable(spark, fresh_dir(spark, "embeddings"))
    table.upsert(spark.range(1000).select(F.col("id").alias("product_id"), F.lit("a").alias("run_id")))
    table.upsert(spark.createDataFrame([(5, "b")], "product_id long, run_id string"))
    assert spark.read.parquet(f"{table.root}/v=2").count() == 1 and table.read().count() == 1000


def test_failed_write_keeps_the_old_version(spark):
    table = VersionedTable(spark, fresh_dir(spark, "embeddings"))
    good = spark.createDataFrame([(1, "a")], "product_id long, run_id string")
    table.write(good)
    broken = good.withColumn("run_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException):
        table.write(broken)
    assert table.version() == 1 and table.read().count() == 1
    assert table.write(good) == 2


def test_class_map_first_wins(spark):
    stored = spark.createDataFrame([("10", "Livres")], "code string, label string")
    batch_rows = spark.createDataFrame([(10, "Books", 1), (20, "Jeux", 2), (20, "Games", 3)],
                                       "prdtypecode int, prodtype string, row_pos long")
    pairs = catalogue.new_category_pairs(batch_rows)
    assert {tuple(r) for r in category_map_first_wins(stored, pairs).collect()} == {("10", "Livres"), ("20", "Jeux")}


def test_keyed_table_rewrites_touched_buckets_only(spark):
    from pathlib import Path

    from vitrine.operators.tables import KeyedTable
    from vitrine.session import fresh_dir

    root = fresh_dir(spark, "keyed").removeprefix("file:")
    table = KeyedTable(spark, root, buckets=16)
    rows = "product_id long, v string"
    assert table.read() is None and table.upsert(spark.createDataFrame([], rows)) == {"replaced": 0, "new": 0, "buckets": 0}
    assert table.upsert(spark.createDataFrame([(i, "a") for i in range(200)], rows))["new"] == 200

    def files():
        return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}

    before = files()
    counts = table.upsert(spark.createDataFrame([(3, "b"), (500, "b"), (None, "n")], rows))
    assert (counts["replaced"], counts["new"]) == (1, 2) and 1 <= counts["buckets"] <= 3
    kept = {p for p, t in before.items() if files().get(p) == t}
    touched = {p.split("bucket=")[1].split("/")[0] for p in set(before) - kept}
    assert len(touched) <= 3 and len({p.split("bucket=")[1].split("/")[0] for p in kept}) >= 13
    found = {r.product_id: r.v for r in table.read().collect()}
    assert len(found) == 202 and found[3] == "b" and found[4] == "a" and found[None] == "n"
    # Repeated, as after a failure: nothing is new and the table is the same.
    again = table.upsert(spark.createDataFrame([(3, "b"), (500, "b"), (None, "n")], rows))
    assert (again["replaced"], again["new"]) == (3, 0) and table.read().count() == 202
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(spark, root, buckets=8).read()
