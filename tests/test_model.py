from __future__ import annotations

import math

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vitrine.functions import scores
from vitrine.operators import evaluation, labels, model, vectors
from vitrine.plans.scoring import label_lookup, rank_logits, score_products, to_prediction_rows
from vitrine.plans.training import split_parts, train_and_measure, training_frame


def test_fusion_order_type_and_mismatch(spark):
    rng = np.random.default_rng(42)
    images = spark.createDataFrame([(i, rng.random(256).tolist()) for i in range(8)],
                                   "product_id long, embedding_image array<float>")
    texts = spark.createDataFrame([(i, rng.random(768).tolist()) for i in range(8)],
                                  "product_id long, embedding_text array<float>")
    fused = vectors.with_fused(vectors.join_vectors(images, texts), width=1024)
    assert dict(fused.dtypes)["features"] == "array<float>"
    row = fused.orderBy("product_id").first()
    assert len(row.features) == 1024 and row.features[:256] == row.embedding_image
    extra = images.unionByName(spark.createDataFrame([(9, [0.0] * 256)], images.schema))
    with pytest.raises(PySparkException, match="no counterpart"):
        vectors.join_vectors(extra, texts).collect()
    with pytest.raises(PySparkException, match="fused width"):
        vectors.with_fused(vectors.join_vectors(images, texts), width=1000).collect()


def test_softmax_argmax_and_top(spark):
    frame = spark.createDataFrame([([1.0, 3.0, 3.0, 1000.0],), ([0.0, 0.0, 0.0, 0.0],)], "l array<double>")
    rows = frame.select(scores.softmax(F.col("l")).alias("p"), scores.argmax(F.col("l")).alias("a"),
                        scores.top_classes(F.col("l"), 3).alias("t")).collect()
    assert sum(rows[0].p) == pytest.approx(1.0) and rows[0].a == 3
    assert [s.class_index for s in rows[0].t] == [3, 1, 2]
    assert rows[1].p == [0.25] * 4 and rows[1].a == 0 and [s.class_index for s in rows[1].t] == [0, 1, 2]
    logs = frame.select(scores.log_softmax(F.col("l"))).collect()[1][0]
    assert logs == pytest.approx([math.log(0.25)] * 4)


def test_uniform_logits_give_five_labelled_entries(spark):
    frame = spark.createDataFrame([([0.0] * 27,)], "logits array<float>")
    names = spark.createDataFrame([(i, f"category_{i}") for i in range(26)], "class_index int, label string")
    row = rank_logits(frame, label_lookup(names)).first()
    assert row.confidence == pytest.approx(1 / 27) and row.predicted_label == "category_0"
    assert [s.label for s in row.top5] == [f"category_{i}" for i in range(5)]
    assert set(row.all_scores) == {f"category_{i}" for i in range(5)}
    few = rank_logits(frame, label_lookup(names.where("class_index > 2"))).first()
    assert few.predicted_label == "class_0" and few.top5[3].label == "category_3"


def test_fewer_classes_than_five(spark):
    frame = spark.createDataFrame([([0.1, 0.9],)], "logits array<float>")
    names = spark.createDataFrame([(0, "a"), (1, "a")], "class_index int, label string")
    row = rank_logits(frame, label_lookup(names)).first()
    assert len(row.top5) == 2 and row.all_scores == {"a": pytest.approx(row.top5[1].confidence)}


def test_unit_vectors(spark):
    frame = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in frame.select(scores.l2_normalise(F.col("v"))).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]


def test_bands(spark):
    frame = spark.createDataFrame([(0.75,), (0.5,), (0.49,)], "c double")
    assert [r[0] for r in frame.select(scores.confidence_band(F.col("c"))).collect()] == ["high", "moderate", "low"]


def test_text_vectors(spark):
    frame = spark.createDataFrame([("ref:1445855 piscine",), ("voiture jouet",), ("livre 14552329666555",), ("",)],
                                  "input_text string")
    rows = vectors.hashed_text_vectors(frame).collect()
    norms = [math.sqrt(sum(x * x for x in r.embedding_text)) for r in rows]
    assert norms[:3] == pytest.approx([1.0] * 3, abs=1e-5) and norms[3] == 0
    assert all(len(r.embedding_text) == 768 for r in rows)
    nothing = vectors.hashed_text_vectors(frame.limit(0))
    assert nothing.count() == 0 and "embedding_text" in nothing.columns


def test_pluggable_text_model(spark):
    def load():
        def encode(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)
        return encode

    frame = spark.createDataFrame([("abc",), (None,)], "input_text string")
    rows = vectors.model_text_vectors(frame, load).collect()
    assert rows[0].embedding_text == pytest.approx([3 / math.sqrt(10), 1 / math.sqrt(10)])
    assert rows[1].embedding_text == [0.0, 1.0]
    assert vectors.model_text_vectors(frame.limit(0), load).count() == 0


@pytest.mark.parametrize("activation", ["ReLU", "SiLU", "GELU"])
def test_head_forward_equals_plain_numpy(spark, activation):
    head = model.random_head(12, 27, (16, 8, 4), activation)
    rng = np.random.default_rng(1)
    head.input_norm.mean[:] = rng.random(12)
    x = rng.random((8, 12)).astype(np.float32)
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, features array<float>")
    got = np.array([r.logits for r in model.head_logits(frame, head).orderBy("i").collect()])
    h = (x - head.input_norm.mean) / np.sqrt(1 + 1e-5)
    for dense, _ in head.blocks:
        h = (h @ dense.weight.T + dense.bias) / np.sqrt(1 + 1e-5)
        h = {"ReLU": lambda v: np.where(v > 0, v, 0), "SiLU": lambda v: v / (1 + np.exp(-v)),
             "GELU": lambda v: v * 0.5 * (1 + np.array([[math.erf(e / 2 ** .5) for e in r] for r in v]))}[activation](h)
    expected = h @ head.output.weight.T + head.output.bias
    assert got.shape == (8, 27) and np.allclose(got, expected, atol=1e-4) and not np.isnan(got).any()


def test_macro_f1_over_the_union_of_classes(spark):
    pairs = spark.createDataFrame(list(zip("aabc", "abbd", strict=True)), "label string, prediction string")
    assert evaluation.macro_f1(pairs).first()[0] == pytest.approx(1 / 3)
    assert evaluation.accuracy(pairs).first()[0] == 0.5
    both = evaluation.accuracy_and_macro_f1(pairs).first()
    assert both.accuracy == 0.5 and both.macro_f1 == pytest.approx(1 / 3) and both.classes == 4
    by_class = {r["class"]: r.f1 for r in evaluation.class_scores(pairs).collect()}
    assert by_class == {"a": pytest.approx(2 / 3), "b": pytest.approx(2 / 3), "c": 0.0, "d": 0.0}


def test_smoothed_loss_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    logits, y, w, e = rng.normal(size=(20, 4)), rng.integers(0, 4, 20), np.array([0.5, 2.0, 1.0, 0.0]), 0.1
    frame = spark.createDataFrame([(row.tolist(), int(c)) for row, c in zip(logits, y, strict=True)],
                                  "logits array<double>, label int")
    logp = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    expected = ((1 - e) * (w[y] * -logp[np.arange(20), y]).sum() + e / 4 * (w * -logp).sum()) / w[y].sum()
    got = evaluation.weighted_smoothed_loss(frame, F.array(*map(F.lit, w.tolist()))).first().loss
    assert got == pytest.approx(expected)


def test_class_index_and_unknown_codes(spark):
    categories = spark.createDataFrame([("40", "d"), ("5", "a"), ("100", "x")], "code string, label string")
    index = labels.class_index(categories)
    assert {r.code: r.class_index for r in index.collect()} == {5: 0, 40: 1, 100: 2}
    frame = spark.createDataFrame([(1, 40)], "product_id long, prdtypecode int")
    assert labels.encode_labels(frame, index).first().class_index == 1
    with pytest.raises(PySparkException, match="unknown class code 7"):
        labels.encode_labels(frame.withColumn("prdtypecode", F.lit(7)), index).collect()


def test_balanced_weights(spark):
    frame = spark.createDataFrame([("a",)] * 3 + [("b",)], "prdtypecode string")
    got = {r.prdtypecode: r.weight for r in labels.class_weights(frame).collect()}
    assert got == {"a": pytest.approx(4 / 6), "b": 2.0}


def ids_in_classes(spark, sizes):
    rows, n = [], 0
    for name, size in sizes.items():
        rows += [(n + i, name) for i in range(size)]
        n += size
    return spark.createDataFrame(rows, "product_id long, prdtypecode string")


@pytest.mark.parametrize("digits", [1, 4])
def test_split_sizes_and_ranks(spark, monkeypatch, digits):
    import hashlib
    monkeypatch.setattr(labels, "HASH_DIGITS", digits)
    frame = ids_in_classes(spark, {"a": 50, "b": 30, "c": 20})
    got = labels.stratified_split(frame).collect()
    for name, expected in {"a": 10, "b": 6, "c": 4}.items():
        members = sorted((hashlib.md5(f"42-{r.product_id}".encode()).hexdigest(), r.product_id)
                         for r in got if r.prdtypecode == name)
        val = {r.product_id for r in got if r.prdtypecode == name and r.split == "val"}
        assert val == {i for _, i in members[:expected]}
    assert len(got) == 100


def test_split_remainders_and_tiny_class(spark):
    got = labels.stratified_split(ids_in_classes(spark, {"a": 7, "b": 7, "c": 2}))
    assert got.where("split = 'val'").count() == math.ceil(16 * 0.2)
    with pytest.raises((PySparkException, Py4JJavaError), match="only one row"):
        labels.stratified_split(ids_in_classes(spark, {"a": 5, "b": 1})).collect()


def test_split_does_not_shuffle_the_vectors(spark, sf_dir):
    from vitrine.queries.adapters import Tables
    plan = labels.stratified_split(Tables(spark, sf_dir).embeddings)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "embedding_text" in line]
    assert not wide


def test_oversampling_follows_the_weight(spark):
    frame = spark.range(1000).select(F.col("id").alias("product_id"), F.when(F.col("id") < 500, 1.0).otherwise(2.5).alias("weight"))
    got = {r.weight: r["count"] for r in model.oversample(frame).groupBy("weight").count().collect()}
    assert got[1.0] == 500 and 1000 < got[2.5] < 1500
    again = model.oversample(frame.repartition(7)).groupBy("product_id").count()
    assert again.exceptAll(model.oversample(frame).groupBy("product_id").count()).count() == 0


def test_train_score_and_search(spark, sf_dir):
    from vitrine.queries.adapters import Tables
    t = Tables(spark, sf_dir)
    categories = t.embeddings.select(F.col("prdtypecode").cast("string").alias("code"),
                                     F.col("prdtypecode").cast("string").alias("label")).distinct()
    frame = training_frame(t.embeddings, categories).persist()
    fitted, measures = train_and_measure(frame, lambda d: model.train_logistic(d, max_iter=5))
    assert 0 <= measures["macro_f1"] <= 1 and 0 <= measures["accuracy"] <= 1
    probabilities = model.model_probabilities(frame, fitted).first().probabilities
    assert sum(probabilities) == pytest.approx(1.0)
    mlp = model.train_mlp(frame, 10, (8, 6, 4), max_iter=3)
    assert len(model.model_probabilities(frame, mlp).first().probabilities) == 10

    def fit(train, params):
        if params["reg"] < 0:
            raise ValueError("bad draw")
        return model.train_logistic(train, max_iter=2, reg=params["reg"])

    train, val = split_parts(frame)
    trials = {r.trial: r for r in model.search(train, val, fit, [{"reg": 0.0}, {"reg": -1.0}]).collect()}
    assert trials[0].state == "COMPLETE" and 0 <= trials[0].value <= 1
    assert trials[1].value == float("-inf") and trials[1].state.startswith("FAIL")


def test_sampled_params_stay_in_the_space():
    drawn = model.sample_params()
    assert len(drawn) == 20 and drawn == model.sample_params()
    for p in drawn:
        assert 1e-5 <= p["learning_rate"] <= 1e-2 and 0.2 <= p["dropout"] <= 0.6
        assert p["hidden_l1"] in range(512, 2049, 256) and p["hidden_l2"] in range(256, 1025, 128)
        assert p["hidden_l3"] in range(128, 513, 64) and p["activation"] in ("ReLU", "GELU", "SiLU")


def test_score_products_end_to_end(spark):
    from vitrine.functions.text import with_input_text
    products = spark.createDataFrame([("Livre", "un roman"), ("Jeu", None)], "designation string, description string")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "class_index int, label string")

    def features(df):
        return vectors.hashed_text_vectors(with_input_text(df, "designation", "description"), out="features", dim=16)

    def probabilities(df):
        scored = model.head_logits(df, model.random_head(16, 2, (4, 4, 4)))
        return scored.withColumn("probabilities", scores.softmax(F.col("logits")))

    rows = to_prediction_rows(score_products(products, features, probabilities, label_lookup(names)), "v1").collect()
    assert len(rows) == 2 and {r.predicted_class for r in rows} <= {"a", "b"}
    assert all(0 <= r.confidence <= 1 and r.model_version == "v1" and len(r.all_scores) == 2 for r in rows)
