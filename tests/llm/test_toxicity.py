"""Classifier: held-out accuracy, what a score may depend on, edge rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import toxicity as tx
from tallyloom.llm.shared import crc_mod

BAD = ["vilest", "rotter", "scumbag", "viler"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"] + "the of and le la der die el los".split() * 3
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text) + 1), rng.choice(BAD))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1200)
    docs = spark.createDataFrame([(i, t, "xx", "clash") for i, t, _ in rows], "doc_id long, text string, lang string, toxicity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    fold = crc_mod(F.col("doc_id"), 5)
    model = tx.fit(docs, labels, fold != 0)
    got = {r.doc_id: r.s for r in docs.where(fold == 0).select("doc_id", tx.scorer(spark, model)("text").alias("s")).collect()}
    truth = {i: y for i, _, y in rows}
    assert len(got) > 150 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(s >= 0.5) == truth[i] for i, s in got.items()]) > 0.97
    # labels of held-out rows teach nothing: turning them round changes no score
    turned = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tx.fit(docs, turned, fold != 0)
    assert (again.embedding == model.embedding).all() and (again.out == model.out).all()
    assert (again.thresholds == model.thresholds).all()


def test_same_text_same_score_whatever_else(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = tx.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), F.lit(True))
    score = tx.scorer(spark, model)
    texts = [None, "", " ", "%%%", "the rotter", "the rotter", "word " * 250_000 + "scumbag"]
    got = [r.s for r in spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select(score("text").alias("s")).collect()]
    assert got[0] == got[1] == got[2] == got[3] and got[4] == got[5]
    assert got[4] > 0.5 > got[0] and got[6] > got[0]  # a whole text counts, not its beginning


def test_chunks_do_not_change_scores():
    rows = corpus(200)
    ids = tx.WordIds()
    texts = [tx.split_ids(ids(t))[0] for _, t, _ in rows]
    model = tx.train(texts, np.array([y for _, _, y in rows]), epochs=2)
    whole = model.probabilities(texts)
    assert np.allclose(whole, [model.probabilities([t])[0] for t in texts], atol=1e-5)


def test_calibration():
    p = np.concatenate([np.linspace(0, 0.3, 50), np.linspace(0.35, 0.9, 50)])
    y = (p > 0.32).astype(int)
    lang = np.zeros(100, int)
    cut = tx.calibrate(p, y, lang)
    assert 0.3 <= cut[0] <= 0.35 and (cut[1:] == cut[0]).all()  # languages without enough rows share the common one
    assert (tx.calibrate(p[:3], y[:3], lang[:3]) == 0.5).all()


def test_language_votes():
    ids = tx.WordIds()
    named = [tx.LANGUAGES[tx.split_ids(ids(t))[1]] for t in ("the cat of that", "le chat est dans la", "der und nicht", "el los para", "zz", None)]
    assert named == ["en", "fr", "de", "es", "other", "other"]


def test_odd_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a c"), (2, None), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1), (2, 0)], "doc_id long, toxic int")
    got = tx.labelled_words(docs, labels, F.lit(True))
    assert sorted(zip(got["id"], got["label"], strict=True)) == [(1, 1), (1, 1), (2, 0)]
    model = tx.fit(docs.limit(0), labels.limit(0), F.lit(True))
    assert docs.select(tx.scorer(spark, model)("text").alias("s")).where("s between 0 and 1").count() == 4


def test_every_labelled_row_and_whole_text_teaches(spark):
    docs = spark.range(7000).selectExpr("id as doc_id", "concat('word', id % 50) as text").union(
        spark.createDataFrame([(7000, "long " * 25_000)], "doc_id long, text string"))
    rows = tx.labelled_words(docs, docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) as toxic"), F.lit(True))
    assert list(rows["id"]) == list(range(7001)) and rows["n"].max() == 25_000


def test_shards_come_to_one_model(spark):
    rows = corpus(1200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    fold = crc_mod(F.col("doc_id"), 5)
    used = tx.labelled_words(docs, labels, fold != 0)
    train = set(used["id"][~used["held"]])
    ids = tx.WordIds()
    here = tx.train([tx.split_ids(ids(t))[0] for i, t, _ in rows if i in train], np.array([y for i, _, y in rows if i in train]))
    one = tx.fit(docs, labels, fold != 0)
    assert np.allclose(one.embedding, here.embedding) and np.allclose(one.out, here.out) and one.out_bias == here.out_bias
    many, again = (tx.fit(docs, labels, fold != 0, shard_rows=200) for _ in range(2))
    assert (many.embedding == again.embedding).all() and (many.thresholds == again.thresholds).all()
    assert not np.allclose(many.embedding, one.embedding)
    got = docs.where(fold == 0).select("doc_id", tx.scorer(spark, many)("text").alias("s")).collect()
    truth = {i: y for i, _, y in rows}
    assert np.mean([(r.s >= 0.5) == truth[r.doc_id] for r in got]) > 0.95


def test_long_texts_are_read_in_stretches(monkeypatch):
    rows = corpus(60)
    ids = tx.WordIds()
    texts, y = [tx.split_ids(ids(t))[0] for _, t, _ in rows], np.array([y for _, _, y in rows])
    whole = tx.train(texts, y, epochs=2)
    monkeypatch.setattr(tx, "CHUNK_WORDS", 10)
    assert np.allclose(tx.train(texts, y, epochs=2).embedding, whole.embedding)
