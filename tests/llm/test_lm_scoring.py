"""Language model: a proper probability, counts and base score by brute force, gain over the base."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import lm_scoring as lm
from tallyloom.llm.logbilinear import LogBilinear, train
from tallyloom.llm.shared import crc_mod


def words_of(text):
    return (text or "").encode().lower().split() + [b""]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = [f"{'ab'[i % 2]}{k}" for k in range(60)]  # two languages: context tells which
        text = [own[min(59, int(rng.expovariate(0.1)))] for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.2:
            text.append(f"Rare{i}")
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(text)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \r\n "), (n + 3, "A B\x1cc \x0b d")]


def test_tokens():
    texts = ["A b\tA", "", None, "  x ", "é É\x1cz\x0by"]
    words, which, ends = lm.tokens_of(pa.array(texts))
    names = [w.encode() for w in words.to_pylist()]
    first = [0, *ends.tolist()]
    assert [[names[k] for k in which[a:b]] for a, b in zip(first, first[1:], strict=False)] == [words_of(t) for t in texts]
    assert lm.tokens_of(pa.array([], pa.string()))[2].tolist() == []
    words, which, ends = lm.tokens_of(pa.array([None, ""], pa.string()))
    assert ends.tolist() == [1, 2] and len(set(which.tolist())) == 1


@pytest.mark.parametrize("known_words", [1 << 18, 40])
def test_against_brute_force(spark, monkeypatch, known_words):
    monkeypatch.setattr(lm.build_vocabulary, "__defaults__", (known_words,))
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = collections.Counter(w for i, t in rows if i not in held for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    got = {r.id: r for r in lm.score_documents(docs, crc_mod(F.col("doc_id"), 7) != 2).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, words = got[i], words_of(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in words))
        assert r.score < 0 and np.isfinite(r.score)
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(t,) for _, t in corpus(60)], "text string")
    counts = lm.count_words(texts).checkpoint()
    v = lm.build_vocabulary(counts)
    model = lm.train_model(texts.withColumn("start", F.lit(True)), v)
    n = len(model.bias)
    before = np.array([[n, n], [0, n], [3, 5]])
    for b in before:
        p = np.exp(model.log_probabilities(np.repeat(b[None], n, 0), np.arange(n)))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    # within a tail class: its words' shares and that of one unseen word
    c = {r.word: r.c for r in counts.collect()}
    tail = [w for w in c if w not in set(v.words.to_pylist()[:lm.HEAD_WORDS])]
    of = lm.tail_class(pa.array(tail, pa.string())) - lm.HEAD_WORDS if tail else []
    for k in set(of):
        mine = [c[w] for w, x in zip(tail, of, strict=True) if x == k]
        assert (sum(mine), len(mine)) == (v.tail_tokens[k], v.tail_words[k])


def test_training_learns_and_is_a_pure_function():
    rng = np.random.default_rng(0)
    token = rng.integers(0, 5, 20_000)
    token[1::2] = (token[::2] + 1) % 5  # every second token follows from the one before
    before = np.stack([np.r_[5, token[:-1]], np.r_[5, 5, token[:-2]]], 1)
    law = np.full(5, 0.2)
    start = LogBilinear.start(law)
    model = train(start, before, token, law, epochs=3)
    gain = model.log_probabilities(before, token).mean() - start.log_probabilities(before, token).mean()
    assert gain > 0.25
    assert (train(start, before, token, law, epochs=3).flat() == model.flat()).all()
    assert (LogBilinear.from_flat(model.flat(), 5).flat() == model.flat()).all()


def test_no_training_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = lm.score_documents(docs, F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 3 and sorted(r.n_tokens for r in got) == [1, 3, 3]
    assert lm.score_documents(docs.limit(0), F.lit(True)).count() == 0


def test_words_of_a_class_sum_to_one(spark, monkeypatch):
    """Own words, the rest's words and one unseen word of every class, in every context."""
    monkeypatch.setattr(lm, "OWN_SHARE", 2)
    rng = random.Random(6)
    texts = spark.createDataFrame([(" ".join(f"{'ab'[i % 2]}{int(rng.expovariate(0.002))}" for _ in range(60)),) for i in range(300)], "text string")
    counts = lm.count_words(texts).checkpoint()
    v = lm.build_vocabulary(counts)
    model = lm.train_model(texts.withColumn("start", F.lit(True)), v)
    assert v.own > 800 and np.abs(model.within.target).max() > 0
    hidden = model.hidden(np.array([[len(model.bias)] * 2, [0, 3]]))
    words = pa.array([r.word for r in counts.collect()], pa.string())
    c = np.array([r.c for r in counts.collect()])
    of, rank = v.classes(words)
    outcome, own = v.outcomes(of, rank)
    for k in set(of[of >= lm.HEAD_WORDS].tolist()):
        at = np.flatnonzero(of == k)
        for h in hidden:
            n = len(at)
            share = np.exp(model.within.log_shares(np.repeat(h[None], n, 0), np.full(n, k - lm.HEAD_WORDS), outcome[at])).astype(float)
            share[~own[at]] *= (c[at][~own[at]] + 1) / v.rest[k - lm.HEAD_WORDS]
            rest = v.place[len(v.place) - len(v.rest) + k - lm.HEAD_WORDS]
            unseen = np.exp(model.within.log_shares(h[None], np.array([k - lm.HEAD_WORDS]), np.array([rest])))[0] / v.rest[k - lm.HEAD_WORDS]
            assert share.sum() + unseen == pytest.approx(1, abs=1e-5)


def test_own_words_learn_from_contexts():
    rng = np.random.default_rng(1)
    hidden = rng.choice([-1.0, 1.0], (20_000, 1)) * np.eye(1, lm.train_within.__globals__["DIM"])
    hidden = hidden.astype(np.float32)
    first, law = np.array([0, 2, 5]), np.array([0.5, 0.5, 0.4, 0.3, 0.3])
    klass = rng.integers(0, 2, 20_000)
    outcome = np.where(klass == 0, (hidden[:, 0] > 0).astype(int), 2 + rng.choice(3, 20_000, p=[0.4, 0.3, 0.3]))
    start = lm.WithinClasses.start(first, law)
    model, seen = lm.train_within(start, hidden, klass, outcome, law)
    told = model.log_shares(hidden, klass, outcome)
    assert told[klass == 0].mean() > np.log(0.5) + 0.3  # the context tells the word
    assert abs(told[klass == 1].mean() - start.log_shares(hidden, klass, outcome)[klass == 1].mean()) < 0.05  # here it does not
    again, _ = lm.train_within(start, hidden, klass, outcome, law)
    assert (again.flat() == model.flat()).all() and (lm.WithinClasses.from_flat(model.flat(), first).flat() == model.flat()).all()


def test_the_model_grows_with_the_vocabulary(spark):
    for n, own, classes in ((3000, lm.HEAD_WORDS, 256), (60_000, 60_000 // lm.OWN_SHARE, 256)):
        counts = spark.range(n).select(F.concat(F.lit("w"), F.col("id")).alias("word"), (F.lit(n) - F.col("id")).alias("c"))
        v = lm.build_vocabulary(counts)
        assert (v.own, len(v.tail_tokens), len(v.law)) == (own, classes, own - lm.HEAD_WORDS + classes)
        for k in range(classes):
            assert v.law[v.first[k]:v.first[k + 1]].sum() == pytest.approx(1)
