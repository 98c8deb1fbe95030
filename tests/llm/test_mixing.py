"""Targets, apportionment and the mix against plain versions; edge rows."""

import random

import numpy as np
import pytest

from tallyloom.llm import mixing


def highest_quotients(votes, seats):
    given = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[k] += 1
    return given


def test_apportionment_is_by_highest_quotients():
    rng = random.Random(2)
    for _ in range(200):
        votes = [rng.choice([0, rng.random(), rng.randrange(1, 1000)]) for _ in range(rng.randrange(1, 12))]
        seats = rng.randrange(0, 60)
        got = mixing.apportion(np.array(votes), seats).tolist()
        assert got == (highest_quotients(votes, seats) if sum(votes) > 0 else [0] * len(votes))


def targets_of(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped = set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in stopped}
        stopped |= over


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_targets(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "Z", "é", None, "tiny"])
        n = 0 if rng.random() < 0.1 else rng.randrange(1, 4 if source == "tiny" else 400)
        rows.append((i, None if n == 0 and i % 2 else " ".join("w" * n), source, 7, "clash"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target string").repartition(3)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + size[r[0]]
    want = targets_of(sizes)
    mix = {r.doc_id: r.asDict()["__mix"] for r in mixing.allocate(docs, shard_docs=40, block_words=16).collect()}
    taken = {}
    for doc, _, source, *_ in rows:
        m = mix[doc]
        assert (m.size, m.source_size) == (size[doc], sizes[source]) and m.target == pytest.approx(want[source])
        assert 0 <= m.taken <= 2 * size[doc]
        taken[source] = taken.get(source, 0) + m.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 17 * 2
    again = {r.doc_id: r.asDict()["__mix"] for r in mixing.allocate(docs.repartition(7), shard_docs=40, block_words=16).collect()}
    assert again == mix
    out = mixing.mixed_documents(docs, shard_docs=40, block_words=16)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {d: m.taken for d, m in mix.items() if m.taken}


def test_cut_text_keeps_word_order(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{i}_{k}" for k in range(500)), s, 0) for i, s in enumerate("abcd")],
                                 "doc_id long, text string, source string, n_chars int")
    for r in mixing.mixed_documents(docs).collect():
        places = [int(w.split("_")[1]) for w in r.text.split()]
        assert places == list(range(places[0], places[0] + len(places)))
        assert r.n_chars in (0, len(r.text))


def test_repeated_missing_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (None, None, None)],
                                 "doc_id long, text string, source string")
    got = mixing.allocate(docs).collect()
    assert len(got) == 4 and sum(r.asDict()["__mix"].size for r in got) == 8
    assert mixing.allocate(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).columns == docs.columns
    blank = spark.createDataFrame([(1, "", "s"), (2, None, "t")], "doc_id long, text string, source string")
    assert [r.asDict()["__mix"].taken for r in mixing.allocate(blank).collect()] == [0, 0]


def test_any_column_names(spark):
    """Columns named like the operator's own, and names with dots and marks, come back as they are."""
    odd = ["__size", "__no", "__key", "__mix", "__shard", "__at", "__piece", "__part", "c0", "c1", "a.b", "x y"]
    docs = spark.createDataFrame([(k, f"w{k} " * 50, f"s{k % 3}", 250, *range(len(odd))) for k in range(60)],
                                 ["doc_id", "text", "source", "n_chars", *odd])
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(tuple(r)[4:] == tuple(range(len(odd))) for r in got)
    plain = mixing.mixed_documents(docs.select("doc_id", "text", "source", "n_chars")).collect()
    assert sorted(map(tuple, plain)) == sorted(tuple(r)[:4] for r in got)
    mix = mixing.allocate(docs, mix_col="mixed")
    assert mix.columns == [*docs.columns, "mixed"] and mix.count() == 60
