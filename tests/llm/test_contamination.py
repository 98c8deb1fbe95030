"""Benchmark passages: recall and exactness against a plain edit distance, edge rows."""

import random

from tallyloom.llm import contamination as cn


def distance_to_best_run(item, words, start):
    d = list(range(len(words) - start + 1))
    for i, a in enumerate(item):
        e = [i + 1]
        for j, b in enumerate(words[start:]):
            e.append(min(e[-1] + 1, d[j + 1] + 1, d[j] + (a != b)))
        d = e
    return min(d)


def leaks_of(items, text):
    words, found = cn.words_of(text), {}
    for key, item in items:
        most = int(cn.edits_allowed(len(item), cn.SIMILARITY))
        best = min((distance_to_best_run(item, words, s) for s in range(len(words))), default=99)
        if best <= most:
            found[key] = best
    return found


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        p, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[p] = f"zz{rng.randrange(99)}"
        elif kind == 1:
            del words[p]
        else:
            words.insert(p, f"zz{rng.randrange(99)}")
    return words


def make(rng, n=12):
    vocabulary = [f"word{i}" for i in range(400)] + ["the", "of", "and"] * 60
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randrange(8, 45))]) for i in range(n)]
    return vocabulary, items


def test_finds_edited_copies_and_nothing_else(spark):
    rng = random.Random(5)
    vocabulary, items = make(rng)
    texts, planted = [], 0
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if i % 2:
            key, item = items[rng.randrange(len(items))]
            most = int(cn.edits_allowed(len(item), cn.SIMILARITY))
            copy = edited(item, rng.choice([0, 0, 1, most, most + 6]), rng)
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "!!" if i % 4 == 1 else w for w in copy]
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, edits int, item_id string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.id, r.item_id): r.edits for r in cn.leaks(docs, bench).collect()}
    want = {(i, k): e for i, t in enumerate(texts) for k, e in leaks_of(items, t).items()}
    assert set(got) <= set(want)  # every report is verified
    assert all(got[k] >= want[k] for k in got)
    planted = len(want)
    assert planted > 50 and len(set(want) - set(got)) <= 0.05 * planted
    kept = cn.without_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(160)) - {k[0] for k in got}


def test_more_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    _, items = make(rng)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "doc_id long, text string")
    bench = docs.withColumnRenamed("doc_id", "item_id")
    one = sorted(tuple(r) for r in cn.leaks(docs, bench).collect())
    whole = cn.item_blocks
    monkeypatch.setattr(cn, "item_blocks", lambda *a: whole(*a, block_words=60))
    assert sorted(tuple(r) for r in cn.leaks(docs, bench).collect()) == one and len(one) >= len(items)


def test_edge_rows(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, passage), (3, passage), (None, passage.upper()), (4, "one two three"),
                                  (5, "the " * 30_000 + passage)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage), (2, passage), (3, None), (None, passage), (4, "two words"), (5, "")],
                                  "item_id long, text string")
    got = sorted(((r.id, r.item_id, r.edits, r.first_word) for r in cn.leaks(docs, bench).collect()), key=str)
    assert got == sorted([(3, 1, 0, 0), (3, 2, 0, 0), (5, 1, 0, 30_000), (5, 2, 0, 30_000), (None, 1, 0, 0), (None, 2, 0, 0)], key=str)
    assert sorted(r.doc_id for r in cn.without_leaks(docs, bench).collect()) == [1, 2, 4]
    empty = bench.limit(0)
    assert cn.leaks(docs, empty).count() == 0 and cn.without_leaks(docs, empty).count() == docs.count()
    assert cn.leaks(docs.limit(0), bench).count() == 0


def test_short_items_and_text_without_spaces(spark):
    chinese = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed\u6563\u6b65"
    docs = spark.createDataFrame([(1, "so Two, words! here two words"), (2, "two other words"), (3, f"abc{chinese}\u3002"), (4, chinese[:6]),
                                  (5, chinese[:5] + "\u4e0d" + chinese[6:]), (6, "yes")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "two words"), (2, "Two words."), (3, chinese), (4, "yes"), (5, "!!"), (6, "here two words")],
                                  "item_id long, text string")
    got = {tuple(r) for r in cn.leaks(docs, bench).collect()}
    assert got == {(1, 1, 0, 1), (1, 2, 0, 1), (1, 6, 0, 3), (3, 3, 0, 1), (5, 3, 1, 0), (6, 4, 0, 0)}
    assert sorted(r.doc_id for r in cn.without_leaks(docs, bench).collect()) == [2, 4]


def test_short_items_against_a_plain_search():
    rng = random.Random(8)
    items = [(i, [rng.choice("abcde") for _ in range(rng.randrange(1, 5))]) for i in range(60)]
    texts = [[rng.choice("abcdefg") for _ in range(rng.randrange(0, 25))] for _ in range(200)]
    want = {(t, i): min(k for k in range(len(ws)) if ws[k:k + len(item)] == item) for t, ws in enumerate(texts) for i, item in items
            if any(ws[k:k + len(item)] == item for k in range(len(ws)))}
    assert {(t, i): w for t, i, _, w in cn.ExactItems(items).find(texts)} == want


def recall_of(lengths, words, copies=60, seed=9, **options):
    """(share of copies found by length, copies at the largest edit distance, hidden among other words)."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(3000)] + ["the", "of", "and"] * 300
    items, key = [], 0
    for m in lengths:
        for _ in range(words):
            items.append((key, [rng.choice(vocabulary) for _ in range(m)]))
            key += 1
    index = cn.BlockIndex(items, **options)
    texts, owner = [], []
    for k in rng.choices(range(len(items)), k=copies * len(lengths)):
        item = items[k][1]
        copy = edited(item, int(cn.edits_allowed(len(item), cn.SIMILARITY)), rng)
        texts.append([rng.choice(vocabulary) for _ in range(30)] + copy + [rng.choice(vocabulary) for _ in range(30)])
        owner.append(k)
    found = {(t, i) for t, i, _, _ in index.find(texts)}
    told = {m: [(t, k) in found for t, k in enumerate(owner) if len(items[k][1]) == m] for m in lengths}
    return index, {m: sum(x) / len(x) for m, x in told.items() if x}


def test_recall_by_length():
    """Few long items among many short ones: every length is found, not their mean."""
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, [rng.choice(vocabulary) for _ in range(m)]) for k, m in enumerate([20] * 150 + [16, 30, 60, 100, 200, 200, 300, 400, 400])]
    index = cn.BlockIndex(items)
    for k in [0, 1, *range(150, len(items))]:
        item = items[k][1]
        texts = [edited(item, int(cn.edits_allowed(len(item), cn.SIMILARITY)), rng) for _ in range(40)]
        found = {t for t, i, _, _ in index.find(texts) if i == k}
        assert len(found) >= 36, (len(item), len(found))


def test_recall_of_every_length():
    index, recall = recall_of([5, 8, 12, 16, 25, 40, 70, 120, 200], 12)
    assert min(recall.values()) >= 0.9, recall
    assert all(b.repeats for b in index.bands)


def test_a_band_beyond_the_repetitions_is_searched_by_rare_words(monkeypatch):
    monkeypatch.setattr(cn, "MOST_REPEATS", 2)
    index, recall = recall_of([16, 60, 200], 10)
    assert not any(b.repeats for b in index.bands)
    assert set(recall.values()) == {1.0}
