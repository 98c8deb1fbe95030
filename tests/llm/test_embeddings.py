"""Links and components of vectors against all pairs in double precision; edge rows."""

import numpy as np
import pytest

from tallyloom.llm import embeddings


def by_all_pairs(rows, cosine=0.9):
    dim = max((len(v) for _, v in rows if v), default=1)
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.zeros((len(rows), dim))
    for i in good:
        x[i, :len(rows[i][1])] = np.asarray(rows[i][1], np.float32)
        x[i] /= np.linalg.norm(x[i])
    link = np.zeros((len(rows), len(rows)), bool)
    for i in good:
        link[i, good] = x[good] @ x[i] >= cosine
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            low = min([label[j] for j in np.flatnonzero(link[i])], default=label[i])
            if low < label[i]:
                label[i], changed = low, True
    out = []
    for i, (k, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if label[j] == label[i]]
        out.append((k, int(max(0, link[i].sum() - 1)), min(s for s in same if s is not None) if k is not None else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [(4096, 512, 32), (16, 4, 32), (8, 4, 2)])  # tiles of one, and of several blocks a side
def test_against_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(embeddings.grid_blocks, "__defaults__", (blocks[0],))
    monkeypatch.setattr(embeddings, "TILES", blocks[2])
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6))
    rows = [(int(i) * 5, (centres[i % 12] * rng.uniform(0.2, 3) + rng.normal(size=6) * rng.choice([0, 0.1, 0.4])).tolist())
            for i in range(150)]
    rows += [(2000 + i, centres[0].tolist()) for i in range(40)]  # copies
    rows += [(3001, None), (3002, []), (3003, [0.0] * 6), (3004, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3005, [float("nan")] * 6),
             (3006, [float("inf")] + [0.0] * 5), (None, centres[0].tolist()), (3007, centres[1][:3].tolist()),
             (3008, [1e-30] + [0.0] * 5), (3009, [1e30] + [0.0] * 5)]
    vectors = spark.createDataFrame([(k, v, "clash", 1) for k, v in rows], "vec_id long, embedding array<float>, key string, n int")
    got = sorted(((r.id, r.n_links, r.component_id) for r in embeddings.near_vectors(vectors.repartition(4)).collect()), key=str)
    assert got == by_all_pairs(rows)


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(8)
    ends = np.where(rng.random((400, 1)) < 0.5, 1.0, -1.0) * np.eye(8)[0] + rng.normal(size=(400, 8)) * 0.02
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(ends)], "vec_id long, embedding array<double>")
    _, groups = embeddings.classes(vectors, "vec_id", "embedding")
    lead = embeddings.principal_axes(groups, "<f8", 8)
    blocks = embeddings.grid_blocks(groups, "<f8", 8, lead, 0.45, block=20)
    n = blocks.count()
    pairs = embeddings.near_blocks(blocks.select("block", "low", "high"), 0.45).count()
    assert n >= 20 and pairs < 0.7 * n * (n + 1) / 2


def test_no_rows_and_nothing_to_link(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (1, [0.0]), (None, None)], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in embeddings.near_vectors(blank).collect()), key=str) == [(1, 0, 1), (1, 0, 1), (None, 0, None)]


def test_same_id_twice(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embeddings.near_vectors(vectors).collect()) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
