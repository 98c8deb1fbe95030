"""Fingerprints, range join and components against brute force; edge rows."""

import itertools
import random
import re

import pytest
import xxhash

from tallyloom.llm import components, simhash

DOCS = "doc_id long, text string, id string, fingerprint string, component_id long"


def slow_fingerprint(text, n=3, seed=42):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, max_bits=2):
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= max_bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "a b c a b c a", "É é Ω ſ İ x\x0by\x1cz",
                                  "w " * 70_000 + "x"])
def test_fingerprint(text):
    assert simhash.simhash64(text) == slow_fingerprint(text)


def test_range_join_finds_exactly_the_near_pairs(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(6):
            y = x
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                y ^= 1 << b
            prints.add(y)
    prints |= {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    for bits in (1, 2, 3):
        want = {tuple(sorted(p)) for p in itertools.combinations([s[0] for s in signed], 2)
                if ((p[0] ^ p[1]) & ((1 << 64) - 1)).bit_count() <= bits}
        got = simhash.near_pairs(spark.createDataFrame(signed, "fingerprint long"), bits).collect()
        assert {tuple(sorted((r.left, r.right))) for r in got} == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {i: 1 for i in range(1, 41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert {k: v for k, v in got.items() if k != v} == {k: v for k, v in want.items() if k != v}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    base = [rng.choice(words) for _ in range(300)]
    texts = [" ".join(base), " ".join(base).upper(), " ".join(base[:150] + ["new"] + base[151:]), "", None, "x", "x", " ",
             " ".join(rng.choice(words) for _ in range(80))] + [" ".join(base[:k] + ["q"] + base[k + 1:]) for k in range(0, 300, 40)]
    rows = [(i * 3, t, "clash", "clash", 9) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    prints = {i: slow_fingerprint(t) for i, t, *_ in rows}
    want = slow_components(prints)
    got = {r.id: (r.fingerprint & ((1 << 64) - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (2, "z y x w")],
                                 "doc_id long, text string")
    got = sorted(((r.id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 2), (None, 1), (None, None)]
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == [(1, "a b c d"), (2, "z y x w"), (None, "a b c d"), (None, None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).columns == ["doc_id", "text"]


def test_any_column_names(spark):
    odd = ["__n", "__kept", "id", "fingerprint", "component_id", "c0", "root", "a.b"]
    docs = spark.createDataFrame([(k, "one two three four" if k % 2 else f"t{k} u v", *range(len(odd))) for k in range(8)], ["doc_id", "text", *odd])
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id in (0, 1, 2, 4, 6))
