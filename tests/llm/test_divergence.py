"""Source divergence against a plain version in exact integers, edge rows."""

import collections
import random
import re

import pytest

from tallyloom.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, least=3, top=200, unit=10 ** 9):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, count, groups = collections.defaultdict(set), collections.Counter(), set()
    for doc, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in TERM.findall((text or "").translate(lower)):
            held[lang, t].add(doc)
            count[lang, source, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), d in held.items() if x == lang and len(d) >= least]
        sources = sorted(s for x, s in groups if x == lang)
        n = {s: {t: count[lang, s, t] for t in kept} for s in sources}
        n[None] = {t: sum(n[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + unit * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in n.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], p[None][t])) for t in kept if n[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:most])]
    return sorted(out)


def told(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in dv.divergence(docs, **options).collect())


def corpus(seed, n=120):
    r = random.Random(seed)
    words = [f"w{chr(97 + k)}{'é' * (k % 3)}" for k in range(26)] + ["Ab-ab", "x.y", "don't", "漢字。", "a　b", "ÀÉ", "q_q", "123", "-"]
    text = lambda: r.choice([" ", "\n", "\x0b "]).join(r.choice(words[:r.randrange(1, len(words))]) for _ in range(r.randrange(40)))
    return [(k, r.choice([text(), text(), text(), None, ""]), r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", None, "only"])) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_plain_version(spark, seed):
    rows = corpus(seed)
    want = plain(rows)
    assert told(spark, rows) == want and {r[2] for r in want} == {"pair", "term"}
    assert told(spark, rows, min_docs=1, top=5, unit=1000) == plain(rows, 1, 5, 1000)


def test_blocks_and_sides_do_not_matter(spark, monkeypatch):
    rows = corpus(3)
    want = plain(rows)
    monkeypatch.setattr(dv, "TERMS", 5)
    monkeypatch.setattr(dv, "SOURCES", 2)
    monkeypatch.setattr(dv, "SLICE_BYTES", 200)
    assert told(spark, rows) == want


def test_repeated_null_and_lone_rows(spark):
    rows = [(1, "a b", "en", "x"), (1, "a b", "en", "x"), (1, "a", "en", "y"), (None, "a", "en", "y"), (None, "a c", "en", "y")]
    assert told(spark, rows, min_docs=2) == plain(rows, 2)  # rows of one id, and rows without one, are one document
    assert told(spark, rows, min_docs=3) == plain(rows, 3) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert told(spark, [(1, "a b", "en", "x")]) == [] == told(spark, [])
    docs = spark.createDataFrame([(1, "a", "l", "s", 1, 2)] * 3, SCHEMA + ", part int, n int")
    assert dv.divergence(docs, min_docs=1).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_zero_and_marks_in_names(spark):
    rows = [(k, "one two", "l\x00,\"", f"s\n{k % 2}") for k in range(6)]
    assert told(spark, rows) == plain(rows)


def test_long_text_without_white_space(spark):
    rows = [(k, "z" * 500_000 + "." + "漢" * 100_000, "en", f"s{k % 2}") for k in range(4)]
    assert told(spark, rows) == plain(rows)


def test_entries_keep_the_least_ids():
    import numpy as np
    import pyarrow as pa

    none = dv.NO_DOC
    e = dv.Entries([("l", "s"), ("l", "t")], np.array([1, 0, 0, 1, 0]), pa.array([b"x", b"x", b"y", b"x", b"x"]), np.array([1, 2, 3, 4, 5]),
                   np.array([[9, none], [7, 8], [-5, none], [2, 9], [3, 7]]))
    got = e.combined(2)
    assert sorted(zip(got.group.tolist(), got.strings.to_pylist(), got.n.tolist(), got.docs.tolist(), strict=True)) == [
        (0, b"x", 7, [3, 7]), (0, b"y", 3, [-5, none]), (1, b"x", 5, [2, 9])]
    back = dv.Entries.joined([b for _, b in got.dealt(3)], 2).combined(2)
    names = lambda z: sorted((z.groups[g], s, n, d) for g, s, n, d in zip(
        z.group.tolist(), z.strings.to_pylist(), z.n.tolist(), z.docs.tolist(), strict=True))
    assert names(back) == names(got)
