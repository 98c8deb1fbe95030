"""Every registered query over the smallest driver tables against a plain version of its contract."""

import collections
import hashlib
import html
import os
import re
import zlib

import numpy as np
import pytest

from tallyloom.llm.queries import QUERIES, tokenizer_path
from tallyloom.llm.shared import read
from tallyloom.llm.tokens import PieceEncoder
from test_chat import digest
from test_contamination import leaks_of
from test_divergence import plain as plain_divergence
from test_embeddings import by_all_pairs
from test_mixing import targets_of
from test_secrets import by_rule
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def run(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in read(spark, SF, "documents").collect()}


def test_op1(spark, texts):
    prints = {d: slow_fingerprint(t) for d, t in texts.items()}
    root = slow_components(prints)
    assert sorted(map(tuple, run(spark, "op1_simhash_near_dedup"))) == sorted((d, f"{prints[d]:016x}", root[d]) for d in texts)


def test_op2(spark, texts):
    words = {d: t.encode().lower().split() + [b""] for d, t in texts.items()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 7 == 2}
    c = collections.Counter(w for d in texts if d not in held for w in words[d])
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in run(spark, "op2_log_bilinear_scores")}
    assert set(got) == set(texts)
    for d, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d in held, len(words[d]), sum(c[w] > 0 for w in words[d]), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in words[d]))
    assert sum(got[d].score for d in held) > sum(got[d].base_score for d in held)


def test_op3(spark, texts):
    tokenizer, start, want = PieceEncoder.of(tokenizer_path()).tokenizer, 0, []
    for d in sorted(texts):
        ids = tokenizer.encode(texts[d], add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, run(spark, "op3_huffman_token_files"))) == want


def test_op4(spark, texts):
    got = run(spark, "op4_cnn_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op5(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in read(spark, SF, "conversations").collect()]
    turns = {}
    for c, _, role, text in sorted(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)]):
        turns.setdefault(c, []).append((role, text))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in run(spark, "op5_chat_format")}
    assert got == {c: digest(t) for c, t in turns.items()}


def test_op6(spark, texts):
    items = [(r.item_id, re.findall(r"[^\W_]+", r.text.lower())) for r in read(spark, SF, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.edits for r in run(spark, "op6_cgk_benchmark_leaks")}
    short = {d: t for d, t in texts.items() if len(t) < 500}  # the plain edit distance is slow
    want = {(d, k): e for d, t in short.items() for k, e in leaks_of(items, t).items()}
    assert {k: e for k, e in got.items() if k[0] in short} == want


def test_op7(spark):
    pages = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in run(spark, "op7_template_articles")}
    assert set(got) == set(pages)
    for k, r in got.items():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[k].html, re.DOTALL).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert (r.url, r.text, r.n_chars) == (pages[k].url, "\n".join(filter(None, blocks)), len(r.text))


def test_op8(spark, texts):
    source = {r.doc_id: r.source for r in read(spark, SF, "documents").collect()}
    size = {d: len(t.encode().split()) for d, t in texts.items()}
    sizes, taken = {}, {}
    for d, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[d]
    want = targets_of(sizes)
    got = run(spark, "op8_sainte_lague_mix")
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s]) and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert len(got) == len(texts) and all(abs(taken[s] - want[s]) <= 66 for s in want)


def test_op9(spark, texts):
    names = ("assign", "access", "hex")
    for r in run(spark, "op9_entropy_secrets"):
        base = by_rule(texts[r.doc_id])
        told = [f"{names[k]}:{s}:{e}" for s, k, e in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("entropy")] == told


def test_op10(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF, "embeddings").collect()]
    got = run(spark, "op10_grid_order_near_vectors")
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == by_all_pairs(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_op11(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, run(spark, "op11_merge_queue_bpe"))) == sorted(want)


def test_op12(spark):
    import duckdb

    from tallyloom.llm.queries import ORACLE

    rows = [(r.doc_id, r.text, r.lang, r.source) for r in read(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in run(spark, "op12_chunk_divergence"))
    assert got == plain_divergence(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cols = "lang, source, part, item, value, rank"
    assert sorted(con.execute(f"SELECT {cols} FROM ({ORACLE['op12_chunk_divergence']})").fetchall()) == got


def test_op13(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF, "embeddings").collect()]
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([v for _, v in keep], np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    order = np.argsort(e)[::-1][:8]
    want = (x - s / n) @ u[:, order] / np.sqrt(e[order])
    got = {(r.vec_id, r.component): r for r in run(spark, "op13_bit_sliced_whitening")}
    assert set(got) == {(i, c) for i, _ in keep for c in range(1, 9)}
    sign = [1 if got[keep[0][0], c + 1].whitened * want[0, c] > 0 else -1 for c in range(8)]
    for k, (i, _) in enumerate(keep):
        for c in range(8):
            r = got[i, c + 1]
            assert (r.n, r.deviation) == (n, ((n * x[k] - s) ** 2).sum())
            assert r.whitened * sign[c] == pytest.approx(want[k, c], abs=1e-8)
            assert r.explained == pytest.approx(e[order][c] / e.sum(), rel=1e-9) and r.identity_error < 1e-9
