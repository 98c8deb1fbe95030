"""Huffman codes and token files: optimality, exact round trips, edge rows."""

import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import tokens
from tallyloom.llm.huffman import Code, code_lengths

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ODD = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb", "a \nb", "a\n b", "a\tb", "x y z", "don't can't. it's!",
       "\nabc def.", "abc\n", "<|endoftext|> a", "héllo, wörld. a,b c,. .. , x", "a.\nB c", "漢字。 x", "1, 2. 3"]


def plain_lengths(counts):
    heap = [(int(c), i, [i]) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    depth = [0] * len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for i in a[2] + b[2]:
            depth[i] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    return depth


@pytest.mark.parametrize("n", [1, 2, 3, 17, 300])
def test_lengths_are_optimal_and_limited(n):
    counts = np.random.default_rng(n).integers(1, 10_000, n)
    lengths = code_lengths(counts, 16)
    assert (2.0 ** -lengths).sum() <= 1
    if n > 1 and max(plain_lengths(counts)) <= 16:
        assert (counts * lengths).sum() == sum(c * d for c, d in zip(counts, plain_lengths(counts), strict=True))
    steep = np.array([2 ** k for k in range(25)])  # unlimited codes would be 24 bits deep
    limited = code_lengths(steep, 8)
    assert limited.max() <= 8 and (2.0 ** -limited).sum() <= 1
    with pytest.raises(ValueError):
        code_lengths(np.ones(5), 2)


def test_code_is_canonical_and_round_trips():
    rng = np.random.default_rng(1)
    symbols = np.sort(rng.choice(60_000, 500, replace=False))
    code = Code(symbols, code_lengths(rng.integers(1, 1000, 500)))
    order = sorted(symbols, key=lambda s: (code.length[s], s))
    words = [code.word[s] << (16 - code.length[s]) for s in order]
    assert words == sorted(words)
    runs = [symbols[rng.integers(0, 500, n)] for n in (0, 1, 127, 128, 129, 1000, 0, 5)]
    rows = [(0, i, len(r), m, b) for i, (r, (m, b)) in enumerate(zip(runs, code.encode(runs), strict=True))]
    ids, sizes, got = tokens.unpack_block(tokens.pack_block(rows), code)
    assert ids == list(range(8)) and sizes.tolist() == [len(r) for r in runs]
    assert (got == np.concatenate(runs)).all()


def test_pieces_equal_the_tokenizer():
    encoder = tokens.PieceEncoder(PATH)
    plain = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, encoder.kind).tobytes() for t in ODD]
    for _ in range(2):
        assert encoder.encode(pa.array(ODD)) == plain
        assert [encoder.encode(pa.array([t]))[0] for t in ODD] == plain
    assert encoder.encode(pa.array([None], pa.string())) == [b""]


def expected(rows):
    tokenizer = tokens.PieceEncoder.of(PATH).tokenizer
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_read_back(spark, monkeypatch):
    monkeypatch.setattr(tokens, "RANGE_BYTES", 64)  # many parts
    rows = [(i * 7 % 101, t) for i, t in enumerate(ODD * 3)] + [(None, "no id"), (-5, None)]
    rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, n long").repartition(5)
    got = sorted((tuple(r) for r in tokens.encode_documents(docs, PATH).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    got = sorted(tuple(r) for r in tokens.encode_documents(docs, PATH).collect())
    assert [r[0] for r in got] == [1, 1, 1] and sorted(r[2] for r in got) == [2, 3, 3]
    assert sorted(r[1] for r in got)[0] == 0 and max(r[1] + r[2] for r in got) == 8
    assert tokens.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_one_long_text(spark):
    text = "lorem ipsum dolor " * 60_000
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    assert sorted(tuple(r) for r in tokens.encode_documents(docs, PATH).collect()) == expected([(1, text), (2, "x")])


def test_files_are_read_by_their_path_alone(spark, tmp_path):
    """Another process, with nothing but the path, reads the files back."""
    import subprocess
    import sys

    rows = [(i, t) for i, t in enumerate(ODD)]
    ids = tokens.token_ids(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    path = tokens.write_token_files(spark, ids, str(tmp_path / "files"))
    code = ("from pyspark.sql import SparkSession; from tallyloom.llm import tokens; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
            f"print('GOT', sorted(map(tuple, tokens.read_token_files(s, {path!r}).collect())))")
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT, timeout=300).stdout
    assert said.split("GOT ")[1].strip() == str(expected(rows))


@pytest.mark.parametrize("hot", [7, None, (1 << 63) - 1])
def test_many_rows_of_one_id_are_many_parts(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(tokens, "RANGE_BYTES", 400)
    rows = [(k, f"text {k} with some words") for k in range(0, 90, 3)] + [(hot, f"copy {k % 40} of words {k % 7}") for k in range(300)]
    ids = tokens.token_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PATH).checkpoint()
    path = tokens.write_token_files(spark, ids, str(tmp_path / "files"))
    held = {}
    for part, block, data in spark.read.parquet(f"{path}/blocks").select("part", "block", "data").collect():
        for doc in tokens.unpack_block(data, tokens.Code(*tokens.read_code(spark, path)))[0]:
            held.setdefault(doc, set()).add(part)
    assert len(held[hot]) > 5 and all(len(v) == 1 for k, v in held.items() if k != hot)
    got = sorted(map(tuple, tokens.read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]  # no gap between the rows
    order = [(-1 if r[0] is None else r[0] + 1) for r in got]
    assert order == sorted(order)
    plain = lambda rows: sorted(((d, n, c) for d, _, n, c in rows), key=str)
    assert plain(got) == plain(expected([(d, t) for d, t in rows])) if hot is not None else len(got) == len(rows)
