"""Byte-pair merges against the tokenizer library and a plain merge loop; round trips, edge rows."""

import random

import numpy as np
import pytest

from tallyloom.llm.bpe import BytePairs, decode_ids, encode_texts

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
HARD = ["", " ", "\n", "a  b", "don't can't it's we'll I'D", "a b　c​d\u0085e", "<|endoftext|>a<|endoftext|><|endo",
        "漢字。한국어 日本語", "🙂👩‍👩‍👧é", "՘x ꟎1", "x" * 3000, "ab" * 700, "\x00\x01\x7f�", " \t\n  x\r\n\r\n y", "1234567 ½ Ⅷ ٣"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(raw):
    return np.frombuffer(raw, np.int32).tolist()


def test_merges_equal_a_plain_loop():
    pairs, rng = BytePairs.of(PATH), random.Random(4)
    for _ in range(300):
        piece = bytes(rng.choice(b" thenio\xc3\xa9\xe6") for _ in range(rng.randrange(1, 30)))
        ids = [pairs.byte_ids[b] for b in piece]
        while True:  # the lowest rank, leftmost, one at a time
            ranked = [(pairs.rank[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in pairs.rank]
            if not ranked:
                break
            r, k = min(ranked)
            ids[k:k + 2] = [pairs.merges[r][2]]
        assert pairs.merge(piece) == ids


def test_equal_to_the_library(library):
    pairs, rng = BytePairs.of(PATH), random.Random(5)
    pool = [chr(c) for c in range(0x250)] + list("  \n\t　​文字한🙂'stredvml") + ["<|endoftext|>", "'re", " the", "՘"]
    texts = HARD + ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for t in texts:
        ids = ids_of(pairs.encode(t))
        assert ids == library.encode(t, add_special_tokens=False).ids, t
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False) == t
    for _ in range(2000):  # ids that are no whole text, or not in the vocabulary
        ids = [rng.randrange(50_400) for _ in range(rng.randrange(6))]
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_character_is_cut_as_the_library_does(library):
    pairs = BytePairs.of(PATH)
    for at in range(0, 0x110000, 97):
        if not 0xD800 <= at < 0xE000:
            text = f"a{chr(at)}1{chr(at)}-{chr(at)} {chr(at)}  b"
            assert ids_of(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids, hex(at)


def test_stretches_and_forgetting(monkeypatch, library):
    import tallyloom.llm.bpe as bpe

    monkeypatch.setattr(bpe, "STRETCH", 7)
    monkeypatch.setattr(bpe, "PIECES", 10)
    pairs = bpe.BytePairs(PATH)
    text = " ".join(f"word{k} ümlaut{k % 13}" for k in range(400))
    assert ids_of(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len(pairs.known) <= 17


def test_rows(spark, library):
    texts = [(1, "hello world", 5), (1, "hello world", 5), (None, "x", 1), (2, None, None), (3, "", 0), (4, "long " * 30_000, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, ids int")
    got = decode_ids(encode_texts(docs, PATH), PATH).collect()
    want = [(d, library.encode(t or "", add_special_tokens=False).ids, t or "") for d, t, _ in texts]
    assert sorted(((r.id, r.ids, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert decode_ids(encode_texts(docs.limit(0), PATH), PATH).collect() == []
    odd = spark.createDataFrame([(1, [220, None, 99_999]), (2, None), (3, [])], "id long, ids array<int>")
    assert {r.id: r.text for r in decode_ids(odd.where("id > 1"), PATH).collect()} == {2: None, 3: ""}
    assert {r.id: r.text for r in decode_ids(odd.where("id = 1"), PATH).collect()} == {1: " "}  # unknown and null ids add nothing


def test_other_kinds_of_tokenizer_are_refused(tmp_path):
    with pytest.raises(ValueError):
        BytePairs(public.path("word_bpe_49k.json"))
