"""The pipeline against a chain of plain stages, and the registration guard."""

import os
import re
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import toxicity
from tallyloom.llm.queries import QUERIES, tokenizer_path
from tallyloom.llm.shared import crc_mod, read
from tallyloom.llm.tokens import PieceEncoder
from test_contamination import leaks_of
from test_mixing import targets_of
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_files"]
    start = {r.doc_id: r.asDict() for r in docs.collect()}

    clean = stage["toxicity"](spark, docs, SF).checkpoint()
    model = toxicity.fit(docs, read(spark, SF, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    ids = toxicity.WordIds()
    rejected = set()
    for d, r in start.items():
        words, lang = toxicity.split_ids(ids(r["text"]))
        if model.calibrated(model.probabilities([words]), np.array([lang]))[0] >= 0.5:
            rejected.add(d)
    assert {r.doc_id for r in clean.collect()} == set(start) - rejected

    single = stage["simhash_near_dedup"](spark, clean, SF).checkpoint()
    root = slow_components({d: slow_fingerprint(start[d]["text"]) for d in set(start) - rejected})
    assert {r.doc_id for r in single.collect()} == {d for d, k in root.items() if d == k}

    unseen = stage["benchmark_decontamination"](spark, single, SF).checkpoint()
    items = [(r.item_id, re.findall(r"[^\W_]+", r.text.lower())) for r in read(spark, SF, "benchmark").collect()]
    short = [r for r in single.collect() if len(r.text) < 500]  # the plain edit distance is slow
    kept = {r.doc_id for r in unseen.collect()}
    assert {r.doc_id for r in short if not leaks_of(items, r.text)} == {r.doc_id for r in short} & kept

    mixed = stage["source_mix"](spark, unseen, SF).checkpoint()
    sizes, taken = {}, {}
    for r in unseen.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    for source, target in targets_of(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 70
    for frame in (clean, single, unseen, mixed):
        assert frame.columns == docs.columns

    out = stage["token_files"](spark, mixed, SF).collect()
    tokenizer = PieceEncoder.of(tokenizer_path()).tokenizer
    want = sorted((r.doc_id, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r in mixed.collect()
                  for i in [tokenizer.encode(r.text, add_special_tokens=False).ids + [2]])
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    by_start = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == sorted(r.doc_id for r in out)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(by_start, by_start[1:], strict=False))
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_stages_of_no_rows(spark):
    docs = read(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "token_files" or out.columns == docs.columns)


def test_entry_without_the_corpus_files():
    """Deleted folders, as a finder that knows neither of them: the entry and its other queries stay."""
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('tallyloom.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert 'receivable_aging' in q and 'pipeline' not in q and not [n for n in q if n[:2] == 'op' and n[2].isdigit()]\n"
            "assert set(e.oracle_sql()) <= set(q)\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(corpus_pipeline.__file__))


def test_every_operator_is_registered():
    assert [int(re.match(r"op(\d+)_", n).group(1)) for n in sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n).group(1)))] == list(range(1, 14))
