"""Source divergence audit: how each source's word use differs from its language's and its siblings'.

1. Every task counts the white-space chunks of each of its documents and adds them
   up by (lang, source, chunk), with the least ``min_docs`` document ids: a term is
   in ``min_docs`` documents or more exactly if the least ids of its chunks, put
   together, are that many.  Entries travel as compressed blocks, dealt by chunk.
2. Where a chunk's entries meet, it is cut into its terms once for the whole
   corpus; its counts and ids go to the terms, which are dealt and added up again.
3. Terms in enough documents are kept; their counts by source and by language
   become integer proportions, and the divergences are sums of integer quotients.

Pairs of sources are compared in blocks: a block holds a stretch of a language's
kept terms and at most ``2 * SOURCES`` of its sources as a matrix, and returns one
partial sum per pair, so neither a language nor a source is one task's work and no
pair is listed per term.

Blocks are dealt to ``spark.sql.shuffle.partitions`` parts, which should grow with
the corpus as for any shuffle.  Null texts, languages and sources are empty text.
Rows of the same document id are one document, rows without an id are one
together.  An empty table gives no rows; other columns are left out, whatever
their names.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_rows, frugal, materialise, string_hashes, text_slices

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = 1_000_000_000  # proportions are counted in parts of it
TOP = 200
SLICE_BYTES = 8 << 20  # of text counted at once
HELD = 1_000_000  # entries put together at once
TERMS = 4096  # of a language in one block
SOURCES = 256  # of a language on one side of a block
NO_DOC = np.iinfo(np.int64).max


@dataclass
class Entries:
    """Counts ``n`` of ``strings`` in ``groups`` (lang, source), with the least document ids (rows of ``docs``, filled with NO_DOC)."""

    groups: list[tuple[str, str]]
    group: np.ndarray
    strings: pa.Array
    n: np.ndarray
    docs: np.ndarray

    def combined(self, least: int) -> Entries:
        """One entry per (group, string): counts added, the ``least`` least ids kept."""
        if not len(self.n):
            return self
        coded = self.strings.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        key = self.group * len(coded.dictionary) + code
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        segment = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        docs = self.docs[order]
        ids, rank = np.unique(docs, return_inverse=True)
        pair = _distinct((segment[:, None] * len(ids) + rank.reshape(docs.shape)).ravel())
        segment, rank = pair // len(ids), pair % len(ids)
        begins = np.flatnonzero(np.diff(segment, prepend=-1))
        place = np.arange(len(pair)) - np.repeat(begins, np.diff(np.append(begins, len(pair))))
        some = place < least
        kept = np.full((len(first), least), NO_DOC, np.int64)
        kept[segment[some], place[some]] = ids[rank[some]]
        one = order[first]
        return Entries(self.groups, self.group[one], coded.dictionary.take(pa.array(code[one])),
                       np.add.reduceat(self.n[order], first), kept)

    def dealt(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """(part, block): the entries by a hash of their string."""
        part = (string_hashes(self.strings) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            yield int(part[order[a]]), self._block(order[a:b])

    def _block(self, at: np.ndarray) -> bytes:
        used, local = np.unique(self.group[at], return_inverse=True)
        names = json.dumps([self.groups[g] for g in used]).encode()
        strings = self.strings.take(pa.array(at))
        sizes = pc.binary_length(strings).to_numpy().astype(np.uint32)
        text = strings.buffers()[2].slice(0, int(sizes.sum())).to_pybytes()  # taken just now: it holds these strings alone
        docs = self.docs[at]
        there = docs != NO_DOC
        body = b"".join([struct.pack("<IIQ", len(at), len(names), len(text)), names, text, sizes.tobytes(),
                         local.astype(np.uint32).tobytes(), self.n[at].astype(np.int64).tobytes(),
                         there.sum(1).astype(np.uint8).tobytes(), docs[there].tobytes()])
        return zlib.compress(body, 1)

    @classmethod
    def joined(cls, blocks: list[bytes], least: int) -> Entries:
        """The entries of several blocks, not yet combined."""
        groups: dict[tuple[str, str], int] = {}
        group, strings, n, docs = [], [], [], []
        for block in blocks:
            body = zlib.decompress(block)
            count, n_names, n_text = struct.unpack_from("<IIQ", body)
            at = 16 + n_names
            here = np.array([groups.setdefault((x, y), len(groups)) for x, y in json.loads(body[16:at])], np.int64)
            text, at = body[at:at + n_text], at + n_text
            sizes = np.frombuffer(body, np.uint32, count, at)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            strings.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(ends), pa.py_buffer(text)]))
            group.append(here[np.frombuffer(body, np.uint32, count, at + 4 * count)])
            n.append(np.frombuffer(body, np.int64, count, at + 8 * count))
            held = np.frombuffer(body, np.uint8, count, at + 16 * count).astype(np.int64)
            ids = np.frombuffer(body, np.int64, int(held.sum()), at + 17 * count)
            rows = np.full((count, least), NO_DOC, np.int64)
            rows[np.arange(least) < held[:, None]] = ids
            docs.append(rows)
        return cls(list(groups), np.concatenate(group), pa.concat_arrays(strings).cast(pa.binary()), np.concatenate(n), np.concatenate(docs))

    def with_(self, other: Entries) -> Entries:
        names = {g: k for k, g in enumerate(self.groups)}
        there = np.array([names.setdefault(g, len(names)) for g in other.groups], np.int64)
        return Entries(list(names), np.concatenate([self.group, there[other.group]]), pa.concat_arrays([self.strings, other.strings]),
                       np.concatenate([self.n, other.n]), np.concatenate([self.docs, other.docs]))


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, each once; a sort is faster here than ``np.unique``'s hash table."""
    numbers.sort()
    return numbers[np.diff(numbers, prepend=-1) != 0]


def count_chunks(rows: pa.RecordBatch, least: int) -> Entries:
    """Chunks of (doc_id, text, lang, source) rows: counted per document, then added up by group."""
    names: dict[tuple[str, str], int] = {}
    group_of = np.array([names.setdefault(g, len(names)) for g in zip(*(rows.column(c).to_pylist() for c in (2, 3)), strict=True)], np.int64)
    split = pc.ascii_split_whitespace(pc.ascii_lower(rows.column(1)))
    words = split.flatten()
    doc = np.repeat(np.arange(len(group_of)), np.diff(split.offsets.to_numpy()))
    full = pc.binary_length(words).to_numpy() > 0  # nothing stands before leading or after trailing white space
    words, doc = words.filter(pa.array(full)), doc[full]
    coded = words.dictionary_encode()
    size = max(1, len(coded.dictionary))
    pair = np.sort(doc * size + coded.indices.to_numpy())
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    n, pair = np.diff(np.append(first, len(pair))), pair[first]
    doc, code = pair // size, pair % size
    chunks = coded.dictionary.cast(pa.binary()).take(pa.array(code))
    ids = rows.column(0).to_numpy()
    return Entries(list(names), group_of[doc], chunks, n.astype(np.int64), ids[doc][:, None]).combined(least)


def cut_into_terms(chunks: Entries, least: int) -> Entries:
    """The entries' chunks, each distinct one cut once, replaced by their terms with the chunk's counts and ids."""
    coded = chunks.strings.dictionary_encode()
    found = [TERM.findall(c) for c in coded.dictionary.cast(pa.string()).to_pylist()]
    sizes = np.array([len(f) for f in found], np.int64)
    begin = np.cumsum(sizes) - sizes
    terms = pa.array([t for f in found for t in f], pa.string()).cast(pa.binary())
    code = coded.indices.to_numpy()
    per = sizes[code]
    entry = np.repeat(np.arange(len(code)), per)
    place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return Entries(chunks.groups, chunks.group[entry], terms.take(pa.array(begin[code[entry]] + place)),
                   chunks.n[entry], chunks.docs[entry]).combined(least)


def _met(parts: Iterable[pa.RecordBatch], least: int) -> Iterator[Entries]:
    """All entries of each part, combined; a partition holds whole parts, in order."""
    def put_together(held: Entries | None, blocks: list[bytes]) -> Entries:
        new = Entries.joined(blocks, least)
        return (held.with_(new) if held else new).combined(least)

    held, blocks, waiting, part = None, [], 0, None
    for batch in parts:
        for p, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if p != part and part is not None:
                yield put_together(held, blocks) if blocks else held
                held, blocks, waiting = None, [], 0
            part = p
            blocks.append(data.as_py())
            waiting += 1 + len(blocks[-1]) // 8
            if waiting > HELD:
                held, blocks, waiting = put_together(held, blocks), [], 0
    if part is not None:
        yield put_together(held, blocks) if blocks else held


BLOCK = "part int, data binary"


def _blocks(entries: Entries, parts: int) -> pa.RecordBatch:
    found = list(entries.dealt(parts))
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
                                      names=["part", "data"])


def term_counts(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """(lang, source, term, n, lang_n, first): occurrences of the terms in ``min_docs`` or more documents of their language.

    ``lang_n`` counts the whole language; ``first`` marks one row per (lang, term).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for some in text_slices(batch, SLICE_BYTES):
                yield _blocks(count_chunks(some, min_docs), parts)

    def cut(blocks: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _met(blocks, min_docs):
            yield _blocks(cut_into_terms(chunks, min_docs), parts)

    def keep(blocks: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for terms in _met(blocks, min_docs):
            yield from _kept(terms, min_docs)

    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc_id")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    dealt = lambda df: df.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    chunks = docs.select(known, *text).mapInArrow(frugal(count), BLOCK)
    terms = dealt(chunks).mapInArrow(frugal(cut), BLOCK)
    return dealt(terms).mapInArrow(
        frugal(keep), "lang string, source string, term string, n long, lang_n long, first boolean")


def _kept(terms: Entries, min_docs: int) -> Iterator[pa.RecordBatch]:
    if not len(terms.n):
        return
    at: dict[str, int] = {}
    lang = np.array([at.setdefault(g[0], len(at)) for g in terms.groups], np.int64)[terms.group]
    # the same entries with a language as their group: one per (lang, term)
    whole = Entries([(x, "") for x in at], lang, terms.strings, terms.n, terms.docs).combined(min_docs)
    enough = (whole.docs != NO_DOC).sum(1) >= min_docs
    both = pa.concat_arrays([whole.strings, terms.strings]).dictionary_encode().indices.to_numpy().astype(np.int64)
    of_whole, of_terms = both[:len(whole.n)] * len(at) + whole.group, both[len(whole.n):] * len(at) + lang
    order = np.argsort(of_whole)
    match = order[np.searchsorted(of_whole[order], of_terms)]
    keep = np.flatnonzero(enough[match])
    match = match[keep]
    first = np.zeros(len(keep), bool)
    first[np.unique(match, return_index=True)[1]] = True
    for a in range(0, len(keep), 50_000):
        rows, m = keep[a:a + 50_000], match[a:a + 50_000]
        group = terms.group[rows].tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array([terms.groups[g][0] for g in group], pa.string()), pa.array([terms.groups[g][1] for g in group], pa.string()),
            terms.strings.take(pa.array(rows)).cast(pa.string()), pa.array(terms.n[rows]), pa.array(whole.n[m]),
            pa.array(first[a:a + 50_000])], names=["lang", "source", "term", "n", "lang_n", "first"])


def divergence(docs: DataFrame, min_docs: int = 3, top: int = TOP, unit: int = UNIT) -> DataFrame:
    """(lang, source, part, item, value, rank): the audit of every (lang, source) that occurs.

    A term's proportion in a group is ``1 + floor(unit * (n + 1) / (N + V))`` with
    ``N`` the group's kept occurrences and ``V`` the language's kept terms; a
    divergence of p from q is ``floor((p - q)^2 / q)``.  Part ``pair`` gives the sum
    over all kept terms against every other source of the language, part ``term``
    the ``top`` terms that the source has and uses more than its language.
    """
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    with arrow_rows(docs.sparkSession, 2500):
        counts = materialise(term_counts(docs, min_docs), "term-counts")
    langs = counts.where("first").groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    stats = (groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
             .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "v"))))
    stats = materialise(stats, "group-totals")
    found = _terms(counts, stats, unit, top).unionByName(_pairs(counts, stats, unit))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _proportion(n: str, total: str, unit: int):
    return F.expr(f"1 + cast({unit} as decimal(10, 0)) * ({n} + 1) div ({total} + v)")


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _terms(counts: DataFrame, stats: DataFrame, unit: int, top: int) -> DataFrame:
    rows = (counts.join(stats, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), _proportion("n", "total", unit).alias("p"),
                    _proportion("lang_n", "lang_total", unit).alias("q")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    return _ranked(rows).where(F.col("rank") <= top)


def _pairs(counts: DataFrame, stats: DataFrame, unit: int) -> DataFrame:
    """Sums over all kept terms for every ordered pair of a language's sources, block by block."""
    numbered = stats.select("lang", "source", "total", "v", F.row_number().over(
        Window.partitionBy("lang").orderBy("source")).alias("no"), F.count("*").over(Window.partitionBy("lang")).alias("sources"))
    numbered = materialise(numbered.withColumns({
        "own": F.expr(f"cast((no - 1) div {SOURCES} as int)"), "sides": F.expr(f"cast((sources - 1) div {SOURCES} as int)"),
        "blocks": F.expr(f"cast(greatest((v + {TERMS} - 1) div {TERMS}, 1) as int)")}), "sources")

    def sides(rows: DataFrame) -> DataFrame:  # each pair of source sides once, the lesser first
        return (rows.withColumn("side", F.explode(F.sequence(F.lit(0), "sides")))
                .withColumns({"a": F.least("own", "side"), "b": F.greatest("own", "side")}))

    block = F.expr("cast(pmod(xxhash64(term), blocks) as int)").alias("block")
    sized = counts.where("first").join(numbered.select("lang", "blocks").distinct(), "lang").select("lang", block)
    sized = sized.groupBy("lang", "block").agg(F.count("*").alias("terms"))
    members = sides(numbered.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    members = members.join(sized, ["lang", "block"], "left").select(
        "lang", "block", "a", "b", "no", "total", "v", "own", F.coalesce("terms", F.lit(0)).alias("terms"))
    members = members.toDF(*members.columns)  # columns of its own: both sides of the cogroup come from ``numbered``
    cells = counts.join(numbered, ["lang", "source"]).select("lang", "term", "no", "n", "own", "sides", block)
    cells = sides(cells).select("lang", "block", "a", "b", "no", "n", "term")

    def compare(cells: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if members.empty:
            return pd.DataFrame({"lang": [], "no": [], "other": [], "value": []})
        members = members.sort_values("no")
        no, total = members["no"].to_numpy(), members["total"].to_numpy()
        v, terms, own = int(members["v"].iat[0]), int(members["terms"].iat[0]), members["own"].to_numpy()
        at, names = pd.factorize(cells["term"])
        n = np.zeros((len(no), len(names)), np.int64)
        n[np.searchsorted(no, cells["no"].to_numpy()), at] = cells["n"].to_numpy()
        p = np.ones((len(no), len(names) + 1), np.int64)  # the last column stands for terms that no source here has
        wide = bool(len(names)) and int(n.max()) > (1 << 62) // unit
        if v:
            some = np.append(n, np.zeros((len(no), 1), np.int64), 1).astype(object if wide else np.int64)
            p += (unit * (some + 1) // (total + v).astype(some.dtype)[:, None]).astype(np.int64)
        weight = np.append(np.ones(len(names), np.int64), terms - len(names))
        found = []
        for k in range(len(no)):
            gap = p[k] - p
            value = (gap * gap // p * weight).sum(1)
            other = (own != own[k]) if len(set(own)) > 1 else (no != no[k])
            found += [(no[k], no[j], value[j]) for j in np.flatnonzero(other)]
        out = pd.DataFrame(found, columns=["no", "other", "value"])
        out.insert(0, "lang", members["lang"].iat[0])
        return out

    keys = ["lang", "block", "a", "b"]
    partial = cells.groupBy(keys).cogroup(members.groupBy(keys)).applyInPandas(
        compare, "lang string, no int, other int, value long")
    names = numbered.select("lang", "no", "source")
    summed = partial.groupBy("lang", "no", "other").agg(F.sum("value").alias("value"))
    rows = summed.join(names, ["lang", "no"]).join(
        names.select("lang", F.col("no").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    return _ranked(rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
