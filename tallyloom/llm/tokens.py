"""Token-ID output: Huffman-coded id files in ascending document order, and their reader.

1. Every text is encoded once; the ids go to a compact table in the shared folder.
2. Ids are counted over the whole table; the counts fix one canonical code.
3. Documents are coded in place, dealt to ranges of ids and written as blocks:
   a file is a Parquet part whose rows are blocks in ascending order of id.

A block decodes on its own: a header, the documents' ids and sizes, a bit offset
for every 128 ids, and the bits.  Blocks hold whole documents and are closed at
``block_tokens`` ids.  The tokenizer library does the encoding; each
worker keeps the ids of words that it has met (bounded, see PIECES).
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .huffman import INTERVAL, Code, code_lengths
from .shared import arrow_rows, batches, column, frugal, materialise, shared_path, string_hashes, text_slices

PIECES = 1_500_000  # words that a worker remembers before it starts anew
CHUNK_BYTES = 8 << 20  # of text encoded at once
END_ID = 2
BLOCK_TOKENS = 1 << 18
RANGE_BYTES = 64 << 20  # of plain ids in one output file
MAGIC = b"TLH1"

_encoders: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Ids of texts as arrays of two bytes, or of four for a vocabulary over 65,536.

    A text is cut before each space and line feed between two characters that are
    no white space: the tokenizer's own word pattern always ends a word there, as
    it does between a letter and a closing mark.  Words met before are kept with
    their ids in Arrow and numpy arrays; a text with other white space is encoded
    as it stands.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = id_type(self.tokenizer.get_vocab_size())
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.marks = dict(zip(".,;:!?", self._plain(list(".,;:!?")), strict=True))
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, and whose they are
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.kind)

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind.char, e.ids).tobytes() for e in found]

    def _joined(self, words: list[str], lead: str) -> Iterator[bytes]:
        """Ids of lead + word, many to a call: the line feed between two is a token of its own."""
        width = self.kind.itemsize
        for at in range(0, len(words), 128):
            text = lead + ("\n" + lead).join(words[at:at + 128])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            raw, last = ids.tobytes(), 0
            for end in [*(np.flatnonzero(ids == self.line_feed) * width).tolist(), len(raw)]:
                yield raw[last:end]
                last = end + width

    def _learn(self, names: list[str], bare: dict[str, int]) -> dict[str, int]:
        """Add new words, and say where each is.

        ``bare``: of those that are a word and a closing mark, where the word alone
        is, or -1.  One that begins with a line feed has no space before its letters.
        """
        wanted = list(dict.fromkeys(p[:-1] if p in bare else p for p in names if bare.get(p, -1) < 0))
        feed = array(self.kind.char, [self.line_feed]).tobytes()
        spaced, lined = [w for w in wanted if w[0] != "\n"], [w for w in wanted if w[0] == "\n"]
        met = dict(zip(spaced, self._joined(spaced, " "), strict=True))
        met.update((w, feed + ids) for w, ids in zip(lined, self._joined([w[1:] for w in lined], ""), strict=True))
        for p, k in bare.items():
            word = met[p[:-1]] if k < 0 else self.flat[self.first[k]:self.first[k] + self.size[k]].tobytes()
            met[p] = word + self.marks[p[-1]]
        start = len(self.words)
        size = np.fromiter(map(len, met.values()), np.int32, len(met)) // self.kind.itemsize
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size, dtype=np.int64) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(met.values()), self.kind)])
        added = pa.array(list(met), pa.string())
        hashes = string_hashes(added)
        order = np.argsort(hashes, kind="stable")
        to = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, to, hashes[order])
        self.at = np.insert(self.at, to, (start + order).astype(np.int32))
        self.words = pa.concat_arrays([self.words, added])
        return dict(zip(met, range(start, start + len(met)), strict=True))

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """Place of each word among the known ones or -1: found by its hash, then compared as it is."""
        place = np.full(len(words), -1, np.int64)
        if not len(self.hashes) or not len(words):
            return place
        hashes = string_hashes(words)
        near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[near] == hashes)
        at = self.at[near[hit]]
        same = pc.equal(words.take(pa.array(hit)), self.words.take(pa.array(at))).to_numpy(zero_copy_only=False)
        place[hit[same]] = at[same]
        return place

    def _places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word among the known ones, whether white space stands at its end: 0 then)."""
        if len(self.words) > PIECES:
            self._forget()
        # a Latin letter and a closing mark are always two tokens: the word before the mark is looked up too
        marked = np.flatnonzero(pc.match_substring_regex(words, "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][.,;:!?]$")
                                .to_numpy(zero_copy_only=False))
        alone = pc.utf8_slice_codeunits(words.take(pa.array(marked)), 0, -1)
        place, odd = self._look_up(words), np.zeros(len(words), bool)
        unmet = np.flatnonzero(place < 0)
        names = words.take(pa.array(unmet)).to_pylist()
        is_odd = np.fromiter(map(_odd, names), bool, len(names))
        odd[unmet[is_odd]], place[unmet[is_odd]] = True, 0
        base = np.full(len(words), -2, np.int64)
        base[marked] = self._look_up(alone)
        bare = {p: k for p, k, o in zip(names, base[unmet].tolist(), is_odd.tolist(), strict=True) if k > -2 and not o}
        new = [p for p, o in zip(names, is_odd.tolist(), strict=True) if not o]
        if new:
            at = self._learn(new, bare)
            place[unmet[~is_odd]] = [at[p] for p in new]
        return place, odd

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a string array, in its order; null texts are empty.

        Words are told apart by Arrow's dictionary encoding, so each is looked up
        once for the array; numpy puts the ids together.
        """
        texts = pc.fill_null(texts, "")
        split = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        place, odd = self._places(coded.dictionary)
        if not len(self.words):  # nothing but white space so far
            return self._plain(texts.to_pylist())
        size, first = np.where(odd, 0, self.size[place]), self.first[place]
        per_word = size[which]
        after = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
        at = np.repeat(first[which] - after[:-1], per_word)
        at += np.arange(after[-1])
        raw = self.flat[at].tobytes()
        del at
        cut = after[ends] * self.kind.itemsize
        width = self.kind.itemsize  # of the line feed that was set before each text
        out = [raw[a + width:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        if odd.any():  # white space beside white space: these texts are encoded as they stand
            odd_before = np.concatenate([[0], np.cumsum(odd[which])])
            whole = np.flatnonzero(odd_before[ends[1:]] > odd_before[ends[:-1]])
            for k, plain in zip(whole.tolist(), self._plain(texts.take(pa.array(whole)).to_pylist()), strict=True):
                out[k] = plain
        return out


def _odd(piece: str) -> bool:
    word = piece.removeprefix("\n")
    return not word or word[0].isspace() or word[-1].isspace()


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")




def token_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """(id, width, ids binary): the ids of each whole text and ``end_id``, ``width`` bytes each; null text: empty."""
    out = pa.schema([("id", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(tokenizer)
        end, width = np.array([end_id], encoder.kind).tobytes(), encoder.kind.itemsize
        for part in parts:
            for rows in text_slices(part, CHUNK_BYTES):
                ids = [b + end for b in encoder.encode(rows.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())], schema=out)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(frugal(run), "id long, width int, ids binary"))


def count_ids(tokens: DataFrame) -> DataFrame:
    """(token, n): how often each id occurs in the whole table."""
    out = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in parts:
            for width, ids in _runs(part):
                n = np.bincount(np.frombuffer(ids, f"<u{width}"))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[:len(n)] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], schema=out)

    return (tokens.select("width", "ids").mapInArrow(frugal(run), "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")))


@dataclass
class Ranges:
    """Ascending parts: ids up to each of ``cuts``; a part of one id with too many rows is split by their hash."""

    cuts: np.ndarray
    own_nulls: bool  # rows without id have the first range to themselves, else they share it
    first: np.ndarray  # part where each range begins, and the number of parts

    @property
    def parts(self) -> int:
        return int(self.first[-1])

    def part(self, doc: int | None, bits: bytes) -> int:
        k = 0 if doc is None else int(np.searchsorted(self.cuts, doc, side="right")) + self.own_nulls
        width = int(self.first[k + 1] - self.first[k])
        if width == 1:
            return int(self.first[k])
        # rows of an id are ordered by Spark's signed hash of their bits
        return int(self.first[k]) + ((xxhash.xxh64_intdigest(bits, 42) ^ (1 << 63)) * width >> 64)


def _ranges(tokens: DataFrame, range_bytes: int | None = None) -> Ranges:
    """Ranges of about ``RANGE_BYTES`` of plain ids; the lists are as long as there are parts."""
    most = range_bytes or RANGE_BYTES
    size = int(tokens.agg(F.sum(F.length("ids"))).first()[0] or 0)
    parts = max(1, -(-size // most))
    if parts == 1:
        return Ranges(np.zeros(0, np.int64), False, np.array([0, 1]))
    cuts = {min(int(c), (1 << 63) - 1) for c in tokens.approxQuantile("id", [k / parts for k in range(1, parts)], 0.1 / parts)}
    hot = {r.id: -(-r.b // most) for r in
           tokens.groupBy("id").agg(F.sum(F.length("ids")).alias("b")).where(F.col("b") > most).collect()}
    cuts |= {c for i in hot if i is not None for c in (i, i + 1) if c < 1 << 63}
    ordered, nulls = np.array(sorted(cuts), np.int64), None in hot
    width = np.ones(len(ordered) + 1 + nulls, np.int64)
    for i, n in hot.items():
        width[0 if i is None else int(np.searchsorted(ordered, i, side="right")) + nulls] = n
    return Ranges(ordered, nulls, np.concatenate([[0], np.cumsum(width)]))


def write_token_files(spark: SparkSession, tokens: DataFrame, path: str,
                      block_tokens: int = BLOCK_TOKENS) -> str:
    """Write ``tokens`` (id, ids) as Huffman-coded blocks under ``path``, ids ascending, nulls first; returns ``path``.

    ``path/blocks`` holds the blocks and ``path/code`` the length of every token's
    code, from which a canonical code follows: the files are read by their path alone.
    Rows that repeat an id stand side by side, ordered by a hash of their ids.
    The code table reaches the driver: one row per id of the vocabulary at most.
    """
    table = count_ids(tokens).orderBy("token").toPandas()
    symbols = table["token"].to_numpy(np.int64)
    lengths = code_lengths(table["n"].to_numpy(np.int64))
    ranges = _ranges(tokens)
    coded_schema = pa.schema([("part", pa.int32()), ("id", pa.int64()), ("n", pa.int64()),
                              ("marks", pa.binary()), ("bits", pa.binary())])

    def encode(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(symbols, lengths)

        def coded() -> Iterator[tuple]:
            for part in rows:
                docs = column(part, "id")
                ids = list(_ids(part))
                for at in range(0, len(docs), 128):
                    for doc, run, (marks, bits) in zip(docs[at:at + 128], ids[at:at + 128],
                                                       code.encode(ids[at:at + 128]), strict=True):
                        yield ranges.part(doc, bits), doc, len(run), marks, bits

        yield from batches(coded(), coded_schema, 512)

    block_schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()),
                              ("n_tokens", pa.int64()), ("data", pa.binary())])

    def assemble(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple]:
            held, tokens_held, part, number = [], 0, None, 0
            for row in _rows(rows):
                if held and (row[0] != part or tokens_held >= block_tokens):
                    yield part, number, held[0][1], tokens_held, pack_block(held)
                    number, held, tokens_held = number + 1, [], 0
                if row[0] != part:
                    part, number = row[0], 0
                held.append(row)
                tokens_held += row[2]
            if held:
                yield part, number, held[0][1], tokens_held, pack_block(held)

        yield from batches(blocks(), block_schema, 16)

    (tokens.select("id", "width", "ids").mapInArrow(frugal(encode), "part int, id long, n long, marks binary, bits binary")
     .repartitionById(ranges.parts, F.col("part")).sortWithinPartitions("part", "id", F.xxhash64("bits"))
     .mapInArrow(frugal(assemble), "part int, block long, first_id long, n_tokens long, data binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    # the code comes last: a folder without it is a write that did not end
    code_rows = pa.table([pa.array(symbols, pa.int64()), pa.array(lengths, pa.int32())], names=["token", "length"])
    spark.createDataFrame(code_rows).coalesce(1).write.parquet(f"{path}/code")
    return path


def read_code(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, code lengths) of the files at ``path``: one row per id of the vocabulary at most."""
    table = spark.read.schema("token long, length int").parquet(f"{path}/code").orderBy("token").toPandas()
    return table["token"].to_numpy(np.int64), table["length"].to_numpy(np.int64)


def _ids(part: pa.RecordBatch) -> Iterator[np.ndarray]:
    for width, ids in zip(column(part, "width"), part.column(part.schema.get_field_index("ids")), strict=True):
        yield np.frombuffer(ids.as_buffer(), f"<u{width}")


def _runs(part: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """The ids of a batch joined, by their width."""
    widths, ids = column(part, "width"), column(part, "ids")
    for width in set(widths):
        yield width, b"".join(i for w, i in zip(widths, ids, strict=True) if w == width)


def _rows(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def pack_block(rows: list[tuple]) -> bytes:
    """A block of coded documents (part, id, n, marks, bits), documents on byte borders."""
    ids = np.array([0 if r[1] is None else r[1] for r in rows], "<i8")
    missing = np.array([r[1] is None for r in rows], np.uint8)
    sizes = np.array([r[2] for r in rows], "<u4")
    first = np.cumsum([0] + [len(r[4]) for r in rows[:-1]]) * 8
    marks = np.concatenate([np.frombuffer(r[3], "<u4").astype(np.int64) + f
                            for r, f in zip(rows, first, strict=True)]).astype("<u8")
    return b"".join([MAGIC, struct.pack("<IIQ", INTERVAL, len(rows), len(marks)), ids.tobytes(),
                     missing.tobytes(), sizes.tobytes(), marks.tobytes(), *(r[4] for r in rows)])


def unpack_block(data: bytes, code: Code) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their sizes, all token ids) of a block."""
    if data[:4] != MAGIC:
        raise ValueError("not a token block")
    interval, n, n_marks = struct.unpack_from("<IIQ", data, 4)
    at = 20
    ids = np.frombuffer(data, "<i8", n, at)
    missing = np.frombuffer(data, np.uint8, n, at + 8 * n)
    sizes = np.frombuffer(data, "<u4", n, at + 9 * n).astype(np.int64)
    marks = np.frombuffer(data, "<u8", n_marks, at + 13 * n)
    bits = data[at + 13 * n + 8 * n_marks:]
    runs = -(-sizes // interval)
    run_sizes = np.full(n_marks, interval, np.int64)
    filled = runs > 0
    run_sizes[np.cumsum(runs)[filled] - 1] = sizes[filled] - (runs[filled] - 1) * interval
    tokens = code.decode(bits, marks, run_sizes, interval)
    return [None if m else int(i) for i, m in zip(ids, missing, strict=True)], sizes, tokens


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, decoded from the files that ``write_token_files`` left at ``path``.

    ``start`` counts the ids of all documents before it: within a part they are
    summed while reading, the parts by their blocks' sizes (one row per part).
    """
    blocks = spark.read.schema("part int, block long, first_id long, n_tokens long, data binary").parquet(f"{path}/blocks")
    symbols, lengths = read_code(spark, path)
    out = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("id", pa.int64()), ("own_start", pa.int64()),
                     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(symbols, lengths)

        def docs() -> Iterator[tuple]:
            for part, block, data in _rows(parts):
                ids, sizes, tokens = unpack_block(data, code)
                start, raw = 0, tokens.astype("<u4")
                for doc, n in zip(ids, sizes.tolist(), strict=True):
                    yield part, block, doc, start, n, zlib.crc32(raw[start:start + n].tobytes())
                    start += n

        yield from batches(docs(), out)

    docs = blocks.select("part", "block", "data").mapInArrow(
        frugal(run), "part int, block long, id long, own_start long, n_tokens long, ids_crc32 long")
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens")).withColumn(
        "part_start", F.coalesce(F.sum("part_tokens").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = (blocks.select("part", "block", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("s"))
              .join(parts, "part").select("part", "block", (F.col("s") + F.col("part_start")).alias("before")))
    return docs.join(before, ["part", "block"]).select(
        "id", (F.col("before") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, write and read back ``docs``: (id, start, n_tokens, ids_crc32), one row per row of ``docs``.

    Null and empty texts hold the end id alone; a null id comes before all others.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, 2500):
        tokens = materialise(token_ids(docs, tokenizer, id_col, text_col), "token-ids")
        files = write_token_files(spark, tokens, shared_path(spark, "token-files"))
    return read_token_files(spark, files)
