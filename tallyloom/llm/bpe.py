"""Byte-pair encoding of texts and its inverse, from a tokenizer's own vocabulary and merge list.

A text is cut into pieces, each piece into bytes.  A piece's symbols are a doubly
linked list; a priority queue holds the rank and place of every pair that can
merge, lowest rank first and leftmost among equals.  Merging a pair joins two
list nodes and queues the two new neighbours; entries of pairs that are gone stay
in the queue and are passed over when they come up, so a piece of n bytes costs
n log n however long it is.  Decoding joins the vocabulary's strings.

Both are one pass over the rows without a shuffle.  A worker keeps the ids of
short pieces that it has met, at most ``PIECES`` of them.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import frugal, text_slices

PIECES = 500_000  # that a worker remembers before it starts anew
LONG_PIECE = 64  # characters; longer ones are merged each time they come
STRETCH = 1 << 16  # pieces of a text handled at once
SLICE_BYTES = 4 << 20  # of text in one batch of results

# The piece pattern and the byte alphabet of byte-level vocabularies.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes written as themselves

_models: dict[str, BytePairs] = {}


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printed ones as they are, the others from U+0100 on."""
    hidden = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairs:
    """Vocabulary, merges and added tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True)
                or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges")
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.byte_ids = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {}
        for k, (a, b, _) in enumerate(self.merges):
            self.rank[a, b] = k  # of a pair listed twice the last place counts
        self.strings = {i: _bytes(t, alphabet) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update((i, _bytes(t, alphabet)) for t, i in self.added.items())
        names = sorted(self.added, key=lambda t: (-len(t), t))  # the longest at a place
        self.marked = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.piece = regex.compile(PIECE)
        self.checked: set[str] = set()
        self.known = _Known(self)
        self.path, self._library = path, None

    @classmethod
    def of(cls, path: str) -> BytePairs:
        if path not in _models:
            _models[path] = cls(path)
        return _models[path]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, merges = self.rank, self.merges
        queue = [(r, i) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapify(queue)
        while queue:
            r, i = heappop(queue)
            left, right, joined = merges[r]
            j = after[i]
            if ids[i] != left or j == n or ids[j] != right:
                continue  # stale: a neighbour merged since
            ids[i], ids[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := rank.get((joined, ids[k]))) is not None:
                    heappush(queue, (new, i))
            h = before[i]
            if h >= 0 and (new := rank.get((ids[h], joined))) is not None:
                heappush(queue, (new, h))
        return [t for t in ids if t >= 0]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text that holds no added token, in stretches."""
        if not text.isascii():
            new = set(text) - self.checked
            if any(unicodedata.category(c) == "Cn" for c in new):
                # characters that this Unicode version lacks: the library's own cut tells what they are
                found = iter([text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)])
                while stretch := list(islice(found, STRETCH)):
                    yield stretch
                return
            self.checked |= new
        if len(text) <= 8 * STRETCH:
            yield self.piece.findall(text)
            return
        matches = self.piece.finditer(text)
        while stretch := [m.group() for m in islice(matches, STRETCH)]:
            yield stretch

    @property
    def library(self):
        if not self._library:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, four bytes each; an added token's string becomes its id."""
        out, at = [], 0
        for m in self.marked.finditer(text) if self.marked else ():
            out += self._plain(text[at:m.start()])
            out.append(np.int32(self.added[m.group()]).tobytes())
            at = m.end()
        out += self._plain(text[at:] if at else text)
        return b"".join(out)

    def _plain(self, text: str) -> Iterator[bytes]:
        for stretch in self.pieces(text):
            yield b"".join(map(self.known.__getitem__, stretch))
            if len(self.known) > PIECES:
                self.known.clear()

    def decode(self, ids: Iterable[int]) -> str:
        """Joined strings of the ids; ids outside the vocabulary add nothing, bytes that are no UTF-8 become U+FFFD."""
        try:
            raw = b"".join(map(self.strings.__getitem__, ids))
        except KeyError:
            raw = b"".join([self.strings.get(i, b"") for i in ids])
        return raw.decode("utf-8", "replace")


class _Known(dict):
    """Piece -> its ids as bytes, merged when first asked for."""

    def __init__(self, pairs: BytePairs):
        self.pairs = pairs

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.pairs.merge(piece.encode("utf-8")), np.int32).tobytes()
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids


def _bytes(token: str, alphabet: dict[str, int]) -> bytes:
    found = [alphabet.get(c) for c in token]
    return token.encode("utf-8") if None in found else bytes(found)


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of every whole text, one row per row of ``docs``.

    Null and empty texts have no ids; null and repeated ids stay as they are;
    other columns are left out.
    """
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs.of(tokenizer)
        for part in parts:
            for rows in text_slices(part, SLICE_BYTES):
                ids = [pairs.encode(t or "") for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), _lists(ids)], names=["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), "id long, ids array<int>")


def _lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def decode_ids(rows: DataFrame, tokenizer: str) -> DataFrame:
    """(id, ids, text): the text of every row of (id, ids); null ids give a null text."""
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs.of(tokenizer)
        for part in parts:
            step = max(1, part.num_rows * SLICE_BYTES // max(part.nbytes, 1))
            for at in range(0, part.num_rows, step):
                some = part.slice(at, step)
                lists = some.column(1)
                flat = lists.values.to_numpy(zero_copy_only=False)
                ends = lists.offsets.to_numpy()
                texts = [pairs.decode(flat[a:b].tolist()) if there else None for a, b, there
                         in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), lists, pa.array(texts, pa.string())],
                                                 names=["id", "ids", "text"])

    return rows.select("id", "ids").mapInArrow(frugal(run), "id long, ids array<int>, text string")
