"""Benchmark passages in documents, by edit distance over words.

A document holds an item of ``m`` words if some run of its words is within
``floor((1 - similarity) * m)`` word insertions, deletions and replacements of
it.  Words are runs of letters and digits, lower-cased, so case, punctuation and
layout do not matter; in scripts written without spaces every character is one.
Items of fewer than ``MIN_WORDS`` words allow no edits and are looked up exactly,
word by word in a tree; the others go the way below.

1. Windows as long as an item start at every word.  A window with more words
   that no item of its length has than edits allowed cannot match (a matching
   run leaves room for that many at most), nor one without any of the rarest
   ``edits + 1`` words of an item of its length, as not all of them can be
   edited away.  Both are left out without loss.
2. The CGK random walk embeds a window: it writes the word it stands on and
   moves on by a random bit that depends on the step and the word.  Equal words
   keep two walks together, and after an edit they meet again, so edit distance
   becomes Hamming distance.  Each repetition has a walk of its own and samples
   a few positions; windows and items that agree on the sample are candidates.
3. Items are worked in bands of like length.  A band's number of repetitions is the
   least that finds ``recall`` of copies of its own items at the largest edit
   distance allowed, with the most positions sampled that come to it in
   ``MOST_REPEATS``.  A band that none brings there takes as candidates all items
   of a window's length that have one of their rarest words in it, which loses none.
4. Every candidate is verified exactly, by the edit distance to the best run
   that starts at the window's first word.

Items are worked through in blocks of about ``BLOCK_WORDS`` words; only a block
travels to the tasks, so what is sent does not grow with the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches, column, frugal, materialise

SIMILARITY, MIN_WORDS = 0.8, 5
RECALL, SAMPLED, MOST_REPEATS = 0.98, (3, 2, 1), 120
BLOCK_WORDS, CHUNK_WORDS = 200_000, 400_000
FOREIGN, GAP = 0, -1
# Thai, Lao, Burmese, Khmer, Japanese and Chinese, written without spaces.
SPACELESS = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
             "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
_word = re.compile(r"[^\W_]+")
_spaceless = re.compile(f"[{SPACELESS}]")
_word_or_character = re.compile(rf"[^\W_{SPACELESS}]+|(?=[^\W_])[{SPACELESS}]")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if text.isascii() or not _spaceless.search(text):
        return _word.findall(text)
    return _word_or_character.findall(text)


def edits_allowed(m: np.ndarray | int, similarity: float):
    return np.floor((1 - similarity) * np.asarray(m) + 1e-9).astype(np.int64)


class ItemIndex:
    """Items of like length: their words as numbers, and per repetition their sampled walks.

    ``known`` numbers all words of the block that the items are from.
    """

    def __init__(self, items: list[tuple[int, list[str]]], known: dict[str, int], similarity: float = SIMILARITY,
                 recall: float = RECALL, seed: int = 42):
        self.ids = [i for i, _ in items]
        self.items = [np.array([known[w] for w in ws]) for _, ws in items]
        self.size = np.array([len(x) for x in self.items], np.int64)
        self.edits = edits_allowed(self.size, similarity)
        self.lengths = np.unique(self.size)
        self.length_edits = edits_allowed(self.lengths, similarity)
        self.longest = int(self.lengths[-1])
        self.steps = 2 * self.longest  # a walk passes the end of its window after about so many
        self.gap = int(self.length_edits.max()) + 1  # no window reaches over it with so few edits
        self.words = len(known) + 2
        self.foreign = np.ones((len(self.lengths), self.words), bool)  # by word + 1: GAP, FOREIGN, words
        self.rare = ~self.foreign
        held_by = np.bincount(np.concatenate([np.unique(x) for x in self.items]), minlength=len(known) + 1)
        letters = np.array([0, *map(len, known)])
        own = np.searchsorted(self.lengths, self.size)
        held = []
        for item, (x, k) in enumerate(zip(self.items, own, strict=True)):
            self.foreign[k, x + 1] = False
            rarest = x[np.lexsort((-letters[x], held_by[x]))[:self.length_edits[k] + 1]]
            self.rare[k, rarest + 1] = True
            held += [(k * self.words + w, item) for w in np.unique(rarest).tolist()]
        self.held = np.array(sorted(held), np.int64)  # (length and rare word, item)
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(1, 1 << 62, (MOST_REPEATS, self.steps), dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.sample = rng.random((MOST_REPEATS, max(SAMPLED)))
        self.mix = rng.integers(1, 1 << 62, max(SAMPLED) + 1, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.flat, self.first = _lay_out(self.items, self.longest, self.steps)
        self.own = own
        copies = self._copies(rng)
        self.repeats = 0  # without any the rare words tell the candidates
        for self.sampled in SAMPLED:
            self.tables: list[tuple[np.ndarray, np.ndarray]] = []
            self.repeats = self._repeats_for(recall, *copies)
            if self.repeats:
                break

    def _table(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables) <= r:
            keys = self.keys(self.flat, self.first, np.arange(len(self.first)), self.own, len(self.tables))
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))
        return self.tables[r]

    def keys(self, flat: np.ndarray, starts: np.ndarray, at: np.ndarray, length: np.ndarray, r: int) -> np.ndarray:
        """Per pair (starts[at], lengths[length]) a hash of the sampled symbols of repetition ``r``."""
        here = starts.copy()
        symbols = np.empty((self.steps, len(starts)), np.int32)
        moved = np.empty((self.steps, len(starts)), np.int32)
        for j in range(self.steps):
            s = flat[here]
            symbols[j] = s
            moved[j] = here - starts
            here += ((s + 2).astype(np.uint64) * self.factor[r, j] >> np.uint64(61)).astype(np.int64) & 1
        m = self.lengths[length]
        key = m.astype(np.uint64) * self.mix[self.sampled]
        for k in range(self.sampled):
            step = (self.sample[r, k] * 2 * m).astype(np.int64)
            s = np.where(moved[step, at] < m, symbols[step, at], -2)
            key = (key ^ (s + 3).astype(np.uint64)) * self.mix[k]
            key ^= key >> np.uint64(29)
        return key

    def candidates(self, flat: np.ndarray, starts: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Distinct (index into starts, item) that agree with an item in one repetition at least."""
        if not self.repeats:
            return self._by_rare_words(flat, starts, at, length)
        found = [np.zeros((0, 2), np.int64)]
        for r in range(self.repeats):
            keys = self.keys(flat, starts, at, length, r)
            table, order = self.tables[r]
            rows, place = _expanded(table, keys)
            found.append(np.stack([at[rows], order[place]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def _by_rare_words(self, flat: np.ndarray, starts: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        found = [np.zeros((0, 2), np.int64)]
        for k in np.unique(length):
            rows = np.flatnonzero(length == k)
            reach = np.arange(self.lengths[k] + self.length_edits[k])
            for part in np.array_split(rows, -(-len(rows) // 5_000)):
                text = flat[np.minimum(starts[at[part]][:, None] + reach, len(flat) - 1)]
                row, place = np.nonzero(self.rare[k].take(text + 1))
                hit, held = _expanded(self.held[:, 0], k * self.words + text[row, place])
                found.append(np.unique(np.stack([at[part[row[hit]]], self.held[held, 1]], 1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def _copies(self, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items copied with as many random edits as allowed, laid out: (words, places of their first kept word, owners)."""
        chosen = rng.permutation(len(self.items))[:200]
        copies, owner = [], []
        for i in np.repeat(chosen, max(3, -(-60 // len(chosen)))):
            words = list(self.items[i])
            for _ in range(int(self.edits[i])):
                p, kind = int(rng.integers(len(words))), int(rng.integers(3))
                if kind == 0:
                    words[p] = FOREIGN
                elif kind == 1 and len(words) > 1:
                    del words[p]
                else:
                    words.insert(p, FOREIGN)
            copies.append(np.array(words))
            owner.append(i)
        flat, first = _lay_out(copies, self.longest, self.steps)
        # a run that begins with an edit is found from its first kept word on
        first = first + np.array([int(np.argmax(c != FOREIGN)) for c in copies])
        return flat, first, np.array(owner)

    def _repeats_for(self, recall: float, flat: np.ndarray, first: np.ndarray, owner: np.ndarray) -> int:
        """Fewest repetitions that find ``recall`` of the copies; 0 if ``MOST_REPEATS`` do not."""
        found = np.zeros(len(owner), bool)
        for r in range(MOST_REPEATS):
            table, order = self._table(r)
            keys = self.keys(flat, first, np.arange(len(first)), self.own[owner], r)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            found |= table[rank[owner]] == keys
            if found.mean() >= recall:
                return r + 1
        return 0

    def windows(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, index into lengths) of every window with no more foreign words than edits allowed."""
        n = len(flat) - self.longest
        total = np.zeros(len(flat) + 1, np.int32)
        starts, which = [], []
        for k, (m, most) in enumerate(zip(self.lengths, self.length_edits, strict=True)):
            foreign = self.foreign[k].take(flat + 1)
            np.cumsum(foreign, out=total[1:])
            near = np.flatnonzero(total[m:n + m] - total[:n] <= most)
            near = near[~foreign[near]]
            for part in range(0, len(near), 20_000):
                some = near[part:part + 20_000]
                text = flat[np.minimum(some[:, None] + np.arange(m + most), len(flat) - 1)]
                near[part:part + 20_000] = np.where(self.rare[k].take(text + 1).any(1), some, -1)
            near = near[near >= 0]
            starts.append(near)
            which.append(np.full(len(near), k))
        return np.concatenate(starts), np.concatenate(which)

    def verify(self, flat: np.ndarray, starts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Word edits from each item to the best run that begins at its start; a large number beyond the limit."""
        out = np.full(len(starts), 1 << 20, np.int64)
        for m in np.unique(self.size[items]):
            rows = np.flatnonzero(self.size[items] == m)
            most = int(self.edits[items[rows[0]]])
            for part in np.array_split(rows, -(-len(rows) // 20_000)):
                text = flat[starts[part][:, None] + np.arange(m + most)]
                item = np.stack([self.items[i] for i in items[part]])
                ramp = np.arange(m + most + 1)
                d = np.broadcast_to(ramp, (len(part), m + most + 1)).copy()
                for i in range(m):
                    t = d + 1
                    t[:, 1:] = np.minimum(t[:, 1:], d[:, :-1] + (text != item[:, i:i + 1]))
                    d = np.minimum.accumulate(t - ramp, axis=1) + ramp
                best = d.min(1)
                out[part] = np.where(best <= most, best, 1 << 20)
        return out

    def find(self, flat: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word): per text and item the fewest edits, the first of equals."""
        starts, which = self.windows(flat)
        if not len(starts):
            return []
        place, at = np.unique(starts, return_inverse=True)
        pairs = self.candidates(flat, place, at, which)
        at_word, item = place[pairs[:, 0]], pairs[:, 1]
        edits = self.verify(flat, at_word, item)
        ok = np.flatnonzero(edits < 1 << 20)
        text = np.searchsorted(first, at_word[ok], side="right") - 1
        order = np.lexsort((at_word[ok], edits[ok], item[ok], text))
        rows, seen = [], None
        for k in order:
            if (int(text[k]), int(item[ok[k]])) != seen:
                seen = (int(text[k]), int(item[ok[k]]))
                rows.append((seen[0], self.ids[seen[1]], int(edits[ok[k]]), int(at_word[ok[k]] - first[text[k]])))
        return rows


class ExactItems:
    """Items found word for word only, as a tree of their words."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.known: dict[str, int] = {}
        edges: dict[tuple[int, int], int] = {}
        self.held: dict[int, list[int]] = {}  # ids of the items that end at a node
        for i, words in items:
            node = 0
            for w in words:
                node = edges.setdefault((node, self.known.setdefault(w, len(self.known) + 1)), len(edges) + 1)
            self.held.setdefault(node, []).append(i)
        self.base, self.nodes = len(self.known) + 1, len(edges) + 1
        keys = np.array([a * self.base + w for a, w in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.longest = max(len(words) for _, words in items)
        self.last = np.zeros(self.nodes, bool)
        self.last[list(self.held)] = True

    def find(self, texts: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(text, item, 0, first word) of the first place of each item in each text."""
        get = self.known.get
        flat, first = _lay_out([np.array([get(w, FOREIGN) for w in ws], np.int64) for ws in texts], 1, self.longest)
        at, node = np.flatnonzero(flat > 0), 0
        rows = []
        for depth in range(self.longest):
            word = flat[at + depth]
            key = node * self.base + word
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = np.flatnonzero((word > 0) & (self.keys[edge] == key))
            at, node = at[on], self.to[edge[on]]
            ends = np.flatnonzero(self.last[node])
            text = np.searchsorted(first, at[ends], side="right") - 1
            pair, once = np.unique(text * self.nodes + node[ends], return_index=True)  # at is ascending
            rows += [(k // self.nodes, i, 0, w) for k, w in zip(
                pair.tolist(), (at[ends] - first[text])[once].tolist(), strict=True) for i in self.held[k % self.nodes]]
        return rows


class BlockIndex:
    """The items of a block: the short ones exactly, the others within their edits."""

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float = SIMILARITY, recall: float = RECALL,
                 min_words: int = MIN_WORDS):
        exact = [x for x in items if len(x[1]) < min_words or not edits_allowed(len(x[1]), similarity)]
        edited = [x for x in items if len(x[1]) >= min_words and edits_allowed(len(x[1]), similarity)]
        self.exact = ExactItems(exact) if exact else None
        self.known: dict[str, int] = {}
        for _, words in edited:
            for w in words:
                self.known.setdefault(w, len(self.known) + 1)
        bands: dict[int, list] = {}  # by length: 5 to 9 words, 10 to 19, 20 to 39 and so on
        for x in edited:
            bands.setdefault((len(x[1]) // 5).bit_length(), []).append(x)
        self.bands = [ItemIndex(bands[k], self.known, similarity, recall) for k in sorted(bands)]
        self.gap = max([b.gap for b in self.bands], default=1)
        self.tail = max([b.longest + b.steps for b in self.bands], default=1)

    def find(self, texts: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word) of every item in every text."""
        rows = self.exact.find(texts) if self.exact else []
        if self.bands:
            get = self.known.get
            flat, first = _lay_out([np.array([get(w, FOREIGN) for w in ws], np.int64) for ws in texts], self.gap, self.tail)
            for band in self.bands:
                rows += band.find(flat, first)
        return rows


def _expanded(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into keys, index into the sorted table) of all that are equal."""
    low, high = np.searchsorted(table, keys), np.searchsorted(table, keys, side="right")
    hit = np.flatnonzero(high > low)
    n = (high - low)[hit]
    rows = np.repeat(hit, n)
    return rows, low[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)


def _lay_out(texts: list[np.ndarray], gap: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """All words with a gap behind each text and more of it at the end, and where each text begins."""
    sizes = np.array([len(t) + gap for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.full(int(sizes.sum()) + tail, GAP, np.int64)
    for t, at in zip(texts, first, strict=True):
        flat[at:at + len(t)] = t
    return flat, first


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, min_words: int,
                block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[str]]]]:
    """The items in blocks, dealt by a hash of their id; items under ``min_words`` words or without id are left out."""
    run = rf"[{SPACELESS}]|((?![{SPACELESS}])[\p{{L}}\p{{N}}])+"
    items = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(run)))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        chosen = [(r.id, w) for r in sorted(rows) if len(w := words_of(r.text)) >= min_words]
        if chosen:
            yield chosen


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
          min_words: int = MIN_WORDS, recall: float = RECALL) -> DataFrame:
    """(id, item_id, edits, first_word): one row per document id and benchmark item that it holds.

    Items of fewer than ``min_words`` words are held word for word only; those without
    a word are in no document.  Null and empty texts hold nothing.  Rows that repeat an id count as one
    document, rows without an id as one document of id null.
    """
    schema = "id long, item_id long, edits int, first_word long"
    out = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("first_word", pa.int64())])
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id_col, item_text_col, 1):
        sent = docs.sparkSession.sparkContext.broadcast(BlockIndex(block, similarity, recall, min_words))

        def run(parts: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value

            def rows() -> Iterator[tuple]:
                ids, held, size = [], [], 0
                for part in parts:
                    for doc, text in zip(column(part, "id"), column(part, "text"), strict=True):
                        words = words_of(text)
                        if not words:
                            continue
                        ids.append(doc)
                        held.append(words)
                        size += len(words) + index.gap
                        if size >= CHUNK_WORDS:
                            yield from ((ids[r[0]], *r[1:]) for r in index.find(held))
                            ids, held, size = [], [], 0
                if held:
                    yield from ((ids[r[0]], *r[1:]) for r in index.find(held))

            yield from batches(rows(), out)

        found = found.unionAll(texts.mapInArrow(frugal(run), schema))
    return (found.groupBy("id", "item_id").agg(F.min(F.struct("edits", "first_word")).alias("best"))
            .select("id", "item_id", "best.edits", "best.first_word"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark item."""
    found = materialise(leaks(docs, benchmark, id_col, **options).select(F.col("id").alias("__leak")).distinct(), "leaks")
    return docs.join(found, docs[id_col].eqNullSafe(found["__leak"]), "left_anti")
