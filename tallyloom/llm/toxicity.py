"""Toxicity by a small convolutional text classifier, written and trained in numpy.

A word, its first four letters and its last four are each hashed to a bucket with
a learnt embedding; their sum is the word's vector, so forms never seen in
training still share the parts of those that were.  Filters of several widths
slide over the words, each keeps its maximum over the text, and a logistic layer
turns the maxima into a probability.  A score is that probability mapped so that
the threshold calibrated for the text's language comes to lie at 0.5.

Only the text enters a score.  Its language is told from function words in the
text itself; the table's language column is never read.

Every labelled row teaches, with its whole text: four fifths train, the rest sets
the thresholds.  Rows are dealt to shards of about ``SHARD_ROWS`` by their id; in
each epoch every shard trains from the common parameters and what the shards come
to is averaged, each bucket's vector over the shards that moved it.  Counts,
sums and thresholds are Spark aggregates; the driver sees parameters and counts of
fixed size only.  Texts are read in chunks of ``CHUNK_WORDS`` words.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, frugal, give_back

BUCKETS = 1 << 15
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PARTS = 3  # hashed parts of a word
PAD = BUCKETS  # its embedding is zero
CHUNK_WORDS = 200_000
MEMO_WORDS = 200_000
SHARD_ROWS = 1 << 14  # labelled rows that one task trains on
BLOCK_WORDS = 1 << 22  # words that it holds at once
SLICE = 512  # rows of the embedding that travel together when shards are averaged
GATHERED = 64  # shards added up at once
BITS = 1 << 25  # of the bitmap of labelled ids
BINS = 1 << 16  # steps of a probability in which calibration rows are counted
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.02, 42

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on with as are was be by this from at",
    "fr": "le la les des du et un une que qui dans est pour pas sur avec au",
    "de": "der die das und den von zu mit ist im nicht ein eine auf für sich des dem",
    "es": "el los las y en que de del por con una para se es al lo su",
}
LANGUAGES = ("other", *FUNCTION_WORDS)
_word = re.compile(r"[^\W_]+")
_votes: dict[str, int] = {}
for _i, _lang in enumerate(FUNCTION_WORDS):
    for _w in FUNCTION_WORDS[_lang].split():
        _votes[_w] = _votes.get(_w, 0) | (1 << _i)


class WordIds:
    """Buckets and language votes of words, remembered for up to MEMO_WORDS words."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, PARTS + 1), np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        """Per word of the lower-cased text a row of its PARTS buckets and its language votes."""
        words = _word.findall((text or "").lower())
        if len(self.known) > MEMO_WORDS:
            self._clear()
        for w in set(words).difference(self.known):
            at = self.known[w] = len(self.known)
            if at >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at] = *(zlib.crc32(x.encode()) % BUCKETS for x in (w, "^" + w[:4], w[-4:] + "$")), _votes.get(w, 0)
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]


def split_ids(coded: np.ndarray) -> tuple[np.ndarray, int]:
    """(buckets, index into LANGUAGES) of a text's coded words; the most votes win, the first of equals."""
    votes = coded[:, PARTS]
    n = [int(((votes >> k) & 1).sum()) for k in range(len(FUNCTION_WORDS))]
    return coded[:, :PARTS], 1 + int(np.argmax(n)) if max(n) else 0


@dataclass
class ConvModel:
    embedding: np.ndarray  # (BUCKETS + 1, DIM)
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray  # (len(WIDTHS) * FILTERS,)
    out_bias: float
    thresholds: np.ndarray  # per LANGUAGES

    def probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        """One probability per text of bucket ids; a text without words has the bias alone."""
        pooled = np.zeros((len(texts), len(WIDTHS) * FILTERS))
        chunk: list[int] = []
        size = 0
        for i, ids in enumerate(texts):
            if len(ids):
                chunk.append(i)
                size += len(ids)
            if chunk and (size >= CHUNK_WORDS or i == len(texts) - 1):
                pooled[chunk] = self._pool([texts[k] for k in chunk])
                chunk, size = [], 0
        if chunk:
            pooled[chunk] = self._pool([texts[k] for k in chunk])
        return 1 / (1 + np.exp(-(pooled @ self.out + self.out_bias)))

    def _pool(self, texts: list[np.ndarray]) -> np.ndarray:
        flat, first, last = lay_out(texts)
        vectors = self.embedding[flat[:, 0]].astype(np.float32)
        for part in range(1, PARTS):
            vectors += self.embedding[flat[:, part]]
        marks = np.stack([first, last], 1).ravel()
        best = []
        for f, bias in zip(self.filters, self.bias, strict=True):
            act = vectors @ f[0].astype(np.float32)
            for j in range(1, len(f)):
                act[:-j] += vectors[j:] @ f[j].astype(np.float32)
            best.append(np.maximum(np.maximum.reduceat(act, marks, axis=0)[::2] + bias, 0))
        return np.concatenate(best, 1)

    def calibrated(self, p: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Monotone in ``p`` for a language, with that language's threshold at 0.5."""
        t = self.thresholds[lang]
        return np.where(p < t, 0.5 * p / t, 0.5 + 0.5 * (p - t) / (1 - t))


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids with padding behind each text, and where each text begins and ends."""
    pad = np.full((max(WIDTHS), PARTS), PAD)
    flat = np.concatenate([x for t in texts for x in (t, pad)])
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes + len(pad))[:-1]])
    return flat, first, first + sizes


def _counts(texts: Iterable[np.ndarray], y: Iterable[float]) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket its texts and its toxic texts; behind the last bucket all texts."""
    n, pos = np.zeros(BUCKETS + 2), np.zeros(BUCKETS + 2)
    for ids, label in zip(texts, y, strict=True):
        seen = np.append(np.unique(ids), BUCKETS + 1)
        n[seen] += 1
        pos[seen] += label
    return n, pos


def _start(n: np.ndarray, pos: np.ndarray, rng: np.random.Generator) -> ConvModel:
    """First embedding axis: how surely a bucket's texts are toxic (signed root of G squared), others random.

    Buckets of fewer than three training texts stay at zero: they say nothing yet.
    """
    base = np.clip(pos[-1] / n[-1] if n[-1] else 0.5, 1e-3, 1 - 1e-3)
    n, pos = n[:-1], pos[:-1]
    share = np.clip(pos / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    g = 2 * n * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    sure = np.sign(share - base) * np.sqrt(np.maximum(g, 0))
    embedding = rng.normal(0, 0.05, (BUCKETS + 1, DIM))
    embedding[:, 0] = np.clip(sure / 5, -2, 3)
    embedding[n < 3] = 0
    embedding[PAD] = 0
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[0, 0, :FILTERS // 2] = 1.0
    out = np.tile(np.r_[np.full(FILTERS // 2, 0.5), np.zeros(FILTERS - FILTERS // 2)], len(WIDTHS))
    return ConvModel(embedding, filters, [np.zeros(FILTERS) for _ in WIDTHS], out, -2.0,
                     np.full(len(LANGUAGES), 0.5))


def _numbers(m: ConvModel) -> list[np.ndarray]:
    """Arrays that training changes in place, but for the last bias."""
    return [m.embedding, *m.filters, *m.bias, m.out]


def _fresh(m: ConvModel) -> list[np.ndarray]:
    """Adagrad's sums before the first step, one array per array of the model."""
    return [np.full_like(x, 1e-2) for x in (*_numbers(m), np.zeros(1))]


def _strongest(m: ConvModel, texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per width (greatest response, buckets under the filter there) of each text and filter.

    A long text is read in stretches that overlap by a filter's width.
    """
    tops = [(np.full((len(texts), FILTERS), -np.inf), np.zeros((len(f), len(texts), FILTERS, PARTS), np.int64)) for f in m.filters]
    owner: list[int] = []
    parts: list[np.ndarray] = []

    def read() -> None:
        flat, first, last = lay_out(parts)
        last = np.minimum(last, first + CHUNK_WORDS)
        vectors = m.embedding[flat[:, 0]]
        for part in range(1, PARTS):
            vectors += m.embedding[flat[:, part]]
        for f, (top, under) in zip(m.filters, tops, strict=True):
            act = vectors @ f[0]
            for j in range(1, len(f)):
                act[:-j] += vectors[j:] @ f[j]
            best = np.array([act[s:e].argmax(0) + s for s, e in zip(first, last, strict=True)])
            found = np.take_along_axis(act, best, 0)
            better = found > top[owner]
            top[owner] = np.where(better, found, top[owner])
            for j in range(len(f)):
                under[j, owner] = np.where(better[..., None], flat[best + j], under[j, owner])

    size = 0
    for i, ids in enumerate(texts):
        for at in range(0, len(ids), CHUNK_WORDS):
            owner.append(i)
            parts.append(ids[at:at + CHUNK_WORDS + max(WIDTHS) - 1])
            size += len(parts[-1])
            if size >= CHUNK_WORDS:  # so no two stretches of a text are read at once
                read()
                owner, parts, size = [], [], 0
    if parts:
        read()
    return tops


def _train_once(m: ConvModel, state: list[np.ndarray], used: np.ndarray, texts: list[np.ndarray], y: np.ndarray,
                order: np.ndarray, moved: np.ndarray) -> None:
    """One pass of Adagrad on the log loss over the texts in this order; marks buckets whose vectors it moved."""
    for at in range(0, len(order), BATCH):
        rows = order[at:at + BATCH]
        tops = _strongest(m, [texts[r] for r in rows])
        h = np.concatenate([np.maximum(top + b, 0) for (top, _), b in zip(tops, m.bias, strict=True)], 1)
        p = 1 / (1 + np.exp(-(h @ m.out + m.out_bias)))
        g = (p - y[rows]) / len(rows)
        d_out, d_bias_out = h.T @ g + 1e-4 * m.out, np.array([g.sum()])
        d_h = np.outer(g, m.out) * (h > 0)
        grads_f, grads_b, touched, moves = [], [], [], []
        for k, (f, (_, under)) in enumerate(zip(m.filters, tops, strict=True)):
            d = d_h[:, k * FILTERS:(k + 1) * FILTERS]
            grads_b.append(d.sum(0))
            gf = np.empty_like(f)
            for j in range(len(f)):
                gf[j] = np.einsum("nfd,nf->df", m.embedding[under[j]].sum(2), d)
                touched.append(under[j].ravel())
                moves.append(np.repeat((d[:, :, None] * f[j].T[None]).reshape(-1, DIM), PARTS, axis=0))
            grads_f.append(gf + 1e-4 * f)
        ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        g_e = np.zeros((len(ids), DIM))
        np.add.at(g_e, inverse, np.concatenate(moves))
        g_e[~used[ids]] = 0
        moved[ids] |= used[ids]
        state[0][ids] += g_e ** 2
        m.embedding[ids] -= RATE * g_e / np.sqrt(state[0][ids])
        params = [*m.filters, *m.bias, m.out]
        for s, x, gx in zip(state[1:], params, [*grads_f, *grads_b, d_out], strict=False):
            s += gx ** 2
            x -= RATE * gx / np.sqrt(s)
        state[-1] += d_bias_out ** 2
        m.out_bias -= float((RATE * d_bias_out / np.sqrt(state[-1]))[0])


def _worded(ids: np.ndarray) -> np.ndarray:
    return ids if len(ids) else np.full((1, PARTS), PAD)


def train(texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ConvModel:
    """Fit in one process; the same rows in the same order give the same model."""
    rng = np.random.default_rng(seed)
    y = np.asarray(y, np.float64)
    texts = [_worded(t) for t in texts]
    m = _start(*_counts(texts, y), rng)
    used, state, moved = np.abs(m.embedding).sum(1) > 0, _fresh(m), np.zeros(BUCKETS + 1, bool)
    for _ in range(epochs):
        _train_once(m, state, used, texts, y, rng.permutation(len(texts)), moved)
    return m


def _binned(p: np.ndarray, y: np.ndarray, lang: np.ndarray) -> pd.DataFrame:
    """Rows and toxic rows per language and step of the probability, with the step's least and greatest."""
    at = pd.DataFrame({"lang": lang, "bin": np.minimum((np.asarray(p) * BINS).astype(np.int64), BINS - 1),
                       "n": 1, "pos": np.asarray(y, np.int64), "lo": p, "hi": p})
    return at.groupby(["lang", "bin"], as_index=False).agg({"n": "sum", "pos": "sum", "lo": "min", "hi": "max"})


def _thresholds(counts: pd.DataFrame, least: int = 20) -> np.ndarray:
    """Per language the threshold of highest accuracy, midway between its neighbours; from ``_binned`` rows.

    A language with fewer than ``least`` rows of either label takes the threshold
    of all rows together; with fewer than 5 of those it stays 0.5.
    """
    def best(c: pd.DataFrame) -> float:
        c = c.groupby("bin").agg({"n": "sum", "pos": "sum", "lo": "min", "hi": "max"}).sort_index()
        pos, neg = c["pos"].to_numpy(), (c["n"] - c["pos"]).to_numpy()
        right = np.concatenate([[pos.sum()], pos.sum() - np.cumsum(pos) + np.cumsum(neg)])
        cuts = np.concatenate([[0], (c["lo"].to_numpy()[1:] + c["hi"].to_numpy()[:-1]) / 2, [1]])
        top = np.flatnonzero(right == right.max())
        return float(np.clip(cuts[top[len(top) // 2]], 0.05, 0.95))

    enough = lambda c, n: min(c["pos"].sum(), (c["n"] - c["pos"]).sum()) >= n
    common = best(counts) if enough(counts, 5) else 0.5
    by_lang = [counts[counts["lang"] == k] for k in range(len(LANGUAGES))]
    return np.array([best(c) if enough(c, least) else common for c in by_lang])


def calibrate(p: np.ndarray, y: np.ndarray, lang: np.ndarray, least: int = 20) -> np.ndarray:
    """``_thresholds`` of rows at hand."""
    return _thresholds(_binned(p, y, lang), least)


def coded_texts(docs: DataFrame, labels: DataFrame, keep: Column, label_col: str = "toxic",
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, n, words, lang, label, held) of every labelled row whose id passes ``keep``, dealt to shards by id.

    ``words`` holds the text's n x PARTS buckets, compressed.  Null labels and ids
    count as not labelled; repeated labels of one id as toxic if one of them is; of
    rows that repeat an id each is used.  ``held`` rows (a fifth, by a checksum of
    the id) are for calibration.  A partition is a shard, its rows in order.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & keep)
             .groupBy("doc_id").agg(F.max(label_col).alias("__label")))
    shards = max(1, -(-known.count() // shard_rows))
    out = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("words", pa.binary()), ("lang", pa.int32()),
                     ("label", pa.int32()), ("held", pa.bool_())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for whole in parts:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                split = [split_ids(ids(t)) for t in column(part, "text")]
                held = [zlib.crc32(b"calibrate %d" % i) % 5 == 0 for i in column(part, "id")]
                words = [pa.compress(w.astype("<u2").tobytes(), "zstd", asbytes=True) if len(w) else b"" for w, _ in split]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(w) for w, _ in split], pa.int32()), pa.array(words, pa.binary()),
                     pa.array([k for _, k in split], pa.int32()), part.column(2), pa.array(held)], schema=out)

    # a bitmap of labelled ids, of fixed size, spares most other texts the shuffle; the join decides
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    slot, mark = F.shiftright(bit, 6).alias("__slot"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {BITS}) % 64 as int))")
    bitmap = known.groupBy(slot).agg(F.bit_or(mark).alias("__bits"))
    near = docs.where(keep).select("doc_id", "text", slot).join(F.broadcast(bitmap), "__slot").where(
        F.col("__bits").bitwiseAND(mark) != 0).select("doc_id", "text")
    rows = near.join(known.hint("merge"), "doc_id").select(
        F.col("doc_id").cast("long").alias("id"), "text", F.col("__label").cast("int").alias("label"))
    rows = rows.mapInArrow(frugal(run), "id long, n int, words binary, lang int, label int, held boolean")
    return rows.repartition(shards, "id").sortWithinPartitions("id", "words")


def labelled_words(docs: DataFrame, labels: DataFrame, keep: Column, label_col: str = "toxic") -> pd.DataFrame:
    """``coded_texts`` of tables that fit into memory."""
    return coded_texts(docs, labels, keep, label_col).toPandas().sort_values(["id", "words"]).reset_index(drop=True)


def _unpacked(parts: Iterable[pa.RecordBatch], held: bool, most: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """(buckets, labels, languages) of the rows for training or for calibration, some ``most`` words at once."""
    texts, y, lang, size = [], [], [], 0
    for part in parts:
        for n, words, k, label, h in zip(*(part.column(i) for i in range(1, 6)), strict=True):
            if h.as_py() != held:
                continue
            n = n.as_py()
            flat = pa.decompress(words.as_py(), 2 * PARTS * n, "zstd", asbytes=True) if n else b""
            texts.append(np.frombuffer(flat, "<u2").reshape(n, PARTS))
            y.append(float(label.as_py() > 0))
            lang.append(k.as_py())
            size += n + 1
            if size >= most:
                yield texts, np.array(y), np.array(lang, np.int64)
                texts, y, lang, size = [], [], [], 0
    if texts:
        yield texts, np.array(y), np.array(lang, np.int64)


def _count_words(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``_counts`` of all training rows."""
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, pos = np.zeros(BUCKETS + 2), np.zeros(BUCKETS + 2)
        for texts, y, _ in _unpacked(parts, False, CHUNK_WORDS):
            more = _counts(texts, y)
            n += more[0]
            pos += more[1]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(n[at].astype(np.int64)),
                                          "pos": pa.array(pos[at].astype(np.int64))})

    n, pos = np.zeros(BUCKETS + 2), np.zeros(BUCKETS + 2)
    found = rows.mapInArrow(frugal(run), "bucket int, n long, pos long").groupBy("bucket").agg(F.sum("n"), F.sum("pos"))
    for bucket, a, b in found.collect():  # one row per bucket
        n[bucket], pos[bucket] = a, b
    return n, pos


def _epoch(rows: DataFrame, m: ConvModel, state: list[np.ndarray], used: np.ndarray, epoch: int, seed: int) -> None:
    """Every shard trains once over its rows from ``m`` and ``state``, which take the mean of what the shards come to."""
    sent = rows.sparkSession.sparkContext.broadcast((m, state, used))
    sums = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("data", pa.binary())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m, state, used = pickle.loads(pickle.dumps(sent.value))  # workers share the received one
        shard, moved, seen = TaskContext.get().partitionId(), np.zeros(BUCKETS + 1, bool), 0
        for texts, y, _ in _unpacked(parts, False, BLOCK_WORDS):
            # one generator per shard: the start values' draws, then an order per epoch
            rng = np.random.Generator(np.random.PCG64(seed).jumped(shard) if shard else np.random.PCG64(seed))
            _start(np.zeros(BUCKETS + 2), np.zeros(BUCKETS + 2), rng)
            orders = [rng.permutation(len(texts)) for _ in range(epoch + 1)]
            _train_once(m, state, used, [_worded(t) for t in texts], y, orders[-1], moved)
            seen += len(texts)
        if not seen:
            return
        # a slice's data: per row whether it moved, its vector and sums, zero if not
        both = np.concatenate([moved[:, None], np.where(moved[:, None], np.concatenate([m.embedding, state[0]], 1), 0)], 1)
        rest = [np.ones(1), *(x.ravel() for x in (*_numbers(m)[1:], np.array([m.out_bias]), *state[1:]))]
        slices = [np.concatenate(rest), *(both[a:a + SLICE] for a in range(0, BUCKETS + 1, SLICE))]
        kept = [(k, x) for k, x in enumerate(slices) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(kept), pa.int64()), pa.array([k for k, _ in kept], pa.int32()),
                                          pa.array([x.tobytes() for _, x in kept], pa.binary())], schema=sums)

    def add(found: pa.Table) -> pa.Table:
        found = found.sort_by("shard")
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in found["data"])
        return pa.table([found["shard"][:1], found["slice"][:1], pa.array([total.tobytes()], pa.binary())], schema=sums)

    schema = "shard long, slice int, data binary"
    found = rows.mapInArrow(frugal(run), schema)
    found = found.groupBy("slice", F.floor(F.col("shard") / GATHERED)).applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    for _, k, data in found.collect():  # as many bytes as the model and its sums have
        total = np.frombuffer(data, np.float64)
        if k:
            total = total.reshape(-1, 1 + 2 * DIM)
            at = np.flatnonzero(total[:, 0])
            mean = total[at, 1:] / total[at, :1]
            m.embedding[at + (k - 1) * SLICE], state[0][at + (k - 1) * SLICE] = mean[:, :DIM], mean[:, DIM:]
        else:
            mean, at, bias = total[1:] / total[0], 0, np.zeros(1)
            for x in (*_numbers(m)[1:], bias, *state[1:]):
                x[...] = mean[at:at + x.size].reshape(x.shape)
                at += x.size
            m.out_bias = float(bias[0])
    sent.destroy()


def _count_scores(rows: DataFrame, m: ConvModel) -> pd.DataFrame:
    """``_binned`` of all calibration rows."""
    sent = rows.sparkSession.sparkContext.broadcast(m)
    names = ["lang", "bin", "n", "pos", "lo", "hi"]

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, y, lang in _unpacked(parts, True, CHUNK_WORDS):
            found = _binned(sent.value.probabilities(texts), y, lang)
            yield pa.RecordBatch.from_pandas(found[names], preserve_index=False)

    found = rows.mapInArrow(frugal(run), "lang long, bin long, n long, pos long, lo double, hi double").groupBy("lang", "bin").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found = pd.DataFrame([tuple(r) for r in found.collect()], columns=names)  # BINS rows a language at most
    sent.destroy()
    return found


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label_col: str = "toxic", shard_rows: int = SHARD_ROWS,
        epochs: int = EPOCHS, seed: int = SEED) -> ConvModel:
    """Train on four fifths of the labelled rows whose ``doc_id`` passes ``keep`` and calibrate on the rest."""
    rows = coded_texts(docs, labels, keep, label_col, shard_rows).checkpoint(eager=True)
    model = _start(*_count_words(rows), np.random.default_rng(seed))
    used, state = np.abs(model.embedding).sum(1) > 0, _fresh(model)
    for epoch in range(epochs):
        _epoch(rows, model, state, used, epoch, seed)
    model.thresholds = _thresholds(_count_scores(rows, model))
    return model


def scorer(spark: SparkSession, model: ConvModel) -> Callable[[Column], Column]:
    """Column of a text column: its toxicity from 0 to 1, calibrated; a null text counts as empty."""
    sent = spark.sparkContext.broadcast(model)  # fixed size: BUCKETS x DIM and the filters

    @F.pandas_udf("double")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, ids = sent.value, WordIds()
        for part in parts:
            found = []
            for at in range(0, len(part), 256):
                split = [split_ids(ids(t)) for t in part.iloc[at:at + 256]]
                p = model.probabilities([s[0] for s in split])
                found.append(model.calibrated(p, np.array([s[1] for s in split], np.int64)))
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))
        give_back()

    return toxicity
