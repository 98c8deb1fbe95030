"""Scoring texts by a log-bilinear model over classes of words.

Tokens are words (A-Z lower-cased, split at ASCII white space) and one end per text.

1. Words of all training texts are counted.  The most frequent ones, at most
   ``KNOWN_WORDS``, go to the tasks as a table; all others are looked up by a join.
2. The ``HEAD_WORDS`` most frequent words are classes of their own, all others fall
   into tail classes by their last two bytes.  The model grows with the vocabulary:
   one word in ``OWN_SHARE``, ``OWN_WORDS`` at most, has a vector of its own inside
   its class, and the classes double as those words do fourfold.  The class's other
   words are one rest there, in which a word has the share (c + 1) / (N + V + 1) of
   the rest's N tokens and V words: all words, never seen ones too, have a
   probability and they sum to one.
3. The model of the classes is trained in two steps: a start on about
   ``START_TEXTS`` texts (a hash of the row chooses them; texts over
   ``START_WORDS`` words are left out of the start only), then every task goes on
   from there over all its training texts, and the tasks' parameters are averaged
   by their tokens: in blocks, at most ``GATHERED`` tasks at a time.
4. With the classes' vectors as they are then, the words inside the classes are
   trained the same way in another pass.
5. Every text is scored in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .logbilinear import CONTEXT, LogBilinear, WithinClasses, train, train_within
from .shared import arrow_rows, frugal, materialise

HEAD_WORDS, TAIL_CLASSES = 512, 256
OWN_WORDS, OWN_SHARE = 1 << 15, 24
KNOWN_WORDS = 1 << 18
PARAMETERS, GATHERED = 1 << 13, 256  # in a block, and its tasks added up at once
START_TEXTS, START_WORDS, START_EPOCHS = 1000, 20_000, 2
CHUNK_BYTES = 8 << 20
END = ""  # no word is empty


def _text_slices(part: pa.RecordBatch, name: str = "text") -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(part.column(part.schema.get_field_index(name))), 0)
    chunk = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), part.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield part.slice(a, b - a)


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different tokens, index of each token, end of each text): an end token closes every text; null is empty."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(low)
    flat = split.flatten()
    empty = (pc.binary_length(low).to_numpy(zero_copy_only=False) == 0).astype(np.int64)  # these have one empty word
    sizes = np.diff(split.offsets.to_numpy().astype(np.int64))
    coded = flat.dictionary_encode()
    words, which = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    end = pc.index(words, END).as_py()
    if end < 0:
        end = len(words)
        words = pa.concat_arrays([words, pa.array([END], words.type)])
    # the empty word of an empty text is its end already
    closed = np.flatnonzero(empty == 0)
    which = np.insert(which, np.cumsum(sizes)[closed], end)
    return words, which, np.cumsum(sizes + 1 - empty)


def tail_class(words: pa.Array, classes: int = TAIL_CLASSES) -> np.ndarray:
    """Class of a word outside the head, by its last two bytes."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    data = np.concatenate([[0, 0], data]).astype(np.int64)
    size = np.diff(offsets)
    last = np.where(size > 0, data[offsets[1:] + 1], 0)
    before = np.where(size > 1, data[offsets[1:]], 0)
    return HEAD_WORDS + ((last * 256 + before) * 2654435761 >> 16) % classes


@dataclass
class Vocabulary:
    """Frequent words by falling count, and what the classes of the others hold."""

    words: pa.Array
    counts: np.ndarray
    tail_tokens: np.ndarray  # per tail class
    tail_words: np.ndarray
    train_tokens: int
    train_words: int
    own: int  # so many of the frequent words have a vector of their own, in the head or in their class

    def __post_init__(self) -> None:
        """Outcomes of the tail classes: each one's own words by falling count, then its rest."""
        classes = len(self.tail_tokens)
        mine = tail_class(self.words.slice(HEAD_WORDS, max(0, self.own - HEAD_WORDS)), classes) - HEAD_WORDS
        mass = self.counts[HEAD_WORDS:HEAD_WORDS + len(mine)] + 1.0
        self.rest = self.tail_tokens + self.tail_words + 1.0 - np.bincount(mine, weights=mass, minlength=classes)
        of = np.concatenate([mine, np.arange(classes)])
        order = np.argsort(of, kind="stable")
        self.first = np.searchsorted(of[order], np.arange(classes + 1))
        self.place = np.empty(len(order), np.int64)  # of own words by rank, then of rests by class
        self.place[order] = np.arange(len(order))
        self.law = np.concatenate([mass, self.rest])[order] / np.repeat(self.tail_tokens + self.tail_words + 1.0, np.diff(self.first))

    def outcomes(self, classes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outcome, whether it is the word's own) of words of tail classes; of others without meaning."""
        own = (rank >= HEAD_WORDS) & (rank < self.own)
        rest = len(self.place) - len(self.rest) + np.maximum(classes - HEAD_WORDS, 0)
        return self.place[np.where(own, rank - HEAD_WORDS, rest)], own

    def unigram(self) -> np.ndarray:
        head = np.zeros(HEAD_WORDS)
        head[:min(HEAD_WORDS, len(self.counts))] = self.counts[:HEAD_WORDS]
        law = np.concatenate([head, self.tail_tokens]) + 0.5
        return law / law.sum()

    def classes(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(class, rank or -1) of each word."""
        rank = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where((rank >= 0) & (rank < HEAD_WORDS), rank, tail_class(words, len(self.tail_tokens))), rank


def contexts(classes: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """(n, CONTEXT): the classes before each token of its text, nearest first; ``start`` where there is none."""
    first = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(classes)) - np.repeat(first, np.diff(np.concatenate([[0], ends])))
    out = np.full((len(classes), CONTEXT), start, np.int64)
    for k in range(CONTEXT):
        inside = place > k
        out[inside, k] = classes[np.flatnonzero(inside) - k - 1]
    return out


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``texts`` (text), the end token as the empty word."""
    out = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows in _text_slices(part):
                words, which, _ = tokens_of(rows.column(rows.schema.get_field_index("text")))
                yield pa.RecordBatch.from_arrays(
                    [words.cast(pa.string()), pa.array(np.bincount(which, minlength=len(words)))], schema=out)

    return (texts.select("text").mapInArrow(frugal(run), "word string, n long").where("n > 0")
            .groupBy("word").agg(F.sum("n").alias("c")))


def build_vocabulary(counts: DataFrame, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """Collects at most ``known_words`` words, a histogram and one row per tail class."""
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    step = F.floor(F.log2("c") * 16)
    histogram = sorted((r[0], r[1]) for r in counts.groupBy(step.alias("s")).count().collect())
    kept, cut = 0, None
    for s, n in reversed(histogram):
        if kept + n > known_words:
            break
        kept, cut = kept + n, s
    frequent = (counts.where(step >= cut) if cut is not None else counts.limit(0)).toPandas()
    frequent = frequent.sort_values(["c", "word"], ascending=[False, True]).reset_index(drop=True)
    words = pa.array(frequent["word"], pa.string())
    head = set(frequent["word"][:HEAD_WORDS])
    own = max(HEAD_WORDS, min(len(frequent), OWN_WORDS, int(totals[1]) // OWN_SHARE))
    classes = TAIL_CLASSES
    while own > classes * classes // 2:  # were OWN_WORDS higher: 512 from 32,769 words on
        classes *= 2
    out = pa.schema([("class", pa.int32()), ("n", pa.int64()), ("v", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            mine = np.fromiter((w not in head for w in part.column(0).to_pylist()), bool, part.num_rows)
            c, k = part.column(1).to_numpy()[mine], tail_class(part.column(0), classes)[mine] - HEAD_WORDS
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(classes), pa.int32()),
                pa.array(np.bincount(k, weights=c, minlength=classes).astype(np.int64)),
                pa.array(np.bincount(k, minlength=classes))], schema=out)

    tail_tokens, tail_words = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in counts.mapInArrow(frugal(run), "class int, n long, v long").groupBy("class").agg(F.sum("n"), F.sum("v")).collect():
        tail_tokens[r[0]], tail_words[r[0]] = r[1], r[2]
    return Vocabulary(words, frequent["c"].to_numpy(np.int64), tail_tokens, tail_words, int(totals[0] or 0), int(totals[1]), own)


def train_model(texts: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """``texts`` (text, start boolean) are the training texts; all of them are trained on, see the module's steps 3 and 4."""
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)  # KNOWN_WORDS words at most
    unigram = vocabulary.unigram()
    classes = len(unigram)
    coded = pa.schema([("classes", pa.binary())])

    def code(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows in _text_slices(part):
                words, which, ends = tokens_of(rows.column(0))
                of = sent.value.classes(words)[0][which].astype("<i4")
                first = np.concatenate([[0], ends[:-1]])
                fits = [(a, b) for a, b in zip(first.tolist(), ends.tolist(), strict=True) if b - a <= START_WORDS]
                yield pa.RecordBatch.from_arrays([pa.array([of[a:b].tobytes() for a, b in fits], pa.binary())], schema=coded)

    sample = texts.where("start").select("text").mapInArrow(frugal(code), "classes binary").collect()
    runs = [np.frombuffer(r, "<i4").astype(np.int64) for r in sorted(bytes(x.classes) for x in sample)]
    model = LogBilinear.start(unigram)
    if runs:
        tokens, ends = np.concatenate(runs), np.cumsum([len(r) for r in runs])
        model = train(model, contexts(tokens, ends, classes), tokens, unigram, epochs=START_EPOCHS)
    begun = texts.sparkSession.sparkContext.broadcast(model)

    def classes_of(v: Vocabulary, rows: pa.RecordBatch) -> tuple:
        words, which, ends = tokens_of(rows.column(0))
        of, rank = v.classes(words)
        tokens = of[which]
        return tokens, contexts(tokens, ends, classes), which, v.outcomes(of, rank)[0]

    def train_classes(slices: Iterator[pa.RecordBatch]) -> tuple[np.ndarray | None, int]:
        own, seen = begun.value, 0
        for rows in slices:
            tokens, before, _, _ = classes_of(sent.value, rows)
            own = train(own, before, tokens, unigram, seed=seen % (1 << 31))
            seen += len(tokens)
        return own.flat(), seen

    flat = _mean_of_tasks(texts, train_classes)
    model = model if flat is None else LogBilinear.from_flat(flat, classes)
    model.within = WithinClasses.start(vocabulary.first, vocabulary.law)
    whole = texts.sparkSession.sparkContext.broadcast(model)

    def train_words(slices: Iterator[pa.RecordBatch]) -> tuple[np.ndarray | None, int]:
        v, model, state, seen = sent.value, whole.value, None, 0
        within = model.within
        for rows in slices:
            tokens, before, which, outcome = classes_of(v, rows)
            tail = np.flatnonzero(tokens >= HEAD_WORDS)
            within, state = train_within(within, model.hidden(before[tail]), tokens[tail] - HEAD_WORDS, outcome[which[tail]],
                                         v.law, state, seen % (1 << 31))
            seen += len(tokens)
        return within.flat(), seen

    flat = _mean_of_tasks(texts, train_words)
    if flat is not None:
        model.within = WithinClasses.from_flat(flat, vocabulary.first)
    return model


def _mean_of_tasks(texts: DataFrame, trained: Callable) -> np.ndarray | None:
    """Parameters that ``trained`` gives from each task's texts, averaged by its tokens; None without texts."""
    out = pa.schema([("task", pa.int64()), ("block", pa.int32()), ("data", pa.binary()), ("weight", pa.float64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flat, seen = trained(rows for part in parts for rows in _text_slices(part))
        if seen:
            flat = flat.astype(np.float64) * seen
            blocks = [flat[a:a + PARAMETERS].tobytes() for a in range(0, len(flat), PARAMETERS)]
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                pa.array(blocks, pa.binary()), pa.array([float(seen)] * len(blocks))], schema=out)

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in rows["data"])
        return pa.table([rows["task"][:1], rows["block"][:1], pa.array([total.tobytes()], pa.binary()),
                         pa.array([pc.sum(rows["weight"]).as_py()], pa.float64())], schema=out)

    schema = "task long, block int, data binary, weight double"
    sums = texts.select("text").mapInArrow(frugal(run), schema)
    sums = sums.groupBy("block", F.floor(F.col("task") / GATHERED)).applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    sums = sorted((r.block, r.data, r.weight) for r in sums.collect())  # as many bytes as the model has
    return np.concatenate([np.frombuffer(d, np.float64) / w for _, d, w in sums]) if sums else None


def score_texts(docs: DataFrame, vocabulary: Vocabulary, counts: DataFrame, model: LogBilinear) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of each row of ``docs`` (id, text).

    Words beyond the table of frequent ones go through a join with ``counts``;
    none of them is frequent, so no key of it is hot.
    """
    spark = docs.sparkSession.sparkContext
    sent, sent_model = spark.broadcast(vocabulary), spark.broadcast(model)
    schema = "row long, id long, word string, n long, known long, base double, lm double"
    out = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("word", pa.string()), ("n", pa.int64()),
                     ("known", pa.int64()), ("base", pa.float64()), ("lm", pa.float64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, model = sent.value, sent_model.value
        number = TaskContext.get().partitionId() << 40
        log_of = np.log10(v.counts + 1.0)
        rest_size = np.concatenate([np.zeros(HEAD_WORDS), np.log10(v.rest)])
        for part in parts:
            for rows in _text_slices(part):
                words, which, ends = tokens_of(rows.column(1))
                of, rank = v.classes(words)
                common = rank >= 0
                log_c = np.where(common, log_of[rank] if len(log_of) else 0.0, 0.0)
                outcome, own = v.outcomes(of, rank)
                in_rest = np.where((of >= HEAD_WORDS) & ~own, log_c - rest_size[of], 0.0)
                tokens = of[which]
                before, tail = contexts(tokens, ends, len(model.bias)), np.flatnonzero(tokens >= HEAD_WORDS)
                lm = model.log_probabilities(before, tokens)
                hidden, at_context = model.distinct(before[tail])
                lm[tail] += model.within.log_shares(hidden, tokens[tail] - HEAD_WORDS, outcome[which[tail]], at_context)
                lm = lm / np.log(10) + in_rest[which]
                first = np.concatenate([[0], ends[:-1]])
                total = lambda x: np.add.reduceat(x, first)  # noqa: B023, E731  every text has its end token
                ids = number + np.arange(rows.num_rows)
                n = ends - first
                none = pa.nulls(rows.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids), rows.column(0), none, pa.array(n), pa.array(total(common[which].astype(np.int64))),
                    pa.array(total(log_c[which])), pa.array(total(lm))], schema=out)
                rare = np.flatnonzero(~common[which])
                pair, times = np.unique(np.repeat(np.arange(rows.num_rows), n)[rare] * len(words) + which[rare],
                                        return_counts=True)
                row, word = np.divmod(pair, len(words))
                for at in range(0, len(pair), 1 << 16):
                    s = slice(at, at + (1 << 16))
                    m = len(pair[s])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[row[s]]), pa.nulls(m, pa.int64()), words.take(pa.array(word[s])).cast(pa.string()),
                        pa.array(times[s]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                        pa.nulls(m, pa.float64())], schema=out)
                number += rows.num_rows

    rows = materialise(docs.select("id", "text").mapInArrow(frugal(run), schema), "lm-scores")
    log_c = F.log10(F.col("c") + 1.0)
    rare = (rows.where("word is not null").select("row", "word", "n").join(counts, "word")
            .groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * log_c).alias("log_c")))
    log_c = F.coalesce("log_c", F.lit(0.0))
    scale = float(np.log10(vocabulary.train_tokens + vocabulary.train_words + 1.0))
    return rows.where("word is null").join(rare, "row", "left").select(
        "id", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + log_c - F.col("n") * scale).alias("base_score"), (F.col("lm") + log_c).alias("score"))


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, train_tokens): one row per row of ``docs``.

    Rows that pass ``learn`` are the training texts.  Null and empty texts are one
    end token.  Without training texts every token is unknown and the model uniform.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), learn.alias("learnt"))
    with arrow_rows(docs.sparkSession, 2500):
        return _learn_and_score(rows)


def _learn_and_score(rows: DataFrame) -> DataFrame:
    texts = rows.where("learnt")
    counts = materialise(count_words(texts), "word-counts")
    vocabulary = build_vocabulary(counts)
    n = texts.count()
    start = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(min(1.0, START_TEXTS / max(1, n)) * (1 << 30))
    model = train_model(texts.select("text", start.alias("start")), vocabulary)
    scored = score_texts(rows, vocabulary, counts, model)
    return scored.withColumn("train_tokens", F.lit(vocabulary.train_tokens).cast("long"))
