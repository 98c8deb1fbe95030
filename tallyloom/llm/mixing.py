"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Every source gets a weight and a target in words: ``share`` of all words dealt
   by weight, no target above ``most`` times its source's size, what is above
   dealt again among the rest.
2. The mix is a number of blocks of ``block_words`` words.  Sainte-Lague gives
   them to sources by their targets, highest quotient first, and each source's
   blocks to its shards by their words.
3. A shard is about ``SHARD_DOCS`` documents chosen by a hash, in the order of
   that hash: one stream of words.  Its quota takes the whole stream as often as
   it fits, and then the blocks from a seeded one on, round the end of the
   stream to its start.  So at most three documents of a shard are cut.

A source of any size is spread over as many shards as it needs; only one row per
shard, and one per source, is ever gathered.  All choices hang on hashes of the
rows and the seed: runs agree on any number of partitions.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, materialise, plain_names

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS, SHARD_DOCS, SEED = 64, 4096, 42


def apportion(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats per party by the highest quotients votes / (2 k - 1); of equal quotients the earlier party's.

    Starts from the rounded shares, which differ from the result by a few seats
    only, and gives or takes back one quotient at a time.
    """
    votes = np.asarray(votes, np.float64)
    if seats <= 0 or not votes.sum() > 0:
        return np.zeros(len(votes), np.int64)
    given = np.floor(votes * (seats / votes.sum()) + 0.5).astype(np.int64)
    left = seats - int(given.sum())
    if left > 0:
        heap = [(-v / (2 * n + 1), i) for i, (v, n) in enumerate(zip(votes.tolist(), given.tolist(), strict=True)) if v > 0]
        heapq.heapify(heap)
        for _ in range(left):
            _, i = heap[0]
            given[i] += 1
            heapq.heapreplace(heap, (-votes[i] / (2 * int(given[i]) + 1), i))
    elif left < 0:
        heap = [(v / (2 * n - 1), -i) for i, (v, n) in enumerate(zip(votes.tolist(), given.tolist(), strict=True)) if n > 0]
        heapq.heapify(heap)
        for _ in range(-left):
            _, i = heapq.heappop(heap)
            given[-i] -= 1
            if given[-i]:
                heapq.heappush(heap, (votes[-i] / (2 * int(given[-i]) - 1), i))
    return given


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_no, docs, source_size, target) from (source, size); sources by code point, null last.

    The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    sources = sources.withColumn("source_no", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1)
        .cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    leveled = sources.withColumn("level", level).withColumn("stopped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the first source that is not stopped fixes the level for all behind it
    common = F.first(F.when(~F.col("stopped"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stopped = F.col("stopped") | common.isNull()
    return leveled.withColumn("target", F.when(stopped, F.col("cap")).otherwise(common * F.col("weight"))).select(
        "source", "source_no", "docs", "source_size", "target")


def _source_quotas(block_words: int):
    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source_no").reset_index(drop=True)
        seats = int(round(rows["target"].sum() / block_words))
        return rows[["source_no"]].assign(blocks=apportion(rows["target"].to_numpy(), seats))

    return deal


def _shard_quotas(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("shard").reset_index(drop=True)
    return rows[["source_no", "shard", "words"]].assign(
        blocks=apportion(rows["words"].to_numpy(), int(rows["blocks"].iloc[0])))


def allocate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
             block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = SEED, mix_col: str = "__mix") -> DataFrame:
    """``docs`` with a column ``mix_col``: size, source_size, target, taken, and what is taken.

    ``whole`` is how often the whole document is taken; besides, its words
    ``[from1, to1)`` and ``[from2, to2)`` are.  A null text has size 0, a null
    source is a source of its own, behind all others.  Repeated rows are dealt one
    by one.  No document is taken more than ``most`` times its size.  Other columns
    may have any names but ``mix_col``.
    """
    plain, (id_col, text_col, source_col) = plain_names(docs, id_col, text_col, source_col)
    mixed = _allocated(plain, id_col, text_col, source_col, weights, share, most, block_words, shard_docs, seed)
    return mixed.toDF(*docs.columns, mix_col)


def _allocated(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float,
               most: float, block_words: int, shard_docs: int, seed: int) -> DataFrame:
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))
    row = docs.select(*docs.columns, F.col(source_col).cast("string").alias("__source"),
                      word_count(F.col(text_col)).alias("__size"), key.alias("__key"))
    sizes = row.select(F.col("__source").alias("source"), F.col("__size").alias("size"))
    sources = materialise(source_targets(sizes, weights, share, most), "mix-sources")
    shards_of = F.ceil(F.col("docs") / F.lit(shard_docs))
    known = sources.select(F.col("source").alias("__named"), F.col("source_no").alias("__no"),
                           F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                           shards_of.alias("__shards"))
    sharded = (row.join(known, F.col("__source").eqNullSafe(F.col("__named")))
               .withColumn("__shard", F.pmod("__key", "__shards")).drop("__source", "__named", "__shards"))
    quotas = (sources.groupBy().applyInPandas(_source_quotas(block_words), "source_no int, blocks long"))
    streams = sharded.groupBy(F.col("__no").alias("source_no"), F.col("__shard").alias("shard")).agg(
        F.sum("__size").alias("words"))
    dealt = materialise(streams.join(quotas, "source_no").groupBy("source_no").applyInPandas(
        _shard_quotas, "source_no int, shard long, words long, blocks long"), "mix-shards")
    quota = F.least(F.col("blocks") * block_words, (F.col("words") * F.lit(float(most))).cast("long"))
    first_block = F.pmod(F.xxhash64("source_no", "shard", F.lit(seed)),
                         F.greatest(F.lit(1), F.ceil(F.col("words") / F.lit(block_words))))
    dealt = dealt.select(
        F.col("source_no").alias("__no"), F.col("shard").alias("__shard"), F.col("words").alias("__words"),
        F.when(F.col("words") > 0, F.floor(quota / F.col("words"))).otherwise(0).alias("__whole"),
        F.when(F.col("words") > 0, quota % F.col("words")).otherwise(0).alias("__extra"),
        (first_block * block_words).alias("__from"))
    stream = Window.partitionBy("__no", "__shard").orderBy("__key", id_col, "__size")
    placed = sharded.join(dealt, ["__no", "__shard"]).withColumn(
        "__at", F.coalesce(F.sum("__size").over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    size, at, zero = F.col("__size"), F.col("__at"), F.lit(0).cast("long")
    end = F.col("__from") + F.col("__extra")
    clip = lambda x: F.greatest(zero, F.least(size, x - at))
    from1, to1 = clip(F.col("__from")), clip(F.least(end, F.col("__words")))
    to2 = clip(end - F.col("__words"))  # round the end of the stream to its start
    pieces = F.greatest(zero, to1 - from1) + to2
    mix = F.struct(size.alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                   (F.col("__whole") * size + pieces).alias("taken"), F.col("__whole").alias("whole"),
                   from1.alias("from1"), to1.alias("to1"), zero.alias("from2"), to2.alias("to2"))
    return placed.select(*docs.columns, mix.alias("__mix"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document as often as it is taken.

    Where only some words of a document are taken, that row's text is those words
    with single spaces between, and ``n_chars``, if there is such a column, its length.
    """
    names = docs.columns
    plain, (id_col, text_col, source_col) = plain_names(docs, id_col, text_col, source_col)
    mix = F.col("__mix")
    piece = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    whole = F.array_repeat(piece(F.lit(0), mix["size"]), mix["whole"].cast("int"))
    cut = F.filter(F.array(piece(mix["from1"], mix["to1"]), piece(mix["from2"], mix["to2"])), lambda p: p["a"] < p["b"])
    rows = (allocate(plain, id_col, text_col, source_col, **options).where(mix["taken"] > 0)
            .withColumn("__piece", F.explode(F.concat(whole, cut))))
    a, b = F.col("__piece.a"), F.col("__piece.b")
    part = (a > 0) | (b < mix["size"])
    words = F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), (a + 1).cast("int"), (b - a).cast("int"))
    rows = rows.withColumn("__part", part).withColumn(
        text_col, F.when(F.col("__part"), F.array_join(words, " ")).otherwise(F.col(text_col)))
    if "n_chars" in names:
        n = plain.columns[names.index("n_chars")]
        rows = rows.withColumn(n, F.when(F.col("__part"), F.length(text_col).cast(plain.schema[n].dataType)).otherwise(F.col(n)))
    return rows.select(*plain.columns).toDF(*names)
