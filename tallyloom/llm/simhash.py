"""SimHash near-duplicates by a segment-popcount embedding and a grid range join.

A 64-bit fingerprint is mapped to 32 counts, the set bits of each two-bit
segment.  Flipping one bit moves one count by one, so the Manhattan distance of
two embeddings never exceeds the Hamming distance of their fingerprints: it is a
lower bound, and the range join over the integer grid loses no pair.  The join
meets in the middle: every fingerprint is entered in all grid cells within
``ceil(max_bits / 2)`` of its own, and two fingerprints meet in a cell on a
shortest path between them.  Pairs that pass the bound are verified on the bits.

The cell is one 64-bit number: each count 0..2 in unary (00, 01, 11), that is,
the segment's bits in order.  In unary the Manhattan distance of two cells is
the number of bits in which they differ, and a step is one bit flip that leaves
every segment in order.  A cell holds at most 2^(segments with count 1)
fingerprints and only distinct fingerprints enter the join, so exact copies,
however many, cost one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import ascii_words, column, frugal, materialise, plain_names

LOW_BITS = 0x5555555555555555


def simhash64(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; 0 without words.

    Words are runs of other than ASCII white space, A-Z lower-cased.  A text of
    fewer words than a shingle has its whole word sequence as the one shingle.
    """
    words = ascii_words(text)
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total = len(words) - shingle_words + 1
    counts = np.zeros(64, np.int64)
    for start in range(0, total, 1 << 16):
        part = words[start:min(start + (1 << 16), total) + shingle_words - 1]
        shingles = zip(*(part[k:] for k in range(shingle_words)), strict=False)
        h = np.array([digest(join(s), seed) for s in shingles], np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3, seed: int = 42) -> DataFrame:
    """(id, fingerprint long) of every row; a null text counts as empty (fingerprint 0)."""
    out = pa.schema([("id", pa.int64()), ("fingerprint", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            marks = np.fromiter((simhash64(t, shingle_words, seed) for t in column(part, "text")), np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks.view(np.int64))], schema=out)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(frugal(run), "id long, fingerprint long"))


def unary_cell(x: Column) -> Column:
    """The grid cell of a fingerprint: per two-bit segment its popcount, in unary."""
    mask, above = F.lit(LOW_BITS), F.shiftrightunsigned(x, 1)
    some, both = x.bitwiseOR(above).bitwiseAND(mask), x.bitwiseAND(above).bitwiseAND(mask)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _ball(prints: DataFrame, radius: int) -> DataFrame:
    """(fingerprint, cell, steps): all cells within ``radius`` steps of each fingerprint's own."""
    home = unary_cell(F.col("fingerprint"))
    shell = prints.select("fingerprint", home.alias("cell"), F.lit(0).alias("steps"))
    ball = shell
    for step in range(1, radius + 1):
        bit, cell = F.col("bit"), F.col("cell")
        # low bit of a segment: free while its high bit is 0; high bit: free while the low one is 1
        free = F.expr("if(bit % 2 = 0, getbit(cell, bit + 1) = 0, getbit(cell, bit - 1) = 1)")
        moved = cell.bitwiseXOR(F.expr("shiftleft(1L, bit)"))
        shell = (shell.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(63)))).where(free)
                 .select("fingerprint", moved.alias("cell"), F.lit(step).alias("steps"))
                 .where(F.bit_count(F.col("cell").bitwiseXOR(home)) == step))
        if step > 1:
            shell = shell.distinct()
        ball = ball.unionAll(shell)
    return ball


def near_pairs(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(left, right): all pairs of different fingerprints of ``prints`` within ``max_bits`` bits.

    Every such pair comes at least once; a pair may come once for each cell
    that lies half-way between the two.
    """
    ball = _ball(prints.select("fingerprint").distinct(), (max_bits + 1) // 2)
    a = ball.select(F.col("fingerprint").alias("left"), "cell", F.col("steps").alias("da"))
    b = ball.select(F.col("fingerprint").alias("right"), "cell", F.col("steps").alias("db"))
    left, right = F.col("left"), F.col("right")
    bound = F.bit_count(unary_cell(left).bitwiseXOR(unary_cell(right)))  # Manhattan distance
    half_way = (F.col("da") == F.floor((bound + 1) / 2)) & (F.col("db") == F.floor(bound / 2))
    return (a.join(b, "cell")
            .where((left < right) & (bound <= max_bits) & half_way
                   & (F.bit_count(left.bitwiseXOR(right)) <= max_bits))
            .select("left", "right"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, seed: int = 42, max_bits: int = 2) -> DataFrame:
    """(id, fingerprint long, component_id long): one row per row of ``docs``.

    ``component_id`` is the least id reachable over links of at most ``max_bits``
    differing bits, the row's own included.  Null and empty texts have
    fingerprint 0 and link like any other.  Repeated rows stay repeated.  A null
    id is never a component id unless no row of the component has one.
    """
    marks = materialise(fingerprints(docs, id_col, text_col, shingle_words, seed), "simhash")
    groups = marks.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = connected_components(near_pairs(groups, max_bits), "left", "right")
    rooted = groups.join(roots, groups.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rooted.join(named, "root").select("fingerprint", "component_id")
    return marks.join(materialise(linked, "simhash-components"), "fingerprint").select(
        "id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the least id.

    Of rows that repeat that id, the least by a hash of the text stays.  Rows
    without an id belong to no group and stay as they are.
    """
    rows, (id_col, text_col) = plain_names(docs, id_col, text_col)
    named = rows.where(F.col(id_col).isNotNull())
    chosen = (near_duplicates(named, id_col, text_col, **options)
              .where("id = component_id").select(F.col("id").alias("__kept")).distinct())
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    kept = (named.join(chosen, named[id_col] == chosen["__kept"], "left_semi")
            .withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n"))
    return kept.unionByName(rows.where(F.col(id_col).isNull())).toDF(*docs.columns)
