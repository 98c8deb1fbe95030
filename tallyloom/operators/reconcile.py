"""Comparison of two tables of one key by a tree of digests.

Each row has a hash over its compared columns, and its key's hash puts it into a
bucket.  A bucket's digest is its count, the sum and the exclusive or of its row
hashes, so the order of rows does not matter, and the digest of an upper node is
put together from its children's.  Two tables are compared from the root down,
only below nodes that differ; only rows of differing leaves are joined, and only
differing rows among them.  Digests are small and can be kept beside a table, so
that a later comparison reads the other table alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = (0, 6, 12, 18)  # bits of the key's hash that name a node, from the root to the leaves


def _leaf(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _row_hash(columns: Sequence[str]) -> Column:
    """NULL and empty text, and a value that moves to the next column, hash differently: nulls have a place of their own."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def leaf_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = LEVELS[-1]) -> DataFrame:
    """(leaf, n, total, parity) of every leaf that has rows: one pass, combined map-side."""
    return df.select(_leaf(keys, bits).alias("leaf"), _row_hash([*keys, *columns]).alias("_tl_hash")).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_tl_hash").cast("decimal(38,0)")).alias("total"),
        F.bit_xor("_tl_hash").alias("parity"))


def differing_leaves(left: DataFrame, right: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """(leaf) whose digests differ, found from the root down."""
    bits = levels[-1]
    pairs = left.select("leaf", F.lit(1).alias("_tl_side"), "n", "total", "parity").unionByName(
        right.select("leaf", F.lit(-1).alias("_tl_side"), "n", "total", "parity")).checkpoint(eager=True)
    suspects = None
    for level in levels:
        node = F.shiftrightunsigned("leaf", bits - level).alias("node")
        below = pairs if suspects is None else pairs.withColumn(
            "up", F.shiftrightunsigned("leaf", bits - upper)).join(suspects.withColumnRenamed("node", "up"), "up", "left_semi")
        suspects = below.groupBy(node).agg(
            F.sum(F.col("n") * F.col("_tl_side")).alias("n"), F.sum(F.col("total") * F.col("_tl_side")).alias("total"),
            F.bit_xor("parity").alias("parity")).filter("n <> 0 or total <> 0 or parity <> 0").select("node").checkpoint(eager=True)
        upper = level
        if suspects.isEmpty():
            break
    return suspects.withColumnRenamed("node", "leaf")


def table_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
               levels: Sequence[int] = LEVELS) -> DataFrame:
    """(keys, kind, column, left_value, right_value) of every difference; equal tables give no rows.

    ``kind``: ``left only`` and ``right only`` (one row per key, no column), or
    ``changed`` (one row per column that differs, values as text).  Keys must be
    unique on each side; NULL keys and values compare as equal to NULL.
    """
    keys = list(keys)
    columns = [c for c in left.columns if c not in keys] if columns is None else list(columns)
    bits = levels[-1]
    leaves = differing_leaves(leaf_digests(left, keys, columns, bits), leaf_digests(right, keys, columns, bits), levels)
    l_rows, r_rows = suspect_rows(left, leaves, keys, columns, bits), suspect_rows(right, leaves, keys, columns, bits)
    pair = [l_rows[k].eqNullSafe(r_rows[k]) for k in keys]
    both = l_rows.alias("l").join(r_rows.alias("r"), reduce(lambda a, b: a & b, pair), "full_outer")
    both = both.filter(~F.col("l._tl_hash").eqNullSafe(F.col("r._tl_hash")))
    kind = F.when(F.col("r._tl_hash").isNull(), "left only").when(F.col("l._tl_hash").isNull(), "right only").otherwise("changed")
    there = F.col("l._tl_hash").isNotNull() & F.col("r._tl_hash").isNotNull()
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    each = F.array(*[F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.struct(
        F.lit(c).alias("column"), text("l", c).alias("left_value"), text("r", c).alias("right_value"))) for c in columns])
    gone = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("column", "left_value", "right_value")]))
    return both.select(*[F.when(F.col("l._tl_hash").isNull(), F.col(f"r.{k}")).otherwise(F.col(f"l.{k}")).alias(k) for k in keys],
                       kind.alias("kind"), F.explode(F.when(there, F.array_compact(each)).otherwise(gone)).alias("_tl_d")) \
        .select(*keys, "kind", "_tl_d.column", "_tl_d.left_value", "_tl_d.right_value")


def suspect_rows(df: DataFrame, leaves: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = LEVELS[-1]) -> DataFrame:
    """The rows of differing leaves, with their hash: all that a comparison joins."""
    return df.withColumn("leaf", _leaf(keys, bits)).join(leaves, "leaf", "left_semi").select(
        *keys, *columns, _row_hash([*keys, *columns]).alias("_tl_hash"))
