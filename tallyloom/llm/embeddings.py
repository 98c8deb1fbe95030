"""Embedding near-duplicates by an epsilon grid order join, exact in double precision.

Two unit vectors have cosine >= t just when they lie within eps = sqrt(2 - 2 t).

1. Equal vectors become one class with a count, so copies are never compared.
2. The leading principal directions of all vectors give a rotation.  On those
   axes vectors get grid cells eps wide, and the classes are sorted by cell:
   the epsilon grid order.  Blocks of consecutive classes carry the box that they
   fill on those axes and in the length of what the axes leave out; two vectors
   are never closer than their boxes.
3. Pairs of sequence intervals are split again and again, eight ways a side,
   from the whole sequence down to blocks; pairs of intervals farther apart than
   eps are dropped together with all that lies in them.
4. A task joins the blocks of a tile, up to ``TILE`` by ``TILE`` pairs of them, which
   travel to it once each.  Per pair, sub-intervals that are provably distant are
   skipped, the rest multiplied in single precision with a margin, and what may
   link is computed again in double precision.  It returns counts and a spanning
   forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import batches, frugal, materialise

COSINE = 0.9
AXES, BLOCK, INNER, FAN = 8, 4096, 512, 8
TILE, TILES = 8, 32  # blocks on a side of a tile; fewer where there would be under ``TILES`` tiles on a side
MARGIN = 1e-4  # single precision is off by less for unit vectors


def _element_type(df: DataFrame, column: str) -> str:
    return "<f4" if df.schema[column].dataType.elementType.simpleString() == "float" else "<f8"


def _unit(raw: Iterable[bytes], kind: str, dim: int) -> np.ndarray:
    """Rows in double precision, shorter ones filled with zeros, divided by their length."""
    out = np.zeros((len(raw), dim))
    for i, r in enumerate(raw):
        v = np.frombuffer(r, kind)
        out[i, :len(v)] = v
    out /= np.abs(out).max(1, keepdims=True)  # no overflow, no underflow
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def can_link(id_col: str, vector_col: str) -> Column:
    """Whether a row has an id and a vector of finite components, one of them not zero; never null."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(members (id, key), classes (key, least, n, vector)) of the rows that can link.

    Rows without id or vector, of only zeros, or with a null or non-finite
    component are left out.
    """
    kind = _element_type(vectors, vector_col)
    out = pa.schema([("id", pa.int64()), ("vector", pa.binary())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(1)
            flat = (lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0).tobytes()
            ends = (lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()) * np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                schema=out)

    rows = vectors.where(can_link(id_col, vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = rows.mapInArrow(frugal(run), "id long, vector binary").withColumn("key", F.unhex(F.md5("vector")))
    rows = materialise(rows, "vectors")
    groups = rows.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    return rows.select("id", "key"), materialise(groups, "vector-classes")


def principal_axes(groups: DataFrame, kind: str, dim: int, axes: int = AXES) -> np.ndarray:
    """(dim, axes): leading directions of the unit vectors of all classes.

    Each task adds up products; the driver gets dim x dim sums, however many vectors there are.
    """
    out = pa.schema([("at", pa.int32()), ("value", pa.float64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim))
        for part in parts:
            x = _unit(part.column(0).to_pylist(), kind, dim)
            total[:dim] += x.T @ x
            total[dim] += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], schema=out)

    sums = groups.select("vector").mapInArrow(frugal(run), "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros((dim + 1) * dim)
    for r in sums.collect():
        flat[r.at] = r.value
    moments, mean = flat[:dim * dim].reshape(dim, dim), flat[dim * dim:]
    n = max(1.0, np.trace(moments))  # unit vectors: the trace is their number
    values, directions = np.linalg.eigh(moments / n - np.outer(mean / n, mean / n))
    lead = directions[:, np.argsort(values)[::-1][:min(axes, dim)]]
    return lead * np.sign(lead[np.abs(lead).argmax(0), np.arange(lead.shape[1])])


def _places(x: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes, and the length of the rest; never farther apart than the vectors."""
    y = x @ lead
    return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1, keepdims=True)))], 1)


def grid_blocks(groups: DataFrame, kind: str, dim: int, lead: np.ndarray, eps: float, block: int = BLOCK) -> DataFrame:
    """(block, low, high, keys, counts, vectors): classes in epsilon grid order, ``block`` to a row."""
    cell_schema = pa.schema([("cell", pa.list_(pa.int32())), ("key", pa.binary()), ("n", pa.int64()), ("vector", pa.binary())])

    def cells(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                cell = np.floor((_unit(part.column(2).to_pylist(), kind, dim) @ lead) / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(list(cell), pa.list_(pa.int32())), *part.columns], schema=cell_schema)

    box = pa.list_(pa.float64())
    block_schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("low", box), ("high", box),
                              ("keys", pa.binary()), ("counts", pa.binary()), ("vectors", pa.list_(pa.binary()))])

    def blocks(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def rows() -> Iterator[tuple]:
            held, number = [], 0
            for part in parts:
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    held.append(row)
                    if len(held) == block:
                        yield number, held
                        number, held = number + 1, []
            if held:
                yield number, held

        def packed() -> Iterator[tuple]:
            own = TaskContext.get().partitionId()
            for number, held in rows():
                at = _places(_unit([r[2] for r in held], kind, dim), lead)
                yield (own, number, (at.min(0) - 1e-9).tolist(), (at.max(0) + 1e-9).tolist(), b"".join(r[0] for r in held),
                       np.array([r[1] for r in held], "<i8").tobytes(), [r[2] for r in held])

        yield from batches(packed(), block_schema, 4)

    ordered = (groups.select("key", "n", "vector")
               .mapInArrow(frugal(cells), "cell array<int>, key binary, n long, vector binary")
               .repartitionByRange("cell", "key").sortWithinPartitions("cell", "key"))
    made = materialise(ordered.select("key", "n", "vector").mapInArrow(
        frugal(blocks), "part int, n int, low array<double>, high array<double>, keys binary, counts binary, "
                "vectors array<binary>"), "grid-blocks")
    numbers = made.select("part", "n").withColumn(
        "block", F.row_number().over(Window.orderBy("part", "n")) - 1)  # one small row per block
    return made.join(numbers, ["part", "n"]).drop("part", "n")


def near_blocks(blocks: DataFrame, eps: float, fan: int = FAN) -> DataFrame:
    """(a, b), a <= b: pairs of blocks whose boxes come within ``eps``, by splitting pairs of intervals."""
    levels = [materialise(blocks.select(F.col("block").cast("long").alias("i"), "low", "high"), "intervals")]
    axes = len(levels[0].first().low) if levels[0].take(1) else 0
    while levels[-1].count() > 1:
        each = [F.min(F.col("low")[k]) for k in range(axes)], [F.max(F.col("high")[k]) for k in range(axes)]
        levels.append(levels[-1].groupBy(F.floor(F.col("i") / fan).alias("i")).agg(
            F.array(*each[0]).alias("low"), F.array(*each[1]).alias("high")).checkpoint())
    pairs = levels[-1].select(F.col("i").alias("a"), F.col("i").alias("b"))
    steps = F.sequence(F.lit(0), F.lit(fan - 1))
    for level in reversed(levels[:-1]):
        one = level.select(F.col("i").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
        two = level.select(F.col("i").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        split = (pairs.withColumn("x", F.explode(steps)).withColumn("y", F.explode(steps))
                 .select((F.col("a") * fan + F.col("x")).alias("a"), (F.col("b") * fan + F.col("y")).alias("b")).where("a <= b"))
        gap = [F.greatest(F.lit(0.0), F.col("low_a")[k] - F.col("high_b")[k], F.col("low_b")[k] - F.col("high_a")[k])
               for k in range(axes)]
        apart = sum((g * g for g in gap), F.lit(0.0))
        pairs = split.join(one, "a").join(two, "b").where(apart <= eps * eps).select("a", "b").checkpoint()
    return pairs


def join_blocks(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, same: bool, lead: np.ndarray,
                cosine: float, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of each row of a, of each row of b, forest label of each row of a and then b).

    Rows count as often as ``na`` and ``nb`` say.  ``same``: a and b are one block, pairs i < j are taken.
    """
    eps2, n = 2 - 2 * cosine + 1e-9, len(a)
    label = np.arange(n if same else n + len(b))
    links_a, links_b = np.zeros(n, np.int64), np.zeros(len(b), np.int64)
    pa_, pb_ = _places(a, lead), _places(b, lead)
    a32, b32 = a.astype(np.float32), b.astype(np.float32)
    starts = range(0, len(b), inner)
    low = np.array([pb_[s:s + inner].min(0) for s in starts])
    high = np.array([pb_[s:s + inner].max(0) for s in starts])
    shift = 0 if same else n
    for s in range(0, n, inner):
        own = pa_[s:s + inner]
        gap = np.maximum(0, np.maximum(low - own.max(0), own.min(0) - high))
        for k, t in enumerate(starts):
            if (gap[k] ** 2).sum() > eps2 or (same and t < s):
                continue
            hit = a32[s:s + inner] @ b32[t:t + inner].T >= cosine - MARGIN
            if same and t == s:
                hit = np.triu(hit, 1)
            if not hit.any():
                continue
            for i in np.flatnonzero(hit.any(1)):
                js = np.flatnonzero(hit[i])
                js = js[np.einsum("jd,d->j", b[t + js], a[s + i]) >= cosine] + t
                if not len(js):
                    continue
                links_a[s + i] += nb[js].sum()
                links_b[js] += na[s + i]
                roots = np.unique(np.append(label[js + shift], label[s + i]))
                if len(roots) > 1:
                    label[np.isin(label, roots)] = roots[0]
    return links_a, links_b, label


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id): one row per row of ``vectors``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    least id reachable.  Rows that cannot link have no links and their own id;
    a null id links with nothing.  Vectors of fewer components than others count
    as filled up with zeros.  Rows that repeat an id stay repeated.
    """
    kind = _element_type(vectors, vector_col)
    members, groups = classes(vectors, id_col, vector_col)
    size = int(groups.agg(F.max(F.length("vector"))).first()[0] or 0)
    all_rows = vectors.select(F.col(id_col).cast("long").alias("id"))
    if not size:
        return all_rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    dim = size // np.dtype(kind).itemsize
    eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    lead = principal_axes(groups, kind, dim)
    blocks = grid_blocks(groups, kind, dim, lead, eps)
    pairs = near_blocks(blocks.select("block", "low", "high"), eps)
    out = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])
    tile = max(1, min(TILE, blocks.count() // TILES))

    def join_tile(pairs: pa.Table, held: pa.Table) -> pa.Table:
        rows = {r["block"]: r for r in held.to_pylist()}
        units: dict[int, np.ndarray] = {}
        found = []
        for _, _, i, j in sorted(zip(*(c.to_pylist() for c in pairs.columns), strict=True)):
            for k in (i, j):
                if k not in units:
                    units[k] = _unit(rows[k]["vectors"], kind, dim)
            same = i == j
            links_a, links_b, label = join_blocks(
                units[i], units[j], *(np.frombuffer(rows[k]["counts"], "<i8") for k in (i, j)), same, lead, cosine)
            raw = rows[i]["keys"] if same else rows[i]["keys"] + rows[j]["keys"]
            links = links_a + links_b if same else np.concatenate([links_a, links_b])
            at = np.flatnonzero(links)
            name = lambda k, raw=raw: raw[16 * k:16 * k + 16]
            found.append(pa.table([pa.array([name(k) for k in at], pa.binary()), pa.array(links[at], pa.int64()),
                                   pa.array([name(label[k]) for k in at], pa.binary())], schema=out))
        return pa.concat_tables(found) if found else out.empty_table()

    own = [F.floor(F.col(x) / tile).alias(f"tile_{x}") for x in ("a", "b")]
    tiled = pairs.select(*own, "a", "b")
    sent = (tiled.select("tile_a", "tile_b", F.explode(F.array("a", "b")).alias("block")).distinct()
            .join(blocks.select(F.col("block").cast("long").alias("block"), "keys", "counts", "vectors"), "block"))
    keys = ["tile_a", "tile_b"]
    sent = sent.toDF(*sent.columns)  # columns of its own: both sides of the cogroup come from ``pairs``
    found = tiled.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(join_tile, "key binary, links long, root binary")
    found = materialise(found, "vector-links")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "key", "root").select(F.col("node").alias("key"), "root")
    named = groups.select("key", "least", "n").join(counts, "key", "left").join(roots, "key", "left").withColumn(
        "root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = materialise(named.join(least, "root").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-classes-linked")
    linked = members.join(by_key, "key").select("id", "n_links", "component_id")
    rest = vectors.where(~can_link(id_col, vector_col)).select(F.col(id_col).cast("long").alias("id"))
    return linked.unionAll(rest.select("id", F.lit(0).cast("long"), F.col("id")))
