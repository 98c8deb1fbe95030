"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation upstream) and gives
    the planner a real size, so joins choose a broadcast only when it is small.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_names(df: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed c0, c1, ..., and the new names of ``named``: no helper column can clash with them."""
    plain = [f"c{k}" for k in range(len(df.columns))]
    places = {c.lower(): n for c, n in zip(df.columns, plain, strict=True)}
    return df.toDF(*plain), [places[c.lower()] for c in named]


def ascii_words(text: str | None) -> list[bytes]:
    """Words of ``text`` as UTF-8, A-Z lower-cased; bytes.split() parts at 0x20 and 0x09-0x0D only."""
    return text.encode("utf-8").lower().split() if text else []


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows of whole texts in an Arrow batch of the jobs run inside; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frugal(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving memory back: Python workers stay for later stages.

    Freed Arrow buffers go back to the system after every 16 MB that it returns,
    freed heap pages when it ends.
    """
    def stream(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        returned = 0
        try:
            for batch in run(parts):
                returned += batch.nbytes
                yield batch
                if returned > 16 << 20:
                    pa.default_memory_pool().release_unused()
                    returned = 0
        finally:
            give_back()

    return stream


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    chunk: list[tuple] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= size:
            yield _batch(chunk, schema)
            chunk = []
    if chunk:
        yield _batch(chunk, schema)


def _batch(chunk: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*chunk, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def text_slices(part: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in stretches of about ``most`` bytes of text, its second column."""
    chunk = np.cumsum(pc.fill_null(pc.binary_length(part.column(1)), 0).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), part.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield part.slice(a, b - a)


_factor = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def string_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes and their places; equal words have equal ones."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    start, size = offsets[:-1] - offsets[0], np.diff(offsets)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64)
    data += np.uint64(1)
    data *= _factor[(np.arange(len(data)) - np.repeat(start, size)) & 255]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data, dtype=np.uint64)])
    found = (total[start + size] - total[start]) * np.uint64(0x9E3779B97F4A7C15)
    return found ^ (found >> np.uint64(32))
