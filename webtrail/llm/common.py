"""Helpers the operators share: stored tables, text chunks for numpy, star edges and components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.session import shared_dir

#: A word of the contracts: a run of bytes that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Most rows of a stored side that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of narrow rows, with a broadcast hint only if it has at most
    ``max_rows`` rows (a footer count); otherwise unchanged, so the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's values as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def chunks(values: list[bytes] | list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes (characters), one row at least, so that temporaries stay small."""
    first, held = 0, 0
    for i, x in enumerate(values):
        if held and held + len(x) > limit:
            yield first, i
            first, held = i, 0
        held += len(x) + 8
    if first < len(values):
        yield first, len(values)


_KEPT: dict[str, object] = {}


def kept(key: str, make):
    """What a Python worker builds once and holds until a task asks for something else.  Workers
    outlive stages, so only one such thing takes memory at a time."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Let go of what an earlier stage's tasks have kept in this worker, and hand its memory back."""
    if _KEPT:
        _KEPT.clear()
        trim()


def trim() -> None:
    """Hand memory that is free in this worker back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of an Arrow batch, which bound what a task holds of long texts in Python and outside the heap.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches bound by bytes and not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges a-b connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(a, b)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node long, component long): the smallest node each node of ``edges`` (a long, b long) reaches.

    Alternating large-star and small-star rounds, each written to the shared folder.  A round's
    minimum per node is partly aggregated before its shuffle; a node with very many neighbours
    is one row of the aggregated side, so its neighbours may be split over tasks.  Nodes
    without an edge do not appear; edges may repeat, run either way or join a node to itself.
    """
    now = stored(edges.select("a", "b").filter("a <> b").mapInArrow(_contract, "a long, b long").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.filter("b < a")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select("b", "m").filter("m < b").toDF("a", "b").union(low.toDF("a", "b")).distinct()
        now = stored(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    nodes = now.toDF("node", "component")
    return nodes.union(now.select("b", "b").distinct())


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Whole groups of rows that are sorted by their first ``n_keys`` columns, of types numpy holds."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        if held:
            change[0] = any(held[0].column(i)[0].as_py() != k[0] for i, k in enumerate(keys))
        done = 0
        for cut in np.flatnonzero(change).tolist():
            if cut > done:
                held.append(batch.slice(done, cut - done))
            if held:
                yield pa.Table.from_batches(held)
            held, done = [], cut
        held.append(batch.slice(done))
    if held:
        yield pa.Table.from_batches(held)
