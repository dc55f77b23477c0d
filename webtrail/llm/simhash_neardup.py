"""SimHash near-duplicates by pigeonring filtering.

Each text gets a 64-bit SimHash over its word shingles.  Two fingerprints within ``max_bits``
of each other, cut into ``max_bits + 1`` segments on a ring, have a segment from which every
chain of ``l`` consecutive segments differs in less than ``l`` bits: the cumulative budget
``l * max_bits / (max_bits + 1)``.  The first two links of the chain make the join key (first
segment equal, second one at most one bit apart); the rest of the chain is tested in the task
that holds the key, and its last link is the whole Hamming distance.

Equal fingerprints are one node from the start, so copies of a text cost one row.  Keys with
many different fingerprints are cut into blocks that meet pair by pair in tasks of their own,
and a task returns star edges, never its pairs.

Null and empty texts and texts of white space have the fingerprint zero, which links like any
other.  Repeated rows share a component and each returns its own row; a component without any
non-null id has a null ``component_id``.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from webtrail.llm import common

#: Fingerprints of a key beyond which the key is cut into blocks of about this size.
BLOCK = 1024
#: Pairs tested in one numpy step.
PAIRS = 1 << 19


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of ``text``; bit 0 is the lowest."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, seed)
    ends = list(accumulate(map(len, words)))
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0, *(e + 1 for e in ends)]
    hashes = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:])], dtype="<u8")
    half, total = len(hashes) // 2, np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        total += np.unpackbits(hashes[i: i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    # over half: 2 * total > n, which for whole numbers is total > n // 2
    return int(np.packbits(total > half, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp long): the SimHash of each row's whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        for batch in batches:
            fps = np.fromiter((fingerprint(x, shingle) for x in common.texts(batch.column(1))), dtype=np.uint64,
                              count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each of the max_bits + 1 segments."""
    m = max_bits + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(m)]


def _keys(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp, probe): for each segment its bits and the next one's; a probe has one zero bit of
    the second segment set.  Of two fingerprints one bit apart there, one probes the other's key."""
    parts, rows = _segments(max_bits), []
    for i, (low, width) in enumerate(parts):
        low2, width2 = parts[(i + 1) % len(parts)]
        first = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        second = F.shiftrightunsigned("fp", low2).bitwiseAND(F.lit((1 << width2) - 1))
        key = (F.lit(i) * F.lit(1 << width) + first) * F.lit(1 << width2) + second
        rows.append(F.struct(key.cast("long").alias("key"), F.lit(False).alias("probe")))
        for bit in range(width2):
            rows.append(F.when(second.bitwiseAND(F.lit(1 << bit)) == 0, F.struct(
                (key + F.lit(1 << bit)).cast("long").alias("key"), F.lit(True).alias("probe"))))
    if max_bits == 0:
        return nodes.limit(0).select(F.lit(0).cast("long").alias("key"), "fp", F.lit(False).alias("probe"))
    return nodes.select("fp", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("k")).select(
        "k.key", "fp", "k.probe")


def _cells(keys: DataFrame, block: int) -> DataFrame:
    """(key, cell, fp, left): rows that meet.  A cell is a pair of blocks of a key's fingerprints:
    left rows are stored under the key, right rows are those and the probes."""
    hot = common.stored(keys.filter("not probe").groupBy("key").count().filter(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("n")), "hot-keys")
    cut = keys.join(common.small_side(hot), "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    cut = cut.withColumn("b", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    each = F.sequence(F.lit(0), F.col("n") - 1)
    left = F.when(~F.col("probe"), F.transform(each, lambda x: F.struct((F.col("b") * F.col("n") + x).alias("cell"),
                                                                        F.lit(True).alias("left"))))
    right = F.transform(each, lambda x: F.struct((x * F.col("n") + F.col("b")).alias("cell"), F.lit(False).alias("left")))
    # right rows of a key that is not cut and not probed are its left rows again: the task adds them
    sides = F.when(F.col("n") > 1, F.concat(F.coalesce(left, F.array().cast("array<struct<cell:int,left:boolean>>")),
                                            right)).otherwise(F.array(F.struct(F.lit(-1).alias("cell"),
                                                                               (~F.col("probe")).alias("left"))))
    return cut.select("key", "fp", F.explode(sides).alias("s")).select("key", "s.cell", "fp", "s.left")


def _chain(x: np.ndarray, y: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs are within len(parts) - 1 bits: some start whose chains all stay within budget."""
    d = [np.bitwise_count((x ^ y) >> np.uint64(low) & np.uint64((1 << width) - 1)) for low, width in parts]
    ok = np.zeros(len(x), dtype=bool)
    for start in range(len(parts)):
        here, total = np.ones(len(x), dtype=bool), np.zeros(len(x), dtype=np.uint8)
        for length in range(1, len(parts) + 1):
            total = total + d[(start + length - 1) % len(parts)]
            here &= total < length
        ok |= here
    return ok


def _links(max_bits: int):
    parts = _segments(max_bits)

    def meet(group: np.ndarray, cell: np.ndarray, fp: np.ndarray, left: np.ndarray) -> Iterator[tuple]:
        """Star edges of whole groups: rows sorted by group, left rows first."""
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(group)])
        lefts = np.add.reduceat(left.astype(np.int64), first)
        # a group that is not cut has its left rows on the right side too
        whole = cell[first] < 0
        from_, to = np.where(whole, 0, lefts), size
        n = lefts * (to - from_)
        for i in range(0, len(first)):
            if n[i] > PAIRS:  # one large cell: a few left rows at a time
                lo, a, b = first[i], fp[first[i]: first[i] + lefts[i]], fp[first[i] + from_[i]: first[i] + to[i]]
                step = max(1, PAIRS // len(b))
                for k in range(0, len(a), step):
                    yield np.repeat(a[k: k + step], len(b)), np.tile(b, len(a[k: k + step]))
        n = np.where(n > PAIRS, 0, n)
        bounds = [0]
        run = 0
        for i, k in enumerate(n):
            if run and run + k > PAIRS:
                bounds.append(i)
                run = 0
            run += k
        bounds.append(len(n))
        for lo, hi in zip(bounds, bounds[1:]):
            m = n[lo:hi]
            if not m.sum():
                continue
            g = np.repeat(np.arange(lo, hi), m)
            k = np.arange(len(g)) - np.repeat(np.cumsum(m) - m, m)
            width = (to - from_)[g]
            yield fp[first[g] + k // width], fp[first[g] + from_[g] + k % width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, cell, fp, left = rows
            group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]) if len(key) else key
            for x, y in meet(group, cell, fp.view(np.uint64), left) if len(key) else ():
                ok = (x != y)
                x, y = x[ok], y[ok]
                ok = _chain(x, y, parts)
                if ok.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(e) for e in common.stars(x[ok].view(np.int64), y[ok].view(np.int64))], names=["a", "b"])

        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            last = (rows[0] != rows[0][-1:]) | (rows[1] != rows[1][-1:])
            cut = int(last.nonzero()[0][-1]) + 1 if last.any() else 0  # the last group may go on
            held = [x[cut:] for x in rows]
            yield from found([x[:cut] for x in rows])
        if held is not None:
            yield from found(held)

    return run



def _labels(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row; (fp, component_id) of every fingerprint."""
    rows = common.stored(fingerprints(docs, doc_id, text, shingle), "simhash")
    nodes = common.stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    cells = _cells(_keys(nodes, max_bits), block)
    edges = (cells.repartition("key", "cell").sortWithinPartitions("key", "cell", F.desc("left"))
             .mapInArrow(_links(max_bits), "a long, b long"))
    reach = common.components(edges).join(nodes.select(F.col("fp").alias("node"), "least"), "node")
    lows = reach.groupBy("component").agg(F.min("least").alias("least"))
    linked = common.stored(reach.select("node", "component").join(lows, "component").select(
        F.col("node").alias("fp"), F.col("least").alias("low")), "simhash-linked")
    best = nodes.join(common.small_side(linked), "fp", "left")
    return rows, best.select("fp", F.coalesce("low", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4,
                    block: int = BLOCK) -> DataFrame:
    """(id, fingerprint string, component_id): one row for each row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest id
    that a row reaches over links, its own included.
    """
    rows, best = _labels(docs, doc_id, text, shingle, max_bits, block)
    return rows.join(best, "fp").select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4,
             block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, with their own columns, that stand for their component: of the smallest id.

    Rows that repeat that id all stay, and rows with a null id stay: nothing tells them apart."""
    rows, best = _labels(docs, doc_id, text, shingle, max_bits, block)
    gone = common.small_side(common.stored(
        rows.join(best, "fp").filter(F.col("id") != F.col("component_id")).select(F.col("id").alias("__gone")).distinct(),
        "simhash-gone"), 1_000_000)
    return docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")
