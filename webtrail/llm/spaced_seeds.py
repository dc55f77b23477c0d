"""Benchmark decontamination by spaced-seed hashing.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.  A seed is a fixed
mask over consecutive words; its hash ignores the masked-out positions, so a passage with
substituted words still shares seeds with its source.  Seeds of the test items are joined with
the seeds of every training text; around each hit the two word sequences are compared along the
hit's diagonal, and a text is contaminated by an item where ``window`` consecutive words agree in
at least ``overlap`` of their positions.  The default masks hit every 13 words with any two
substitutions, so that no such window is missed at the default overlap.

Items of fewer words than ``window`` are one window as a whole, with masks of their own over the
whole item: its places are dealt into two classes more than the substitutions it may have, and
each mask ignores as many classes as there may be substitutions, so one mask is always hit.
Items of fewer than ``min_words`` words match nothing: :func:`find_leaks` takes all lengths,
:func:`decontaminate` by default five words and more, as a word or two say nothing of a leak.

Null and empty texts and items match nothing.
Repeated texts match each by itself; items with equal texts all match.  Empty tables give no
matches; extra columns are passed by.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common

#: 1: the word counts, 0: it may be any word.  Every 13 words with two substitutions keep one of these whole.
MASKS = ("11001011", "111011")
WINDOW = 13
OVERLAP = 0.8
#: Words of an item that :func:`decontaminate` takes for a passage.
MIN_WORDS = 5
#: Most words of test items held at once (16 bytes each, and a seed for each mask); more go in blocks.
BLOCK_WORDS = 1 << 20
CHUNK = 1 << 20

_KIND = np.zeros(256, dtype=np.uint64)  # 0: no part of a word, else the byte's value in the hash
_KIND[ord("0"): ord("9") + 1] = np.arange(1, 11)
_KIND[ord("a"): ord("z") + 1] = _KIND[ord("A"): ord("Z") + 1] = np.arange(11, 37)
_KIND[128:] = np.arange(128, 256)
_MULTIPLIER = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _MULTIPLIER, dtype=np.uint64)], dtype=np.uint64)


_POWERS = _powers(64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(29)


@dataclass
class Words:
    """Hash, first and last byte (exclusive, within its text) and text of each word; first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray


def words(values: list[bytes]) -> Words:
    data = np.frombuffer(b" ".join([*values, b""]), dtype=np.uint8)
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    begin = np.cumsum(sizes + 1) - sizes - 1
    kind = _KIND[data]
    inside = (kind > 0).view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.r_[starts, len(data)])) if len(starts) and not starts[0] \
        else np.arange(len(data)) - np.r_[np.zeros(starts[0] if len(starts) else len(data), dtype=np.int64),
                                          np.repeat(starts, np.diff(np.r_[starts, len(data)]))]
    powers = _POWERS if not len(starts) or (ends - starts).max() < len(_POWERS) else _powers(int((ends - starts).max()) + 1)
    # the gap after a word adds nothing
    hashes = np.add.reduceat(kind * powers[np.minimum(place, len(powers) - 1)], starts) if len(starts) else kind[:0]
    text = np.searchsorted(begin, starts, "right") - 1
    first = np.searchsorted(starts, begin)
    return Words(_mix(hashes), starts - begin[text], ends - begin[text], text, first)


def _seeds(w: Words, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the mask at each place where it fits into one text."""
    n = len(w.hashes) - len(mask) + 1
    if n <= 0:
        return w.hashes[:0], np.zeros(0, dtype=np.int64)
    out = np.zeros(n, dtype=np.uint64)
    for k in (i for i, c in enumerate(mask) if c == "1"):
        out = (out + w.hashes[k: k + n]) * np.uint64(_MULTIPLIER)
    out ^= out >> np.uint64(32)
    at = np.flatnonzero(w.text[:n] == w.text[len(mask) - 1:])
    return out[at], at


def short_masks(size: int, overlap: float) -> list[str]:
    """Masks over a whole item of ``size`` words, one of which agrees whichever words are substituted."""
    free = max(k for k in range(size + 1) if size - k >= overlap * size)
    classes = min(size, free + 2) if free else 1
    return ["".join("0" if i % classes in gone else "1" for i in range(size))
            for gone in itertools.combinations(range(classes), free)]


class Index:
    """Seeds of a block of test items, sorted, with a bit table that most training seeds fail."""

    BITS = 20

    def __init__(self, ids: list, values: list[bytes], masks: tuple[str, ...], window: int = WINDOW,
                 overlap: float = OVERLAP, min_words: int = 1):
        self.ids, self.w = ids, words(values)
        self.sizes = np.diff(np.r_[self.w.first, len(self.w.hashes)])
        size = self.sizes[self.w.text]  # of each word's item
        self.tables = [self._table(mask, size >= max(window, min_words)) for mask in masks]
        self.short = [self._table(mask, size == n) for n in np.unique(self.sizes).tolist()
                      if max(1, min_words) <= n < window for mask in short_masks(n, overlap)]

    def _table(self, mask: str, own: np.ndarray) -> tuple:
        """The mask with its seeds in items of the words ``own``, where they begin, and the bit table."""
        seeds, at = _seeds(self.w, mask)
        seeds, at = seeds[own[at]], at[own[at]]
        order = np.argsort(seeds, kind="stable")
        table = np.zeros(1 << self.BITS, dtype=bool)
        table[seeds >> np.uint64(64 - self.BITS)] = True
        return mask, seeds[order], at[order], table

    def hits(self, w: Words, tables: list[tuple]) -> np.ndarray:
        """Different (text, item, diagonal) of seeds that agree; diagonal: text's word less item's."""
        found = [np.zeros((0, 3), dtype=np.int64)]
        for mask, seeds, places, table in tables:
            own, at = _seeds(w, mask)
            maybe = np.flatnonzero(table[own >> np.uint64(64 - self.BITS)])
            own, at = own[maybe], at[maybe]
            lo, n = np.searchsorted(seeds, own, "left"), 0
            n = np.searchsorted(seeds, own, "right") - lo
            a = np.repeat(at, n)
            b = places[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            found.append(np.stack([w.text[a], self.w.text[b], a - w.first[w.text[a]] - b + self.w.first[self.w.text[b]]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def _short_matches(self, w: Words, overlap: float) -> dict[tuple[int, int], tuple]:
        """:meth:`matches` of items that are one window: the best place of each in each text, the first of equals."""
        text, item, diagonal = self.hits(w, self.short).T
        if not len(text):
            return {}
        here, there, size = w.first[text] + diagonal, self.w.first[item], self.sizes[item]
        same = np.zeros(len(text), dtype=np.int64)
        for k in range(int(size.max())):
            inside = np.flatnonzero(size > k)
            same[inside] += w.hashes[here[inside] + k] == self.w.hashes[there[inside] + k]
        good = np.flatnonzero(same >= overlap * size)
        good = good[np.lexsort((diagonal[good], -same[good], item[good], text[good]))]
        pair = np.stack([text[good], item[good]], 1)
        good = good[np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(axis=1)][: len(good)])]
        return {(int(text[i]), int(item[i])): (int(same[i]), int(size[i]), int(w.starts[here[i]]),
                                              int(w.ends[here[i] + size[i] - 1])) for i in good}

    def matches(self, w: Words, window: int, overlap: float) -> dict[tuple[int, int], tuple]:
        """(text, item) -> (agreeing words, words, first byte, last byte) of the best window."""
        best = self._short_matches(w, overlap) if self.short else {}
        sizes, size = np.diff(np.r_[w.first, len(w.hashes)]), window
        for text, item, diagonal in self.hits(w, self.tables).tolist():
            lo, hi = max(0, diagonal), min(int(sizes[text]), diagonal + int(self.sizes[item]))
            if hi - lo < size:
                continue
            here, there = w.first[text] + lo, self.w.first[item] + lo - diagonal
            same = w.hashes[here: here + hi - lo] == self.w.hashes[there: there + hi - lo]
            run = np.cumsum(np.r_[0, same])
            run = run[size:] - run[:-size]
            k = int(run.argmax())
            if run[k] >= overlap * size:
                good = np.flatnonzero(run >= overlap * size)
                a, b = here + good[0], here + good[-1] + size - 1
                new = (int(run[k]), size, int(w.starts[a]), int(w.ends[b]))
                if new[0] > best.get((text, item), (0,))[0]:
                    best[text, item] = new
        return best


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[tuple[list, list[bytes]]]:
    """The test items, at most about ``block_words`` words at a time; the smallest id first."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    # a word and its gap are two characters at least
    n = 1 + total // (2 * block_words)
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == k)
        rows = sorted(part.collect(), key=lambda r: (r.id is None, r.id if r.id is not None else 0, r.t))
        yield [r.id for r in rows], [r.t.encode() for r in rows]


def _scan(docs: DataFrame, text: str, block, masks, window, overlap, min_words, schema, emit) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = common.kept(key, lambda: Index(*shared.value, masks, window, overlap, min_words))
        for batch in batches:
            values = common.texts(batch.column(at))
            found = {}
            for lo, hi in common.chunks(values, CHUNK):
                for (row, item), match in index.matches(words(values[lo:hi]), window, overlap).items():
                    found[lo + row, item] = match
            yield emit(batch, index, found)

    return docs.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW,
               overlap: float = OVERLAP, block_words: int = BLOCK_WORDS, min_words: int = 1) -> DataFrame:
    """One row for each text and item that match: (doc_id, item_id, n_same, n_words, first_byte, end_byte).

    ``n_same`` of ``n_words`` agree in the best window; the bytes span all windows of its diagonal
    that pass.  The items are held in blocks of bounded size; the texts are read once a block and
    never shuffled, so neither a hot source nor a passage that many texts share makes a hot task."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    kinds = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_same int, n_words int, first_byte long, end_byte long"
    item_type = benchmark.select(item_id).limit(0).toArrow().schema.field(0).type

    def emit(batch, index, found):
        at = pa.array([r for r, _ in found], pa.int64())
        cols = [batch.column(0).take(at), pa.array([index.ids[i] for _, i in found], item_type)]
        for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64())):
            cols.append(pa.array([m[k] for m in found.values()], kind))
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "n_same", "n_words", "first_byte", "end_byte"])

    out = None
    for block in _blocks(benchmark, item_id, item_text, block_words):
        part = _scan(rows, "t", block, masks, window, overlap, min_words, schema, emit)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW,
                  overlap: float = OVERLAP, block_words: int = BLOCK_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, with their own columns, that match no item."""

    def emit(batch, index, found):
        clean = np.ones(batch.num_rows, dtype=bool)
        clean[[r for r, _ in found]] = False
        return batch.filter(pa.array(clean))

    for block in _blocks(benchmark, item_id, item_text, block_words):
        docs = _scan(docs, text, block, masks, window, overlap, min_words, docs.schema, emit)
    return docs
