"""Removal of repeated 100-byte strings by column-wise suffix sorting of many documents.

A byte goes when a string of ``length`` bytes covers it that also starts earlier: in a smaller
document, or earlier in the same one.  The strings are judged on the input.

One symbol per document and round, over whole documents, would take as many rounds as the longest
document has bytes, each a pass over everything.  Only strings of ``length`` bytes matter, so the
collection is cut first: every string has an anchor, the least hash of the ``gram``-byte strings in
it.  Equal strings have equal anchors at equal places.  The strings of one anchor occurrence form a
segment of ``length`` to ``2 * length`` bytes, and only segments with the same anchor can share a
string.  Segments that are equal as a whole are settled by digest; different ones with the same
anchor are the documents of a column-wise construction.  They are aligned at the anchor and, column
by column from the right, one symbol of each is inserted: the symbols in the order of the suffixes
to their right are the column of the Burrows-Wheeler transform, a stable sort by symbol gives the
next order, and the common prefix of two neighbours is one more than the least common prefix
between their former places, or zero.  Runs of common prefixes of ``length`` are equal strings.  The
collections and their results pass through Spark's sorted shuffle files, read in sequence; a task
holds a bounded number of segments at a time.

Anchors that very many documents hold (found on a bounded sample, which decides nothing else) are
dealt out by document over ``SALTS`` tasks, which settle their own segments and hand on only each
different string's first occurrence.

Null texts are empty.  Null ids come before all others.  Rows of equal ids are ordered by a hash of
their texts; rows that repeat id and text are one document, and each returns its result.  Texts
shorter than ``length`` lose nothing.  Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from webtrail.llm import common

LENGTH = 100
GRAM = 32
#: Bytes of a document looked at in one numpy step; a longer document overlaps its next step.
PIECE = 1 << 18
#: Parts of an anchor that very many documents hold.
SALTS = 32
#: Documents sampled to find those anchors (about so many at most), and the share of them that makes one.
SAMPLE, FREQUENT = 100_000, 1 / 256
#: Segments sorted together in a task.
COLLECTION = 1 << 15
#: Most bits of the filter that picks the segments to sort; 32 MB.
FILTER_BITS = 28

_U = np.uint64
_RNG = np.random.default_rng(100)
_TABLES = _RNG.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * _U(2) + _U(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        n = max(n, PIECE + 1)
        base = _BASES[which]
        _POWERS[which] = tuple(np.cumprod(np.r_[_U(1), np.full(n - 1, b, dtype=np.uint64)], dtype=np.uint64)
                               for b in (base, pow(base, -1, 1 << 64)))
    return _POWERS[which]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _U(32)) * _U(0xD6E8FEB86659FD93)
    x = (x ^ x >> _U(32)) * _U(0xD6E8FEB86659FD93)
    return x ^ x >> _U(32)


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    power, _ = _powers(which, len(data) + 1)
    return np.r_[_U(0), np.cumsum(_TABLES[which][data] * power[: len(data)], dtype=np.uint64)]


def _hash(sums: np.ndarray, which: int, a: np.ndarray | slice, b: np.ndarray | slice) -> np.ndarray:
    """Hashes of the strings from a to b (places or slices of equal length)."""
    _, inverse = _powers(which, len(sums))
    return _mix((sums[b] - sums[a]) * inverse[a])


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, anchor's place, first, end, digest) of the segments of one piece of text: its strings of
    ``length`` bytes, each run of those with the same anchor being one segment."""
    n = len(data) - length + 1
    if n <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty.view(np.uint64), empty, empty, empty, empty.view(np.uint64)
    sums = _sums(data, 0)
    grams = len(data) - gram + 1
    h = _hash(sums, 0, slice(0, grams), slice(gram, gram + grams))
    # least hash, then leftmost: hash above, place (under PIECE) below; windows by doubling
    least = h >> _U(20) << _U(20) | np.arange(grams, dtype=np.uint64)
    window, have = length - gram + 1, 1
    while have < window:
        step = min(have, window - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    place = (least & _U((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    end = np.r_[first[1:], n] + length - 1
    place = place[first]
    digest = _hash(_sums(data, 1), 1, first, end) + (place - first).astype(np.uint64) * _U(_BASES[1])
    return h[place], place, first, end, digest


def _pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes): pieces that share no string of LENGTH bytes and miss none."""
    data = np.frombuffer(text, dtype=np.uint8)
    step = PIECE - LENGTH + 1
    for at in range(0, max(1, len(data) - LENGTH + 1), step):
        yield at, data[at: at + PIECE]


def _key(ids: np.ndarray, tie: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of a segment's document and place."""
    return _mix(_mix(ids.view(np.uint64) * _U(_BASES[0]) ^ tie.view(np.uint64)) + first.astype(np.uint64) * _U(_BASES[1]))


def _scan(hot: np.ndarray, chosen: tuple[np.ndarray, int] | None, only_anchor: bool = False):
    """Segments of each document; with ``chosen`` (a bit table) those in it, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            pieces = [(row, at, data) for row, text in enumerate(common.texts(batch.column(1))) if len(text) >= LENGTH
                      for at, data in _pieces(text)]
            out, held = [], 0
            for k, (row, at, data) in enumerate(pieces):
                tie = ties[row]
                anchor, place, first, end, digest = segments(data)
                n = len(anchor)
                if only_anchor:
                    out.append((np.unique(anchor),))
                else:
                    id_, tie_ = np.full(n, ids[row]), np.full(n, tie, dtype=np.int64)
                    salt = np.zeros(n, dtype=np.int32)
                    if len(hot):
                        spot = np.searchsorted(hot, anchor).clip(max=len(hot) - 1)
                        salt[hot[spot] == anchor] = 1 + xxh64_intdigest(b"%d %d" % (ids[row], tie)) % SALTS
                    cols = [anchor, salt, digest, id_, tie_, first + at, (end - first).astype(np.int32),
                            (place - first).astype(np.int32)]
                    if chosen is not None:
                        bits, mask = chosen
                        slot = _key(id_, tie_, first + at) & _U(mask)
                        keep = (bits[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8) & 1).astype(bool)
                        cols = [c[keep] for c in cols]
                        cols.append(np.array([data[a:b].tobytes() for a, b in zip(first[keep], end[keep])], dtype=object))
                    out.append(tuple(cols))
                held += n
                if held > 100_000 or k == len(pieces) - 1:
                    yield _batch([np.concatenate(c) for c in zip(*out)])
                    out, held = [], 0

    return run


_SCANNED = ["anchor", "salt", "digest", "id", "tie", "first", "size", "lead", "data"]
_KINDS = dict(anchor="long", salt="int", digest="long", id="long", tie="long", first="long", size="int", lead="int",
              data="binary")


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {_KINDS[n]}" for n in names)


def _batch(cols: list[np.ndarray], names: list[str] | None = None) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) if c.dtype == np.uint64 else
              pa.array(c.tolist(), pa.binary()) if c.dtype == object else pa.array(c) for c in cols]
    return pa.RecordBatch.from_arrays(arrays, names=(names or _SCANNED)[: len(arrays)])


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int, enough: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups (rows sorted by their first ``n_keys`` columns), about ``enough`` rows
    at a time; a group of more rows comes in several parts."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows < enough:
            continue
        cols = [np.concatenate(x) for x in zip(*held)]
        same = np.ones(rows, dtype=bool)
        for c in cols[:n_keys]:
            same &= c == c[-1]
        cut = rows if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        yield [c[:cut] for c in cols]
        held, rows = [[c[cut:] for c in cols]], rows - cut
    if rows:
        yield [np.concatenate(x) for x in zip(*held)]


def _equal_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (anchor, salt, digest, id, tie, first): all but the first of a digest go as a
    whole.  A first one stays open if its anchor has another digest, or is dealt out."""
    last = None  # anchor, salt, digest of the row before this batch, and that row if it may yet stay open
    names = ["open", "key", "anchor", "salt", "digest", "id", "tie", "first", "size"]

    def rows(cols: list[np.ndarray], pick: np.ndarray, open_: bool) -> pa.RecordBatch:
        own = [c[pick] for c in cols[:7]]
        return _batch([np.full(len(own[0]), open_), _key(own[3], own[4], own[5]), *own], names)

    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(cols[0]):
            continue
        if last is not None:
            cols = [np.r_[a, b] for a, b in zip(last[0], cols)]
        n = len(cols[0])
        anchor, salt, digest = cols[:3]
        new_anchor = np.r_[True, (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])]
        new = new_anchor | np.r_[True, digest[1:] != digest[:-1]]
        if last is not None:  # the carried row: the first one of its digest, of its anchor or not
            new_anchor[0] = last[1]
        heads = np.flatnonzero(new)
        head = heads[np.cumsum(new) - 1]
        gone = ~new & ~_equal(cols[3:6], np.arange(n), head)  # a row that repeats the first one is the first one
        more = new_anchor[heads] & np.r_[~new_anchor[heads[1:]], False]  # its anchor has a second digest
        open_ = ~new_anchor[heads] | more | (salt[heads] > 0)
        undecided = new_anchor[heads[-1]] and not open_[-1]
        keep = heads[open_]
        if last is not None and last[2]:
            keep = keep[keep != 0]  # has gone out before
        yield rows(cols, np.flatnonzero(gone), False)
        yield rows(cols, keep, True)
        h = heads[-1]
        last = ([c[h: h + 1] for c in cols], bool(new_anchor[h]), not undecided)


def _equal(cols: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows a and b agree in all of ``cols``."""
    return np.logical_and.reduce([c[a] == c[b] for c in cols])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tie, first, size) of all but the first of equal keys; rows sorted by (key, id, tie, first)."""
    last = None  # the first row of the last key
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(cols[0]):
            continue
        if last is not None:
            cols = [np.r_[a, b] for a, b in zip(last, cols)]
        at = np.arange(len(cols[0]))
        new = np.r_[True, ~_equal(cols[:2], at[1:], at[:-1])]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        last = [c[head[-1:]] for c in cols]
        gone = ~_equal(cols[2:5], at, head)
        yield _batch([c[gone] for c in cols[2:6]], ["id", "tie", "first", "size"])


def sort_columns(group: np.ndarray, data: list[bytes], lead: np.ndarray, rank: np.ndarray, length: int = LENGTH):
    """Column-wise construction over segments aligned at their anchors; those of a group share an anchor.

    Yields for each column (segments, run): the segments whose string of ``length`` bytes starts in
    this column, in suffix order, and the number of their run of equal strings.  ``rank`` only picks
    the order within :func:`_repeats`; it has no part in the sorting."""
    n = len(data)
    sizes = np.fromiter(map(len, data), dtype=np.int64, count=n)
    flat = np.frombuffer(b"".join(data), dtype=np.uint8)
    base = np.cumsum(sizes) - sizes
    tail = sizes - lead  # columns right of the anchor's first byte, which is column 0
    begin, left = int(tail.max()), int(lead.max())
    ends: dict[int, np.ndarray] = {int(c): np.flatnonzero(tail == c) for c in np.unique(tail)}
    order, prefix = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for column in range(begin - 1, -left - 1, -1):
        if column + 1 in ends:  # their empty suffixes come first in their groups
            new = ends[column + 1]
            order, prefix = np.r_[new, order], np.r_[np.zeros(len(new), dtype=np.int64), prefix]
            by = np.argsort(group[order], kind="stable")
            order, prefix = order[by], prefix[by]
        at = column + lead[order]
        live = at >= 0
        symbol = np.where(live, flat[base[order] + np.maximum(at, 0)], 256)
        key = group[order] * 512 + symbol
        by = np.argsort(key, kind="stable")
        key = key[by]
        same = np.r_[False, (key[1:] == key[:-1]) & (symbol[by][1:] < 256)]
        # the least common prefix between the former places of neighbours, (p, q]
        p, q = by[:-1][same[1:]], by[1:][same[1:]]
        least = prefix[q]
        far = q - p > 1
        if far.any():
            lo, hi = p[far] + 1, q[far] + 1
            level = np.frexp((hi - lo).astype(float))[1] - 1
            table, worth = prefix, np.empty(len(lo), dtype=np.int64)
            for k in range(int(level.max()) + 1):
                here = level == k
                worth[here] = np.minimum(table[lo[here]], table[hi[here] - (1 << k)])
                table = np.minimum(table[: max(0, len(table) - (1 << k))], table[1 << k:])
            least[far] = worth
        order = order[by]
        prefix = np.zeros(len(order), dtype=np.int64)
        prefix[same] = least + 1
        starts = np.flatnonzero(live[by] & (at[by] + length <= sizes[order]))
        if len(starts):
            # segments whose string would run over their end stand apart: their common prefixes are shorter
            yield column, order[starts], np.cumsum(prefix < length)[starts]


def _repeats(group: np.ndarray, data: list[bytes], lead: np.ndarray, rank: np.ndarray) -> Iterator[tuple]:
    """(column, segments whose string is not the first of its kind, segments whose string is)."""
    for column, own, run in sort_columns(group, data, lead, rank):
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        least = np.minimum.reduceat(rank[own], first)
        is_first = rank[own] == np.repeat(least, np.diff(np.r_[first, len(own)]))
        yield column, own[~is_first], own[is_first]


def _sort_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings that go (w1 null), and of anchors dealt out each string's first here, by its digest."""
    names = ["w1", "w2", "id", "tie", "first", "size"]
    whole, part = None, 0
    for cols in _groups(batches, 2, COLLECTION):
        anchor, salt, _, ids, tie, first, _, lead = cols[:8]
        data = cols[8].tolist()
        # a group in several parts hands on its strings as anchors dealt out do
        over = bool(len(anchor)) and (len(set(anchor.tolist())) == 1 and len(anchor) >= COLLECTION)
        same_as_before = whole is not None and (anchor[0], salt[0]) == whole
        group = np.cumsum(np.r_[0, (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])])
        handed = (salt > 0)
        if over or same_as_before:
            handed = handed | (group == 0)
        whole = (anchor[-1], salt[-1]) if over else None
        rank, by = np.empty(len(ids), dtype=np.int64), np.lexsort((first, tie, ids))
        rank[by] = np.cumsum(np.r_[0, ~_equal([ids, tie, first], by[1:], by[:-1])])
        out_ids, out_at, hands, hand_at, digests = [], [], [], [], []
        for column, later, firsts in _repeats(group, data, lead.astype(np.int64), rank):
            out_ids.append(later)
            out_at.append(first[later] + lead[later] + column)
            firsts = firsts[handed[firsts]]
            for s in firsts.tolist():
                a = int(lead[s]) + column
                digests.append(xxh3_128_digest(data[s][a: a + LENGTH]))
            hands.append(firsts)
            hand_at.append(first[firsts] + lead[firsts] + column)
        if out_ids:
            # strings of a segment that follow one another are one removal
            s, at = np.concatenate(out_ids), np.concatenate(out_at)
            by = np.lexsort((at, s))
            s, at = s[by], at[by]
            if len(s):
                head = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (at[1:] != at[:-1] + 1)])
                last = np.r_[head[1:], len(s)] - 1
                none = pa.nulls(len(head), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, *(pa.array(x) for x in (
                    ids[s[head]], tie[s[head]], at[head], (at[last] - at[head] + LENGTH).astype(np.int32)))], names=names)
            if digests:
                s, w = np.concatenate(hands), np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    w[:, 0].copy(), w[:, 1].copy(), ids[s], tie[s], np.concatenate(hand_at),
                    np.full(len(s), LENGTH, dtype=np.int32))], names=names)


def frequent_anchors(docs: DataFrame) -> np.ndarray:
    """Anchors that more than a share FREQUENT of a sample of about SAMPLE documents hold, sorted: the
    same share at every size of the corpus, and a bounded number of them."""
    n = docs.count()
    share = max(1, -(-n // SAMPLE))
    some = docs.filter(F.pmod(F.xxhash64("id", F.lit(4)), F.lit(share)) == 0)
    found = some.mapInArrow(_scan(np.zeros(0, dtype=np.uint64), None, True), "anchor long").groupBy("anchor").count()
    rows = found.filter(F.col("count") >= max(50, FREQUENT * n / share)).select("anchor").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _removals(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(id, tie, first, size): strings to remove from each document; they may overlap."""
    spark = docs.sparkSession
    names = _SCANNED[:7]
    scanned = docs.mapInArrow(_scan(hot, None), _schema(_SCANNED[:8])).select(*names)
    order = ["anchor", "salt", "digest", "id", "tie", "first"]
    first = common.stored(
        scanned.repartition("anchor", "salt").sortWithinPartitions(*order).mapInArrow(
            _equal_segments, "open boolean, key long, " + _schema(names)), "suffix-segments")
    gone = first.filter("not open").select("id", "tie", "first", "size")
    dealt = first.filter("open and salt > 0").select("anchor", "digest", "id", "tie", "first", "size")
    gone_dealt = dealt.repartition("anchor", "digest").sortWithinPartitions(
        "anchor", "digest", "id", "tie", "first").mapInArrow(_settle, _schema(["id", "tie", "first", "size"]))

    # a bit table of bounded size picks the open segments in a second scan; what it lets through
    # besides is sorted too and changes nothing
    n = first.filter("open").count()
    bits = min(FILTER_BITS, max(18, (16 * n).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1)) + 1  # Spark's bit tables begin at 1
    maps = first.filter("open").groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toArrow()
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for bucket, part in zip(maps.column(0).to_pylist(), maps.column(1).to_pylist()):
        table[(bucket - 1) * 4096: bucket * 4096] = np.frombuffer(part, dtype=np.uint8)
    shared = spark.sparkContext.broadcast((table, (1 << bits) - 1))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scan(hot, shared.value)(batches)

    strings = common.stored(
        docs.mapInArrow(chosen, _schema(_SCANNED)).repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
        .mapInArrow(_sort_segments, "w1 long, w2 long, id long, tie long, first long, size int"), "suffix-strings")
    gone_strings = strings.filter("w1 is null").select("id", "tie", "first", "size")
    across = strings.filter("w1 is not null").repartition("w1", "w2").sortWithinPartitions(
        "w1", "w2", "id", "tie", "first").mapInArrow(_settle, _schema(["id", "tie", "first", "size"]))
    return gone.union(gone_dealt).union(gone_strings).union(across)


def _cut(text: bytes, spans: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, what remains)."""
    kept, removed, runs, end = [], 0, 0, 0
    for a, b in sorted((x["first"], x["first"] + x["size"]) for x in spans):
        if a > end or not runs:
            kept.append(text[end:a])
            runs += 1
            end = a
        if b > end:
            removed += b - end
            end = b
    kept.append(text[end:])
    return removed, runs, b"".join(kept)


def _report(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, spans = common.texts(batch.column(1)), batch.column(2).to_pylist()
            found = [_cut(t, s or []) for t, s in zip(values, spans)]
            cols = [batch.column(0), pa.array(list(map(len, values)), pa.int64()),
                    pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                    pa.array([hashlib.sha256(x[2]).hexdigest() for x in found])]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                cols.append(pa.array([x[2] for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=names + ["kept"] * keep_text)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False,
                   hot: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of ``docs``, by the rule of this
    module; with ``keep_text`` also the remaining bytes, ``kept``.  Ids are whole numbers.  ``hot``:
    the anchors to deal out, if they are known (:func:`frequent_anchors`)."""
    none = -(1 << 63)  # a null id, before all others
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(none)).alias("id"), F.col(text).alias("t"),
                       F.xxhash64(text).alias("tie"))
    hot = frequent_anchors(rows) if hot is None else hot
    spans = _removals(rows, hot).groupBy("id", "tie").agg(F.collect_list(F.struct("first", "size")).alias("spans"))
    joined = rows.join(spans, ["id", "tie"], "left").select(
        F.when(F.col("id") != none, F.col("id")).alias("doc_id"), "t", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_report(keep_text), schema + ", kept binary" * keep_text)
