"""Target-distribution importance resampling on hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks all separators of the UTF-8 text, ``bytes.split`` gives
the words, and ``zlib.crc32`` seeded with the checksum of the shorter run extends it by a space and
a word: no n-gram is ever built.  Counters reduce the buckets of a task; a shuffle of at most
``buckets`` rows a task adds them up.  A second pass sums each document's gains, and the documents
that may be drawn are ranked by weight plus Gumbel noise of their id (sampling without replacement).

Long texts are read in pieces that end at a separator and carry the last words on, so a task holds
the words of one piece only.  What goes to the tasks is one number a bucket.

Defined results: null text has no words (weight 0); a null id hashes as empty text and comes last
among ties; equal ids with equal scores are drawn in any order; an empty table gives no rows, an
empty target counts nothing (gains come from the table alone); other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common
from webtrail.operators.sequence import global_sequence

_KEPT_BYTES = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
#: Lower case for A-Z; every byte that is no part of a word becomes a space.
TABLE = bytes(b if b in _KEPT_BYTES else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Bytes of a text that are split at a time.
PIECE_BYTES = 1 << 20


def _pieces(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; a piece ends at a separator."""
    text = text.translate(TABLE)
    at = 0
    while len(text) - at > size:
        cut = text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut
    yield text[at:].split()


def features(text: bytes, longest: int = 3, size: int = PIECE_BYTES) -> Iterator[tuple[int, list[int]]]:
    """(words, checksums of the runs of 1 to ``longest`` words that end in the piece) for each piece."""
    carried: list[bytes] = []
    for words in _pieces(text, size):
        known, words = len(carried), carried + words
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        found = sums[known:]
        for n in range(1, longest):
            sums = list(map(crc32, spaced[n:], sums))
            found += sums[max(0, known - n):]
        yield len(words) - known, found
        carried = words[-(longest - 1):] if longest > 1 else []


def _counting(buckets: int, longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in common.texts(batch.column(0)):
                for _, sums in features(text, longest):
                    total.update((np.array(sums, np.int64) % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()), pa.array(list(total.values()), pa.int64())],
                                         names=["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, longest: int) -> DataFrame:
    """(bucket int, n long): how often features of all texts fall into each bucket that any falls into."""
    return (texts.select(F.col(text_col).cast("string")).mapInArrow(_counting(buckets, longest), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Each bucket's floor(1000 ln(target share / source share)), counts smoothed by one."""
    found = np.zeros((2, buckets))
    for i, counts in enumerate((source, target)):
        for row in counts.collect():  # at most ``buckets`` rows
            found[i, row.bucket] = row.n
    (s, t), (all_s, all_t) = found, found.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def _weighing(values: np.ndarray, longest: int) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, count, weight = [], [], []
            for text in common.texts(batch.column(1)):
                w = n = total = 0
                for new, sums in features(text, longest):
                    w, n = w + new, n + len(sums)
                    total += int(values[np.array(sums, np.int64) % len(values)].sum())
                words.append(w)
                count.append(n)
                weight.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (words, count, weight)]],
                                             names=["id", "n_words", "n_features", "weight"])

    return weigh


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 5,
         min_words: int = 20, buckets: int = 10_000, longest: int = 3, seed: int = 42) -> DataFrame:
    """Every document's (id, n_features, weight, score, rank), all long; rank is null where it is not
    drawn.  Of the N documents of at least ``min_words`` words, floor(percent * N / 100) are drawn."""
    values = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, text_col, buckets, longest), buckets)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _weighing(values, longest), "id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = common.stored(rows.withColumn("score", F.col("weight") + noise), "resampling")
    able = F.col("n_words") >= min_words
    wanted = rows.filter(able).count() * percent // 100
    ranked = global_sequence(rows.filter(able), [F.col("score").desc(), F.col("id").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    both = ranked.unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return both.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
