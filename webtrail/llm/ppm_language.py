"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree of variable order (0 to 3 preceding bytes) is counted
over the labelled texts.  With its statistics frozen, the code length of a byte is that of
escape method C: a symbol seen ``c`` times in a context with ``n`` symbols, ``d`` of them
different, costs ``-log2(c / (n + d))``; an unseen one costs an escape ``-log2(d / (n + d))``
and is coded in the next shorter context, at last uniformly over 256 bytes.  A text belongs to
the language that codes it in the fewest bits.

Counting is one aggregation over all labelled texts.  The model holds every language's whole
tree, however large the others are: what is collected and broadcast grows with the different
grams (four bytes each), not with the texts.

Null texts and texts without a letter give ``und`` and score 0.  With no labelled text every
row gives ``und``.  Rows with a null language never train.  Ties between languages go to the
first by code point.  Repeated rows count, and return, each time; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common

ORDER = 3
PAD = b"\0" * ORDER
UNKNOWN = "und"
CHUNK = 1 << 20
#: Contexts of an order up to which its tables (1 KB each) are built; beyond it grams are searched.
TABLE_CONTEXTS = 1 << 16


def _grams(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(each byte with the three before it as one number, first gram of each text)."""
    data = np.frombuffer(PAD + PAD.join(values), dtype=np.uint8).astype(np.uint32)
    grams = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    keep = np.ones(len(grams), dtype=bool)  # without the bytes of the padding between texts
    for k in range(ORDER):
        at = starts[1:] - 1 - k
        keep[at] = False
    return grams[keep], np.cumsum(sizes) - sizes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task: merged as it goes, so a task holds its different grams only."""
    common.forget()
    held: dict[str, list] = {}

    def merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, dtype=np.int64)
        return grams[first], np.add.reduceat(counts, first) if len(first) else counts

    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), common.texts(batch.column(1))):
            by_lang.setdefault(lang, []).append(text)
        for lang, values in by_lang.items():
            for lo, hi in common.chunks(values, CHUNK):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(_grams(values[lo:hi])[0], return_counts=True))
                if len(parts) > 16:
                    held[lang] = [merge(parts)]
    for lang, parts in held.items():
        grams, counts = merge(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)),
                                          pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


@dataclass
class Model:
    """Frozen statistics: grams (context and symbol) with their counts, for each language."""

    languages: list[str]
    counts: list[tuple[np.ndarray, np.ndarray]]


def _most_frequent(counts: DataFrame, max_nodes: int) -> DataFrame:
    """About ``max_nodes`` rows: the most frequent grams of each language within an even share, one
    at least; what a small language leaves of its share goes to the larger ones."""
    sizes = sorted((r["count"], r.lang) for r in counts.groupBy("lang").count().collect())
    out, room = counts.limit(0), max_nodes
    for k, (size, lang) in enumerate(sizes):
        share = min(size, max(1, room // (len(sizes) - k)))
        room -= share
        out = out.union(counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(share))
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", max_nodes: int | None = None) -> Model:
    """Count the context trees of all rows of ``docs`` with a language.

    ``max_nodes``, if given, bounds the longest contexts kept over all languages, with an even
    share for each; shorter contexts are summed from them."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("t"))
    counts = common.stored(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "ppm-counts")
    kept = (counts if max_nodes is None else _most_frequent(counts, max_nodes)).toArrow().combine_chunks()
    if not kept.num_rows:
        return Model([], [])
    code = kept.column("lang").chunk(0).dictionary_encode()
    at, names = code.indices.to_numpy(), code.dictionary.to_pylist()
    gram, n = kept.column("gram").to_numpy().astype(np.uint32), kept.column("n").to_numpy()
    by = np.lexsort((gram, at))
    ends = np.cumsum(np.bincount(at, minlength=len(names)))
    trees = {x: (gram[own], n[own]) for x, own in zip(names, np.split(by, ends[:-1]))}
    languages = sorted(trees, key=lambda x: x.encode())
    return Model(languages, [trees[x] for x in languages])


class Coder:
    """Code lengths by direct lookup: a trie over all languages' grams for each order, or, where it
    would be too wide, the sorted grams."""

    def __init__(self, model: Model):
        self.n = len(model.languages)
        self.steps, self.costs, self.escapes = [], [], []
        below = np.full((1, self.n), 8.0, dtype=np.float32)  # the uniform code
        self.uniform = below[0]
        for order in range(ORDER + 1):
            mask = np.uint32((1 << 8 * (order + 1)) - 1) if order < 3 else np.uint32(0xFFFFFFFF)
            own = []
            for grams, counts in model.counts:
                g, inv = np.unique(grams & mask, return_inverse=True)
                own.append((g, np.bincount(inv, counts).astype(np.float64)))
            symbols = np.unique(np.concatenate([g for g, _ in own]))
            contexts = np.unique(symbols >> np.uint32(8))
            # what the next shorter context takes for each gram: the cost if a language escapes
            lower = self._lookup(symbols, order - 1) if order else np.tile(self.uniform, (len(symbols), 1))
            cost, escape = np.empty((len(symbols), self.n), np.float32), np.zeros((len(contexts), self.n), np.float32)
            at_context = np.searchsorted(contexts, symbols >> np.uint32(8))
            for k, (g, c) in enumerate(own):
                at = np.searchsorted(symbols, g)
                total = np.bincount(at_context[at], c, len(contexts))
                kinds = np.bincount(at_context[at], minlength=len(contexts))
                seen = kinds > 0
                escape[seen, k] = np.log2((total + kinds)[seen] / kinds[seen])
                cost[:, k] = escape[at_context, k] + lower[:, k]
                cost[at, k] = np.log2((total + kinds)[at_context[at]] / c)
            self.steps.append(self._trie(symbols, order) if len(contexts) <= TABLE_CONTEXTS else symbols)
            self.costs.append(cost)
            self.escapes.append((contexts, escape))

    @staticmethod
    def _trie(symbols: np.ndarray, order: int) -> list[np.ndarray]:
        """Tables [node * 256 + byte] -> node of the next level, -1 where there is none."""
        out = []
        parent = np.zeros(1, dtype=np.uint32)
        for level in range(order + 1):
            prefix = np.unique(symbols >> np.uint32(8 * (order - level)))
            table = np.full(len(parent) * 256, -1, dtype=np.int32)
            at = np.searchsorted(parent, prefix >> np.uint32(8)) if level else np.zeros(len(prefix), dtype=np.int64)
            table[at * 256 + (prefix & np.uint32(255))] = np.arange(len(prefix), dtype=np.int32)
            out.append(table)
            parent = prefix
        return out

    def _lookup(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Code lengths [gram, language] of each gram's last byte after ``order`` bytes."""
        node = np.zeros(len(grams), dtype=np.int64)
        known, steps = None, self.steps[order]
        if isinstance(steps, np.ndarray):
            own = grams & np.uint32((1 << 8 * (order + 1)) - 1)
            node = np.searchsorted(steps, own).clip(max=len(steps) - 1)
            known, steps = steps[node] == own, []
        for level, table in enumerate(steps):
            byte = grams >> np.uint32(8 * (order - level)) & np.uint32(255)
            node = table[node * 256 + byte]
            if (node < 0).any():
                known = node >= 0 if known is None else known & (node >= 0)
                node = np.where(node < 0, 0, node)
        if known is None or known.all():
            return self.costs[order][node]
        out = self.costs[order][node]
        rest = grams[~known]
        lower = self._lookup(rest, order - 1) if order else np.tile(self.uniform, (len(rest), 1))
        contexts, escape = self.escapes[order]
        context = rest >> np.uint32(8) & np.uint32((1 << 8 * order) - 1)
        at = np.searchsorted(contexts, context).clip(max=len(contexts) - 1)
        out[~known] = lower + np.where((contexts[at] == context)[:, None], escape[at], 0)
        return out

    def bits(self, values: list[bytes]) -> np.ndarray:
        """Code lengths [text, language] of whole texts, in bits."""
        out = np.zeros((len(values), self.n))
        limit = max(1 << 14, CHUNK * 4 // max(4, self.n))
        for lo, hi in common.chunks(values, limit):
            grams, starts = _grams(values[lo:hi])
            sizes = np.diff(np.r_[starts, len(grams)])
            for k in range(0, len(grams), limit):  # a very long text goes piece by piece
                cost = self._lookup(grams[k: k + limit], ORDER)
                a, b = np.searchsorted(starts, [k, k + len(cost)], "right")
                rows = np.flatnonzero(sizes[max(0, a - 1): b] > 0) + max(0, a - 1)
                rows = rows[(starts[rows] + sizes[rows] > k) & (starts[rows] < k + len(cost))]
                out[lo + rows] += np.add.reduceat(cost, np.maximum(starts[rows] - k, 0), axis=0, dtype=np.float64)
        return out


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out``: lang, score (0 to 1: the language's share of the probability
    that the models give the text) and bits_per_byte under the language's model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    index, key = docs.columns.index(text), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        coder = common.kept(key, lambda: Coder(model)) if model.languages else None
        for batch in batches:
            values = common.texts(batch.column(index))
            n = len(values)
            letters = np.fromiter((any(map(str.isalpha, x.decode("utf-8", "replace"))) for x in values), bool, n)
            langs, score, rate = np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.zeros(n)
            known = letters & (coder is not None)
            if known.any():
                bits = coder.bits([values[i] for i in np.flatnonzero(known)])
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(best)), best]
                langs[known] = np.array(model.languages, dtype=object)[best]
                score[known] = 1 / np.exp2(np.minimum(0, low[:, None] - bits)).sum(axis=1)
                rate[known] = low / np.array([len(values[i]) for i in np.flatnonzero(known)])
            found = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score), pa.array(rate)],
                                               names=["lang", "score", "bits_per_byte"])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    schema = docs.select("*", F.lit(None).cast("struct<lang:string,score:double,bits_per_byte:double>").alias(out)).schema
    return docs.mapInArrow(run, schema)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def identify(docs: DataFrame, train: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             max_nodes: int | None = None) -> DataFrame:
    """(id, lang_pred, score, bits_per_byte) of each row of ``docs`` by models of ``train``."""
    model = fit(train, text, lang, max_nodes)
    rows = predict(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")), model, "t", "found")
    return rows.select(F.col("id").alias(doc_id), F.col("found.lang").alias("lang_pred"), "found.score",
                       "found.bits_per_byte")


def reject_unknown(docs: DataFrame, train: DataFrame, text: str = "text", lang: str = "lang",
                   max_bits_per_byte: float = 6.0, max_nodes: int | None = None) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose language is known: not ``und``, and coded
    in at most ``max_bits_per_byte`` by the best model (uniform bytes take 8, ordinary prose 2 to 4)."""
    found = "__llm_language"
    rows = predict(docs, fit(train, text, lang, max_nodes), text, found)
    kept = (F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.bits_per_byte") <= max_bits_per_byte)
    return rows.filter(kept).drop(found)
