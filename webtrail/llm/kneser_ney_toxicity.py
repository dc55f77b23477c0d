"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models with the discount 0.75, one of toxic and one of ordinary texts, hold
every count.  A bigram falls back to its word's continuation count in the class (after how many
different words it occurs), and that to the continuation count of both classes together, which
the models share.  Words that a few texts repeat, or copies of a text bring, have few different
neighbours and so little weight.

An expression's log-ratio (toxic against ordinary) counts in a text by its evidence: it is
multiplied by 1 - ``sure`` / G, where G is the square root of the likelihood-ratio statistic of its
counts in the two classes (of continuation counts for words, of counts for bigrams), and by 0 where
G is below ``sure``.  A bigram without evidence is its word.  Only expressions of a weight over 0
are collected and broadcast; they are found with all counts, without any limit on their number.

A text is judged by two length-normalised log-likelihood ratios, per word: that of its most toxic
passage, a single word in its context, and that of the whole text.  A logistic curve, fitted on
labelled texts that the counts left out, makes them a score; by cross-fitting, each fold is judged
by the counts of the others, and the model counts them all.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased, held as 64-bit
hashes.  Counts cover all labelled texts of the training folds.

Null and empty texts have both ratios 0 and get the curve's value there.  Rows without a label of
0 or 1 don't train.  Without labelled texts of both classes the score is the share of toxic ones,
0 if there are none.  Repeated rows count each, ties share a score, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common
from webtrail.llm.spaced_seeds import Words, words

DISCOUNT = 0.75
#: The evidence a word, and a bigram, needs to count at all: of many more bigrams, more look telling by chance.
SURE, SURE_PAIR = 2.0, 6.0
#: Labelled texts the curve is fitted on, at most.
CURVE_TEXTS = 20_000
CHUNK = 1 << 20
#: Most bigrams in a row of the counts' shuffle, and rows in a batch.
ROW_PAIRS, BATCH_ROWS = 1 << 16, 1 << 14
_START = np.uint64(1)  # the context of a text's first word


def _contexts(w: Words) -> np.ndarray:
    before = np.r_[_START, w.hashes[:-1]][: len(w.hashes)]
    first = w.first[w.first < len(w.hashes)]
    before[first] = _START
    return before


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (v * np.uint64(0x9E3779B97F4A7C15) ^ w) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(32)


def _merge(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """Sorted different (w, v) of the parts (w, v, n of each kind), with their counts added up."""
    w, v, *n = (np.concatenate(x) for x in zip(*parts))
    by = np.lexsort((v, w))
    w, v = w[by], v[by]
    if not len(w):
        return w, v, *n
    first = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
    return w[first], v[first], *(np.add.reduceat(x[by], first, dtype=np.int32) for x in n)


def _counter(kinds: int, hot: dict[int, int]):
    """For rows (kind below ``kinds``, t): a task's counts of bigrams (v, w) in rows (w, part, vs, ns), where
    ns is n * kinds + kind.  A word that follows very many others is dealt out by
    them over ``hot`` parts, other words have one."""
    hot_words = np.array(sorted(hot), dtype=np.int64)
    parts_of = np.array([hot[x] for x in hot_words.tolist()], dtype=np.uint64)

    def part(w: np.ndarray, v: np.ndarray) -> np.ndarray:
        if not len(hot_words):
            return np.zeros(len(w), dtype=np.int32)
        at = np.searchsorted(hot_words, w).clip(max=len(hot_words) - 1)
        return np.where(hot_words[at] == w, _pair(v, v) % parts_of[at], np.uint64(0)).astype(np.int32)

    def packed(w: np.ndarray, v: np.ndarray, *n: np.ndarray) -> Iterator[pa.RecordBatch]:
        row, kind = np.nonzero(np.stack(n, 1))
        coded = np.stack(n, 1)[row, kind] * np.int32(kinds) + kind.astype(np.int32)
        w, v = w[row].view(np.int64), v[row]
        dealt = part(w, v)
        by = np.lexsort((dealt, w))
        w, v, dealt, coded = w[by], v[by].view(np.int64), dealt[by], coded[by]
        change = (w[1:] != w[:-1]) | (dealt[1:] != dealt[:-1])
        first = np.flatnonzero(np.r_[True, change] | (np.arange(len(w)) % ROW_PAIRS == 0))
        ends = np.r_[first[1:], len(w)]
        for lo in range(0, len(first), BATCH_ROWS):
            f, e = first[lo: lo + BATCH_ROWS], ends[lo: lo + BATCH_ROWS]
            offsets = pa.array((np.r_[f, e[-1]] - f[0]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[f[0]: e[-1]])) for x in (v, coded)]
            yield pa.RecordBatch.from_arrays([pa.array(w[f]), pa.array(dealt[f]), *lists], names=["w", "part", "vs", "ns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            kind, values = batch.column(0).to_numpy(), common.texts(batch.column(1))
            for lo, hi in common.chunks(values, CHUNK):
                found = words(values[lo:hi])
                of = kind[lo:hi][found.text]
                n = [(of == k).astype(np.int32) for k in range(kinds)]
                held.append(_merge([(found.hashes, _contexts(found), *n)]))
                if len(held) > 8:
                    held = [_merge(held)]
        if held:
            w, v, *n = _merge(held)
            if len(w):
                yield from packed(w, v, *n)

    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in common.chunks(values := common.texts(batch.column(0)), CHUNK):
            w, n = np.unique(words(values[lo:hi]).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])


def _hot(rows: DataFrame) -> dict[int, int]:
    """Words with more than a fourth of a shuffle partition's even share of all words in a sample of the
    texts, with the number of such shares: at most four words a partition.  It only sets where rows go."""
    shares = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = _sample(rows, CURVE_TEXTS).select("t").mapInArrow(_frequent, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    n = common.stored(n, "toxic-words")
    total = n.agg(F.sum("n")).first()[0] or 0
    return {r.w: 1 + r.n * shares // total for r in n.filter(F.col("n") * shares > total).collect()}


def _counts(rows: DataFrame, kinds: int) -> DataFrame:
    """Stored (v, w, c0, c1, ...) of all rows (kind, t).

    The shuffle moves a word once a task and part, with the words before it as one array: a bigram
    takes eight bytes and its counts.  The aggregation then needs no further exchange."""
    packed = rows.select("kind", "t").mapInArrow(
        _counter(kinds, _hot(rows)), "w long, part int, vs array<long>, ns array<int>").repartition("w", "part")
    each = packed.select("w", "part", F.explode(F.arrays_zip("vs", "ns")).alias("x")).select(
        "w", "part", F.col("x.vs").alias("v"), (F.col("x.ns") % kinds).alias("kind"), F.expr(f"x.ns div {kinds}").alias("n"))
    return common.stored(each.groupBy("w", "part", "v").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(kinds))).select(
        "v", "w", *(f"c{k}" for k in range(kinds))), "toxic-counts")


@dataclass
class Model:
    """Weighted log-ratios of the words and bigrams with evidence, sorted by hash; all others' are 0."""

    word: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    word_ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    curve: tuple[float, float, float] | None = None

    def ratios(self, values: list[bytes]) -> np.ndarray:
        """[text, 2]: the highest ratio of a passage, and the whole text's, both per word."""
        out = np.zeros((len(values), 2))
        for lo, hi in common.chunks(values, CHUNK):
            w = words(values[lo:hi])
            if not len(w.hashes):
                continue
            ratio = self._find(self.word, self.word_ratio, w.hashes)[0]
            pairs, has = self._find(self.pair, self.pair_ratio, _pair(_contexts(w), w.hashes))
            ratio = np.where(has, pairs, ratio)
            rows, first = np.unique(w.text, return_index=True)
            out[lo + rows, 0] = np.maximum.reduceat(ratio, first)
            out[lo + rows, 1] = np.add.reduceat(ratio, first) / np.diff(np.r_[first, len(ratio)])
        return out

    @staticmethod
    def _find(keys: np.ndarray, worth: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), dtype=bool)
        at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
        known = keys[at] == wanted
        return np.where(known, worth[at], 0.0), known


def _evidence(n0: Column, n1: Column, total0: float, total1: float) -> Column:
    """Square root of the likelihood-ratio statistic of two counts against equal rates."""
    part = lambda n, total: F.when(n > 0, n * F.log(n * (total0 + total1) / ((n0 + n1) * total))).otherwise(0.0)
    return F.sqrt(F.greatest(2 * (part(n0, float(total0)) + part(n1, float(total1))), F.lit(0.0)))


def _weighted(ratio: Column, evidence: Column, sure: float) -> Column:
    return F.when(evidence > sure, ratio * (1 - sure / evidence)).otherwise(0.0)


def _keeps(n: Column) -> Column:
    return F.greatest(n - DISCOUNT, F.lit(0.0))


def count(labelled: DataFrame, sure: float = SURE, sure_pair: float = SURE_PAIR) -> Model:
    """The models' log-ratios from rows (label 0 or 1, t)."""
    return _models(_counts(labelled.withColumnRenamed("label", "kind"), 2), [[0]], sure, sure_pair)[0]


def _models(counts: DataFrame, sets: list[list[int]], sure: float, sure_pair: float) -> list[Model]:
    """For each set of folds, the model of their texts, from (v, w, c0, c1, ...): the counts in ordinary
    and toxic texts of the first fold, of the second, and so on.  All models in one pass."""
    def n(j: int, k: int) -> Column:
        return sum((F.col(f"c{2 * i + k}") for i in sets[j]), F.lit(0))

    def collected(rows: DataFrame, keys: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        found = rows.select(*keys, *(f"r{j}" for j in alive)).toArrow()
        columns = [c.to_numpy() for c in found.columns]
        return [c.view(np.uint64) for c in columns[: len(keys)]], columns[len(keys):]

    every = range(len(sets))
    both = [(j, k) for j in every for k in (0, 1)]
    by_word = common.stored(counts.groupBy("w").agg(
        *(F.count_if(n(j, k) > 0).alias(f"m{j}_{k}") for j, k in both),
        *(F.sum(n(j, k)).alias(f"t{j}_{k}") for j, k in both),
        *(F.count_if(n(j, 0) + n(j, 1) > 0).alias(f"m{j}") for j in every)), "toxic-continued")
    sums = by_word.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in by_word.columns if c != "w"),
                       *(F.count_if(F.col(f"m{j}_{k}") > 0).alias(f"kinds{j}_{k}") for j, k in both)).first().asDict()
    models = [Model() for _ in every]
    alive = [j for j in every if sums[f"t{j}_0"] and sums[f"t{j}_1"]]
    if not alive:
        return models

    def p(j: int, k: int) -> Column:
        """Of a word without its context: what its own continuation count keeps, the rest by both classes'."""
        own, of = F.col(f"m{j}_{k}"), float(sums[f"m{j}_{k}"])
        rest = DISCOUNT * sums[f"kinds{j}_{k}"] / of
        return _keeps(own) / of + rest * F.col(f"m{j}") / float(sums[f"m{j}"])

    word_worth = {f"r{j}": F.when(F.col(f"m{j}") > 0, _weighted(
        F.log(p(j, 1) / p(j, 0)), _evidence(F.col(f"m{j}_0"), F.col(f"m{j}_1"), sums[f"m{j}_0"], sums[f"m{j}_1"]), sure)
    ).otherwise(0.0) for j in alive}
    told = by_word.withColumns(word_worth).filter(F.greatest(*(F.abs(f"r{j}") for j in alive), F.lit(0.0)) > 0)
    (word,), worth = collected(told, ["w"])
    for j, x in zip(alive, worth):
        at = np.flatnonzero(x)
        at = at[np.argsort(word[at])]
        models[j].word, models[j].word_ratio = word[at], x[at]

    # n occurrences have at most n times the statistic of one in the rarer class
    one = max(2 * np.log((sums[f"t{j}_0"] + sums[f"t{j}_1"]) / min(sums[f"t{j}_0"], sums[f"t{j}_1"])) for j in alive)
    all_counts = sum((F.col(c) for c in counts.columns if c not in ("v", "w")), F.lit(0))
    pairs = counts.filter(all_counts * float(one) >= 0.999 * sure_pair ** 2)
    pairs = pairs.withColumns({f"e{j}": F.when(n(j, 0) + n(j, 1) > 0, _evidence(
        n(j, 0), n(j, 1), sums[f"t{j}_0"], sums[f"t{j}_1"])).otherwise(0.0) for j in alive})
    pairs = common.stored(pairs.filter(F.greatest(*(F.col(f"e{j}") for j in alive), F.lit(0.0)) > sure_pair), "toxic-pairs")
    before = counts.join(pairs.select(F.col("v").alias("own")).distinct(), F.col("v") == F.col("own"), "left_semi").groupBy(
        F.col("v").alias("context")).agg(
        *(F.sum(n(j, k)).alias(f"s{j}_{k}") for j, k in both), *(F.count_if(n(j, k) > 0).alias(f"f{j}_{k}") for j, k in both))

    def q(j: int, k: int) -> Column:
        of = F.col(f"s{j}_{k}")
        return F.when(of > 0, _keeps(n(j, k)) / of + DISCOUNT * F.col(f"f{j}_{k}") / of * p(j, k)).otherwise(p(j, k))

    rows = pairs.join(before, F.col("v") == F.col("context")).join(
        by_word.withColumnRenamed("w", "word"), F.col("w") == F.col("word")).withColumns({f"r{j}": F.when(
            F.col(f"e{j}") > sure_pair, _weighted(F.log(q(j, 1) / q(j, 0)), F.col(f"e{j}"), sure_pair)).otherwise(0.0)
            for j in alive})
    (v, w), worth = collected(rows, ["v", "w"])
    pair = _pair(v, w)
    for j, x in zip(alive, worth):
        at = np.flatnonzero(x)
        at = at[np.argsort(pair[at])]
        models[j].pair, models[j].pair_ratio = pair[at], x[at]
    return models


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve with a slight penalty on its slopes: classes that part cleanly have no best one."""
    design = np.c_[np.ones(len(x)), x]
    beta, penalty = np.zeros(3), np.array([1e-6, 0.05, 0.05])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - penalty * beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty), grad)
        beta += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(beta)


def _ratios(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = model.ratios(common.texts(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())],
                                         names=["id", "passage", "whole"])


def _labelled(df: DataFrame, text: str, label: str, *more: Column) -> DataFrame:
    return df.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), F.col(text).alias("t"), *more)


def _sample(rows: DataFrame, curve_texts: int) -> DataFrame:
    """About ``curve_texts`` of the rows at most: an even share by the hash of their texts."""
    n = rows.count()
    if n <= curve_texts:
        return rows
    # a little below the bound
    return rows.filter(F.pmod(F.xxhash64("t", F.lit(8)), F.lit(1 << 20)) < int((1 << 20) * 0.9 * curve_texts / n))


def _judged(model: Model, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(labels, ratios) of rows (label, t)."""
    found = rows.select(F.col("label").alias("id"), "t").mapInArrow(
        lambda batches: _ratios(model, batches), "id int, passage double, whole double").toArrow()
    return found.column(0).to_numpy().astype(float), np.c_[found.column(1).to_numpy(), found.column(2).to_numpy()]


def _with_curve(model: Model, y: np.ndarray, x: np.ndarray) -> Model:
    # in order of their values, so that sums, and so the curve, do not depend on how rows arrive
    by = np.lexsort((y, x[:, 1], x[:, 0]))
    model.prior = float(y.mean()) if len(y) else 0.0
    if len(np.unique(y)) == 2 and (len(model.word) or len(model.pair)):
        model.curve = _fit_curve(x[by], y[by])
    return model


def fit(counted: DataFrame, left_out: DataFrame, text: str = "text", label: str = "label", sure: float = SURE,
        sure_pair: float = SURE_PAIR, curve_texts: int = CURVE_TEXTS) -> Model:
    """Models of all rows of ``counted``, and the curve from about ``curve_texts`` rows of ``left_out``
    at most: an even share by the hash of their texts."""
    model = count(_labelled(counted, text, label), sure, sure_pair)
    return _with_curve(model, *_judged(model, _sample(_labelled(left_out, text, label), curve_texts)))


def cross_fit(labelled: DataFrame, fold: Column, folds: Sequence[int], text: str = "text", label: str = "label",
              sure: float = SURE, sure_pair: float = SURE_PAIR, curve_texts: int = CURVE_TEXTS) -> Model:
    """Models of all rows of ``labelled`` in ``folds``.  The curve is from about ``curve_texts`` of them at
    most, each judged by models of the other folds.  Texts are counted once, by fold and label."""
    place = F.coalesce(*(F.when(fold == f, i) for i, f in enumerate(folds)))
    rows = _labelled(labelled, text, label, place.alias("place")).filter("place is not null")
    counts = _counts(rows.withColumn("kind", F.col("place") * 2 + F.col("label")), 2 * len(folds))

    own = list(range(len(folds)))
    *left, whole = _models(counts, [[i for i in own if i != k] for k in own] + [own], sure, sure_pair)
    sample = _sample(rows, curve_texts)
    judged = [_judged(left[i], sample.filter(F.col("place") == i)) for i in own]
    return _with_curve(whole, *(np.concatenate(x) for x in zip(*judged)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, passage, whole): one row for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in _ratios(model, batches):
            x = np.c_[batch.column(1).to_numpy(), batch.column(2).to_numpy()]
            worth = np.full(len(x), model.prior)
            if model.curve:
                worth = 1 / (1 + np.exp(-np.clip(model.curve[0] + x @ np.array(model.curve[1:]), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(worth), batch.column(1), batch.column(2)],
                                             names=["id", "score", "passage", "whole"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, passage double, whole double").withColumnRenamed("id", doc_id)
