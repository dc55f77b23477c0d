import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import mixture


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        held = sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        t = {s: most * sizes[s] if s in full else (total - held) * w[s] / free for s in names}
        over = {s for s in names if s not in full and t[s] >= most * sizes[s]}
        if not over:
            return t
        full |= over
        if full == set(names):
            return {s: float(most * sizes[s]) for s in names}


def corpus(n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = "b" if rnd.random() < 0.35 else rnd.choice(["a", "é", "Z", "z10", None, "tiny", ""])
        if s == "tiny" and rnd.random() < 0.9:
            s = "a"
        words = int(rnd.lognormvariate(4, 1)) if rnd.random() < 0.95 else 0
        rows.append((i, "\t".join(["wörd"] * words), s))
    rows += [(n, None, "a"), (n + 1, " \n ", "b"), (n + 2, "x " * 40000, "Z"), (None, "one two", "b"), (n + 3, "", "empty"),
             (n + 3, "", "empty")]
    return rows + [rows[3], rows[3]]


def test_targets_and_copies(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).withColumns(
        {"size": F.lit("x"), "n": F.lit(1), "hash": F.lit(2), "rate": F.lit(3)})
    got = mixture.balance(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), size(t)) for d, t, _ in rows)
    sizes, of = defaultdict(int), {}
    for d, t, s in rows:
        sizes[s] += size(t)
        of[d] = s
    want = plain_targets(sizes)
    taken, mean = defaultdict(int), defaultdict(list)
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        assert r.copies <= 3
        taken[s] += r.taken
        mean[s].append((r.size, r.rate))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 + 0.001 * want[s], s
        # the rates are one exponential tilt: log(rate) / size is the same wherever no cap holds
        tilt = [math.log(r) / z for z, r in mean[s] if z > 0 and r < 3]
        assert np.ptp(tilt) < 1e-9 if tilt else want[s] == 3 * sizes[s]
    again = mixture.balance(docs.repartition(3)).collect()
    key = lambda rs: sorted((str(r.doc_id), r.size, r.taken, r.target) for r in rs)
    assert key(again) == key(got)
    mixed = mixture.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixed.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == sum(r.taken for r in got)


def test_many_documents_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(mixture, "RANKED", 10)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                    F.when(F.col("id") % 3 == 0, "p").otherwise("q").alias("source"))
    got = mixture.balance(docs).groupBy("target").agg(F.sum("taken").alias("t"), F.min("copies").alias("lo"),
                                                      F.max("copies").alias("hi")).collect()
    assert len(got) == 2 and all(abs(r.t - r.target) <= 3 and r.hi - r.lo <= 1 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, None, "b")]])
def test_without_words(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixture.balance(docs).collect()] == [(0, 0.0, 0)] * len(rows)
    assert mixture.mix(docs).count() == len(rows)
