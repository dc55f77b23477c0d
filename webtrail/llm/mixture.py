"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how often the mix takes it.  Of all rates that reach each source's
token target, with no rate above ``max_repeats``, entropy balancing takes those closest to one in
relative entropy.  The convex dual has one multiplier per source and the solution is an
exponential tilt, ``rate = min(max_repeats, exp(lambda * size / scale))``.  Newton iterations
solve the dual, distributed: each round is one aggregation of gradient and curvature over all
sizes, per source.  As the rate depends on source and size only, the documents enter as counts
per (source, size): exact, and far smaller than the documents.

Rates become whole copies: within a source, from the largest size down, the copies of each size
are rounded with the words left over so far carried on, so a source ends within about half its
smallest documents of its target.  Which documents of a size take one copy more is decided by a
hash of the id: reruns agree.

Size is the number of words; null and empty texts have size 0, rate 1 and take no words.  Null is
a source of its own, last in order.  Repeated rows count each.  An empty table gives no rows; a
source without words has target 0.  Extra columns are ignored (or kept, by :func:`mix`).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webtrail.llm import common
from webtrail.operators.sequence import global_sequence

#: Documents of one source and size that are ranked together.
RANKED = 1000
#: Most rows (about 100 bytes each) of a plan that are broadcast; a larger plan is joined by a shuffle.
PLAN_ROWS = 200_000


def targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """(no_source, source, source_size, target) from rows (no_source, source, source_size): weights
    repeat over the sources by code point, null last, and share all sizes; what a target exceeds
    ``max_repeats`` times its source's size is shared again by weight, until none does."""
    ranked = global_sequence(sizes, [F.col("no_source"), F.col("source")], "__rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    rows = common.stored(ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(max_repeats)),
                         "mix-sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # a source is full once level * weight reaches its cap; each round only adds such sources
        over = F.col("cap") <= F.lit(level) * F.col("w")
        n, held, free = rows.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
                                 F.sum(F.when(~over, F.col("w")))).first()
        if n == full or not free:
            break
        full, level = n, (total - held) / free
    return rows.select("no_source", "source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def _balance(counts: DataFrame, goal: DataFrame, max_repeats: int, tolerance: float, max_rounds: int) -> DataFrame:
    """(no_source, source, lam, scale): damped Newton on each source's dual, all sources at once."""
    state = common.stored(goal.filter("source_size > 0").select(
        "no_source", "source", "source_size", "target", (F.col("source_size") / F.col("docs")).alias("scale"),
        F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")), "mix-state")
    for _ in range(max_rounds):
        side = common.small_side(state.select(F.col("no_source").alias("g1"), F.col("source").alias("g2"), "scale", "lam"))
        x = F.col("size") / F.col("scale")
        free = F.exp(F.col("lam") * x)
        words = F.col("n") * F.col("size")
        sums = counts.filter("size > 0").join(side, _on("g1", "g2")).groupBy("g1", "g2").agg(
            F.sum(words * F.least(free, F.lit(float(max_repeats)))).alias("words"),
            F.sum(F.when(free < max_repeats, words * x * free).otherwise(0.0)).alias("slope"))
        gap = F.col("words") - F.col("target")
        done = (F.abs(gap) <= tolerance * F.col("target")) | (F.col("target") >= max_repeats * F.col("source_size"))
        # a bracket around the root keeps every step inside what is known of it
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, gap / F.col("slope")).otherwise(F.signum(gap))
        step = F.col("lam") - F.greatest(F.least(step, F.lit(1.0)), F.lit(-1.0))
        new = F.when(done, F.col("lam")).when((step > low) & (step < high), step).otherwise((low + high) / 2)
        now = common.stored(state.join(sums, _on("g1", "g2")).select(
            "no_source", "source", "source_size", "target", "scale", new.alias("lam"), low.alias("low"),
            high.alias("high"), done.alias("done")), "mix-state")
        state = now.drop("done")
        if now.filter("not done").isEmpty():
            break
    return state


def _round(max_repeats: int):
    """Copies of each size of one source, from the largest size down, words left over carried on.
    A group holds one row for each different size of a source, whatever the number of documents."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        size, n = rows["size"].to_numpy(float), rows["n"].to_numpy(float)
        first = rows.iloc[0]
        if first["source_size"] == 0:  # no words, no multiplier
            rate = np.ones(len(rows))
        elif first["target"] >= max_repeats * first["source_size"]:
            rate = np.full(len(rows), float(max_repeats))
        else:
            rate = np.minimum(max_repeats, np.exp(np.minimum(first["lam"] * size / first["scale"], 50.0)))
        rate = np.where(size > 0, rate, 1.0)
        copies, left = np.empty(len(rows), dtype=np.int64), 0.0
        for i, (s, k, r) in enumerate(zip(size, n, rate)):
            want = k * r + (left / s if s else 0.0)
            copies[i] = min(max(int(np.floor(want + 0.5)), 0), max_repeats * int(k))
            left += (k * r - copies[i]) * s
        return rows.assign(rate=rate, copies=copies)[["no_source", "source", "size", "source_size", "target", "n", "rate",
                                                      "copies"]]

    return run


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``docs`` with its size, its key columns and the hash that ranks it."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"__mix_none": F.col(source).isNull(), "__mix_source": F.col(source), "__mix_size": size,
                             "__mix_hash": F.xxhash64(doc_id)})


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, tolerance: float = 1e-6,
         max_rounds: int = 60) -> DataFrame:
    """The mix, one row per source and size that occur: no_source, source, size, source_size, target, n
    documents, rate, ``base`` copies of each, one more for those whose id hashes to ``cut`` or less."""
    rows = _keyed(docs.select(doc_id, text, source), doc_id, text, source)
    rows = common.stored(rows.select(F.col("__mix_none").alias("no_source"), F.col("__mix_source").alias("source"),
                                     F.col("__mix_size").alias("size"), F.col("__mix_hash").alias("hash")), "mix-sizes")
    counts = common.stored(rows.groupBy("no_source", "source", "size").agg(F.count("*").alias("n")), "mix-counts")
    by_source = common.stored(counts.groupBy("no_source", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")), "mix-by-source")
    shares = targets(by_source.drop("docs"), weights, max_repeats)
    goal = common.stored(by_source.join(shares.toDF("g1", "g2", "g3", "target"), _on("g1", "g2")).select(
        "no_source", "source", "source_size", "target", "docs"), "mix-goal")
    state = _balance(counts, goal, max_repeats, tolerance, max_rounds).select(
        F.col("no_source").alias("g1"), F.col("source").alias("g2"), "lam", "scale")
    tilt = goal.drop("docs").join(state, _on("g1", "g2"), "left").drop("g1", "g2").withColumnsRenamed(
        {"no_source": "g1", "source": "g2"})
    copies = common.stored(counts.join(tilt, _on("g1", "g2")).drop("g1", "g2").groupBy("no_source", "source").applyInPandas(
        _round(max_repeats), "no_source boolean, source string, size long, source_size long, target double, n long, "
        "rate double, copies long").withColumn("base", F.floor(F.col("copies") / F.col("n"))).withColumn(
        "more", F.col("copies") - F.col("base") * F.col("n")), "mix-copies")

    # the hash of the last document raised: only sizes with some to raise are ranked, in buckets of few documents
    raised = common.small_side(copies.filter("more > 0").select(
        F.col("no_source").alias("g1"), F.col("source").alias("g2"), F.col("size").alias("g3"), "n", "more"), PLAN_ROWS)
    part = F.pmod(F.shiftright("hash", 20), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.join(raised, _on("g1", "g2", "g3")).withColumn("bucket", F.floor(part * F.ceil(F.col("n") / RANKED)))
    key = ["g1", "g2", "g3"]
    fill = Window.partitionBy("f1", "f2", "f3").orderBy("f4").rowsBetween(Window.unboundedPreceding, -1)
    before = some.groupBy(*key, "bucket").agg(F.count("*").alias("k")).toDF("f1", "f2", "f3", "f4", "k").withColumn(
        "before", F.coalesce(F.sum("k").over(fill), F.lit(0)))
    # buckets follow the hash's middle bits, so ``cut`` orders by them first
    order = F.struct("bucket", "hash")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("hash"))).join(
        before, (F.col("g1") == F.col("f1")) & F.col("g2").eqNullSafe(F.col("f2")) & (F.col("g3") == F.col("f3"))
        & (F.col("bucket") == F.col("f4")))
    cuts = ranked.filter(F.col("before") + F.col("rank") == F.col("more")).select(*key, order.alias("cut"))
    return common.stored(copies.join(cuts, _on(*key), "left").select(
        "no_source", "source", "size", "source_size", "target", "n", "rate", "base", "cut"), "mix-plan")


def _on(*names: str):
    """Join condition of the key columns with those named."""
    pairs = list(zip(("no_source", "source", "size"), names))
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs]


def _apply(docs: DataFrame, plan: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``docs`` with the plan's columns of its source and size, all named __mix_*, and __mix_copies."""
    rows = _keyed(docs, doc_id, text, source)
    side = common.small_side(plan, PLAN_ROWS)
    side = side.toDF(*(f"__plan_{c}" for c in side.columns))
    part = F.pmod(F.shiftright("__mix_hash", 20), F.lit(1 << 30)) / F.lit(float(1 << 30))
    here = F.struct(F.floor(part * F.ceil(F.col("__plan_n") / RANKED)).alias("bucket"), F.col("__mix_hash").alias("hash"))
    on = [F.col(f"__mix_{a}").eqNullSafe(F.col(f"__plan_{b}")) for a, b in
          (("none", "no_source"), ("source", "source"), ("size", "size"))]
    more = F.coalesce(here <= F.col("__plan_cut"), F.lit(False)).cast("long")
    return rows.join(side, on).withColumn("__mix_copies", F.col("__plan_base") + more)


def balance(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(id, size, source_size, target, taken, copies, rate), one row for each row of ``docs``:
    ``copies`` whole repeats, so ``taken = copies * size`` words."""
    narrow = docs.select(doc_id, text, source)
    rows = _apply(narrow, plan(narrow, doc_id, text, source, **options), doc_id, text, source)
    return rows.select(doc_id, F.col("__mix_size").alias("size"), F.col("__plan_source_size").alias("source_size"),
                       F.col("__plan_target").alias("target"),
                       (F.col("__mix_copies") * F.col("__mix_size")).alias("taken"),
                       F.col("__mix_copies").alias("copies"), F.col("__plan_rate").alias("rate"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed rows themselves: each row of ``docs``, with its own columns, as often as its copies."""
    own = docs.columns
    rows = _apply(docs, plan(docs, doc_id, text, source, **options), doc_id, text, source)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies")))
    return rows.filter("__mix_copies > 0").withColumn("__mix_copy", times).select(*own)
