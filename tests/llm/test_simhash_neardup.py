import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from webtrail.llm import common, simhash_neardup as sh


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, bits):
    comp = list(range(len(ids)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                comp[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one Two"), (4, "ONE two"), (5, "one two three four"), (6, "é Ünder"),
            (None, "lone text of a null id"), (7, "x " * 30000)]
    n = 8
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(20, 200))]
        for _ in range(rnd.randint(1, 8)):
            words = [rnd.choice(vocab) if rnd.random() < 0.02 else w for w in base]
            rows.append((n, " ".join(words)))
            n += 1
    return rows + [rows[-1], rows[-1]]


@pytest.mark.parametrize("block", [1024, 2])
def test_against_brute_force(spark, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit(1), "key": F.lit("x"), "component_id": F.lit(None).cast("string")})
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in sh.near_duplicates(docs, block=block).collect()),
                 key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components([d for d, _ in rows], fps, 4)
    assert got == sorted(((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, comps)), key=str)


def test_dense_fingerprints_are_linked_whole(spark):
    """Many different fingerprints under one key, cut into blocks."""
    rnd = random.Random(1)
    centre = rnd.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        x = centre
        for b in rnd.sample(range(64), rnd.randint(1, 7)):
            x ^= 1 << b
        fps.add(x)
    fps = list(fps) + [rnd.getrandbits(64) for _ in range(200)]
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    cells = sh._cells(sh._keys(nodes, 4), 16)
    edges = cells.repartition("key", "cell").sortWithinPartitions("key", "cell", F.desc("left")).mapInArrow(
        sh._links(4), "a long, b long")
    comp = {r.node: r.component for r in common.components(edges).collect()}
    ids = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert [comp.get(i, i) for i in ids] == brute_components(ids, fps, 4)


def test_empty_table(spark):
    assert sh.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_long_chains(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5000, 5000)],
                                  "a long, b long").repartition(4)
    got = {r.node: r.component for r in common.components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_keep_one_against_brute_force(spark):
    """What the pipeline's stage keeps: of each group the row of the smallest id, with its own columns."""
    rnd = random.Random(9)
    base = [" ".join(rnd.choice(["ka", "lo", "mi", "ru", "so", "te"]) for _ in range(60)) for _ in range(8)]
    rows = [(i, rnd.choice(base) if i % 3 else f"alone {i} " + rnd.choice(base)) for i in range(40)] + [(50, None), (51, ""), (52, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("own"))
    comps = brute_components([d for d, _ in rows], [brute_fingerprint(t) for _, t in rows], 4)
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for (d, _), c in zip(rows, comps) if d == c]
    assert sh.keep_one(docs.limit(0)).collect() == []
