import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import embedding_neardup as en


def brute(rows, min_cosine=0.98):
    n = len(rows)
    good = [v is not None and lab is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
            and any(x != 0 for x in v) for _, v, lab in rows]
    links, comp = [0] * n, list(range(n))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(n):
        for j in range(i):
            (a, x, la), (b, y, lb) = rows[i], rows[j]
            if good[i] and good[j] and la == lb and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= min_cosine:
                    links[i] += 1
                    links[j] += 1
                    comp[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), links[i], str(least.get(find(i)) if good[i] else d)) for i, (d, _, _) in enumerate(rows))


def corpus(seed=1, dim=16, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for lab in ("a", "b", "c"):
        for _ in range(n // 12):
            base = rng.standard_normal(dim)
            base /= np.linalg.norm(base)
            for _ in range(rng.integers(1, 7)):
                v = base + rng.standard_normal(dim) * rng.choice([0.01, 0.03, 0.05])
                rows.append((len(rows), (v * rng.choice([0.5, 1, 3])).astype(np.float32).tolist(), lab))
    base = rng.standard_normal(dim)
    dense = [base + rng.standard_normal(dim) * 0.08 for _ in range(120)]
    rows += [(len(rows) + i, v.astype(np.float32).tolist(), "a") for i, v in enumerate(dense)]
    k = len(rows)
    odd = [(k, None, "a"), (k + 1, [0.0] * dim, "a"), (k + 2, [float("nan")] + [1.0] * (dim - 1), "a"), (k + 3, [], "a"),
           (k + 4, [None] + [1.0] * (dim - 1), "a"), (k + 5, rows[0][1], None), (k + 6, [float("inf")] * dim, "b"),
           (k + 7, [1.0, 2.0], "a"), (k + 8, [1.0, 2.0], "a"), (k + 9, rows[3][1], rows[3][2]), rows[5], rows[5],
           (None, rows[7][1], rows[7][2]), (None, (-np.array(rows[9][1])).tolist(), "b"), (k + 10, [1e-30] * dim, "c")]
    return rows + odd


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, block):
    rows = corpus()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(4).withColumns(
        {"node": F.lit("x"), "v": F.lit(1), "component": F.lit(2)})
    got = en.near_duplicates(vectors, block=block).collect()
    want = brute(rows)
    have = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)
    assert len(have) == len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    # recall of links against brute force; none that is not one
    assert sum(h[1] for h in have) >= 0.99 * sum(w[1] for w in want)
    by_id = {}
    for d, n, c in want:
        by_id.setdefault(d, []).append(n)
    assert all(n <= max(by_id[d]) for d, n, _ in have)
    assert sum(h == w for h, w in zip(have, want)) >= 0.97 * len(want)


def test_more_grid_lines(spark):
    """Routes as for a very large label."""
    routes = en.calibrate(50_000_000)
    assert routes.grid >= 8 and routes.n > 5
    rows = corpus(2)
    old = en.calibrate
    en.calibrate = lambda *a, **k: routes
    try:
        got = en.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"))
        have = sum(r.n_links for r in got.collect())
    finally:
        en.calibrate = old
    want = sum(w[1] for w in brute(rows))
    assert 0.99 * want <= have <= want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert en.near_duplicates(empty).collect() == []
