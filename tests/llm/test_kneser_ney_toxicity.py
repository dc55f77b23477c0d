import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import kneser_ney_toxicity as kn
from webtrail.llm.spaced_seeds import words


def corpus(n=1500, seed=1):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(4000)]
    bad = ["scum", "idiot", "ärsch"]
    rows = []
    for i in range(n):
        toxic = rnd.random() < 0.15
        t = [rnd.choice(words) for _ in range(rnd.randint(3, 150))]
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                t.insert(rnd.randrange(len(t)), rnd.choice(bad))
        rows.append((i, " ".join(t), int(toxic)))
    return rows


def test_held_out_accuracy_and_edge_cases(spark):
    rows = corpus()
    odd = [(5000, None, 1), (5001, "", 0), (5002, "... ", None), (5003, "w1 w2 " * 20000, 0), (5004, "SCUM!", None),
           (None, "you idiot", 1), (5004, "SCUM!", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, label int").repartition(4).withColumns(
        {"t": F.lit(1), "v": F.lit("x"), "score": F.lit(2)})
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = kn.fit(docs.filter(fold.isin(1, 2, 3)), docs.filter(fold == 4))
    got = {r.doc_id: r for r in kn.score(docs, model).collect()}
    out = {r.doc_id for r in docs.filter(fold == 0).select("doc_id").collect()}
    held = [(got[i].score >= 0.5) == bool(y) for i, _, y in rows if i in out]
    assert len(held) > 200 and sum(held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and kn.score(docs, model).count() == len(rows) + len(odd)
    assert got[5000].score == got[5001].score == got[5002].score < 0.5 and got[5003].score < 0.5
    assert got[5004].score > 0.5 and got[None].score > 0.5


@pytest.mark.parametrize("sure,sure_pair", [(0.0, 0.0), (1.0, 1.5), (2.0, 6.0)])
def test_ratios_against_plain_formulas(spark, sure, sure_pair):
    rnd = random.Random(3)
    rows = [(int(k % 3 == 0), " ".join(rnd.choice("abcdefgh") + (rnd.choice("xyz") if k % 3 == 0 else "")
                                       for _ in range(60))) for k in range(60)]
    rows += [(1, "a rare word"), (1, "one rare expression"), (0, "a b c"), (0, "")]
    model = kn.count(spark.createDataFrame(rows, "label int, t string").repartition(3), sure, sure_pair)
    pairs = [{}, {}]
    for y, t in rows:
        last = None
        for w in t.split():
            pairs[y][last, w] = pairs[y].get((last, w), 0) + 1
            last = w
    kinds = set(pairs[0]) | set(pairs[1])
    total = [sum(x.values()) for x in pairs]
    continued = lambda of, w: sum(x[1] == w for x in of)

    def p(k, w):
        rest = 0.75 * len({x[1] for x in pairs[k]}) / len(pairs[k])
        return max(continued(pairs[k], w) - 0.75, 0) / len(pairs[k]) + rest * continued(kinds, w) / len(kinds)

    def q(k, v, w):
        after = [m for (a, _), m in pairs[k].items() if a == v]
        if not after:
            return p(k, w)
        return max(pairs[k].get((v, w), 0) - 0.75, 0) / sum(after) + 0.75 * len(after) / sum(after) * p(k, w)

    def weight(n, of, sure):
        parts = [x * np.log(x * sum(of) / (sum(n) * t)) for x, t in zip(n, of) if x]
        g = max(2 * sum(parts), 0) ** 0.5
        return 1 - sure / g if g > sure else 0

    def worth(v, w):
        n = [x.get((v, w), 0) for x in pairs]
        if sum(n) and weight(n, total, sure_pair):
            return weight(n, total, sure_pair) * np.log(q(1, v, w) / q(0, v, w))
        n = [continued(x, w) for x in pairs]
        return weight(n, [len(x) for x in pairs], sure) * np.log(p(1, w) / p(0, w)) if sum(n) else 0

    for text in ("a bx c", "ax ay az", "h g f e d c b a", "a", "a rare word", "unknown", "so rare"):
        each = [worth(v, w) for v, w in zip([None, *text.split()], text.split())]
        assert np.allclose(model.ratios([text.encode()])[0], [max(each), sum(each) / len(each)]), text


def test_counts_of_hot_words_in_parts(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(4), " ".join(x for _ in range(rnd.randint(0, 300)) for x in (f"u{rnd.randrange(200)}", "the")))
            for _ in range(80)] + [(1, None), (2, "")]
    table = spark.createDataFrame(rows, "kind int, t string").repartition(5)
    hot = kn._hot(table)
    code = lambda w: int(words([w.encode()]).hashes.view(np.int64)[0])
    assert hot[code("the")] > 1
    want = {}
    for k, t in rows:
        for v, w in zip([None, *(t or "").split()], (t or "").split()):
            want.setdefault((code(v) if v else 1, code(w)), [0] * 4)[k] += 1
    assert {(r.v, r.w): [r.c0, r.c1, r.c2, r.c3] for r in kn._counts(table, 4).collect()} == want
    places = table.select("kind", "t").mapInArrow(kn._counter(4, hot), "w long, part int, vs array<long>, ns array<int>").filter(
        F.col("w") == code("the")).select("part").distinct().count()
    assert places > 1


def test_an_expression_seen_twice_in_toxic_texts(spark):
    rows = corpus(600)
    rare = [(9000, rows[0][1] + " oaf", 1), (9001, rows[1][1] + " oaf", 1)]
    ratio = lambda more: kn.count(spark.createDataFrame(
        [(y, t) for _, t, y in rows + more], "label int, t string")).ratios([b"you oaf"])[0, 0]
    assert ratio([]) == 0 < ratio(rare)


@pytest.mark.parametrize("rows,want", [([], 0.0), ([(1, "a b", 0)], 0.0), ([(1, "a b", 1)], 1.0), ([(1, None, None)], 0.0)])
def test_nothing_to_learn_from(spark, rows, want):
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = kn.fit(docs, docs)
    new = spark.createDataFrame([(7, "a"), (8, None)], "doc_id long, text string")
    assert [r.score for r in kn.score(new, model).collect()] == [want, want]
    assert kn.score(new.limit(0), model).collect() == []


def test_a_rare_toxic_word_beside_many_frequent_pairs(spark):
    """More telling pairs than any fixed table of 262,144 rows, beside one toxic word of few texts."""
    n = 740
    every_pair = " ".join(" ".join([f"w{i}", *(f"w{i} w{j}" for j in range(i + 1, n))]) for i in range(n))
    rows = [(0, every_pair)] * 4 + [(1, every_pair[::-1])] * 4 + [(1, f"w{k} scum") for k in range(12)]
    model = kn.count(spark.createDataFrame(rows, "label int, t string").repartition(4), sure_pair=2.0)
    assert len(model.word) + len(model.pair) > 1 << 18
    assert model.ratios([b"w3 scum"])[0, 0] > 0.3


def test_all_folds_but_the_held_out_one_are_counted(spark, tmp_path, monkeypatch):
    """The query's model has what only fold 4's texts hold, and nothing of fold 0's."""
    from webtrail.llm import queries

    rows = corpus(400)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    rows = [(i, t + (f" only{fold(i)}" * 30 if y else ""), y) for i, t, y in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    models = []
    plain = kn.score
    monkeypatch.setattr(kn, "score", lambda docs, model, *a: models.append(model) or plain(docs, model, *a))
    assert queries.op8_kneser_ney_toxicity(spark, str(tmp_path)).count() == 400
    known = set(models[0].word.tolist())
    assert [int(words([f"only{k}".encode()]).hashes[0]) in known for k in range(5)] == [False, True, True, True, True]
    labelled = [r for r in rows if fold(r[0]) in (1, 2, 3, 4)]
    whole = kn.count(spark.createDataFrame([(y, t) for _, t, y in labelled], "label int, t string"))
    assert np.array_equal(models[0].word, whole.word) and np.allclose(models[0].pair_ratio, whole.pair_ratio)
    left = [kn.count(spark.createDataFrame([(y, t) for i, t, y in labelled if fold(i) != k], "label int, t string"))
            for k in (1, 2, 3, 4)]
    x = np.array([left[fold(i) - 1].ratios([t.encode()])[0] for i, t, _ in labelled])
    y = np.array([float(y) for _, _, y in labelled])
    by = np.lexsort((y, x[:, 1], x[:, 0]))
    assert np.allclose(models[0].curve, kn._fit_curve(x[by], y[by]), rtol=1e-4)
