import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import ppm_language as ppm

WORDS = {"aa": ["the", "and", "where", "thing", "of"], "bb": ["der", "und", "schön", "ß", "nicht"],
         "cc": ["le", "où", "être", "que", "les"]}


def rows(seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(90):
        lang = rnd.choice(list(WORDS))
        out.append((i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(3, 60))), lang))
    return out


def plain_bits(train, text):
    """PPM, escape method C, one symbol at a time."""
    trees = defaultdict(lambda: defaultdict(Counter))
    for _, t, lang in train:
        if lang is not None:
            data = ppm.PAD + (t or "").encode()
            for i in range(3, len(data)):
                for k in range(4):
                    trees[lang][data[i - k:i]][data[i]] += 1
    out = {}
    for lang in trees:
        bits, data = 0.0, ppm.PAD + text.encode()
        for i in range(3, len(data)):
            for k in (3, 2, 1, 0):
                seen = trees[lang].get(data[i - k:i])
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if data[i] in seen:
                    bits -= math.log2(seen[data[i]] / (n + d))
                    break
                bits -= math.log2(d / (n + d))
            else:
                bits += 8
        out[lang] = bits
    return out


def test_code_lengths_against_plain_version(spark):
    train = rows()
    model = ppm.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    texts = [t for _, t, _ in rows(9)[:12]] + ["", "zzz", "\x00\x00\x00 the", "ß", "x" * 3000 + " the und"]
    got = ppm.Coder(model).bits([t.encode() for t in texts])
    for text, have in zip(texts, got):
        want = plain_bits(train, text)
        assert np.allclose(have, [want[x] for x in model.languages], rtol=1e-4, atol=1e-2), text[:30]


def test_long_texts_in_pieces(spark, monkeypatch):
    model = ppm.fit(spark.createDataFrame(rows(), "doc_id long, text string, lang string"))
    texts = [t.encode() for t in ("the and " * 9000, "", "und " * 3, "", "", "que les " * 5000, "x")]
    whole = ppm.Coder(model).bits(texts)
    monkeypatch.setattr(ppm, "CHUNK", 1)
    assert np.allclose(ppm.Coder(model).bits(texts), whole)


def test_held_out_accuracy_and_edge_cases(spark):
    data = rows() + [(500 + i, t, x) for i, (_, t, x) in enumerate(rows(7))]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 --", "cc"), (903, "the and of " * 20000, None), (None, "où les", None),
           (903, "the and of " * 20000, None)]
    docs = spark.createDataFrame(data + odd, "doc_id long, text string, lang string").withColumns(
        {"score": F.lit("x"), "found": F.lit(1), "id": F.lit(2)})
    got = {r.doc_id: r for r in ppm.identify(docs, docs.filter(ppm.fold("doc_id", 4) != 2)).collect()}
    assert len(got) == len(data) + 5
    assert sum(got[i].lang_pred == x for i, _, x in data) >= 0.98 * len(data)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "aa", "cc"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].score == 0
    kept = ppm.reject_unknown(docs, docs)
    assert kept.columns == docs.columns and kept.count() == len(data) + 3


@pytest.mark.parametrize("train", [[], [(1, "abc", None)]])
def test_nothing_to_learn_from(spark, train):
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(1, "abc", None)], schema)
    got = ppm.identify(docs, spark.createDataFrame(train, schema)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert ppm.identify(docs.limit(0), docs).collect() == []


def test_model_is_bounded(spark):
    model = ppm.fit(spark.createDataFrame(rows(), "doc_id long, text string, lang string"), max_nodes=100)
    assert 0 < sum(len(g) for g, _ in model.counts) <= 100
    assert np.isfinite(ppm.Coder(model).bits(["où être".encode(), b"the"])).all()


def test_rare_script_beside_a_hot_language(spark):
    """The hot language has more different grams than any fixed table of 262,144 rows."""
    import corpus_pipeline

    rnd = random.Random(4)
    letters = [chr(c) for c in range(33, 127)]
    hot = [(i, "".join(rnd.choices(letters, k=12000)), "hot") for i in range(40)]
    words = ["საქართველო", "თბილისი", "მდინარე", "წიგნი"]
    rare = [(1000 + i, " ".join(rnd.choice(words) for _ in range(30)), "ka") for i in range(12)]
    docs = spark.createDataFrame(hot + rare, "doc_id long, text string, lang string")
    train = docs.filter(ppm.fold("doc_id", 4) != 2)
    model = ppm.fit(train)
    assert len(model.counts[model.languages.index("hot")][0]) > 1 << 18
    held = {i for i, t, x in rare} & {r.doc_id for r in docs.filter(ppm.fold("doc_id", 4) == 2).collect()}
    found = {r.doc_id: r.lang_pred for r in ppm.identify(docs, train).collect()}
    assert held and {found[i] for i, t, x in rare} == {"ka"}
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert {i for i, t, x in rare} <= kept


def test_a_given_bound_leaves_each_language_a_share(spark):
    data = rows() + [(200 + i, "the and of " * 500, "aa") for i in range(20)] + [(300, "ქვა", "ka")]
    model = ppm.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"), max_nodes=60)
    sizes = dict(zip(model.languages, (len(g) for g, _ in model.counts)))
    assert set(sizes) == {"aa", "bb", "cc", "ka"} and sizes["ka"] == 9 and sum(sizes.values()) == 60


def test_search_gives_what_tables_give(spark, monkeypatch):
    model = ppm.fit(spark.createDataFrame(rows(), "doc_id long, text string, lang string"))
    texts = [t.encode() for _, t, _ in rows(9)[:12]] + [b"", b"zzz", b"\x00 the"]
    tables = ppm.Coder(model).bits(texts)
    monkeypatch.setattr(ppm, "TABLE_CONTEXTS", 0)
    assert np.array_equal(ppm.Coder(model).bits(texts), tables)
