import hashlib
import math
import random
import re
import zlib

from pyspark.sql import functions as F

from webtrail.llm import importance_resampling as ir
from webtrail.llm.queries import QUERIES


def plain(rows, target, percent=5, least=20):
    def grams(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]

    def counts(texts):
        c = [0] * 10000
        for t in texts:
            for b in grams(t)[1]:
                c[b] += 1
        return c

    s, t = counts(x for _, x in rows), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for ident, text in rows:
        n_words, found = grams(text)
        h = int(hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append((ident, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {x[0]: i + 1 for i, x in enumerate(able[:percent * len(able) // 100])}
    return sorted((*x[:4], rank.get(x[0]) if x[4] >= least else None) for x in out)


def corpus():
    rnd = random.Random(11)
    words = ["Alpha", "beta", "gAMMA", "d3lta", "Élan", "éTÉ", "日本", "x\u0085y", "don't", "a-b", " ", "42", "\x1c", "q_r"]
    rows = [(i, rnd.choice([" ", "\n", ". "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    return rows + [(1000, None), (1001, ""), (1002, "..."), (-3, "word " * 5000), (1004, "alpha beta " * 30), (1005, "alpha beta " * 30)]


TARGET = ["alpha beta gamma", "Beta d3lta " * 20, None, ""]


def test_draw_equals_the_plain_version(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    got = sorted(tuple(r) for r in ir.draw(df, target).collect())
    want = plain(rows, TARGET)
    assert got == want and sum(r[4] is not None for r in want) >= 10


def test_registered_query_equals_the_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = QUERIES["op12_importance_resampling"](spark, folder)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, target)


def test_pieces_give_the_features_of_the_whole_text():
    rnd = random.Random(2)
    for _ in range(200):
        text = " ".join("ab"[: rnd.randint(0, 2)] * rnd.randint(1, 4) for _ in range(rnd.randint(0, 40))).encode()
        whole = list(ir.features(text))
        for size in (1, 3, 17):
            cut = list(ir.features(text, size=size))
            assert sorted(x for _, f in cut for x in f) == sorted(x for _, f in whole for x in f)
            assert sum(n for n, _ in cut) == sum(n for n, _ in whole) == len(text.split())


def test_empty_tables_null_ids_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ir.draw(empty, empty).collect() == []
    rows = [(1, "a b c"), (None, "one word"), (None, None), (2, "y " * 30), (2, "y " * 30)]
    names = ["id", "n_words", "n_features", "weight", "score", "rank", "bucket", "n"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    got = ir.draw(df, empty, percent=50).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_features, r["rank"]) for r in got if r.n_features < 87) == [
        (False, 1, 6, None), (True, 0, 0, None), (True, 0, 3, None)]
    assert sorted([r["rank"] for r in got if r.n_features == 87], key=str) == [1, None]
