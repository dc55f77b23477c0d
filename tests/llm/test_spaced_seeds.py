import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from webtrail.llm import spaced_seeds as sp


def split(text):
    return [bytes(w).lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]


def brute(docs, items, window=13, overlap=0.8, min_words=1):
    out = set()
    for d, t in docs:
        a = split(t)
        for i, u in items:
            b = split(u)
            size = min(window, len(b))
            if size < min_words:
                continue
            for diagonal in range(-len(b), len(a)):
                same = [0 <= diagonal + k < len(a) and a[diagonal + k] == b[k] for k in range(len(b))]
                inside = [0 <= diagonal + k < len(a) for k in range(len(b))]
                if any(all(inside[k:k + size]) and sum(same[k:k + size]) >= overlap * size
                       for k in range(len(b) - size + 1)):
                    out.add((d, i))
    return out


def data():
    rnd = random.Random(2)
    vocab = [f"{a}{b}" for a in ("ka", "Lo", "né", "x9") for b in ("ta", "MI", "ru", "ö", "s")]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rnd.randint(15, 40)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "too short"), (23, "an item of nine words only, no more here"), (24, items[0][1]),
              (None, " ".join(say(20)))]
    docs = [(0, None), (1, ""), (2, "..."), (3, " ".join(say(50000)))]
    for d in range(4, 60):
        words = say(rnd.randint(0, 60))
        i = rnd.randrange(12)
        part = items[i][1].split()
        lo = rnd.randint(0, max(0, len(part) - 13))
        part = part[lo:lo + rnd.randint(9, 30)]
        for _ in range(rnd.randint(0, 4)):
            part[rnd.randrange(len(part))] = rnd.choice(vocab)
        docs.append((d, ", ".join([*words, *part, *say(rnd.randint(0, 9))])))
    docs += [(60, "see: An item of NINE words only no more here!"), (61, items[17][1]), (None, items[1][1]), docs[-1]]
    return docs, items


def test_masks_hit_every_window_with_two_substitutions():
    for gone in itertools.combinations(range(13), 2):
        assert any(all(k + i not in gone for i, c in enumerate(m) if c == "1")
                   for m in sp.MASKS for k in range(13 - len(m) + 1))


@pytest.mark.parametrize("block_words", [sp.BLOCK_WORDS, 200])
def test_against_brute_force(spark, block_words):
    rows, items = data()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"item_id": F.lit("x"), "t": F.lit(1)})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute(rows, items)
    assert {d for d, _ in want} > {60, 61, None} and len(want) > 30
    got = sp.find_leaks(docs, bench, block_words=block_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len({(r.doc_id, r.item_id) for r in got})
    texts = dict(rows)
    for r in got:
        assert r.n_same >= 0.8 * r.n_words and 0 <= r.first_byte < r.end_byte <= len(texts[r.doc_id].encode())
    clean = sp.decontaminate(docs, bench, block_words=block_words)
    assert clean.columns == docs.columns
    long = {i for i, t in items if len(split(t)) >= 5}
    dirty = {d for d, i in want if i in long}
    assert sorted((r.doc_id for r in clean.collect())) == sorted(d for d, _ in rows if d not in dirty)


@pytest.mark.parametrize("size", range(1, 13))
def test_short_masks_hit_every_permitted_substitution(size):
    free = max(k for k in range(size) if size - k >= 0.8 * size)
    masks = sp.short_masks(size, 0.8)
    assert free == (0 if size < 5 else 1 if size < 10 else 2) and all("1" in m for m in masks)
    for gone in itertools.combinations(range(size), free):
        assert any(all(m[i] == "0" for i in gone) for m in masks)


def test_items_of_every_length_against_brute_force(spark):
    """Items of 1 to 14 words, exact and with more and more words of them substituted, beside frequent words."""
    rnd = random.Random(6)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 15)] + [(20, "of"), (21, "of the of the of")]
    docs = []
    for n, t in items[:14]:
        for gone in range(4):
            part = t.split()
            for k in rnd.sample(range(n), min(n, gone)):
                part[k] = "of"
            docs.append((len(docs), " ".join(rnd.choices(["of", "the"], k=9) + part + rnd.choices(["of", "the"], k=9))))
    docs += [(900, "of " * 5000), (901, ""), (902, "The")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r.doc_id, r.item_id) for r in sp.find_leaks(table, bench).collect()]
    want = brute(docs, items)
    assert set(got) == want and len(got) == len(want)
    assert all((4 * (n - 1), n) in want for n in range(1, 15)) and {(4 * (n - 1) + 1, n) in want for n in range(5, 15)} == {True}
    kept = {r.doc_id for r in sp.decontaminate(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in brute(docs, items, min_words=5)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o")], "doc_id long, text string")
    assert sp.find_leaks(docs, items).collect() == [] and sp.find_leaks(some, items).collect() == []
    assert sp.decontaminate(some, items).count() == 1
    assert sp.find_leaks(docs, some.withColumnRenamed("doc_id", "item_id")).collect() == []
