import hashlib
import random
import re

from pyspark.sql import functions as F

from webtrail.llm import trie_dedup


def expected(rows):
    groups = {}
    for ident, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(ident)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = ids.index(keep)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), at == first, sha) for at, i in enumerate(ids)]
    # of rows that repeat the smallest id exactly one is kept, whichever
    return sorted(out, key=repr)


def corpus(n=600):
    rnd = random.Random(3)
    stems = ["", "a", "ab", "abc", "abcd ", "é", "日本", "x" * 3000, "the same start " * 40, " "]
    rows = [(i, rnd.choice(stems) + rnd.choice(["", " ", "\n", "\t\r", "tail", " b", " ", "\u0085"])
             + rnd.choice(["", "1", "2", "\x1c"])) for i in rnd.sample(range(10 * n), n)]
    hot = [(i, "hot text \n of a third") for i in range(100_000, 100_000 + n // 2)]
    return rows + hot + [(None, None), (None, ""), (7_000_000, None), (None, "only without id"), (-5, "ab"),
                         rows[0], rows[0], (rows[1][0], "another text, same id"), (9_000_000, "long " * 60_000)]


def run(df, **options):
    return sorted([tuple(r) for r in trie_dedup.owners(df, **options).collect()], key=repr)


def test_owners_equal_grouping_by_text(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert run(df) == expected(rows)


def test_spilled_branches_and_dealt_keys_give_the_same(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, trie_bytes=6_000, task_bytes=2_000) == expected(rows)
    assert run(df, trie_bytes=1) == expected(rows)


def test_one_row_of_a_repeated_row_stays(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "doc_id long, text string")
    got = trie_dedup.owners(df).collect()
    assert sum(r.kept for r in got) == 1 and {r.keep_id for r in got} == {1} and {r.group_size for r in got} == {3}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert trie_dedup.owners(df).collect() == []
    names = ["row", "id", "sha", "up", "length", "hash", "n", "keep_id", "group_size", "kept", "salt", "parts"]
    df = spark.createDataFrame([(1, "a b"), (2, "a  b")], "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in names})
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in trie_dedup.owners(df).collect()) == [(1, 1, True), (2, 1, False)]


def test_distinct_texts(spark):
    df = spark.createDataFrame([(3, "a \t b"), (2, "a b"), (5, None), (4, "c")], "doc_id long, text string")
    got = sorted(tuple(r) for r in trie_dedup.distinct_texts(df).select("doc_id", "text", "group_size").collect())
    assert got == [(2, "a b", 2), (4, "c", 1), (5, "", 1)]


def test_trie_against_a_dictionary():
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    trie, seen = trie_dedup.Trie(1 << 40), {}
    for i, t in enumerate(texts):
        trie.insert(t, (i % 97, i), i, 1)
        seen.setdefault(t, []).append(i)
    assert {n.whole(): n.members for n in trie.terminals()} == seen
    assert all(n.owner == min((i % 97, i) for i in n.members) and n.size == len(n.members) for n in trie.terminals())
    assert trie.held == sum(n.cost + trie_dedup._MEMBER_BYTES * len(n.members) for n in trie.nodes(trie.root))
