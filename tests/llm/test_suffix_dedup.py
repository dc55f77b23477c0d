import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import suffix_dedup as sd

none = -(1 << 63)


def brute(rows, length=100):
    """(id, text) -> (n_bytes, n_removed, n_spans, sha of the rest)."""
    docs = sorted({(none if d is None else d, int(np.uint64(sd.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64)),
                    t or "") for d, t in rows})
    seen, out = set(), {}
    for d, _, t in docs:
        data = t.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[None if d == none else d, t] = (len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def corpus(seed=3):
    rnd = random.Random(seed)
    vocab = ["the", "of", "und", "é", "ß", "ción", "one", "ndly", "er", "\n", "x" * 9]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, notice = say(60), say(30)
    rows = [(0, None), (1, ""), (2, "short"), (3, "a" * 99), (4, "a" * 100), (5, "a" * 350), (6, "ab" * 300),
            (None, passage), (7, passage[:40] + "é" + passage[40:])]
    n = 8
    for _ in range(12):
        base = say(rnd.randint(5, 150))
        for _ in range(rnd.randint(1, 6)):
            t = base
            for _ in range(rnd.randint(0, 2)):
                k = rnd.randrange(len(t) + 1)
                t = t[:k] + say(rnd.randint(0, 2)) + t[k + rnd.randint(0, 3):]
            if rnd.random() < 0.6:
                t = say(rnd.randint(0, 20)) + passage + t
            if rnd.random() < 0.5:
                t = t + notice + say(3)
            rows.append((n, t))
            n += 1
    rnd.shuffle(rows)
    big = say(70000)
    return rows + [rows[5], (n, rows[6][1]), (n, "other " + rows[6][1] * 2), (n + 1, big), (n + 2, "y" + big[:200_000])]


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns(
        {"id": F.lit("x"), "tie": F.lit(1), "spans": F.lit(None).cast("string")})
    want = brute(rows)
    got = sd.remove_repeats(docs, keep_text=True, **options).collect()
    have = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert have == sorted((str(d), *want[d, t or ""]) for d, t in rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_against_brute_force(spark):
    check(spark, corpus())


def test_anchors_dealt_out_and_groups_in_parts(spark, monkeypatch):
    rows = corpus(8)
    anchors = [sd.segments(np.frombuffer(t.encode(), dtype=np.uint8))[0] for _, t in rows if t and len(t) < 200_000]
    hot = np.unique(np.concatenate(anchors))[::2]
    check(spark, rows, hot=np.sort(hot))


def test_a_group_in_several_parts(spark):
    """What a task does with a group of more segments than it sorts together."""
    rnd = random.Random(4)
    core = bytes(rnd.randrange(97, 123) for _ in range(100))
    rows = []
    for i in range(60):
        data = (bytes([rnd.choice(b"pq") for _ in range(2)]) + core + bytes([rnd.choice(b"rs") for _ in range(2)]))
        rows.append((i, data))
    import pyarrow as pa

    def batch(part):
        n = len(part)
        return pa.RecordBatch.from_arrays(
            [pa.array([7] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int64()),
             pa.array([i for i, _ in part], pa.int64()), pa.array([0] * n, pa.int64()), pa.array([0] * n, pa.int64()),
             pa.array([104] * n, pa.int32()), pa.array([30] * n, pa.int32()), pa.array([d for _, d in part], pa.binary())],
            names=sd._SCANNED)

    def result(size):
        old, sd.COLLECTION = sd.COLLECTION, size
        try:
            out = pa.Table.from_batches(list(sd._sort_segments(iter([batch(rows[i:i + 10]) for i in range(0, 60, 10)]))))
        finally:
            sd.COLLECTION = old
        t = out.to_pandas()
        gone = {(r.id, r.first + k) for r in t[t.w1.isna()].itertuples() for k in range(r.size - 99)}
        handed = t[t.w1.notna()].sort_values(["w1", "w2", "id", "tie", "first"])
        again = handed[handed.duplicated(["w1", "w2"])]
        return gone | {(r.id, r.first) for r in again.itertuples()}

    seen, want = set(), set()
    for i, d in rows:
        for k in range(5):
            (want.add((i, k)) if d[k:k + 100] in seen else seen.add(d[k:k + 100]))
    assert result(10) == result(1000) == want


def test_long_documents_in_pieces(spark, monkeypatch):
    text = "".join(random.Random(1).choices("abcdef ", k=sd.PIECE * 2 + 77))
    pieces = list(sd._pieces(text.encode()))
    starts = [at + i for at, data in pieces for i in range(len(data) - 99)]
    assert starts == list(range(len(text) - 99))


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
