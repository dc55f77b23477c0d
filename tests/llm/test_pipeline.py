import random
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from webtrail.llm.queries import END_ID, tokenizer_path

EN = "the of and to in is that it was for on are with as his they be at one have this from or had by word but what".split()
FR = "le la les des une dans que qui pour sur avec est pas plus par ce il elle nous vous être avoir fait même où très".split()
DDL = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"{a}{b}" for a in ("quartz", "violet", "monsoon", "ledger") for b in ("ine", "ory", "al", "ers", "um"))


def corpus():
    """Documents and what stages must take: (rows, without a language, copies, with the benchmark's passage)."""
    rnd = random.Random(5)
    rows = []
    for i in range(120):
        words = [rnd.choice(EN if i % 2 else FR) + rnd.choice(["", "", "s"]) for _ in range(rnd.randint(60, 120))]
        rows.append((i, " ".join(words) + ".", ("en" if i % 2 else "fr"), f"src{i % 3}" if i % 7 else None, 1))
    rows += [(200, None, "en", "src0", 0), (201, "", None, None, None), (202, "12 34 !!", "fr", "src1", 8)]
    rows += [(300 + i, rows[10 + i][1], rows[10 + i][2], "src0", 1) for i in range(20)] + [(320, rows[10][1], None, None, 1)]
    rows += [(400, rows[30][1] + " " + PASSAGE + " " + rows[32][1], "fr", "src2", 1)]
    return rows, {200, 201, 202}, {*range(300, 321)}, {400}


def write(spark, folder, rows):
    docs = spark.createDataFrame(rows, DDL).withColumns({"lang_pred": F.lit("x"), "size": F.lit(None).cast("string")})
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = bench.limit(1).withColumn("text", F.lit(PASSAGE))
    (one if rows else one.limit(0)).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_whole_run(spark, tmp_path):
    rows, unknown, copies, leaks = corpus()
    sf = write(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in rows}
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], (unknown, copies, leaks)):
        ids -= gone
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(ids), name

    got = corpus_pipeline.run(spark, sf).collect()
    assert got and {r.doc_id for r in got} <= ids
    texts, encoder = {r[0]: r[1] for r in rows}, Tokenizer.from_file(tokenizer_path())
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        own = [*encoder.encode(texts[r.doc_id], add_special_tokens=False).ids, END_ID]
        data = b"".join(x.to_bytes(4, "little") for x in own)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(data))
        start += r.n_tokens
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in again) == sorted(r.doc_id for r in got)


@pytest.mark.parametrize("rows", [[], [(None, "le la les des une dans que", "fr", None, None), (3, None, None, None, None)]])
def test_empty_table_and_null_ids(spark, tmp_path, rows):
    got = corpus_pipeline.run(spark, write(spark, tmp_path, rows)).collect()
    assert {r.doc_id for r in got} <= {r[0] for r in rows[:1]}
