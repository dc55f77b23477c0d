import random
import zlib

import numpy as np
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from webtrail.llm import orc_tokens
from webtrail.llm.queries import tokenizer_path


def corpus():
    rnd = random.Random(1)
    words = ["the", "don't", "DO", "n't", "é", "é", "schön", "12", "3.5", "ﬁn", "x" * 200, "<|endoftext|>", "…", "日本語", "ÇA",
             "ab́c", "a b", " ", "🙂", "I'll", "we've\n", "İstanbul", "\r\n", "\u0085", "Σας"]
    rows = [(d, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80)))) for d in rnd.sample(range(10000), 300)]
    return rows + [(20000, None), (-5, ""), (20001, "\n\t "), (20002, "Wörter und mehr " * 9000), (None, "no id"), rows[0],
                   rows[0], (20002, "other text, same id")]


def test_ids_are_those_of_whole_texts():
    encoder = orc_tokens.Encoder(tokenizer_path(), 2)
    assert encoder.by_word
    texts = [t or "" for _, t in corpus()]
    assert encoder.cut is not None
    rnd = random.Random(2)
    signs = "".join(map(chr, range(1, 0x250))) + "'" * 9 + "---...   <|endoftext|>st\u0301\u0308\u3000\u200b"
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    plain = Tokenizer.from_file(tokenizer_path())
    for _ in range(2):  # new words, then known ones
        ids, starts = encoder(texts)
        for text, a, b in zip(texts, starts, starts[1:]):
            assert ids[a:b].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]
    assert len(encoder([])[0]) == 0


def test_files_and_index(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).withColumns(
        {"tokens": F.lit("x"), "file": F.lit(1)})
    path = str(tmp_path / "tokens")
    got = orc_tokens.export(docs, tokenizer_path(), end_id=2, path=path).collect()
    plain = Tokenizer.from_file(tokenizer_path())
    ids = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 2]
    want = sorted((str(d), len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    run = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == run
        run += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    # the files one after another hold the documents in that order
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    stored = [x for f in files for x in pyarrow.orc.read_table(f).column("doc_id").to_pylist()]
    assert stored == order
    one = orc_tokens.read(spark, path).filter("doc_id = 20002")
    assert one.count() == 2 and "EqualTo(doc_id,20002)" in one._jdf.queryExecution().toString()


def test_bloom_filters_and_row_index(spark, tmp_path):
    docs = spark.range(0, 6000, 3).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))
    path = str(tmp_path / "tokens")
    orc_tokens.write(docs, path, tokenizer_path(), end_id=2)
    kinds = spark._jvm.org.apache.orc.OrcProto.Stream.Kind
    conf = spark._jvm.org.apache.hadoop.conf.Configuration()
    seen = set()
    for f in (tmp_path / "tokens").glob("*.orc"):
        reader = spark._jvm.org.apache.orc.OrcFile.createReader(
            spark._jvm.org.apache.hadoop.fs.Path(str(f)), spark._jvm.org.apache.orc.OrcFile.readerOptions(conf))
        rows = reader.rows()
        for stripe in reader.getStripes():
            for stream in rows.readStripeFooter(stripe).getStreamsList():
                seen.add((stream.getColumn(), str(stream.getKind())))
    assert (1, "ROW_INDEX") in seen and (1, "BLOOM_FILTER_UTF8") in seen
    assert kinds is not None


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in orc_tokens.export(docs, tokenizer_path(), end_id=2).collect()]
    assert got == [(1, 0, 1, zlib.crc32(b"\2\0\0\0"))] * len(rows)


def test_pieces_are_encoded_as_lines_of_one_text(monkeypatch):
    """Each piece as the model alone encodes it, over several texts of lines; none is an empty result."""
    monkeypatch.setattr(orc_tokens, "LINES", 3)
    encoder = orc_tokens.Encoder(tokenizer_path(), 2)
    pieces = ["hello", "x", "7", "internationalization", "zqxjkvw", "cafÃ©", "'s", "Ã", "!"]
    ids, size = encoder._piece_ids(pieces)
    alone = [encoder.model.encode(x, add_special_tokens=False).ids for x in pieces]
    assert size.tolist() == list(map(len, alone)) and ids.tolist() == [i for x in alone for i in x]
    none = encoder._piece_ids([])
    assert none[0].size == none[1].size == 0
