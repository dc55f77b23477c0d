"""Token ids as ORC files: encoded once, range-sorted by document id, read back by stripes.

The texts are range-partitioned and sorted by id, encoded in Arrow batches and written as ORC:
ids as ``array<int>`` in run-length encoded integer streams, a row index every ``row_index``
rows and Bloom filters on the document ids, so that a reader splits the files by stripes and
prunes stripes and row groups by id (min/max and Bloom filter) before it decodes any token.
Files are named in range order: reading them one after another gives ascending ids.

A word (a run without spaces) is encoded once per Python process and looked up after that.  This
gives the ids of the whole text for a tokenizer that drops white space and never joins across a
space; :func:`splits_at_spaces` checks it on the tokenizer itself, and others encode whole texts.

Null texts are empty: the end id alone.  Rows with a null id come first.  Rows of equal ids are
ordered by text hash; repeated rows are written each.  An empty table gives an empty file set and
no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from webtrail.llm import common
from webtrail.session import shared_dir

#: Words, and pieces of words, that a process remembers with their ids; a full memory is emptied.
REMEMBERED = 700_000
#: Characters of texts that are taken apart at once.
CHUNK = 1 << 21
#: Pieces that the model encodes at once, as lines of one text.
LINES = 2_000
#: Words that a tokenizer of the known kind only lowers: printable, and of letters that have one form.
_PLAIN = regex.compile(r"(?:(?<=\n)|^)[!-~\u00a1-\u017f]+(?=\n|$)").findall
#: Texts of which lower case is letter by letter, and a sign of special tokens.
_LATIN, _SPECIAL = regex.compile(r"[\x00-\u00ff]*").fullmatch, regex.compile(r"<\|").search
OPTIONS = {"compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
           "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20)}
_PROBES = ("a b", " a  b ", "don't do n't", "x\n y", "1 23 4.5", "É à ñ ü", "á e ́", "<b> </b> ...!? !", "A\tb c\r\n d")


def splits_at_spaces(tokenizer) -> bool:
    """Whether texts may be encoded word by word: true if the probes' ids are those of their words."""
    ids = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    return all(ids(x) == list(chain.from_iterable(ids(w) for w in x.split(" "))) for x in _PROBES)


def _piece_pattern(tokenizer) -> str | None:
    """The pattern that cuts a normalized word into the model's pieces, if the tokenizer is of the
    kind that does nothing else to plain Latin words than to lower their case: its file says so."""
    parts = json.loads(tokenizer.to_str())
    kinds = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
    steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return None
    split, to_bytes = steps
    plain = split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"] \
        and not to_bytes["add_prefix_space"] and not to_bytes["use_regex"]
    return split["pattern"]["Regex"] if plain else None


class _Letters(dict):
    """Each character in the letters that stand for its bytes in a byte-level vocabulary."""

    def __missing__(self, code: int) -> str:
        step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self[code] = step.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class _Memory:
    """Ids by name: each name's row, and the rows' ids one after another."""

    def __init__(self, name, ids: list[int]):
        self.row = {name: 0}
        self.ids = np.array(ids, dtype=np.uint32)
        self.first, self.size = np.zeros(1, dtype=np.int64), np.array([len(ids)], dtype=np.int64)

    def add(self, names: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.row.update(zip(names, range(len(self.size), len(self.size) + len(names))))
        self.first = np.r_[self.first, len(self.ids) + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.ids = np.r_[self.ids, ids]

    def add_encoded(self, names: list[str], found: list) -> None:
        ids = [x.ids for x in found]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.add(names, np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(size.sum())), size)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the rows, where each row's begin; the last entry is their number)."""
        size = self.size[rows]
        total = np.r_[0, np.cumsum(size)]
        return self.ids[np.repeat(self.first[rows] - total[:-1], size) + np.arange(total[-1])], total


class Encoder:
    """The ids of whole texts, from the tokenizer's own encoding of each different word.

    New words of plain Latin letters, digits and signs are cut by the tokenizer's own pattern, and
    its model encodes each different piece; other words pass through the whole tokenizer."""

    def __init__(self, path: str, end_id: int | None, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_spaces(self.tokenizer)
        self.end = [] if end_id is None else [end_id]
        pattern = _piece_pattern(self.tokenizer)
        self.cut = regex.compile(pattern + "| ").findall if pattern else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _Letters()
        if pattern:
            bare = json.loads(self.tokenizer.to_str())
            lines = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
            bare |= {"normalizer": None, "pre_tokenizer": lines, "post_processor": None, "added_tokens": []}
            self.model = Tokenizer.from_str(json.dumps(bare))
            del bare
        common.trim()  # the tokenizer's file as Python values
        self.words, self.pieces = _Memory(None, self.end), _Memory(" ", [])  # None: a text's end; a space has no ids

    def _learn(self, new: set[str]) -> None:
        plain: list[str] = []
        if self.cut:
            joined = "\n".join(new)
            plain = _PLAIN(joined)
            if any(t in joined for t in self.special):
                plain = [w for w in plain if not any(t in w for t in self.special)]
        if plain:
            cut = self.cut(" ".join(plain).lower())
            if len(self.pieces.row) > self.remembered:
                self.pieces = _Memory(" ", [])
            unknown = list(set(cut).difference(self.pieces.row))
            as_bytes = [x if x.isascii() else x.translate(self.letters) for x in unknown]
            self.pieces.add(unknown, *self._piece_ids(as_bytes))
            rows = np.fromiter(map(self.pieces.row.__getitem__, cut), dtype=np.int64, count=len(cut))
            ids, total = self.pieces.take(rows)
            gaps = np.flatnonzero(rows == 0)  # between the words; a space itself adds no ids
            self.words.add(plain, ids, np.diff(np.r_[0, total[gaps], total[-1]]))
        rest = list(new.difference(plain))
        self.words.add_encoded(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False))

    def _piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has).  Pieces hold no line break and go to the model as lines of
        one text, which it cuts there: a result for each piece would cost more than the encoding."""
        ids, size = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for lo in range(0, len(pieces), LINES):
            part = pieces[lo:lo + LINES]
            found = self.model.encode("\n".join(part), add_special_tokens=False)
            ids.append(np.array(found.ids, dtype=np.uint32))
            size.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(size)

    def __call__(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin; the last entry is their number)."""
        if not self.by_word:
            found = [[*x.ids, *self.end] for x in self.tokenizer.encode_batch(values, add_special_tokens=False)]
            return np.array(list(chain.from_iterable(found)), dtype=np.uint32), np.cumsum([0, *map(len, found)])
        split = [[*self._lowered(x).replace("\n", " ").split(" "), None] for x in values]
        words = list(chain.from_iterable(split))
        ends = np.cumsum([0, *map(len, split)])
        for _ in range(2):
            rows = np.fromiter(map(self.words.row.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            missing = np.flatnonzero(rows < 0).tolist()
            new = set(map(words.__getitem__, missing))
            if len(self.words.row) + len(new) <= self.remembered:
                break
            self.words = _Memory(None, self.end)  # full: begin anew, and look again
        if new:
            self._learn(new)
            rows[missing] = [self.words.row[words[k]] for k in missing]
        ids, total = self.words.take(rows)
        return ids, total[ends]

    def _lowered(self, text: str) -> str:
        """The text in lower case, where the tokenizer does nothing else to it: one form of a word to know."""
        return text.lower() if self.cut and _LATIN(text) and not _SPECIAL(text) else text


def _encode(path: str, end_id: int | None, at: int, remembered: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder = common.kept(f"encoder {path} {end_id} {remembered}", lambda: Encoder(path, end_id, remembered))
        for batch in batches:
            values = [x or "" for x in batch.column(at).to_pylist()]
            for lo, hi in common.chunks(values, chunk):
                ids, starts = encoder(values[lo:hi])
                tokens = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.view(np.int32)))
                rest = [c.slice(lo, hi - lo) for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, tokens], names=["doc_id", "tokens"])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
          end_id: int | None = None, remembered: int = REMEMBERED, chunk: int = CHUNK) -> None:
    """Encode every row of ``docs`` and write (doc_id, tokens array<int>) as ORC files in ascending id order.
    ``remembered``: words that a process keeps with their ids; ``chunk``: characters of texts that it takes
    apart at once.  Less of either takes less memory and more time."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    order = [F.col("doc_id"), F.xxhash64("t")]
    kind = rows.schema["doc_id"].dataType.simpleString()
    encoded = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _encode(tokenizer, end_id, 1, remembered, chunk), f"doc_id {kind}, tokens array<int>")
    encoded.write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str, doc_id_type: str = "bigint") -> DataFrame:
    """(doc_id, tokens) of the files; a filter on ``doc_id`` is pushed down to stripes and row groups."""
    return spark.read.schema(f"doc_id {doc_id_type}, tokens array<int>").orc(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.forget()
    for batch in batches:
        tokens = batch.column(1)
        ends, ids = tokens.offsets.to_numpy(), tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int64)),
                                          pa.array(crc, pa.int64()), *batch.columns[2:]],
                                         names=["doc_id", "n_tokens", "ids_crc32", "file", "row"])


def index(spark: SparkSession, path: str, doc_id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files: ``start`` counts the ids of
    all documents before it.  Running totals of each file, then of the files in range order."""
    rows = read(spark, path, doc_id_type).select("doc_id", "tokens", F.col("_metadata.file_name").alias("file"), F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("row"))
    found = common.stored(rows.mapInArrow(
        _digest, f"doc_id {doc_id_type}, n_tokens long, ids_crc32 long, file string, row struct<block:long,at:long>"),
        "orc-index")
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("file").alias("f"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        before, F.col("file") == F.col("f"))
    return rows.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def export(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = None,
           path: str | None = None, remembered: int = REMEMBERED, chunk: int = CHUNK) -> DataFrame:
    """Write ``docs`` as token files (a new folder of the shared one unless ``path`` is given), and
    return :func:`index` of what the files hold."""
    path = path or shared_dir(docs.sparkSession, "llm", f"tokens-{uuid.uuid4().hex}")
    write(docs, path, tokenizer, doc_id, text, end_id, remembered, chunk)
    return index(docs.sparkSession, path, docs.schema[doc_id].dataType.simpleString())
