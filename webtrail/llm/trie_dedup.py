"""Exact deduplication: full texts in compressed radix (Patricia) tries that know each text's owner.

1. Each input task inserts its normalised texts into a trie.  A terminal node stores the smallest
   identifier of the rows that end there; equal texts of a task become one *open* row, so a group of
   copies enters the shuffle at most once a task (more only when a trie was full).
2. Open rows are dealt out by text length and content hash, and each task inserts the full byte
   strings into a trie again: the hash only deals them out, equal are texts that reach the same
   terminal.  Every row gets a *link* to the smallest row of its terminal.
3. A key (length, hash) whose rows hold more bytes than a task is meant to get is dealt over several
   tasks, whose owners stay open.  A trie that outgrows its memory spills its largest subtree: the
   subtree's owners stay open, and so does every later row of that task that leads into it.  Open
   rows are written to the shared folder and meet in a further round, until none is left.
4. Links of the rounds are put together, from the last to the first, and joined with the documents
   by row number.  Texts never pass this join.

Defined results: null text is empty; only ``[\\x20\\x09-\\x0D]`` counts as white space; of equal
texts the row with the smallest id stays (null ids last), of rows that repeat that id exactly one;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common

#: Bytes of texts, nodes and members that one trie may hold in a task.
TRIE_BYTES = 64 << 20
#: Bytes of open rows a task is meant to get, and what a row counts beside its text.
TASK_BYTES, ROW_BYTES = 32 << 20, 64
#: Least rows of a key for each task it is dealt over, so that a round always shrinks it.
MIN_ROWS = 16
_NODE_BYTES, _MEMBER_BYTES = 600, 120
_SPACE = b" \t\n\x0b\x0c\r"
_LAST = 1 << 63  # sorts null ids behind all others


def normalise(text: bytes) -> bytes:
    """Each run of white space as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    return (b" " if text[0] in _SPACE else b"") + b" ".join(words) + (b" " if text[-1] in _SPACE else b"")


class Node:
    """An edge ``text[start:end]`` and what follows it.  Labels are slices of texts held by terminals
    (of any one below the edge), so no label is copied."""

    __slots__ = ("text", "start", "end", "cost", "children", "owner", "members", "size")

    def __init__(self, text: bytes, start: int, end: int, cost: int):
        self.text, self.start, self.end, self.cost = text, start, end, cost
        self.children: dict[int, Node] = {}
        self.owner: tuple | None = None  # (id, row) that sorts first among the members
        self.members: list = []
        self.size = 0  # documents that end here

    def whole(self) -> bytes:
        """The text that ends here: labels are slices of texts that begin with the path to them."""
        return self.text[:self.end]


def _common(a: bytes, i: int, b: bytes, j: int, most: int) -> int:
    """Length of the common prefix of a[i:] and b[j:], at most ``most``, by halving."""
    if a[i:i + most] == b[j:j + most]:
        return most
    low, high = 0, most - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[i + low:i + middle] == b[j + low:j + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie over byte strings.  ``insert`` returns False where the text leads into a branch
    that was spilled; such a text belongs with it."""

    def __init__(self, limit: int):
        self.root, self.limit, self.held = Node(b"", 0, 0, 0), limit, 0
        self.spilled: set[tuple[int, int]] = set()  # (node, first byte) of the branches

    def insert(self, text: bytes, rank: tuple, member, size: int) -> bool:
        node, at = self.root, 0
        while at < len(text):
            first = text[at]
            child = node.children.get(first)
            if child is None:
                if (id(node), first) in self.spilled:
                    return False
                child = node.children[first] = Node(text, at, len(text), _NODE_BYTES + len(text))
                self.held += child.cost
                node = child
                break
            most = min(child.end - child.start, len(text) - at)
            same = _common(text, at, child.text, child.start, most)
            if child.start + same < child.end:
                middle = node.children[first] = Node(child.text, child.start, child.start + same, _NODE_BYTES)
                child.start += same
                middle.children[child.text[child.start]] = child
                self.held += _NODE_BYTES
                child = middle
            node, at = child, at + same
        node.owner = rank if node.owner is None else min(rank, node.owner)
        node.members.append(member)
        node.size += size
        self.held += _MEMBER_BYTES
        return True

    def full(self) -> bool:
        return self.held > self.limit

    @staticmethod
    def nodes(top: Node) -> Iterator[Node]:
        stack = [top]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(node.children.values())

    def terminals(self) -> list[Node]:
        return [x for x in self.nodes(self.root) if x.owner is not None]

    def spill(self, mark: bool) -> list[Node]:
        """Cut the largest branch where the trie first branches and return its terminals; none if one
        text is all there is.  ``mark``: later texts of the branch are refused."""
        node = self.root
        while len(node.children) == 1 and node.owner is None:
            (node,) = node.children.values()
        sizes = {first: sum(x.cost + _MEMBER_BYTES * len(x.members) for x in self.nodes(child))
                 for first, child in node.children.items()}
        if not sizes:
            return []
        first = max(sizes, key=lambda b: (sizes[b], -b))
        cut = [x for x in self.nodes(node.children.pop(first)) if x.owner is not None]
        if mark:
            self.spilled.add((id(node), first))
        self.held -= sizes[first]
        return cut


#: Documents after the first step; ``text`` and ``n`` are those of the open rows alone.
_LOCAL = "row long, id long, sha binary, up long, length long, hash long, n long, text binary"
#: Open rows after a round, and the links of all its rows.  ``keep`` is null while ``up`` is open.
_ROUND = "row long, up long, keep_row long, keep_id long, n long, length long, hash long, text binary"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _emit(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes (the text is the last column)."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += ROW_BYTES + len(r[-1] or b"")
        if size > common.BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


_LOCAL_ARROW = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("sha", pa.binary()), ("up", pa.int64()),
                          ("length", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
_ROUND_ARROW = pa.schema([("row", pa.int64()), ("up", pa.int64()), ("keep_row", pa.int64()), ("keep_id", pa.int64()),
                          ("n", pa.int64()), ("length", pa.int64()), ("hash", pa.int64()), ("text", pa.binary())])


def _local(limit: int):
    """The first step: (row, id, text) to one row a document, with the text on the open rows."""

    def flush(terminals: list[Node]) -> Iterator[tuple]:
        for node in terminals:
            up, text = node.owner[1], node.whole()
            sha = hashlib.sha256(text).digest()
            for row, ident in node.members:
                if row == up:
                    yield row, ident, sha, up, len(text), _signed(xxhash.xxh64_intdigest(text)), node.size, text
                else:
                    yield row, ident, sha, up, None, None, None, None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = Trie(limit)
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for (row, ident), raw in zip(keys, common.texts(batch.column(2))):
                trie.insert(normalise(raw), (_LAST if ident is None else ident, row), (row, ident), 1)
                if trie.full():
                    cut = trie.spill(mark=False)
                    if not cut:
                        cut, trie = trie.terminals(), Trie(limit)
                    yield from flush(cut)
        yield from flush(trie.terminals())

    return lambda batches: _emit(rows(batches), _LOCAL_ARROW)


def _merge(limit: int):
    """A round: (salted, row, id, n, length, hash, text) to links, and to open rows for the next one."""

    def links(node: Node, is_open: bool) -> Iterator[tuple]:
        (rank, up), text = node.owner, node.whole() if is_open else None
        ident, size = None if rank == _LAST else rank, node.size
        for row in node.members:
            if not is_open:
                yield row, up, up, ident, size, None, None, None
            elif row == up:
                yield row, up, None, ident, size, len(text), _signed(xxhash.xxh64_intdigest(text)), text
            else:
                yield row, up, None, None, None, None, None, None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tries = {False: Trie(limit), True: Trie(limit)}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for salted, row, ident, n, length, key, text in zip(*columns, common.texts(batch.column(6))):
                trie = tries[salted]
                if not trie.insert(text, (_LAST if ident is None else ident, row), row, n):
                    yield row, row, None, ident, n, length, key, text
                while trie.full() and (cut := trie.spill(mark=True)):
                    for node in cut:
                        yield from links(node, True)
        for salted, trie in tries.items():
            for node in trie.terminals():
                yield from links(node, salted)

    return lambda batches: _emit(rows(batches), _ROUND_ARROW)


def _deal(rows: DataFrame, task_bytes: int) -> DataFrame:
    """Open rows (row, id, n, length, hash, text) over tasks by length and hash; a key with more than
    ``task_bytes`` over several, marked ``salted``.  There are at most total / task_bytes such keys,
    one for each task, which bounds the broadcast."""
    spark = rows.sparkSession
    size = F.col("length") + ROW_BYTES
    total = rows.agg(F.sum(size)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))
    parts = F.least(F.ceil(F.col("b") / task_bytes), F.ceil(F.col("c") / MIN_ROWS))
    hot = (rows.groupBy("length", "hash").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("c"))
           .filter(F.col("b") > task_bytes).select("length", "hash", parts.alias("parts")).filter("parts > 1"))
    salt = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.col("parts")))
    dealt = rows.join(F.broadcast(hot), ["length", "hash"], "left").withColumn("salt", salt)
    return (dealt.repartition(tasks, "length", "hash", "salt")
            .select(F.col("parts").isNotNull().alias("salted"), "row", "id", "n", "length", "hash", "text"))


def _solve(docs: DataFrame, id_col: str, text_col: str, trie_bytes: int, task_bytes: int
           ) -> tuple[DataFrame, DataFrame]:
    """Stored documents of the first step, and (row, keep_row, keep_id, n) of each of their open rows."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    local = common.stored(rows.mapInArrow(_local(trie_bytes), _LOCAL), "trie-local")
    still = local.filter("text is not null").select("row", "id", "n", "length", "hash", "text")
    rounds = []
    while True:
        done = common.stored(_deal(still, task_bytes).mapInArrow(_merge(trie_bytes), _ROUND), "trie-round")
        rounds.append(done.select("row", "up", "keep_row", "keep_id", "n"))
        still = done.filter("text is not null").select("row", F.col("keep_id").alias("id"), "n", "length", "hash", "text")
        if still.isEmpty():
            break
    links = rounds.pop()
    while rounds:
        # few rows are still open in a round, so the later links are a small part of the earlier
        later = links.select(F.col("row").alias("up"), *[F.col(c).alias(f"l_{c}") for c in ("keep_row", "keep_id", "n")])
        earlier, was_open = rounds.pop(), F.col("keep_row").isNull()
        links = earlier.join(later, "up", "left").select(
            "row", "up", *[F.when(was_open, F.col(f"l_{c}")).otherwise(F.col(c)).alias(c)
                           for c in ("keep_row", "keep_id", "n")])
    return local, links.drop("up")


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, trie_bytes: int = TRIE_BYTES,
           task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per document: (id, keep_id, group_size long, kept boolean, text_sha256 string)."""
    local, links = _solve(docs, id_col, text_col, trie_bytes, task_bytes)
    up = links.select(F.col("row").alias("up"), "keep_row", "keep_id", F.col("n").alias("size"))
    return local.select("row", "id", "sha", "up").join(up, "up").select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, trie_bytes: int = TRIE_BYTES,
                   task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per different text: (id of its owner, group_size, text as normalised)."""
    local, links = _solve(docs, id_col, text_col, trie_bytes, task_bytes)
    kept = links.filter("row = keep_row").select("row", F.col("n").alias("group_size"))
    return local.select("row", F.col("id").alias(id_col), F.col("text").cast("string").alias("text")).join(
        kept, "row").drop("row")
