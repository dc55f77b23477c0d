"""Cheapest repair of conversations, the least of the cheapest by its audit string.

Rows are edited by Keep (0), Rerole to user or assistant (1), Delete (2) or an Insert of an empty row
(5), so that the role initials read ``(s?(ua)+)?``.  The states of that pattern are start, after s,
after u and after a; from each state there is one role that a Rerole or an Insert can give.

1. All rows are numbered in order (conversation, turn, ties by role and text) over range partitions,
   without their texts, and cut into blocks of equal row counts.  A block may hold many conversations
   or a piece of one, so a conversation of any size is spread over tasks.
2. Pieces at the rim of a block become (min, +) matrices of states.  One small task a conversation
   chains its matrices (16 numbers a block) and gives each piece the cost to go behind it.
3. Each block does the cost DP backwards over all its pieces at once and ranks the nodes of the
   optimal arcs by prefix doubling: the rank of the first 2k letters of a node's audit is that of the
   pair (its first k letters, the first k letters of the node k arcs on).  At a node two optimal arcs
   never have the same initial, so the pointer to the node k arcs on is unique.  Ranks select each
   node's arc, and the doubled pointers list the path from a piece's first node.
4. A piece that begins inside a conversation does so for all four states; a second chain picks the one
   that the piece before leaves.

Repaired rows come from one shuffle of the texts by conversation, sorted as in 1; rows and audits are
read side by side as streams, so no conversation is held in memory.

Defined results: ties of a turn are ordered by the first 32 characters of role and text, then by their
digest; null turns come first; null role or text is one space; a null conversation id is a conversation
of its own; repeated rows are duplicates; the initial of an empty role fits nowhere; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common
from webtrail.operators.sequence import global_sequence

#: Rows of a block.
BLOCK_ROWS = 1 << 16
# Costs of the edits, and what a kept truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: 0 start, 1 after s, 2 after u, 3 after a.  Where a Rerole or an Insert leads, and a Keep by initial.
FREE = np.array([2, 2, 3, 2])
KEEP = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
INITIALS = {"s": 1, "u": 2, "a": 3}
ROLE_OF_STATE = {2: "user", 3: "assistant"}
LETTERS = np.frombuffer(b"?DIKR", np.uint8)  # by label, ASCII order
_FAR = 1 << 40
_END = np.array([0, _FAR, _FAR, 0])
_BLANK = r"\A[\x20\x09-\x0D]*\z"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults by crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fault = F.pmod(F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")), F.lit(20))
    plain = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(part(role)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(part(text), "[.!?]", "")).otherwise(part(text)).alias("text"),
        fault.alias("__fault")).filter("__fault <> 0")
    return plain.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__fault") == 3, 2).otherwise(1)))
                            ).drop("__fault", "__copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the columns that order the rows of a turn; nulls as one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return rows.select("conv", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       F.substring(role, 1, 32).alias("k_role"), F.substring(text, 1, 32).alias("k_text"),
                       F.unhex(digest).alias("digest"))


_KEY = ["k_role", "k_text", "digest"]


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), *map(F.col, _KEY)]


def faults(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored: every row without its text, numbered, with its first fault (blank, duplicate, truncated)."""
    narrow = _keyed(rows).select(
        "conv", "turn", *_KEY, F.substring("role", 1, 1).alias("initial"), F.col("text").rlike(_BLANK).alias("blank"),
        (~F.col("text").rlike(_WHOLE)).alias("open"), F.monotonically_increasing_id().alias("row"))
    numbered = global_sequence(narrow, [*_order(), F.col("row")])
    # the first of equal rows is found by a partial aggregate and joined by number: no hot key in a join
    first = numbered.filter(~F.col("blank")).groupBy("conv", "digest").agg(F.min("s_no").alias("s_no"))
    first = first.select("s_no", F.lit(True).alias("first"))
    duplicate = ~F.col("blank") & F.col("first").isNull()
    return common.stored(numbered.join(first, "s_no", "left").select(
        "conv", "turn", *_KEY, "s_no", F.floor((F.col("s_no") - 1) / block_rows).alias("block"), "initial", "blank",
        duplicate.alias("duplicate"), (~F.col("blank") & ~duplicate & F.col("open")).alias("truncated")), "repair-faults")


class Block:
    """The rows of a block in order, as numpy columns, cut into pieces of conversations."""

    def __init__(self, table: pa.Table):
        self.table = table = table.sort_by("s_no").combine_chunks()
        conv = table["conv"].combine_chunks()
        ends = np.asarray(pc.run_end_encode(conv).run_ends) if len(conv) else np.zeros(0, np.int64)
        self.ends, self.starts = ends.astype(np.int64), np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.role = np.array([INITIALS.get(x, 0) for x in table["initial"].to_pylist()], np.int64)
        column = lambda name: np.asarray(table[name].combine_chunks().cast(pa.uint8())).astype(bool)
        self.forced = column("blank") | column("duplicate")
        self.late = np.where(column("truncated"), TRUNCATED, 0).astype(np.int64)
        self.s_no = np.asarray(table["s_no"].combine_chunks())

    def illegal(self) -> np.ndarray:
        """Adjacent initials of each piece that are not su, ua or au."""
        bad = np.ones(len(self.role), np.int64)
        bad[1:] = ~fits(self.role[:-1], self.role[1:])
        bad[self.starts] = 0
        return np.add.reduceat(bad, self.starts) if len(bad) else bad


def fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether initials (1 s, 2 u, 3 a) may follow each other."""
    return ((b == 2) & ((a == 1) | (a == 3))) | ((a == 2) & (b == 3))


def _inserts(b: np.ndarray) -> np.ndarray:
    """Costs to go by state when rows may be inserted before the next row; two in a row never help twice."""
    u, a = np.minimum(b[:, 2], b[:, 3] + INSERT), np.minimum(b[:, 3], b[:, 2] + INSERT)
    return np.stack([np.minimum(b[:, 0], u + INSERT), np.minimum(b[:, 1], u + INSERT), u, a], axis=1)


def _edit_costs(after: np.ndarray, role: np.ndarray, forced: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cost to go by state (axis 1) for Delete, Keep and Rerole of one row, given the costs after it."""
    wide = (slice(None), None, None)
    extra = np.where(forced, _FAR, late)[wide]
    to = KEEP[role]
    keep = np.take_along_axis(after, np.maximum(to, 0)[:, :, None], axis=1) + extra + np.where(to < 0, _FAR, 0)[:, :, None]
    return after + DELETE, keep, after[:, FREE] + REROLE + extra


def costs_to_go(block: Block, pieces: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs of the layers of the pieces, (layer, state, goal), and each piece's first layer.

    A piece of n rows has n + 1 layers; ``after`` (piece, state, goal) is its last.  All pieces go
    back row by row together, the longest ones longest."""
    starts, ends = block.starts[pieces], block.ends[pieces]
    length = ends - starts
    base = np.concatenate([[0], np.cumsum(length + 1)[:-1]]).astype(np.int64)
    out = np.empty((int((length + 1).sum()), 4, after.shape[2]), np.int64)
    out[base + length] = after
    by_length = np.argsort(-length, kind="stable")
    falling = -length[by_length]
    for back in range(1, int(length.max(initial=0)) + 1):
        now = by_length[:np.searchsorted(falling, -back, side="right")]
        rows, layer = ends[now] - back, base[now] + length[now] - back
        delete, keep, rerole = _edit_costs(out[layer + 1], block.role[rows], block.forced[rows], block.late[rows])
        out[layer] = np.minimum(_inserts(np.minimum(np.minimum(delete, keep), rerole)), _FAR)
    return out, base


def least_paths(block: Block, after: np.ndarray, last: np.ndarray):
    """(costs, first layers, label, head, jumps): the least audits of all pieces' nodes.

    Nodes are layer * 4 + state; labels are 1 Delete, 2 Insert, 3 Keep, 4 Rerole, and 0 at the end
    of a path; ``jumps[k]`` leads 2**k arcs on.  ``last``: pieces that end their conversation, behind
    whose rows an Insert may follow; other pieces leave that to the next one."""
    costs, base = costs_to_go(block, np.arange(len(block.starts)), after[:, :, None])
    cost = costs[:, :, 0]
    length = block.ends - block.starts
    layer = np.arange(len(block.role)) + np.repeat(np.arange(len(length)), length)
    state = np.arange(4)
    arcs = np.full((4, len(cost), 4), _FAR)  # cost over each arc, by label - 1
    heads = np.broadcast_to(np.arange(len(cost) * 4).reshape(-1, 4), arcs.shape).copy()
    delete, keep, rerole = _edit_costs(costs[layer + 1], block.role, block.forced, block.late)
    arcs[0, layer], arcs[2, layer], arcs[3, layer] = delete[:, :, 0], keep[:, :, 0], rerole[:, :, 0]
    follow = (layer + 1)[:, None] * 4
    heads[0, layer], heads[2, layer], heads[3, layer] = follow + state, follow + KEEP[block.role], follow + FREE
    inner = np.concatenate([layer, (base + length)[last]])
    arcs[1, inner], heads[1, inner] = cost[inner][:, FREE] + INSERT, inner[:, None] * 4 + FREE
    best = (arcs == cost) & (cost < _FAR)
    best[:, (base + length)[last]] &= (_END[state] >= _FAR)  # an accepted end stops
    best, heads = best.reshape(4, -1), heads.reshape(4, -1)
    node = np.arange(best.shape[1])
    first = np.where(best.any(axis=0), best.argmax(axis=0) + 1, 0)
    jump = np.where(first > 0, heads[np.maximum(first - 1, 0), node], node)
    rank, jumps = first.astype(np.int64), [jump]
    while not np.array_equal(jump, jump[jump]):
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]
        jumps.append(jump)
    # each node's arc: the least by (initial, rank of what follows)
    order = np.where(best, (np.arange(4) + 1)[:, None] * (int(rank.max(initial=0)) + 1) + rank[heads], np.iinfo(np.int64).max)
    label = np.where(best.any(axis=0), order.argmin(axis=0) + 1, 0)
    return cost, base, label, jumps


def audits(starts: np.ndarray, label: np.ndarray, jumps: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """The audit of the path from each start node, and the node where it ends."""
    steps = np.zeros(len(starts), np.int64)  # arcs to the end, by the pointers, from the longest down
    at = starts.copy()
    ends = jumps[-1][starts]
    for k in range(len(jumps) - 1, -1, -1):
        far = jumps[k][at]
        go = label[far] > 0  # still inside the path: the end is further on
        at, steps = np.where(go, far, at), steps + np.where(go, 1 << k, 0)
    steps += label[at] > 0
    offsets = np.concatenate([[0], np.cumsum(steps)])
    place = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], steps)
    path = np.repeat(starts, steps)
    for k, jump in enumerate(jumps):
        move = (place >> k) & 1 == 1
        path[move] = jump[path[move]]
    letters = LETTERS[label[path]].tobytes()
    return [letters[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], ends


def _rim(table: pa.Table) -> pa.Table:
    """The matrices of the first and the last piece of a block."""
    block = Block(table)
    pieces = np.unique([0, len(block.starts) - 1])
    goals = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(pieces), 4, 4))
    costs, base = costs_to_go(block, pieces, goals)
    starts, ends = block.starts[pieces], block.ends[pieces]
    return pa.table({"conv": block.table["conv"].take(pa.array(starts)), "block": block.table["block"].take(pa.array(starts)),
                     "piece": block.s_no[starts], "matrix": pa.array(costs[base].reshape(-1, 16).tolist(), pa.list_(pa.int64())),
                     "head": block.role[starts], "tail": block.role[ends - 1]})


def _chain(table: pa.Table) -> pa.Table:
    """What follows each rim piece of one conversation: costs to go; the whole cost; pairs across cuts."""
    table = table.sort_by("piece")
    matrices = np.array(table["matrix"].to_pylist(), np.int64).reshape(-1, 4, 4)
    head, tail = (np.array(table[c].to_pylist(), np.int64) for c in ("head", "tail"))
    after = np.empty((len(matrices), 4), np.int64)
    now = _inserts(_END[None, :, None])[0, :, 0]
    for i in range(len(matrices) - 1, -1, -1):
        after[i] = now
        now = (matrices[i] + now[None, :]).min(axis=1)
    at = np.arange(len(matrices))
    return pa.table({"block": table["block"], "piece": table["piece"], "after": pa.array(after.tolist(), pa.list_(pa.int64())),
                     "first": at == 0, "last": at == len(at) - 1,
                     "joints": np.where(at == 0, int((~fits(tail[:-1], head[1:])).sum()), 0)})


def _paths(rows: pa.Table, rims: pa.Table) -> pa.Table:
    """The least audits of all pieces of a block; of one that begins inside a conversation for each state."""
    block = Block(rows)
    n = len(block.starts)
    after = np.broadcast_to(_inserts(_END[None, :, None])[0, :, 0], (n, 4)).copy()
    first, last, joints = np.ones(n, bool), np.ones(n, bool), np.zeros(n, np.int64)
    known = {int(s): i for i, s in enumerate(block.s_no[block.starts])}
    for rim in rims.to_pylist():
        i = known[rim["piece"]]
        after[i], first[i], last[i], joints[i] = rim["after"], rim["first"], rim["last"], rim["joints"]
    cost, base, label, jumps = least_paths(block, after, last)
    piece = np.repeat(np.arange(n), np.where(first, 1, 4))
    entry = np.concatenate([np.zeros(0, np.int64), *[[0] if f else [0, 1, 2, 3] for f in first.tolist()]]).astype(np.int64)
    found, ends = audits(base[piece] * 4 + entry, label, jumps)
    rows_at = pa.array(block.starts[piece])
    keep = {c: block.table[c].take(rows_at) for c in ("conv", "turn", *_KEY)}
    return pa.table({**keep, "piece": block.s_no[block.starts[piece]], "entry": entry, "exit": ends % 4,
                     "inside": ~(first & last)[piece], "illegal": (block.illegal() + joints)[piece],
                     "cost": np.where(first[piece], cost[base[piece], 0], 0), "audit": pa.array([x.decode() for x in found])})


def _pick(table: pa.Table) -> pa.Table:
    """The state in which each piece of one conversation is entered."""
    exits = {(r["piece"], r["entry"]): r["exit"] for r in table.to_pylist()}
    state, out = 0, []
    for piece in sorted({p for p, _ in exits}):
        out.append((piece, state))
        state = exits[piece, state]
    return pa.table({"piece": pa.array([p for p, _ in out], pa.int64()), "entry": pa.array([e for _, e in out], pa.int64())})


def plan(found: DataFrame) -> DataFrame:
    """Stored: the pieces of all conversations of :func:`faults` with their parts of the least audits."""
    kind = found.schema["conv"].dataType.simpleString()
    shape = found.select("conv", "turn", *_KEY, "block", "s_no", "initial", "blank", "duplicate", "truncated")
    rims = shape.drop("turn", *_KEY).groupBy("block").applyInArrow(
        _rim, f"conv {kind}, block long, piece long, matrix array<long>, head long, tail long")
    chained = rims.groupBy("conv").applyInArrow(
        _chain, "block long, piece long, after array<long>, first boolean, last boolean, joints long")
    paths = common.stored(shape.groupBy("block").cogroup(common.stored(chained, "repair-rims").groupBy("block")).applyInArrow(
        _paths, f"conv {kind}, turn long, k_role string, k_text string, digest binary, piece long, entry long, exit long, "
                "inside boolean, illegal long, cost long, audit string"), "repair-paths")
    cut = paths.filter("inside")
    picks = cut.select("conv", "piece", "entry", "exit").groupBy("conv").applyInArrow(_pick, "piece long, entry long")
    return paths.filter("not inside").unionByName(cut.join(picks, ["piece", "entry"], "left_semi").select(*paths.columns))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task in order, audits before their rows, to repaired rows in order."""
    conv, audit, at, state, place = None, "", 0, 0, 0
    out: list[tuple] = []

    def add(letter: str, role: str, text: str) -> None:
        nonlocal place
        out.append((conv, place, letter, role, text))
        place += 1

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = int(FREE[state])
            add("I", ROLE_OF_STATE[state], "")
            at += 1

    begun = False
    for batch in batches:
        kinds = batch.schema.field("conv").type
        schema = pa.schema([("conv", kinds), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                            ("text", pa.string())])
        for c, part, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "audit", "role", "text"))):
            if not begun or c != conv:
                inserts()
                begun, conv, audit, at, state, place = True, c, "", 0, 0, 0
            if part is not None:
                audit, at = audit[at:] + part, 0
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter == "K":
                state = int(KEEP[INITIALS[role[0]], state])
                add("K", role, text)
            elif letter == "R":
                state = int(FREE[state])
                add("R", ROLE_OF_STATE[state], text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    if begun:
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired conversations: (conv, position from 0, edit, role, text), each in order within one task."""
    kind = rows.schema["conv"].dataType.simpleString()
    texts = _keyed(rows).withColumns({"piece": F.lit(None).cast("long"), "audit": F.lit(None).cast("string")})
    marks = pieces.select("conv", "turn", *_KEY, "piece", "audit").withColumns(
        {"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    both = texts.unionByName(marks).repartition("conv")
    # audits come before the rows of the same key, in their order; what is left of one waits
    both = both.sortWithinPartitions(*_order(), F.col("piece").asc_nulls_last())
    return both.select("conv", "audit", "role", "text").mapInArrow(
        _edited, f"conv {kind}, position long, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha, schema = None, None, None
    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field("conv").type), ("sha", pa.string())])
        done = []
        for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "text"))):
            if sha is None or c != conv:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], schema[0].type), pa.array([sha.hexdigest()])], schema=schema)


def report(conversations: DataFrame, rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation id (column ``conv``) of ``conversations``: gaps, faults, illegal pairs,
    cost, audit and digest of its repair.  ``rows`` (conv, turn, role, text) are what is to be repaired."""
    kind = rows.schema["conv"].dataType.simpleString()
    found = faults(rows, block_rows)
    pieces = common.stored(plan(found), "repair-plan")
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = found.groupBy("conv").agg(count("blank"), count("duplicate"), count("truncated"), gaps.alias("gaps"))
    parts = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    costs = pieces.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                       F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    digests = repaired(rows, pieces).select("conv", "role", "text").mapInArrow(_digests, f"conv {kind}, sha string")
    whole = conversations.select("conv")
    for part in (counts, costs, digests):
        whole = whole.unionByName(part, allowMissingColumns=True)
    number = lambda c: F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c)
    empty = hashlib.sha256().hexdigest()
    return whole.groupBy("conv").agg(
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha"), F.lit(empty)).alias("repaired_sha256"))
