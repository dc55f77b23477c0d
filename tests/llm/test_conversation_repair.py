import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from webtrail.llm import conversation_repair as cr
from webtrail.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        part = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        role, text = part(role), part(text)
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def key(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role[:32], text[:32],
            hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())


def fault_of(row, seen):
    text = row[3]
    if not text.strip(SPACE):
        return "blank"
    if row[2:] in seen:
        return "duplicate"
    return None if text.rstrip(SPACE)[-1] in ".!?" else "truncated"


def search(rows, faults):
    """Uniform-cost search over (cost, audit): the first accepted end has the least audit of the cheapest."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, made = heapq.heappop(heap)
        if (i, roles) in done:
            continue
        done.add((i, roles))
        if i == len(rows) and PATTERN.fullmatch(roles):
            return cost, audit, made
        if len(roles) > 2 * len(rows) + 4:
            continue
        moves = [("I", 5, x[0], ((x, ""),), i) for x in ("user", "assistant")]
        if i < len(rows):
            _, _, role, text = rows[i]
            moves.append(("D", 2, "", (), i + 1))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                moves.append(("K", extra, role[:1] or "?", ((role, text),), i + 1))
                moves += [("R", 1 + extra, x[0], ((x, text),), i + 1) for x in ("user", "assistant")]
        for letter, price, initial, new, at in moves:
            now = roles + initial
            if any(PATTERN.fullmatch(now + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + price, audit + letter, at, now, made + new))


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], [])
    for r in damaged(rows):
        groups[r[0]].append(r)
    out = []
    for conv, held in groups.items():
        held.sort(key=key)
        seen, faults = set(), []
        for r in held:
            faults.append(fault_of(r, seen))
            seen.add(r[2:])
        turns = {r[1] for r in held} - {None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        cost, audit, made = search(held, faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def corpus(n=150):
    rnd = random.Random(4)
    texts = ["Fine.", "Yes!", "open end", "", " \n", "Fine.", "Why?\n", "a.b", "...", "é", "long text " * 20 + ".", " ", "\u0085", "Fine.\u2028", "Fine.\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "usher", None]
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(0, 9)):
            if rnd.random() < 0.8:
                role = ("user", "assistant")[turn % 2] if rnd.random() < 0.7 else rnd.choice(roles)
                rows.append((conv, turn * rnd.choice([1, 1, 1, 2]), role, rnd.choice(texts + [f"{turn} said."] * 9 + [None])))
    rows += [(None, t, r, f"{t}.") for t, r in enumerate(["user", "assistant", "system", "user"])]
    rows += [(1000, None, "user", "no turn."), (1000, None, None, None), (1001, 3, "user", "same."), (1001, 3, "user", "same.")]
    return rows + [r for r in rows[:5]]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(3)
    got = cr.report(df.select("conv"), cr.damage(df, "conv"), **options)
    assert got.columns == ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted([tuple(r) for r in got.collect()], key=repr)


@pytest.mark.parametrize("block_rows", [1, 4, 1 << 16])
def test_report_equals_search_whatever_the_blocks(spark, block_rows):
    rows = corpus(60 if block_rows == 1 else 150)
    assert run(spark, rows, block_rows=block_rows) == plain(rows)


def test_registered_query_equals_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, folder)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain(rows)


def test_one_long_conversation_over_many_blocks(spark):
    rnd = random.Random(8)
    rows = [(7, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice([f"{t}.", f"{t}", "", "again."]))
            for t in range(60)]
    whole = run(spark, rows)
    assert run(spark, rows, block_rows=5) == whole == plain(rows)


def test_repaired_rows_read_as_the_pattern(spark):
    df = spark.createDataFrame(corpus(), "conv long, turn long, role string, text string")
    rows = cr.damage(df, "conv")
    made = cr.repaired(rows, cr.plan(cr.faults(rows, 7)))
    roles = made.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("position", "role", "edit", "text"))).alias("r"))
    for conv, found in roles.collect():
        assert PATTERN.fullmatch("".join(x.role[0] for x in found)), conv
        assert [x.position for x in found] == list(range(len(found)))
        assert all(x.text == "" for x in found if x.edit == "I")


def test_empty_table_and_clashing_columns(spark):
    ddl = "conv_id long, turn long, role string, text string"
    names = ["conv", "s_no", "block", "piece", "audit", "blank", "row", "first", "__fault", "digest"]
    df = spark.createDataFrame([], ddl)
    assert cr.report(df.select(F.col("conv_id").alias("conv")), cr.damage(df)).collect() == []
    rows = [(1, t, r, f"{t} x.") for t, r in enumerate(["user", "assistant"])]
    df = spark.createDataFrame(rows, ddl).withColumns({c: F.lit("z") for c in names})
    got = cr.report(df.select(F.col("conv_id").alias("conv")), cr.damage(df)).collect()
    assert [tuple(r) for r in got] == plain(rows)
