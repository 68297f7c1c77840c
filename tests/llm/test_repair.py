"""Repair of conversations against a search over all edits, and the query against plain Python on whole tables."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import pytest

from maskloom.llm import queries, repair

WHITE = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda v: " " if v is None else v
        fault = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.strip(WHITE)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """The least (cost, audit) and its rows, by trying edits from the cheapest on."""
    heap, settled = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, said, out = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.fullmatch(said):
            return cost, audit, out
        if (at, said[-2:], len(said) > 1) in settled:
            continue
        settled.add((at, said[-2:], len(said) > 1))
        if not re.fullmatch(r"s?(ua)*u?", said):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", at, said + role[0], (*out, f"{role}:")))
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, said, out))
            if found[at] in ("", "truncated"):
                more = 3 if found[at] else 0
                if role[:1] in ("s", "u", "a"):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, said + role[:1], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, said + new[0], (*out, f"{new}:{text}")))
    raise AssertionError("no repair")


def expected(original):
    groups = defaultdict(list)
    for conv, *_ in original:
        groups[conv]
    for conv, turn, role, text in damaged(original):
        groups[conv].append((turn, role, text))
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        said = [r[1:] for r in rows]
        found = faults(said)
        cost, audit, fixed = cheapest(said, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])), cost, audit,
            hashlib.sha256("\n".join(fixed).encode()).hexdigest(),
        )
    return out


def answer(df):
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in rows}


SAMPLE = [
    (c, t, role, text) for c in range(60)
    for t, (role, text) in enumerate([
        ("system", "Be kind."), ("user", f"Question {c}?"), ("assistant", "Yes."), ("user", "And so"), ("user", "Now!"), ("assistant", "No."),
        ("tool", "x."), ("assistant", "Yes."), ("", "y."), ("system", "Again."), ("user", "ends \n"),
    ][: 1 + c % 11])
] + [
    (None, 0, "user", "a."), (None, 1, None, None), (-1, None, "user", "q."), (-1, None, "assistant", "r."), (-1, 3, "assistant", "r."),
    (-2, 0, "user", "same."), (-2, 0, "user", "same."), (-2, 0, "user", "same."), (-3, 5, "assistant", "  "), (-4, -7, "user", "x"), (-4, 90, "user", "z?"),
]
SCHEMA = "conv_id long, turn long, role string, text string, copies string, fresh string, _hash string, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "f", "h", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("segment, partitions", [(4096, 1), (4096, 4), (2, 4), (1, 7)])
def test_awkward_conversations(spark, segment, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = table(spark, SAMPLE)
        assert answer(repair.repair_all(rows, repair.damaged(rows), segment)) == expected(SAMPLE)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answer(queries.op11_repair(spark, sf)) == expected(rows)


def test_one_long_conversation(spark):
    """A third of all rows under one id: cut over tasks and segments, with texts that repeat."""
    rows = [(7, t, ("user", "assistant", "user")[t % 3], f"text {t % 4000}{'.' if t % 5 else ''}") for t in range(6000)]
    rows += [(100 + i // 4, i % 4, ("user", "assistant")[i % 2], f"row {i}.") for i in range(12_000)]
    got = answer(repair.repair_all(table(spark, rows), repair.damaged(table(spark, rows)), 500))
    assert got == expected(rows)


def test_empty(spark):
    none = table(spark, SAMPLE[:1]).where("false")
    assert repair.repair_all(none, repair.damaged(none)).count() == 0


def test_edits_are_applied():
    tops = repair.inserted({repair.START: (0, "")})
    for initial in "uu":
        tops = repair.advanced(tops, initial, False, False)
    assert repair.best(tops) == (3, "KR")
    assert repair.lines([("user", "a"), ("user", "b")], repair.START, "KR") == (["user:a", "assistant:b"], repair.EXCHANGES)
    assert repair.lines([("user", "a")], repair.START, "DI") == (["user:"], repair.USER)
