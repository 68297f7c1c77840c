"""Conversations whose turns follow the role grammar again, by the cheapest edits: generalised LR repair.

Grammar: conversation -> nothing | exchanges | system exchanges; exchanges -> exchange | exchanges exchange;
exchange -> user assistant. Its parser has four kinds of stack top: START, SYSTEM, USER (an exchange is open) and
EXCHANGES (reduced as soon as the assistant is shifted). All stacks that the edits of the rows so far can give are
kept as one graph; stacks with equal tops have the same future and are merged by the least (cost, audit), each top
linking back to the path it came by. Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or
assistant turn 3; a truncated row that stays costs 3 more, blank and repeated rows can only go. Merging by the least
audit is right: of two audits of one cost at one row and top neither begins the other, so what follows keeps their order.

Scale: rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any size lies in as many
tasks as it needs. A conversation inside one task is repaired there. One cut by a border, or longer than ``SEGMENT``,
is cut into segments; each gives, for every top it may be entered with, the least (cost, audit) for every top it can
be left with; these tables are put together in order, and the texts of the segments written one after the other.
Whether a row's role and text were seen before is known from an aggregation by (conversation, role, text) joined back
on whole rows, so that no frequent text meets in one task.

Nulls: a role or text that is null counts as one space; a null turn comes before all others; null conversation ids
are one conversation. Rows of one turn go by role, then text. Equal rows stay together: the first counts, the others are
duplicates. Texts of white space are blank. A role counts by its first letter ('' has none); only s, u and a are ever
kept. An empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm import store

START, SYSTEM, USER, EXCHANGES = range(4)
#: Where shifting a role leads from each top (an assistant also reduces the exchange), and the role a new turn needs.
_SHIFT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": EXCHANGES}, {"u": USER})
_NEEDED = ("user", "user", "assistant", "user")
_ACCEPTED = (START, EXCHANGES)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and characters of a segment.
SEGMENT, CHARACTERS = 4096, 4 << 20
_WHITE = " \t\n\x0b\x0c\r"
_LONG = (1 << 63) - 1

Tops = dict[int, tuple[int, str]]


def _offer(tops: Tops, top: int, way: tuple[int, str]) -> bool:
    """Merge a stack into the one with the same top: the less (cost, audit) stays."""
    if top in tops and tops[top] <= way:
        return False
    tops[top] = way
    return True


def inserted(tops: Tops) -> Tops:
    """The stacks with any turns inserted."""
    waiting = list(tops)
    while waiting:
        top = waiting.pop()
        cost, audit = tops[top]
        after = _SHIFT[top][_NEEDED[top][0]]
        if _offer(tops, after, (cost + INSERT, audit + "I")):
            waiting.append(after)
    return tops


def advanced(tops: Tops, initial: str, lost: bool, truncated: bool) -> Tops:
    """The stacks after a row: deleted, kept or with another role, and anything inserted behind it."""
    after: Tops = {}
    more = TRUNCATED if truncated else 0
    for top, (cost, audit) in tops.items():
        _offer(after, top, (cost + DELETE, audit + "D"))
        if lost:
            continue
        if initial in _SHIFT[top]:
            _offer(after, _SHIFT[top][initial], (cost + more, audit + "K"))
        _offer(after, _SHIFT[top][_NEEDED[top][0]], (cost + REROLE + more, audit + "R"))
    return inserted(after)


def best(tops: Tops) -> tuple[int, str]:
    return min(tops[t] for t in _ACCEPTED if t in tops)


class Segment:
    """Consecutive rows of one conversation: counts, and what is needed to repair them."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, bool, bool]] = []  # role, text, lost, truncated
        self.characters = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first = self.last = None

    def add(self, turn: int | None, role: str, text: str, copies: int, fresh: bool) -> None:
        kept = text.rstrip(_WHITE)
        blank = not kept
        truncated = not blank and fresh and kept[-1] not in ".!?"
        repeats = 0 if blank else copies - fresh
        self.blank += copies if blank else 0
        self.duplicate += repeats
        self.truncated += truncated
        initial = role[:1]
        self.illegal += (copies - 1) + (self.last is not None and not _legal(self.last, initial))
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if not blank and fresh:
            self.rows.append((role, text, False, truncated))
            self.characters += len(text)
        self.rows.extend([(role, "", True, False)] * (copies if blank else repeats))

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.characters >= CHARACTERS

    def ways(self, top: int) -> Tops:
        tops = inserted({top: (0, "")})
        for role, _, lost, truncated in self.rows:
            tops = advanced(tops, role[:1], lost, truncated)
        return tops


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def lines(rows: list[tuple[str, str]], top: int, audit: str) -> tuple[list[str], int]:
    """The repaired rows as ``role:text`` by an audit from a top, and the top they lead to."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = (_NEEDED[top], "") if edit == "I" else rows[at]
        if edit == "R":
            role = _NEEDED[top]
        at += edit != "I"
        out.append(f"{role}:{text}")
        top = _SHIFT[top][role[:1]]
    return out, top


def gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else min(last - first + 1 - distinct, _LONG)


_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint"
_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_CUT = f"part int, seq int, {_COUNTS}, first string, last string, ways array<struct<entry:int,top:int,cost:bigint,audit:string>>"
_ROWS = "roles array<string>, texts array<string>"


def _walked(conv_type: str, longest: int):
    """The task: conversations that lie inside it are repaired, others become segments."""
    names = ["conv_id", "found", "cut"]
    kinds = [_arrow(conv_type), pa.struct(_fields(_FOUND)), pa.struct(_fields(f"{_CUT}, {_ROWS}"))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        out: list[dict] = []
        segment, conv, started, alone = None, None, False, False

        def found() -> dict:
            cost, audit = best(segment.ways(START))
            text = "\n".join(lines([r[:2] for r in segment.rows], START, audit)[0])
            return {
                "gaps": gaps(segment.first_turn, segment.last_turn, segment.turns), "blank": segment.blank,
                "duplicate": segment.duplicate, "truncated": segment.truncated, "illegal": segment.illegal, "cost": cost,
                "audit": audit, "repaired_sha256": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
            }

        def cut() -> dict:
            ways = [
                {"entry": entry, "top": top, "cost": cost, "audit": audit}
                for entry in range(4) for top, (cost, audit) in segment.ways(entry).items()
            ]
            return {
                "part": part, "seq": seq, "ways": ways, "roles": [r[0] for r in segment.rows], "texts": [r[1] for r in segment.rows],
                **{k: getattr(segment, k) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last")},
            }

        def batch() -> pa.RecordBatch:
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

        def handed_on(whole: bool) -> None:
            out.append({"conv_id": conv, "found": found() if whole else None, "cut": None if whole else cut()})

        size = 0
        for some in batches:
            columns = [some.column(i).to_pylist() for i in range(6)]
            for conv_id, turn, role, text, copies, fresh in zip(*columns):
                if segment is None or conv_id != conv:
                    if segment is not None:
                        # The first conversation of a task may have begun in the one before.
                        size += segment.characters
                        handed_on(alone)
                        seq += 1
                    alone, conv, segment, started = started, conv_id, Segment(), True
                elif segment.full(longest):
                    alone = False
                    size += segment.characters
                    handed_on(False)
                    seq, segment = seq + 1, Segment()
                segment.add(turn, role, text, copies, fresh)
                if len(out) >= 1024 or size >= CHARACTERS:
                    size = 0
                    yield batch()
        if segment is not None:
            handed_on(False)
            yield batch()

    return work


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def _fields(ddl: str) -> list[pa.Field]:
    return list(_arrow(f"struct<{ddl}>"))


def put_together(cuts: pd.DataFrame) -> tuple[dict, list[dict]]:
    """Totals of a conversation out of its segments in order, and how each of them is entered and repaired."""
    tops: dict[int, tuple[int, str, tuple]] = {START: (0, "", ())}
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    first_turn = last_turn = last = None
    rows = list(cuts.sort_values(["part", "seq"]).itertuples(index=False))
    for row in rows:
        for name in total:
            total[name] += int(getattr(row, name))
        if last is not None and not _legal(last, row.first):
            total["illegal"] += 1
        last = row.last
        if not pd.isna(row.first_turn):
            total["turns"] -= last_turn is not None and int(row.first_turn) == last_turn
            first_turn = int(row.first_turn) if first_turn is None else first_turn
            last_turn = int(row.last_turn)
        after: dict = {}
        for way in row.ways:
            if way["entry"] in tops:
                cost, audit, path = tops[way["entry"]]
                new = (cost + way["cost"], audit + way["audit"], (path, way["entry"], way["audit"]))
                if way["top"] not in after or new[:2] < after[way["top"]][:2]:
                    after[way["top"]] = new
        tops = after
    cost, audit, path = min((tops[t] for t in _ACCEPTED if t in tops), key=lambda w: w[:2])
    steps = []
    for row in reversed(rows):
        path, entry, edits = path
        steps.append({"part": row.part, "seq": row.seq, "entry": entry, "edits": edits})
    turns = total.pop("turns")
    return {"gaps": gaps(first_turn, last_turn, turns), **total, "cost": cost, "audit": audit}, steps


def _composed(cuts: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, found) of the conversations that were cut."""
    steps = "steps array<struct<part:int,seq:int,entry:int,edits:string>>"
    totals = _FOUND.replace(", repaired_sha256 string", "")

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        found, chosen = put_together(group)
        return pd.DataFrame([{"conv_id": group["conv_id"].iloc[0], **found, "steps": chosen}])

    light = cuts.select("conv_id", *[f"cut.{n}" for n in _names(_CUT)])
    whole = store.stored(light.groupBy("conv_id").applyInPandas(compose, f"conv_id {conv_type}, {totals}, {steps}"), "repair-composed")
    # (part, seq) names a segment, whatever its conversation.
    chosen = whole.select(F.inline("steps"))
    texts = cuts.select("conv_id", "cut.part", "cut.seq", "cut.roles", "cut.texts").join(chosen, ["part", "seq"])
    ordered = texts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    kind = _arrow(conv_type)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, begun = None, None, False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                if sha is None or row["conv_id"] != conv:
                    if sha is not None:
                        yield done()
                    conv, sha, begun = row["conv_id"], hashlib.sha256(), False
                written, _ = lines(list(zip(row["roles"], row["texts"])), row["entry"], row["edits"])
                if written:
                    sha.update((("\n" if begun else "") + "\n".join(written)).encode("utf-8", "surrogatepass"))
                    begun = True
        if sha is not None:
            yield done()

    shas = ordered.select("conv_id", "roles", "texts", "entry", "edits").mapInArrow(digest, f"conv_id {conv_type}, repaired_sha256 string")
    joined = whole.join(shas.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    return joined.select("conv_id", *_names(_FOUND))


def _names(ddl: str) -> list[str]:
    return [f.name for f in _fields(ddl)]


def flagged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, fresh): equal rows as one, ``fresh`` where role and text are met first."""
    hashed = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("_hash", F.sha2("text", 256))
    some = hashed.groupBy("conv_id", "turn", "role", "_hash").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    turn = F.when(~F.bool_or(F.col("turn").isNull()), F.min("turn"))
    firsts = hashed.groupBy("conv_id", "role", "_hash").agg(turn.alias("turn")).select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("role").alias("_r"), F.col("_hash").alias("_h")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
        & (F.col("role") == F.col("_r")) & (F.col("_hash") == F.col("_h"))
    )
    return some.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "copies", F.col("_h").isNotNull().alias("fresh"))


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation of ``rows``.

    ``rows`` holds (conv_id, turn, role, text); the cheapest edits of each conversation are its audit.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = flagged(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"conv_id {kind}, found struct<{_FOUND}>, cut struct<{_CUT}, {_ROWS}>"
    walked = store.stored(dealt.mapInArrow(store.lean(_walked(kind, segment)), schema), "repair-walked")
    whole = walked.where("found IS NOT NULL").select("conv_id", "found.*")
    return whole.unionByName(_composed(walked.where("cut IS NOT NULL"), kind))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that crc32(``conv_id:turn``) modulo 20 names; nulls are one space.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault, text = F.crc32(key) % 20, F.coalesce("text", space)
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_one")).drop("_one")


def repair_all(conversations: DataFrame, rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``repair(rows)`` with a row of zeros for the conversations that have no rows left."""
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    found = ids.join(repair(rows, segment), F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("_id").alias("conv_id"), *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
