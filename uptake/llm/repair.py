"""Conversations brought back into order by the cheapest edits.

A conversation is in order if the initials of its roles are ``(s?(ua)+)?``. Rows are kept, given another role or
deleted, and rows without text are inserted. Iterative-deepening A* finds the edits: a
depth-first search tries them in ASCII order under a cost bound, which grows by the least
excess; a table holds for each failed state what it costs at least to go on from there, so
that no state fails twice at one budget. The first path that accepts is the cheapest, and the first in ASCII order among those.

Rows are numbered along each conversation by a range sort, and searched in blocks of ``BLOCK`` rows, one row of a
block being one byte. A conversation of one block is searched directly. In a longer one each block is
searched for each pair of a state at its start and one at its end, all blocks at once; then
the ends are chained, 16 costs a block, and tell each block where it starts and ends.
A block's edits end with its last row, so their texts are compared alike in parts and as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import prefix_sums, written

BLOCK = 256
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
#: States: nothing yet, after s, after u, after a. The role each expects next, and what ends a conversation there.
EXPECTS = "uuau"
CLOSING = ("", "ua", "a", "")
FINAL = tuple(INSERT * len(x) for x in CLOSING)
NEVER = 1 << 40
ROLES = {"u": "user", "a": "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
_AFTER = {"u": 2, "a": 3}


def _steps(state: int, row: str) -> Iterator[tuple[str, int, int, int]]:
    """The edits in ASCII order at a state before a row: name, cost, next state, rows used.

    A row is one letter: s, u, a or x for its role, upper case if it was cut off; - if it must go.
    """
    yield "D", DELETE, state, 1
    yield "I", INSERT, _AFTER[EXPECTS[state]], 0
    if row != "-":
        extra = CUT_OFF if row.isupper() else 0
        role = row.lower()
        if role == EXPECTS[state]:
            yield "K", extra, _AFTER[role], 1
        elif role == "s" and state == 0:
            yield "K", extra, 1, 1
        yield "R", REROLE + extra, _AFTER[EXPECTS[state]], 1


def search(rows: str, start: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
    """The cheapest edits of ``rows`` from a state, the first in ASCII order: cost, edits, state at the end.

    ``ends`` says what each state costs after the last row; the edits end with that row. The cost
    is ``NEVER`` if no end can be reached.
    """
    n = len(rows)
    # What the rows cost at least, whatever the states.
    least = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        least[k] = least[k + 1] + (DELETE if rows[k] == "-" or rows[k].isupper() else REROLE if rows[k] == "x" else 0)
    end = min(ends)
    failed = [[least[k] + end for _ in range(4)] for k in range(n)] + [list(ends)]
    kept_s = start == 0 and any(x in "sS" for x in rows)
    reach = [start == 0, start == 1 or kept_s, n > 0 or start == 2, n > 0 or start == 3]
    if not any(reach[q] and ends[q] < NEVER for q in range(4)):
        return NEVER, "", 0
    if n == 0:
        return ends[start], "", start
    while True:
        bound = failed[0][start]
        # One entry a level: row, state, budget left, edits to try, the least total seen below, the edit that led here.
        stack = [[0, start, bound, _steps(start, rows[0]), NEVER, ""]]
        while stack:
            top = stack[-1]
            k, q, budget = top[0], top[1], top[2]
            for edit, cost, state, used in top[3]:
                total = cost + failed[k + used][state]
                if total > budget:
                    top[4] = min(top[4], total)
                    continue
                if k + used == n:
                    return bound, "".join(x[5] for x in stack) + edit, state
                stack.append([k + used, state, budget - cost, _steps(state, rows[k + used]), NEVER, edit])
                break
            else:
                failed[k][q] = max(failed[k][q], top[4])
                stack.pop()
                if stack:
                    up = stack[-1]
                    paid = up[2] - budget
                    up[4] = min(up[4], paid + failed[k][q])


def replay(rows: str, audit: str, start: int) -> list[tuple[str, int]]:
    """What the edits of a block leave, in order: the role ("" for a kept row's own) and the row's number, -1 if inserted."""
    out, state, k = [], start, 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        role = rows[k].lower() if edit == "K" else EXPECTS[state]
        state = 1 if role == "s" else _AFTER[role]
        if edit == "I":
            out.append((ROLES[role], -1))
            continue
        out.append(("" if edit == "K" else ROLES[role], k))
        k += 1
    return out


def chain(costs: list[list[int]], ranks: list[list[int]]) -> list[tuple[int, int]]:
    """The states at each block's start and end on the first cheapest path of a conversation, from its blocks' 16 costs and ranks."""
    after = [FINAL]
    for block in reversed(costs):
        ahead = after[-1]
        after.append(tuple(min(block[4 * q + e] + ahead[e] for e in range(4)) for q in range(4)))
    after.reverse()
    out, q = [], 0
    for k, block in enumerate(costs):
        ends = [e for e in range(4) if block[4 * q + e] + after[k + 1][e] == after[k][q]]
        end = min(ends, key=lambda e: ranks[k][4 * q + e])
        out.append((q, end))
        q = end
    return out


def _only(end: int) -> tuple[int, ...]:
    return tuple(0 if e == end else NEVER for e in range(4))


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's 16 costs from a state to a state, and how the edits of those from one state are ordered."""
    for batch in batches:
        costs, ranks = [], []
        for rows, block in zip(batch.column("rows").to_pylist(), batch.column("block").to_pylist(), strict=True):
            of_block, order = [], []
            for q in range(4):
                found = [search(rows, q, _only(e)) if block or not q else (NEVER, "", e) for e in range(4)]
                texts = sorted(f[1] for f in found)
                of_block += [f[0] for f in found]
                order += [texts.index(f[1]) for f in found]
            costs.append(of_block)
            ranks.append(order)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(costs, kind), pa.array(ranks, kind)], ["conv", "block", "costs", "ranks"]
        )


_PLAN = "conv string, block long, start int, end int"


def _plan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            states = chain([b["costs"] for b in row["blocks"]], [b["ranks"] for b in row["blocks"]])
            out += [{"conv": row["conv"], "block": k, "start": q, "end": e} for k, (q, e) in enumerate(states)]
        kind = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
        yield pa.RecordBatch.from_pylist(out, kind)


_SOLVED = "conv string, block long, cost long, audit string, left array<struct<role: string, uid: long>>"


def _solved_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            start = row["start"] or 0
            ends = FINAL if row["start"] is None else _only(row["end"])
            cost, audit, end = search(row["rows"], start, ends)
            left = [{"role": role, "uid": row["uids"][k] if k >= 0 else None} for role, k in replay(row["rows"], audit, start)]
            if row["last"]:
                left += [{"role": ROLES[x], "uid": None} for x in CLOSING[end]]
                audit += "I" * len(CLOSING[end])
                cost += 0 if row["start"] is None else FINAL[end]
            out.append({"conv": row["conv"], "block": row["block"], "cost": cost, "audit": audit, "left": left})
        left = pa.list_(pa.struct([("role", pa.string()), ("uid", pa.int64())]))
        kind = [("conv", pa.string()), ("block", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("left", left)]
        yield pa.RecordBatch.from_pylist(out, pa.schema(kind))


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's lines, which come in order; one line is held at a time."""
    now, state = None, None
    for batch in batches:
        names, sums = [], []
        for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if conv != now:
                if state is not None:
                    names.append(now)
                    sums.append(state.hexdigest())
                now, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.string())], ["conv", "repaired_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])


def conversation_key(name: str = "conv_id") -> Column:
    """The id as text, empty for a null, so that joins and sorts treat null as one conversation."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by the CRC-32 of ``conv_id:turn``; nulls become one space.

    Of twenty rows one is dropped, one loses its text, one its sentence ends, one is repeated, and one gets the role user.
    """
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate != 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


class Repair:
    """The repair of all conversations of a table (``conv_id, turn, role, text``).

    Rows are taken by turn, nulls first, then by role and a hash of the text. Defined cases: a
    null id is one conversation; a null role or text is one space; a row equal to an earlier one of its conversation in
    role and text is a duplicate; other columns are ignored; an empty table gives empty results.
    """

    def __init__(self, conversations: DataFrame):
        role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
        uid = F.monotonically_increasing_id().alias("uid")
        rows = conversations.select(conversation_key().alias("conv"), "turn", role, text, uid)
        self.rows = written(rows, "conversations")
        self.flagged = written(self._flagged(), "flagged")
        blocks = self._blocks()
        self.blocks = written(blocks, "blocks")
        self.solved = written(self._solved(), "solved")

    def _flagged(self) -> DataFrame:
        """Each row's number ``n`` in its conversation, its letter for the search, its initial and its fault; no texts."""
        initial = F.substring("role", 1, 1)
        narrow = self.rows.select(
            "conv",
            F.col("turn").isNotNull().alias("known"),
            "turn",
            "role",
            F.md5(F.col("text").cast("binary")).alias("digest"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("empty"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
            "uid",
            F.lit(1).cast("long").alias("one"),
        )
        numbered = written(prefix_sums(narrow, ["conv"], ["known", "turn", "role", "digest", "uid"], "one", "n"), "numbered")
        first = numbered.groupBy("conv", "role", "digest").agg(F.min("n").alias("first"))
        fault = F.when(F.col("empty"), "blank").when(F.col("n") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
        rows = numbered.join(first, ["conv", "role", "digest"]).withColumn("fault", F.coalesce(fault, F.lit("")))
        letter = (
            F.when(F.col("fault").isin("blank", "duplicate"), "-")
            .when(F.col("fault") == "truncated", F.upper("initial"))
            .otherwise(F.col("initial"))
        )
        return rows.select("conv", "turn", "n", "uid", "initial", "fault", letter.alias("letter"))

    def _blocks(self) -> DataFrame:
        """One row for each ``BLOCK`` rows of a conversation."""
        row = F.struct("n", "uid", "letter", "initial")
        counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in FAULTS]
        block = F.floor(F.col("n") / BLOCK).cast("long").alias("block")
        found = self.flagged.groupBy("conv", block).agg(F.sort_array(F.collect_list(row)).alias("items"), *counts)
        return found.select(
            "conv",
            "block",
            *FAULTS,
            F.array_join(F.transform("items", lambda x: x.letter), "").alias("rows"),
            F.array_join(F.transform("items", lambda x: x.initial), "").alias("initials"),
            F.transform("items", lambda x: x.uid).alias("uids"),
        )

    def _solved(self) -> DataFrame:
        """Each block's cost, edits and what they leave."""
        last = self.blocks.groupBy("conv").agg(F.max("block").alias("number"))
        blocks = self.blocks.join(last, "conv")
        parts = blocks.where("number > 0").select("conv", "block", "rows")
        pairs = parts.mapInArrow(_pair_rows, "conv string, block long, costs array<long>, ranks array<long>")
        whole = pairs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "costs", "ranks"))).alias("blocks"))
        plan = whole.mapInArrow(_plan_rows, _PLAN)
        todo = blocks.select("conv", "block", "rows", "uids", (F.col("block") == F.col("number")).alias("last"))
        return todo.join(plan, ["conv", "block"], "left").mapInArrow(_solved_rows, _SOLVED)

    def lines(self) -> DataFrame:
        """``conv, block, at, role, text`` of what is left and inserted; ``block, at`` give the order."""
        left = self.solved.select("conv", "block", F.posexplode("left").alias("at", "row"))
        left = left.select("conv", "block", "at", "row.uid", F.col("row.role").alias("new"))
        kept = left.where("uid is not null").join(self.rows.select("uid", "role", "text"), "uid")
        role = F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")).alias("role")
        inserted = left.where("uid is null").select("conv", "block", "at", F.col("new").alias("role"), F.lit("").alias("text"))
        return kept.select("conv", "block", "at", role, "text").unionByName(inserted)

    def digests(self) -> DataFrame:
        """``conv, repaired_sha256``. The hash runs along a conversation, so one task streams each one's lines."""
        line = F.concat("role", F.lit(":"), "text").alias("line")
        ordered = self.lines().select("conv", "block", "at", line).repartition("conv").sortWithinPartitions("conv", "block", "at")
        return ordered.mapInArrow(_hash_rows, "conv string, repaired_sha256 string")

    def audits(self) -> DataFrame:
        """One row for each conversation: ``conv``, its gaps, faults, illegal neighbours, and the cost and letters of its edits."""
        turns = self.flagged.where("turn is not null").select("conv", "turn").distinct().groupBy("conv")
        gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
        before = F.lag(F.substring("initials", -1, 1), 1, "").over(Window.partitionBy("conv").orderBy("block"))
        chained = F.concat(before, F.col("initials"))
        pair = F.transform(F.sequence(F.lit(1), F.length("chain") - 1), lambda k: F.substring("chain", k, F.lit(2)))
        wrong = F.when(F.length("chain") > 1, F.size(F.filter(pair, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
        blocks = self.blocks.withColumn("chain", chained).select("conv", "block", *FAULTS, wrong.cast("long").alias("illegal"))
        joined = blocks.join(self.solved.select("conv", "block", "cost", "audit"), ["conv", "block"])
        sums = joined.groupBy("conv").agg(
            *[F.sum(c).alias(c) for c in (*FAULTS, "illegal", "cost")],
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x.audit), "").alias("audit"),
        )
        return sums.join(gaps, "conv", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id`` as text, ``block, at`` for the order, ``role`` and ``text`` of all conversations after their cheapest repair."""
    return Repair(conversations).lines().withColumnRenamed("conv", "conv_id")


def audit(conversations: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``originals`` (or of ``conversations``): what was wrong, the edits, and the SHA-256 of the repaired lines.

    A conversation without rows gets zeros, no edits and the hash of an empty text.
    """
    found = Repair(conversations)
    all_ids = (conversations if originals is None else originals).select("conv_id").distinct().withColumn("conv", conversation_key())
    joined = all_ids.join(found.audits(), "conv", "left").join(found.digests(), "conv", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
