"""Quotation linking: messages without the passages they quote, in reply order.

A line's quote level is the number of ">" marks before it. Lines of one level that follow each other are a passage. Passages and the
messages' own text are sequences of words in lower case, across line breaks. Their units are all runs of five words, and
lines, sentences and wholes that are shorter; each goes by a hash. A unit belongs to the earliest message of the conversation
whose own text has it. A message replies to the earlier message that owns most of the outermost passage it could link. A quoted
line leaves the text when units that an earlier message owns cover all its words; what links to nothing stays, with its marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import chunks, prefix_sums, row_order, written
from uptake.llm.hashing import Sums, U

#: Words in a run that links by itself.
WINDOW = 5

_MARKS = re.compile(r"(?:[ \t]*>)+")
# How mail programs introduce a quotation, in the languages of the tables.
_OPENED = r"on\b.*\bwrote|am\b.*\bschrieb\b.*|le\b.*\ba écrit|el\b.*\bescribió"
_INTRODUCTION = re.compile(rf"(?i)^\s*(?:{_OPENED}|.*\bwrote|.*\bschrieb\b.*)\s*:\s*$|^\s*-{{2,}}\s*original message\s*-{{2,}}\s*$")
_TWO_LINES = re.compile(rf"(?i)^\s*(?:{_OPENED})\s*:\s*$")
_SENTENCE_END = (".", "!", "?")


def levels(text: str) -> list[tuple[int, str, str]]:
    """Each line's quote level, its text without marks, and the line itself. Lines that introduce a quotation have level -1.

    An introduction stands before a line of a deeper level; it may be broken in two, the first of which then holds the date.
    """
    out = []
    for line in text.splitlines():
        marks = _MARKS.match(line)
        out.append((marks[0].count(">"), line[marks.end() :].strip(" \t"), line) if marks else (0, line, line))
    # The level of the next line that isn't blank, after each line.
    following = [0] * len(out)
    for k in range(len(out) - 2, -1, -1):
        level, line, _ = out[k + 1]
        following[k] = level if line.strip() else following[k + 1]
    for k, (level, line, whole) in enumerate(out):
        if following[k] <= level or level < 0:
            continue
        above, start, _ = out[k - 1] if k else (-1, "", "")
        if above == level and re.search(r"\d", start) and not _INTRODUCTION.match(start) and _TWO_LINES.match(f"{start} {line}"):
            out[k - 1], out[k] = (-1, *out[k - 1][1:]), (-1, line, whole)
        elif _INTRODUCTION.match(line):
            out[k] = (-1, line, whole)
    return out


def passages(lines: list[tuple[int, str, str]]) -> list[tuple[int, list[int]]]:
    """Level and line numbers of each quoted passage."""
    out: list[tuple[int, list[int]]] = []
    for k, (level, _, _) in enumerate(lines):
        if level > 0:
            if k and lines[k - 1][0] == level:
                out[-1][1].append(k)
            else:
                out.append((level, [k]))
    return out


def _tidy(lines: list[str]) -> str:
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def units(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and hash of each unit of the words of ``lines``; hashes don't depend on the place."""
    words: list[str] = []
    line_ends = []
    for line in lines:
        words += line.lower().split()
        line_ends.append(len(words))
    n = len(words)
    sentence_ends = [k + 1 for k, word in enumerate(words) if word.rstrip("\"')]»”’").endswith(_SENTENCE_END)]
    short = set()
    for ends in (line_ends, [*sentence_ends, n], [n]):
        short |= {(lo, hi) for lo, hi in zip([0, *ends], ends, strict=False) if 0 < hi - lo < WINDOW}
    runs = np.arange(max(0, n - WINDOW + 1))
    some = np.array(sorted(short), np.int64).reshape(-1, 2)
    starts, ends = np.concatenate([runs, some[:, 0]]), np.concatenate([runs + WINDOW, some[:, 1]])
    each = Sums(np.fromiter(map(xxhash.xxh64_intdigest, words), U, n))
    return starts, ends, each.of(starts, ends).view(np.int64)


_FIELDS = "own string, raw string, n_quotes int, quoted array<struct<level:int,unit:long,words:int>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own text and units of the passages; only messages that quote keep their whole text as ``raw``."""
    quoted_type = pa.list_(pa.struct([("level", pa.int32()), ("unit", pa.int64()), ("words", pa.int32())]))
    for batch in chunks(batches, "text"):
        own, raw, counts, quoted = [], [], [], []
        for text in batch.column("text").to_pylist():
            lines = levels(text or "")
            found = passages(lines)
            own.append(_tidy([line for level, line, _ in lines if level == 0]))
            raw.append(text if found else None)
            counts.append(len(found))
            asked = []
            for level, at in found:
                starts, ends, hashes = units([lines[k][1] for k in at])
                seen = dict(zip(hashes.tolist(), (ends - starts).tolist(), strict=True))
                asked += [{"level": level, "unit": unit, "words": n} for unit, n in seen.items()]
            quoted.append(asked)
        columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        made = [pa.array(own, pa.string()), pa.array(raw, pa.string()), pa.array(counts, pa.int32()), pa.array(quoted, quoted_type)]
        yield pa.RecordBatch.from_arrays([*columns, *made], [*names, "own", "raw", "n_quotes", "quoted"])


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different unit of each own text."""
    for batch in chunks(batches, "own"):
        each = [np.unique(units((text or "").splitlines())[2]) for text in batch.column("own").to_pylist()]
        row = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
        unit = np.concatenate(each) if each else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id").take(row), batch.column("at").take(row), pa.array(unit, pa.int64())], ["conv_id", "at", "unit"]
        )


def without_quotes(text: str, linked: set[int]) -> str:
    """The text without introductions and without quoted lines whose words are all covered by ``linked`` units."""
    lines = levels(text)
    kept = {k for k, (level, _, _) in enumerate(lines) if level == 0}
    for _, at in passages(lines):
        mine = [lines[k][1] for k in at]
        starts, ends, hashes = units(mine)
        sizes = [len(line.split()) for line in mine]
        covered = np.zeros(sum(sizes) + 1, np.int64)
        hit = np.fromiter((h in linked for h in hashes.tolist()), bool, len(hashes))
        np.add.at(covered, starts[hit], 1)
        np.add.at(covered, ends[hit], -1)
        known = np.cumsum(covered) > 0
        place = 0
        for k, size in zip(at, sizes, strict=True):
            if not known[place : place + size].all():
                kept.add(k)
            place += size
    return _tidy([lines[k][2] for k in sorted(kept)])


def _unquoted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "raw"):
        pairs = zip(batch.column("raw").to_pylist(), batch.column("linked").to_pylist(), strict=True)
        texts = pa.array([without_quotes(raw, set(linked or ())) for raw, linked in pairs], pa.string())
        names = [name for name in batch.schema.names if name not in ("raw", "linked")]
        yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], texts], [*names, "text"])


def _same(*names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out &= F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    return out


def _ddl(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in names)


def linked_units(parsed: DataFrame) -> DataFrame:
    """``uid, conv_id, at, level, unit, words, source``: each quoted unit with the place of the earlier message that owns it.

    Only conversations in which somebody quotes have their own texts cut into units.
    """
    asked = parsed.where("n_quotes > 0").select("uid", "conv_id", "at", F.explode("quoted").alias("q")).select("uid", "conv_id", "at", "q.*")
    quoting = asked.select("conv_id").distinct()
    told = parsed.alias("l").join(quoting.alias("r"), _same("conv_id"), "left_semi").select("conv_id", "at", "own")
    said = told.mapInArrow(_said, f"{_ddl(told, ['conv_id', 'at'])}, unit long").groupBy("conv_id", "unit").agg(F.min("at").alias("source"))
    found = asked.alias("l").join(said.alias("r"), _same("conv_id", "unit")).where("source < at")
    return found.select("uid", "l.conv_id", "at", "level", "l.unit", "words", "source")


def reply_links(found: DataFrame) -> DataFrame:
    """``conv_id, at, parent``: for each message that quotes an earlier one, the place of the one it replies to."""
    votes = found.groupBy("conv_id", "at", "level", "source").agg(F.sum("words").alias("words"))
    # The outermost level first, then the most words, then the latest message.
    best = F.max_by("source", F.struct(-F.col("level"), "words", "source")).alias("parent")
    return votes.groupBy("conv_id", "at").agg(best)


def roots(links: DataFrame) -> DataFrame:
    """``conv_id, at, root, depth`` of every message with a parent, by pointer jumping: rounds grow with the logarithm of the depth."""
    jumps = written(links.select("conv_id", "at", F.col("parent").alias("up"), F.lit(1).alias("depth")), "jumps")
    while True:
        higher = jumps.select("conv_id", F.col("at").alias("up"), F.col("up").alias("over"), F.col("depth").alias("more"))
        joined = jumps.alias("l").join(higher.alias("r"), _same("conv_id", "up"), "left")
        jumps = written(
            joined.select(
                "l.conv_id", "l.at", F.coalesce("over", "l.up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("over").isNotNull().alias("_moved"),
            ),
            "jumps",
        )
        if not jumps.where("_moved").limit(1).count():
            return jumps.select("conv_id", "at", F.col("up").alias("root"), "depth")
        jumps = jumps.drop("_moved")


def reply_order(messages: DataFrame) -> DataFrame:
    """Every message with its own text, what it replies to, and its place in the conversation in reply order.

    Returns ``conv_id, turn, role, text, n_quotes, parent_turn, root_turn, depth, position``. Threads follow
    each other by their first message; within a thread a message comes after the one it replies to: by depth, then by turn.
    Positions count from 0 in each conversation. A message that links nothing begins a thread and keeps its quoted lines. Defined
    cases: a null text is empty; a null ``turn`` comes before all others; null ids form one conversation; rows that
    share conversation and turn share parent and depth, and follow each other by role and text; other columns are ignored.
    """
    # Rows may share conversation and turn, so each has a number of its own, kept by the written copy.
    rows = messages.select("conv_id", "turn", "role", row_order("turn").alias("at"), F.monotonically_increasing_id().alias("uid"), "text")
    kinds = _ddl(rows, ["conv_id", "turn", "role", "at", "uid"])
    parsed = written(rows.mapInArrow(_parsed, f"{kinds}, {_FIELDS}"), "messages")
    found = written(linked_units(parsed), "linked")
    links = written(reply_links(found), "links")
    above = links.alias("l").join(roots(links).alias("r"), _same("conv_id", "at")).select("l.conv_id", "l.at", "parent", "root", "depth")
    keep = ["conv_id", "turn", "role", "at", "n_quotes"]
    plain = parsed.where("n_quotes = 0").select(*keep, F.col("own").alias("text"))
    # A message's units only: no more than its own words and lines.
    units_of = found.groupBy("uid").agg(F.collect_set("unit").alias("linked"))
    asking = parsed.where("n_quotes > 0").join(units_of, "uid", "left").select(*keep, "raw", "linked")
    texts = plain.unionByName(asking.mapInArrow(_unquoted, f"{_ddl(asking, keep)}, text string"))
    placed = texts.alias("l").join(written(above, "above").alias("r"), _same("conv_id", "at"), "left")
    told = placed.select(
        "l.conv_id", "turn", "role", "l.at", "text", "n_quotes", "parent",
        F.coalesce("root", "l.at").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"), F.lit(1).alias("_one"),
    )
    ordered = prefix_sums(told, ["conv_id"], ["root", "depth", "at", "role", "text"], "_one", "position")
    turn_type = messages.schema["turn"].dataType

    def turn(name: str, to: str) -> Column:
        return F.when(F.col(name) != -(2**63), F.col(name)).cast(turn_type).alias(to)

    return ordered.select(
        "conv_id", "turn", "role", "text", "n_quotes", turn("parent", "parent_turn"), turn("root", "root_turn"), "depth", "position"
    )


def conversations(messages: DataFrame, most_chars: int = 1 << 20) -> DataFrame:
    """Reply-ordered conversations as documents of turns: ``conv_id, part, turns``.

    A part holds consecutive messages until ``most_chars`` characters are reached; a conversation of any length is thus
    a number of rows of bounded size (a longer message is a part of its own).
    """
    ordered = reply_order(messages).withColumn("_size", F.char_length("text"))
    before = prefix_sums(ordered, ["conv_id"], ["position"], "_size", "_before")
    part = F.floor(F.col("_before") / most_chars).alias("part")
    turns = F.array_sort(F.collect_list(F.struct("position", "turn", "parent_turn", "depth", "role", "text"))).alias("turns")
    return before.groupBy("conv_id", part).agg(turns)
