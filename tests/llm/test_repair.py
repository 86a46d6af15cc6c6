"""Repair of conversations against an exhaustive search over edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from uptake.llm import repair

COLUMNS = "conv_id long, turn long, role string, text string, conv string, uid int, n string, block int, fault string"
SPACE = " \t\n\x0b\x0c\r"
GOAL = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, t, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def cheapest(letters):
    """The least (cost, edits) by a plain search over all paths, most promising first; ``letters`` as in ``repair``."""
    heap = {(0, "", "", 0)}
    best = None
    while heap:
        item = min(heap)
        heap.remove(item)
        cost, edits, done, k = item
        if best and cost > best[0]:
            return best
        if k == len(letters) and GOAL.fullmatch(done):
            best = min(best, (cost, edits)) if best else (cost, edits)
            continue
        if len(edits) > 2 * len(letters) + 2:
            continue
        last = done[-1:]
        able = {"": "us", "s": "u", "u": "a", "a": "u"}[last]
        for role in "ua":
            if role in able:
                heap.add((cost + 5, edits + "I", done + role, k))
        if k < len(letters):
            x = letters[k]
            heap.add((cost + 2, edits + "D", done, k + 1))
            if x != "-":
                extra = 5 if x.isupper() else 0
                if x.lower() in able:
                    heap.add((cost + extra, edits + "K", done + x.lower(), k + 1))
                for role in "ua":
                    if role in able:
                        heap.add((cost + 1 + extra, edits + "R", done + role, k + 1))
    return best


def brute(rows, search=cheapest):
    """By conversation: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
    out = {c: None for c, *_ in rows}
    kept = plain_damage(rows)
    for c in out:
        own = [(t, r, x) for c2, t, r, x in kept if c2 == c]
        own.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.md5(v[2].encode()).hexdigest()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, letters, seen = [], "", set()
        for _, r, x in own:
            body = x.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((r, x))
            faults.append(fault)
            first = r[:1] if r[:1] in ("s", "u", "a") else "x"
            letters += "-" if fault in ("blank", "duplicate") else first.upper() if fault else first
        firsts = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(firsts))
        cost, audit = search(letters)
        lines, state, k = [], "", 0
        for e in audit:
            if e == "D":
                k += 1
                continue
            role = "a" if state == "u" else "u"
            if e == "K":
                role = own[k][1][:1]
            state = role
            name = own[k][1] if e == "K" else {"u": "user", "a": "assistant"}[role]
            lines.append(f"{name}:{'' if e == 'I' else own[k][2]}")
            k += e != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, *[faults.count(f) for f in repair.FAULTS], illegal, cost, audit, digest)
    return out


def audits(df):
    got = repair.audit(repair.damaged(df), df).collect()
    names = ("gaps", *repair.FAULTS, "illegal", "cost", "audit", "repaired_sha256")
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r[x] for x in names) for r in got}


def whole_search(letters):
    cost, edits, end = repair.search(letters, 0, repair.FINAL) if letters else (0, "", 0)
    return cost, edits + "I" * len(repair.CLOSING[end])


def test_search_finds_the_first_cheapest_edits():
    rng = random.Random(1)
    cases = ["", "s", "a", "u", "uu", "sus", "-", "--", "xx", "S", "U-A", "aua"]
    cases += ["".join(rng.choice("suaxUAS-uauaua") for _ in range(rng.randrange(1, 7))) for _ in range(150)]
    for letters in cases:
        assert whole_search(letters) == cheapest(letters), letters


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_agree_with_one_search(size):
    rng = random.Random(size)
    for _ in range(60):
        letters = "".join(rng.choice("suaxUA-uauaua") for _ in range(rng.randrange(size + 1, 14)))
        blocks = [letters[k : k + size] for k in range(0, len(letters), size)]
        costs, ranks = [], []
        for b in blocks:
            found = [[repair.search(b, q, repair._only(e)) for e in range(4)] for q in range(4)]
            costs.append([f[0] for q in found for f in q])
            ranks.append([sorted(g[1] for g in q).index(f[1]) for q in found for f in q])
        parts = [repair.search(b, q, repair._only(e)) for b, (q, e) in zip(blocks, repair.chain(costs, ranks), strict=True)]
        end = parts[-1][2]
        got = sum(p[0] for p in parts) + repair.FINAL[end], "".join(p[1] for p in parts) + "I" * len(repair.CLOSING[end])
        assert got == whole_search(letters), letters


def conversations():
    rng = random.Random(4)
    texts = ["Yes.", "No!", "Why?", "  ", "", "cut off", "é.", "a.\n", "Yes.", None, "...", "long " * 300 + "."]
    roles = ["user", "assistant", "user", "assistant", "user", "assistant", "system", "tool", None, "", "u", "Über"]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([t, t, t, t + 2, None]), rng.choice(roles[:8] if c < 40 else roles), rng.choice(texts)))
    rows += [(None, None, None, None), (None, 1, "user", "x."), (-5, None, None, ""), (7, 0, "user", "Yes."), (7, 0, "user", "Yes.")]
    gone = next(c for c in range(100, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.")]


def test_audits_agree(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "c", 1, "n", 2, "f") for r in rows], COLUMNS).repartition(3)
    assert audits(df) == brute(rows)
    assert audits(df.where("false")) == {}


def test_long_conversation_is_searched_in_blocks(spark):
    rng = random.Random(9)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Line {t}." if rng.random() < 0.9 else f"cut {t}") for t in range(700)]
    rows += [(2, t, rng.choice(["user", "assistant", "system"]), "same text.") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert audits(df) == brute(rows, whole_search)


def test_repaired_conversations_are_in_order(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    lines = repair.repaired(df).orderBy("conv_id", "block", "at").collect()
    by = {}
    for r in lines:
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert all(GOAL.fullmatch("".join(x)) for x in by.values())
    again = repair.audit(repair.repaired(df).select("conv_id", (F.col("block") * 100_000 + F.col("at")).alias("turn"), "role", "text"))
    assert again.where("illegal > 0").count() == 0
