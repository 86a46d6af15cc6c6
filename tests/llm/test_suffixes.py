"""Removal of repeated byte strings against a dictionary of all of them."""

import hashlib
import random

import numpy as np
import pytest

from uptake.llm import suffixes

COLUMNS = "doc_id long, text string, ord long, rid string, start int, blob string, n_bytes int"


def brute(rows, width):
    """rows: (doc_id, text), equal ids are one place. Sorted (doc_id, n_bytes, n_removed, n_spans, digest)."""
    low = -(2**63)
    texts = [(low if d is None else d, d, (t or "").encode()) for d, t in rows]
    first = {}
    for place, _, raw in texts:
        for k in range(len(raw) - width + 1):
            w = raw[k : k + width]
            first[w] = min(first.get(w, (place, k)), (place, k))
    out = []
    for place, d, raw in texts:
        gone = [False] * len(raw)
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < (place, k):
                gone[k : k + width] = [True] * width
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone][: len(gone)], strict=True))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, width, gram):
    df = spark.createDataFrame([(*r, 1, "clash", 2, "x", 3) for r in rows], COLUMNS).repartition(3)
    got = suffixes.remove_repeats(df, width, gram, digest=True)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted([tuple(r) for r in got.collect()], key=str)
    assert got == brute(rows, width)
    return got


def odd_rows():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdé 日") for _ in range(300))
    other = "".join(rng.choice("abcdefgh \n") for _ in range(3000))
    return [
        (0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "y" * 5000), (6, "ab" * 400 + "c"),
        (7, "start " + passage + " end"), (8, passage[50:250] + "!" + passage[:120]), (9, other), (10, other[100:] + other[:200]),
        (11, other), (None, "none " + passage), (None, "zz " + other[:500]), (8, passage), (9, other), (-4, passage[:150]),
        (12, "\x00" * 150 + passage[:100] + "\x00" * 150),
    ]


def test_odd_rows(spark):
    got = check(spark, odd_rows(), 100, suffixes.GRAM)
    assert sum(r[2] for r in got) > 5000
    kept = suffixes.remove_repeats(spark.createDataFrame([(1, "q" * 150), (2, "q" * 120 + "é")], "doc_id long, text string")).collect()
    assert {r.doc_id: bytes(r.kept) for r in kept} == {1: b"q", 2: "é".encode()}


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_of_few_letters(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abc", "abcdefgh é", "a"][seed]
    rows = [(rng.randrange(30), "".join(rng.choice(letters) for _ in range(rng.randrange(120)))) for _ in range(60)]
    check(spark, rows, 12, 4)


def test_empty_table(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert suffixes.remove_repeats(empty, digest=True).collect() == []


def test_crowded_anchors_give_way_and_change_nothing(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    line = " this line is in very many of the texts "
    lines = [word(60) for _ in range(30)]
    rows = [(k, word(80) + line + rng.choice(lines) + line + word(90)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffixes.crowded_anchors(df.coalesce(1), 100, suffixes.GRAM)
    assert len(found.names)
    names = suffixes.gram_names(np.frombuffer(line.encode(), np.uint8), suffixes.GRAM)
    assert set(found.names) <= set(names.tolist())
    check(spark, rows, 100, suffixes.GRAM)


def test_columns_agree_with_sorted_suffixes():
    rng = np.random.default_rng(1)
    width = 8
    texts = [rng.integers(0, 2, 40, np.uint8) for _ in range(30)]
    pieces = []
    for t in texts:
        p = suffixes.Pieces(t, np.array([0, len(t)]), width, 3, suffixes.Crowded([]))
        assert p.runs.sum() == len(t) - width + 1
        pieces += [(t[s : s + r + width - 1], r, d) for s, r, d in zip(p.start, p.runs, p.lead, strict=True)]
    data, runs, lead = np.concatenate([p[0] for p in pieces]), np.array([p[1] for p in pieces]), np.array([p[2] for p in pieces])
    late = suffixes.late_windows(data, runs, lead, np.arange(len(pieces)), width)
    seen = set()
    for k, (t, r, d) in enumerate(pieces):
        for i in range(r):
            w = (d - i, bytes(t[i : i + width]))
            assert late[k, i] == (w in seen)
        seen |= {(d - i, bytes(t[i : i + width])) for i in range(r)}
