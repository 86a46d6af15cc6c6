"""Importance resampling against a plain version with zlib's CRC-32."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from uptake.llm import resampling

COLUMNS = "doc_id long, text string, rank string, score double, weight int, row int, uid int, whole string, one int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [w.encode() for w in words] + [f"{a} {b}".encode() for a, b in zip(words, words[1:], strict=False)]


def brute(rows, target):
    counts = []
    for texts in ([t for _, t in rows], target):
        counts.append(Counter(zlib.crc32(f) % 10_000 for t in texts for f in features(t)[1]))
    held, wanted = counts
    s, t = sum(held.values()), sum(wanted.values())
    out = []
    for d, text in rows:
        words, found = features(text)
        total = 0
        for f in found:
            b = zlib.crc32(f) % 10_000
            total += math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((held[b] + 1) * (t + 10_000))))
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(found), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], -(2**63) if r[0] is None else r[0], r[1], r[2]))
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = k + 1
    return sorted([tuple(r[:5]) for r in out], key=str)


def make_rows():
    rng = random.Random(2)
    words = ["The", "of", "Ärger", "naïve", "x1", "日本", "a" * 63, "b" * 64, "c" * 65, "d" * 700, "é" * 2000, "ZÉ", "9"]
    rows = [(0, None), (1, ""), (2, " ..\x00\x7f\n"), (3, "one"), (4, "One,two"), (5, "z" * 5000), (None, "of the " * 30), (None, None)]
    rows += [(k, " ".join(rng.choice(words) + rng.choice(["", ",", "!"]) for _ in range(rng.randrange(60)))) for k in range(10, 90)]
    return rows + [rows[20], rows[20], (20, "another text of this id " * 9)]


def test_draw_agrees(spark):
    rows = make_rows()
    target = ["the of Ärger x1 " * 20, None, "", "naïve 日本 naïve"]
    df = spark.createDataFrame([(*r, "r", 0.5, 1, 2, 3, "w", 4) for r in rows], COLUMNS).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.importance(df, goal)
    want = brute(rows, target)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()], key=str) == want
    chosen = resampling.drawn(df, goal)
    assert chosen.columns == df.columns
    assert sorted([str(r.doc_id) for r in chosen.collect()]) == sorted(str(r[0]) for r in want if r[4])
    nothing = df.where("false")
    assert resampling.importance(nothing, goal).collect() == [] and resampling.importance(df, goal.where("false")).count() == len(rows)


@pytest.mark.parametrize("most", [3, 70, 400, 3000])
def test_crcs_of_spans(most):
    rng = np.random.default_rng(most)
    data = rng.integers(0, 256, 20_000, np.uint8)
    size = rng.integers(1, most, 60)
    starts = rng.integers(0, len(data) - most, 60)
    got = resampling.span_crcs(data, starts, starts + size)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, size, strict=True)]


def test_features_of_a_chunk():
    texts = [None, "", "a", "A b", "x" * 100 + " Éé-9", ". ,", "end"]
    got = resampling.Features(pa.array(texts), 3)
    want = []
    for k, t in enumerate(texts):
        words = features(t)[0]
        want += [(k, zlib.crc32(" ".join(words[i : i + n]).encode())) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert sorted(zip(got.text.tolist(), got.crc.tolist(), strict=True)) == sorted(want)
    assert got.words.tolist() == [0, 0, 1, 2, 3, 0, 1]
