"""The operators against brute-force versions, over the smallest tables and a fixture of odd rows."""

import hashlib
import itertools
import math
import pickle
import random
import re
import textwrap
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from uptake.llm import fingerprints, html, mixing, mtree, near, packing, quoting, secrets, substrings, toxicity
from uptake.llm.queries import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ord long, rid string, row int, size double, fp string, key int"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows():
    rng = random.Random(7)
    words = ["the", "of", "Ärger", "naïve", "x", "key", "日本", "a" * 40, "token=secret1"]
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(9000))
    passage = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", " \t\n", "one", "one two", passage, passage, "new start " + passage + " new end", "again " * 50, "again " * 70,
             long, long + " tail", "TOKEN: 'abcdefgh'   é AKIA" + "Z" * 16 + " " + "deadbeef" * 4, "one  two   three\r\n\x1c four five", "<|endoftext|> x"]
    rows = [(k, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None) for k, t in enumerate(texts)]
    rows += [(None, "without an id " + passage, "en", None, 3), (5, passage, "en", "s2", None), (5, passage, "en", "s2", None)]
    return [(*r, 1, "clash", 2, 0.5, "fp", 3) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("false")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        db.execute(f"create view {t} as select * from '{TABLES}/{t}.parquet'")
    got = QUERIES[name](spark, TABLES)
    columns = sorted(got.columns)
    want = db.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_every_query_runs_over_the_tables(spark):
    for name, query in QUERIES.items():
        if name not in ORACLES:
            assert query(spark, TABLES).count() > 0, name


# ---- 1 ---------------------------------------------------------------------------------


def pieces(lines):
    """All runs of five words, and shorter lines, sentences and wholes, written out."""
    words = " ".join(lines).lower().split()
    out = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} | {tuple(words)}
    out |= {tuple(x.lower().split()) for x in lines}
    out |= {tuple(x.split()) for x in re.split(r"(?<=[.!?])\s+", " ".join(words))}
    return {x for x in out if 0 < len(x) <= 5}


def brute_threads(rows):
    """rows: (conv, turn, text). Parent by (conv, turn). Lines are told apart by their marks; introductions end in 'wrote:'."""
    own = {(c, t): [x for x in (text or "").split("\n") if not x.startswith(">") and not x.endswith("wrote:")] for c, t, text in rows}
    parents = {}
    for c, t, text in rows:
        quoted = [(re.match(r"[> ]*", x)[0].count(">"), x.lstrip("> ")) for x in (text or "").split("\n") if x.startswith(">")]
        votes = Counter()
        for level, group in itertools.groupby(quoted, key=lambda x: x[0]):
            for piece in pieces([x for _, x in group]):
                owners = [t2 for (c2, t2), lines in own.items() if c2 == c and piece in pieces(lines)]
                if owners and min(owners) < t:
                    votes[level, min(owners)] += len(piece)
        if votes:
            parents[c, t] = max(votes, key=lambda k: (-k[0], votes[k], k[1]))[1]
    return parents


MESSAGES = "conv_id long, turn long, role string, text string"


def test_generated_quotations(spark):
    """Known replies: each message quotes a run of words of one earlier message, wrapped anew at another width."""
    rng = random.Random(11)
    rows, truth, said = [], {}, {}
    for conv in range(30):
        for turn in range(8):
            words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60))]
            mine = textwrap.wrap(" ".join(words), rng.randrange(30, 80))
            lines, source = [], None
            if turn and rng.random() < 0.8:
                source = rng.randrange(turn)
                start = rng.randrange(len(said[conv, source]) - 12)
                part = said[conv, source][start : start + rng.randrange(6, 60)]
                lines = [f"> {x}" for x in textwrap.wrap(" ".join(part).upper(), rng.randrange(30, 80))]
                if rng.random() < 0.5:
                    lines = ["On Mon, 3 Feb 2025 at 10:00, Some One", "<a@b.example> wrote:", "", *lines]
            said[conv, turn] = words
            truth[conv, turn] = (source, "\n".join(mine))
            rows.append((conv, turn, "u", "\n".join([*lines, *mine])))
    got = quoting.reply_order(spark.createDataFrame(rows, MESSAGES)).collect()
    assert {(r.conv_id, r.turn): (r.parent_turn, r.text) for r in got} == truth


def test_partly_known_quotations(spark):
    rows = [
        (1, 0, "a", "The committee met on Tuesday, and nobody objected to the plan. Thanks.\nYours, A."),
        (1, 1, "b", "> and nobody objected to\n> the plan.\n> a line of my own making\n\nI did."),
        (1, 2, "c", "Am 3. Mai 2024 schrieb A\n<a@b>:\n> Thanks.\nWelcome."),
        (1, 3, "d", "We left on 3 May.\nBob wrote:\n>> On 2 May A wrote:\n>>> Thanks.\n>> nobody knows\nYes."),
    ]
    got = {r.turn: r for r in quoting.reply_order(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert [got[t].parent_turn for t in range(4)] == [None, 0, 0, 0]
    assert got[1].text == "> a line of my own making\n\nI did."  # found in no earlier message
    assert got[2].text == "Welcome."
    assert got[3].text == "We left on 3 May.\n>> nobody knows\nYes."


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello all.\nShall we meet on Monday?\nThe room is free."),
        (1, 1, "bob", "On 3 May Ann wrote:\n> Shall we meet on Monday?\nMonday is fine."),
        (1, 2, "cy", "> > shall we  MEET on monday?\n> Monday is fine.\nNot for me."),
        (1, 3, "dee", ">Hello all.\n>Shall we meet\n>on Monday? The room is free.\nWhich room?"),
        (1, 4, "eve", "> nobody said this\nIndeed."),
        (2, 0, "user", "> Shall we meet on Monday?\nanother conversation"),
        (2, 1, "bob", None), (None, None, None, ""), (None, 3, "x", "> >\n>"), (1, 4, "eve", "> nobody said this\nIndeed."),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, at int, root int")
    got = quoting.reply_order(df).collect()
    assert len(got) == len(rows)
    parents = {(r.conv_id, r.turn): r.parent_turn for r in got if r.parent_turn is not None}
    assert parents == brute_threads([(c, t, x) for c, t, _, x in rows]) == {(1, 1): 0, (1, 2): 1, (1, 3): 0}
    first = {r.turn: r for r in got if r.conv_id == 1}
    assert [first[t].depth for t in range(5)] == [0, 1, 2, 1, 0]
    assert first[1].text == "Monday is fine." and first[2].text == "Not for me." and first[3].text == "Which room?"
    assert first[4].text == "> nobody said this\nIndeed."
    order = sorted((r.position, r.turn) for r in got if r.conv_id == 1)
    assert [p for p, _ in order] == list(range(6)) and [t for _, t in order] == [0, 1, 3, 2, 4, 4]
    parts = quoting.conversations(df, 40).collect()
    assert sum(len(p.turns) for p in parts) == len(rows)
    assert quoting.reply_order(df.where("false")).count() == 0


def test_a_long_chain_of_replies(spark):
    rows = [(1, k, "u", (f"> line {k - 1}\n" if k else "") + f"line {k}") for k in range(40)]
    got = quoting.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r.depth == r.turn and r.root_turn == 0 and r.position == r.turn for r in got)


# ---- 2 ---------------------------------------------------------------------------------


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        n = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - n] + u[:n]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_edits(which, request):
    df = request.getfixturevalue(which)
    got = fingerprints.fingerprint_edits(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == brute_edits(texts_of(df))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    if which == "docs":
        assert np.mean([r.near_edited for r in got]) > 0.7 > 0.3 > np.mean([r.near_next for r in got])
    by = defaultdict(set)
    texts = dict(texts_of(df))
    for r in got:
        by[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by.values())


def test_edits_of_one_row_and_none(odd, nothing):
    assert fingerprints.fingerprint_edits(nothing).count() == 0
    got = fingerprints.fingerprint_edits(odd.where("doc_id = 3")).first()
    assert got.near_edited <= 1 and got.near_next == 1.0


def test_block_tables_find_all_in_the_radius(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(20)]
    near_by = [b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(5))) for b in base for _ in range(12)]
    values = sorted({*base, *near_by})
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in (v & (1 << 64) - 1, v >> 64)) for v in values]
    got = {(r[0], r[1], r[2], r[3]) for r in fingerprints.neighbours(spark.createDataFrame(signed, "f1 long, f2 long")).collect()}
    want = {(*a, *b) for a, x in zip(signed, values, strict=True) for b, y in zip(signed, values, strict=True) if 0 < (x ^ y).bit_count() <= 3}
    assert got == want and got


# ---- 3 ---------------------------------------------------------------------------------


def brute_kept(rows, width=20):
    words = [SPACE.findall(t or "") for _, t in rows]
    ids = [(-1 if i is None else i) for i, _ in rows]
    first = {}
    for i, w in zip(ids, words, strict=True):
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for (doc_id, _), i, w in zip(rows, ids, words, strict=True):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] < (i, s):
                gone.update(range(s, s + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["odd", "docs", "nothing"])
def test_repeats(which, request):
    df = request.getfixturevalue(which)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()]
    assert sorted(got, key=str) == brute_kept(texts_of(df))


def test_repeats_of_runs_and_shifted_passages(spark):
    rng = random.Random(11)
    rows = []
    for k in range(120):
        parts = [rng.choice(["a"] * 9 + ["b"]) for _ in range(rng.randrange(90))]
        parts += rng.choice([["p", "q"] * 15, ["a"] * 45, [f"v{j}" for j in range(30)], [f"v{j}" for j in range(7, 40)]])
        rows.append((k, " ".join(parts + [rng.choice("xyz") for _ in range(rng.randrange(30))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()]
    assert sorted(got, key=str) == brute_kept(rows)


# ---- 4 ---------------------------------------------------------------------------------


def test_pages(spark):
    from uptake.llm.common import table

    for r in html.extract(table(spark, TABLES, "pages")).limit(60).collect():
        page = spark.read.parquet(f"{TABLES}/pages.parquet").where(F.col("page_id") == r.page_id).first().html if r.page_id < 3 else None
        assert r.n_chars == len(r.text)
        if page:
            inside = page.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
            import html as plain

            blocks = re.split(r"</?(?:p|h1)>", inside)
            want = [" ".join(plain.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
            assert r.text == "\n".join(x for x in want if x)


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "plain text only"),
        (3, "u", "<body><nav><a href=/>Home</a></nav><main><h1>A &amp; B</h1><p>x&nbsp;<b>y</b>\n z<p>Short.</main><aside>no</aside><footer>(c)"),
        (3, "u", "<article><p>one<br>two</p><script>if (a<b) {'</p>'}</script><style>p{}</style><div class='comments'>no</div><p>three</article>"),
        (4, "u", "<div class=cookie-banner>Accept all cookies now please</div><article><p>yes</p></article><form>Name <input></form>"),
        (5, "u", "<p>" + "word " * 50_000),
        (6, "u", "<article><p>cut off <a href='x"),
    ]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r.page_id, r.text) for r in html.extract(df).collect()}
    assert {(1, ""), (2, ""), (3, "A & B\nx y z\nShort."), (3, "one two\nthree"), (4, "yes"), (6, "cut off")} <= got
    assert (5, " ".join(["word"] * 50_000)) in got
    assert html.extract(df.where("false")).count() == 0


# ---- 5 ---------------------------------------------------------------------------------


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable")) + 1
    pos = np.array(labels) == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, folder).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert auc([got[i].score for i, _ in labels], [t for _, t in labels]) > 0.88


def test_probabilities_are_those_of_a_plain_count(spark):
    rng = random.Random(5)
    words = ["ab", "abc", "bad", "cab", "Dé", "a-b"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(30)), int(k % 3 == 0)) for k in range(30)]
    model = toxicity.fit_counts(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))

    def grams(text):
        folded = re.sub(rb"[^a-z0-9\x80-\xff]+", b" ", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        data = b"   " + folded.removeprefix(b" ")
        return [data[k : k + 4] for k in range(len(data) - 3)]

    count = [Counter(g for _, t, y in rows if y == c for g in grams(t)) for c in (0, 1)]
    kinds = set(count[0]) | set(count[1])
    short = Counter(g[1:] for g in kinds)
    last = Counter(g[2:] for g in short)
    d = toxicity.DISCOUNT

    def shared(g):
        own = [h for h in short if h[:2] == g[1:3]]
        total = sum(short[h] for h in own)
        base = (last[g[3:]] + 1) / (sum(last.values()) + 256)
        return max(short[g[1:]] - d, 0) / total + d * len(own) / total * base if total else base

    def chance(c, g):
        own = [h for h in count[c] if h[:3] == g[:3]]
        total = sum(count[c][h] for h in own)
        return max(count[c][g] - d, 0) / total + d * len(own) / total * shared(g) if total else shared(g)

    for text in ("abc bad Dé", "new words, a-b", "x"):
        want = np.mean([math.log(chance(1, g)) - math.log(chance(0, g)) for g in grams(text)])
        assert math.isclose(model.evidence(pa.array([text]))[0, 0], want, abs_tol=1e-6)


def test_final_counts_cover_all_labelled_rows(spark):
    rows = spark.createDataFrame([(k, f"text word{k} of id{k}", k % 2) for k in range(60)], "doc_id long, text string, toxic int")
    got, want = toxicity.fit(rows), toxicity.fit_counts(rows)
    assert all((g == w).all() for g, w in zip(got.counts + got.totals, want.counts + want.totals, strict=True))


def test_toxicity_edges(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(odd, none).collect()
    assert len(got) == odd.count() and all(r.score == 0.5 and r.predicted == 0 for r in got)
    labels = spark.createDataFrame([(k, 1, k % 2 if k % 3 else None) for k in range(20)], "doc_id long, quality int, toxic int")
    scores = toxicity.toxicity(odd, labels).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_memory_of_the_tasks_of_one_step():
    """Two workers of an executor keep what they once took; counts took 159 MB here, evidence 76 MB and fingerprints 51 MB."""
    rng = random.Random(3)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(400)) for _ in range(2000)]
    column = pa.array([*texts, None, ""])
    toxic = pa.array([k % 3 == 0 for k in range(len(column))])
    ones = np.ones(toxicity.SLOTS, np.float32)
    model = toxicity.Model([ones] * 2, [ones] * 2, [ones] * 2, ones, ones, np.ones(256) / 256)
    steps = {
        "counts": (toxicity._count_rows, pa.RecordBatch.from_arrays([column, toxic], ["text", "toxic"]), 80),
        "evidence": (toxicity._evidence_rows(SimpleNamespace(value=model)), pa.RecordBatch.from_arrays([column, toxic], ["text", "toxic"]), 40),
        "fingerprints": (near._fingerprints, pa.RecordBatch.from_arrays([toxic, toxic, column], ["row", "ord", "text"]), 30),
    }
    for name, (step, batch, limit) in steps.items():
        tracemalloc.start()
        for _ in step(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert most < limit, (name, most)
    got = Counter()
    for out in toxicity._count_rows(iter([steps["counts"][1]])):
        got.update(dict(zip(*out.to_pydict().values(), strict=True)))
    keys, text = toxicity.expressions(column)
    assert got == Counter((keys.astype(np.int64) * 2 + np.array(toxic.to_pylist(), int)[text]).tolist())


# ---- 6 ---------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "docs", "nothing"])
def test_packing(which, request):
    import public_tokenizers
    from tokenizers import Tokenizer

    df = request.getfixturevalue(which)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = sorted([(str(i), [*whole.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts_of(df)])
    pieces = [r.asDict() for r in packing.packed(df, pack_bytes=40_000).collect()]
    want = Counter()
    for i, x in ids:
        want[i, len(x)] += len(x)
    got, known = Counter(), {(i, len(x)): x for i, x in ids}
    sequences = defaultdict(list)
    for p in pieces:
        x = known[str(p["doc_id"]), p["doc_tokens"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(np.array(x, "<u4").tobytes()) == p["ids_crc32"]
        got[str(p["doc_id"]), p["doc_tokens"]] += p["length"]
        sequences[p["sequence_id"]].append(p)
    assert got == want
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0 and len({(p["context"], p["step_group"]) for p in parts}) == 1


def test_pack_places_every_token_once():
    rng = random.Random(1)
    for _ in range(50):
        lengths = [rng.choice([1, 7, 200, 256, 257, 1024, 2047, 2048, 2049, 9000, rng.randrange(1, 5000)]) for _ in range(rng.randrange(0, 60))]
        covered = [np.zeros(n, int) for n in lengths]
        for size, window in packing.pack(lengths):
            assert sum(n for _, _, n in window) == size and size & (size - 1) == 0 and size <= 2048
            for d, s, n in window:
                covered[d][s : s + n] += 1
        assert all((c == 1).all() for c in covered)


# ---- 7 ---------------------------------------------------------------------------------


def brute_top(rows, k):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if i % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in fine if j != i))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_top_k_with_odd_vectors(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1) for _ in range(6)]) for k in range(400)]
    rows += [(1000 + k, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25]) for k in range(60)]
    rows += [(None, [1.0] * 6), (600, None), (601, [1.0, None]), (650, [float("nan")] * 6), (602, [float("inf")] * 6), (603, [2.0]), (604, [])]
    for name, value in (("PAGE", 64), ("LEAF", 8), ("ROUTE_SIZE", 50), ("BLOCK", 3)):
        monkeypatch.setattr(mtree, name, value)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, route int, v int").repartition(3)
    for k in (1, 5):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(df, F.col("vec_id") % 50 == 0, k).collect())
        assert got == brute_top(rows, k)
    assert mtree.top_k(df.where("vec_id < 3"), F.col("vec_id") % 50 == 0).count() == 2
    assert mtree.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_routes_reach_the_driver_once_not_once_a_task(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(4000)]
    rows += [(5000, [1.0, 2.0, 3.0, 4.0])] * 1000
    for name, value in (("ROUTE_SIZE", 500), ("PAGE", 256), ("LEAF", 16)):
        monkeypatch.setattr(mtree, name, value)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    kept, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: kept.append(self) or collect(self))
    found = mtree.top_k(df, F.col("vec_id") % 500 == 250)
    met = 0
    for frame in kept:
        plan = frame._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        plan = plan.plan() if plan.nodeName() == "ResultQueryStage" else plan
        while plan.nodeName() != "TakeOrderedAndProject" and plan.children().size() == 1:
            plan = plan.children().head()
        if plan.nodeName() == "TakeOrderedAndProject":
            met += 1
            assert plan.limit() == 10
            assert plan.child().execute().count() <= 100
    assert met
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in collect(found))
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for i, q in fine:
        if i % 500 == 250:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in fine if j != i)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    assert got == sorted(want)


def test_routes_are_drawn_where_most_rows_are_copies(spark):
    row, other = (1, [1, 2]), (2, [3, 4])
    df = spark.createDataFrame([row] * 5000 + [other], "vec_id long, v array<long>").repartition(8)
    assert sorted(mtree._drawn(df, 5001)) == [[1, 2], [3, 4]]
    assert mtree._drawn(df.where("false"), 0) == []


def test_blocks_leave_a_task_a_few_mb_at_a_time():
    blocks = ((1, p, bytes(1 << 20)) for p in range(40))
    batches = list(mtree._batches(blocks))
    assert sum(b.num_rows for b in batches) == 40
    assert max(b.nbytes for b in batches) < 6 << 20


def test_a_leaf_of_copies_is_compared_a_part_at_a_time():
    """A whole page of copies and a block of queries took 0.7 GB at once."""
    x = np.tile(np.arange(64), (mtree.PAGE, 1))
    space = mtree.Space(64, float((x[0] ** 2).sum()))
    page = mtree.Page.build(np.arange(len(x)), x, space, space.candidates(x[:1])[0])
    own = np.arange(mtree.BLOCK)
    tracemalloc.start()
    got = page.search(x[own], own, 5, space, np.zeros(len(own)), np.full(len(own), np.inf))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    want = [[i, j] for i in own for j in [j for j in range(6) if j != i][:5]]
    assert np.column_stack(got[:2]).tolist() == want


def test_pages_of_wide_vectors_have_fewer_entries():
    assert [mtree._entries(w) for w in (1, 64, 128, 256, 1536)] == [mtree.PAGE] * 3 + [mtree.PAGE // 2, mtree.PAGE // 4]


def test_components_travel_as_the_smallest_integers_that_hold_them():
    for most, size in ((0.0, 1), (100.0, 1), (127.0**2, 2), (257.0**2, 2), (32000.0**2, 2), (40000.0**2, 4), (2.0**80, 8), (2.0**126, 8)):
        assert mtree._narrow(most).itemsize == size


def test_queries_of_a_block_share_the_comparisons_of_a_leaf():
    """A page and a block as tasks get them; one comparison for each query and leaf took 1.6 s and more here."""
    rng = np.random.default_rng(5)
    for spread, copies in ((256, 1), (2, 40), (1 << 27, 1)):
        x = np.repeat(rng.integers(-spread, spread, (4000 // copies, 64)), copies, axis=0)
        ids = rng.permutation(len(x))
        space = mtree.Space(64, float((x.astype(float) ** 2).sum(axis=1).max()))
        page = mtree.Page.build(ids, x, space, space.candidates(x[:1])[0])
        at = rng.permutation(len(x))[:500]
        asked = [(int(ids[k]), x[k].tobytes(), gap, np.inf) for k, gap in zip(at, mtree.apart(space.queries(x[at]), space.candidates(x[:1]))[:, 0], strict=True)]
        batch = pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(vars(page).values()))]), pa.array([pickle.dumps(asked)])], ["page", "block"])
        began = time.thread_time()
        got = [r for b in mtree._searched(5, space)(iter([batch])) for r in zip(*b.to_pydict().values(), strict=True)]
        assert time.thread_time() - began < 0.8
        want = []
        for k in at:
            scores = x @ x[k]
            best = [j for j in np.lexsort((ids, -scores)) if j != k][:5]
            want += [(ids[k], ids[j], scores[j]) for j in best]
        assert sorted(got) == sorted(want)


# ---- 8 ---------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Rows (id, fingerprint) to the smallest id reachable; ids are not null."""
    todo, out = set(range(len(fps))), {}
    while todo:
        group, edge = set(), {todo.pop()}
        while edge:
            group |= edge
            new = {k for k in todo for j in edge if (fps[k][1] ^ fps[j][1]).bit_count() <= 2}
            todo -= new
            edge = new
        for k in group:
            out[k] = min(fps[j][0] for j in group)
    return sorted((i, f"{fp:016x}", out[k]) for k, (i, fp) in enumerate(fps))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_near_components(which, request):
    df = request.getfixturevalue(which)
    rows = [(-(2**63) if i is None else i, brute_fingerprint(t)) for i, t in texts_of(df)]
    got = near.near_components(df).collect()
    low = -(2**63)
    ids = [(low if r.doc_id is None else r.doc_id, r.fingerprint, low if r.component_id is None else r.component_id) for r in got]
    assert sorted(ids) == brute_components(rows)
    kept = near.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(r.component_id) for r in got})


def test_links_of_close_fingerprints(spark, nothing):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for b in base for _ in range(15)} | {0, 1, 3})
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    got = {tuple(sorted(r)) for r in near.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {tuple(sorted((a, b))) for a, x in zip(signed, values, strict=True) for b, y in zip(signed, values, strict=True) if 0 < (x ^ y).bit_count() <= 2}
    assert got == want and got
    assert near.near_components(nothing).count() == 0 and near.one_of_each(nothing).count() == 0


def test_components_that_share_an_id_keep_a_row_each(spark):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.randrange(10**6)}" for _ in range(80)) for _ in range(6)]
    rows = [(None, texts[0]), (5, texts[0]), (None, texts[1]), (9, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3]), (7, texts[4]), (7, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[4])], key=str)
    assert sorted(map(tuple, near.one_of_each(df).collect()), key=str) == want


# ---- 9 ---------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, target, left = set(), {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = left - sum(epochs * sizes[s] for s in full)
        target = {s: epochs * sizes[s] if s in full else rest * weight[s] / max(1, sum(weight[x] for x in free)) for s in names}
        new = {s for s in free if target[s] > epochs * sizes[s] + 1e-9}
        if not new:
            return target
        full |= new


@pytest.mark.parametrize("which", ["odd", "docs", "nothing"])
def test_mixture(which, request):
    df = request.getfixturevalue(which)
    rows = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == df.count()
    sizes, words = Counter(), Counter()
    for r in df.collect():
        sizes[r.source] += len(SPACE.findall(r.text or ""))
        words[r.doc_id] += len(SPACE.findall(r.text or ""))
    want = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(want[s] + 1e-9) for s in sizes)
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    got = Counter()
    for r in mixed.collect():
        got[r.source] += len(SPACE.findall(r.text or ""))
    assert +got == +taken


# ---- 10 --------------------------------------------------------------------------------

PATTERNS = (
    # re.ASCII: either case of the pattern's own letters, not of others that fold to them.
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def brute_spans(text):
    out = [(name, *m.span()) for name, p, keep in PATTERNS for m in p.finditer(text or "") if keep(m)]
    rank = {name: k for k, (name, *_) in enumerate(PATTERNS)}
    return sorted(out, key=lambda x: (x[1], rank[x[0]]))


def check_scan(df):
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan(df).collect()}
    want = set()
    for i, t in texts_of(df):
        spans = brute_spans(t)
        count = Counter(k for k, *_ in spans)
        want.add((i, count["assign"], count["access"], count["hex"], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    assert got == want


def test_scan_of_tables(odd, docs, nothing):
    for df in (odd, docs, nothing):
        check_scan(df)


def test_scan_of_random_texts(spark):
    rng = random.Random(9)
    bits = ["token", "Secret", "passwd", "password", "api_key", "APIkey", "=", ":", " ", "'", '"', "a", "abcdef", "ghij", "AKIA", "Z9" * 8, "0f" * 12, "é", "日", "\n", ".", "ſecret"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for k in range(3000)]
    check_scan(spark.createDataFrame(rows, "doc_id long, text string"))


def test_added_rules_and_redaction(spark, odd):
    text = "é ghp_" + "x1" * 18 + " and -----BEGIN RSA PRIVATE KEY----- token=" + "q" * 9
    df = spark.createDataFrame([(1, text), (2, "clean text"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert [x.split(":")[0] for x in got[1].spans.split(",")] == ["hosting", "private", "assign"] and got[2].spans == got[3].spans == ""
    cleaned = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert cleaned == {1: "é [hosting] and [private] [assign]", 2: "clean text", 3: None}
    assert secrets.redact(odd).columns == odd.columns and secrets.redact(odd).count() == odd.count()


def test_redaction_leaves_nothing_of_a_private_key(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choice("ABCxyz019+/") for _ in range(64)) for _ in range(5)] + ["Zq9/AB=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n"
    bodies = ["\n" + "\n".join(lines) + "\n", "\r\n" + "\r\n".join(lines) + "\r\n", "\\n" + "\\n".join(lines) + "\\n",
              "\n" + headers + "\n".join(lines) + "\n", " " + " ".join(lines) + " ", "\n> " + "\n> ".join(lines) + "\n> "]
    texts = [f"é {begin}{b}{end} after." for b in bodies] + [f"é {begin}{b[: b.rindex('==') + 2]}" for b in bodies]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert all(got[k] == ("é [private] after." if k < len(bodies) else "é [private]") for k in got)
    spans = {r.doc_id: r.spans.split(",")[0] for r in secrets.scan(df).collect()}
    assert all(s.startswith("private:2:") for s in spans.values())


def test_minimal_automaton_agrees_with_the_subset_one():
    nfa = secrets.Nfa()
    start = nfa.state()
    accepts = {nfa.add(r.sought, secrets.start_of(nfa, start)): k for k, r in enumerate(secrets.RULES)}
    large = secrets.subsets(nfa, start, accepts, True)
    small = secrets.combined()
    assert len(small.next) <= len(large.next)
    rng = random.Random(8)
    data = [rng.choice(b"tokensecretAKIAapi_key=: '\"0123456789abcdefXYZ\xc3") for _ in range(20_000)]
    s = t = 0
    for b in data:
        s, t = large.next[s][b], small.next[t][b]
        assert large.marks[s] == small.marks[t]
