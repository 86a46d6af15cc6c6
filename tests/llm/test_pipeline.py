"""The five stages in a row, over odd rows, a table and none, against plain versions of each stage."""

import re
from collections import Counter

import pytest
from test_operators import DOCS, SPACE, TABLES, odd_rows

import corpus_pipeline
from uptake.llm import mixing, near, packing, secrets, toxicity

HELPERS = "_score double, __score double, uid long, whole string, _uid long, _group long, _id long, _key string, _size long, _taken long, _words int, _same int"


def components(texts):
    """Numbers of texts that two bits link, by comparing all fingerprints."""
    prints = [int(near_print(t), 16) for t in texts]
    todo, out = set(range(len(texts))), []
    while todo:
        group, edge = set(), {todo.pop()}
        while edge:
            group |= edge
            new = {k for k in todo if any((prints[k] ^ prints[j]).bit_count() <= 2 for j in edge)}
            todo -= new
            edge = new
        out.append(sorted(group))
    return out


def near_print(text):
    import xxhash

    words = re.findall(rb"[^ \t\n\v\f\r]+", (text or "").encode().lower())
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    votes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return f"{sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes)):016x}"


def stage(spark, name, docs, folder=TABLES):
    before = docs.columns
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    if name != "packing":
        assert out.columns == before and out.dtypes == docs.dtypes
    return spark.createDataFrame(out.collect(), out.schema)


@pytest.mark.parametrize("which", ["odd", "docs", "nothing"])
def test_stages_in_a_row(spark, which):
    odd = spark.createDataFrame([(*r, *([None] * 5), 1, 2, "k", 3, 4, 5, 6)[: len(r) + 12] for r in odd_rows()], f"{DOCS}, {HELPERS}")
    docs = {"odd": odd, "docs": spark.read.parquet(f"{TABLES}/documents.parquet"), "nothing": odd.where("false")}[which]
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    start = docs.collect()
    scores = toxicity.score(docs.select("text"), model).collect()
    toxic = {r.text for r in scores if r._score >= toxicity.THRESHOLD}

    kept = stage(spark, "toxicity", docs)
    rows = kept.collect()
    assert Counter(map(repr, rows)) == Counter(repr(r) for r in start if r.text not in toxic)

    single = stage(spark, "near-dedup", kept)
    groups = components([r.text for r in rows])
    assert single.count() == len(groups)
    chosen = Counter(map(repr, single.collect()))
    for group in groups:
        low = min(-1 if rows[k].doc_id is None else rows[k].doc_id for k in group)
        firsts = [repr(rows[k]) for k in group if (-1 if rows[k].doc_id is None else rows[k].doc_id) == low]
        assert any(chosen[x] for x in firsts)

    safe = stage(spark, "secrets", single)
    for a, b in zip(sorted(map(repr, single.collect())), sorted(map(repr, safe.collect())), strict=True):
        assert a[:20] == b[:20]
    assert all(not secrets.code_point_spans(r.text) for r in safe.collect() if r.text)

    mixed = stage(spark, "mixing", safe)
    sizes = Counter()
    for r in safe.collect():
        sizes[r.source] += len(SPACE.findall(r.text or ""))
    taken = Counter()
    for r in mixed.collect():
        taken[r.source] += len(SPACE.findall(r.text or ""))
        assert r.n_chars is None and r.text is None or r.n_chars == len(r.text)
    goal = {r.source: r.target for r in mixing.targets(safe.select("source", mixing.word_count(safe.text).alias("size"))).collect()}
    assert all(taken[s] == int(goal[s]) for s in goal)

    pieces = stage(spark, "packing", mixed).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r.doc_id for r in mixed.collect())
    coder = packing.encoder(*packing.vocabulary_files())
    ids = Counter()
    for r in mixed.collect():
        ids[r.doc_id] += len(coder.ids(r.text or "")) // 4 + 1
    found = Counter()
    for p in pieces:
        found[p.doc_id] += p.length
    assert found == ids


def test_near_dedup_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c d", 7, 8, 9), (2, "a b c d", 1, 2, 3)], "doc_id long, text string, uid long, whole long, hash long")
    assert [tuple(r) for r in near.one_of_each(df).collect()] == [(1, "a b c d", 7, 8, 9)]


def test_run_goes_through_all_stages(spark):
    out = corpus_pipeline.run(spark, TABLES)
    assert out.columns[0] == "doc_id" and out.count() > 0
