"""Contract calendar, overlaps, ids, cohorts and volumes, against brute force."""

import hashlib
import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.fixtures import Book, d
from uptake.operators import contracts, keys, volumes


def spine(spark, start, end, lo="2025-07-01", hi="2026-06-01"):
    df = spark.createDataFrame([("E", d(start), d(end))], "entitlement_id string, start_date date, end_date date")
    rows = contracts.month_spine(df, lo, hi).collect()
    return [(str(r.month), r.month_idx) for r in rows]


def test_spine_is_half_open_and_clipped(spark):
    got = spine(spark, "2025-09-01", "2026-09-01")
    assert len(got) == 10
    assert got[0] == ("2025-09-01", 0)
    assert got[-1] == ("2026-06-01", 9)


def test_spine_of_odd_windows(spark):
    assert [m for m, _ in spine(spark, "2025-07-15", "2025-09-01")] == ["2025-08-01"]
    assert [m for m, _ in spine(spark, "2025-07-31", "2025-09-02")] == ["2025-08-01", "2025-09-01"]
    assert [m for m, _ in spine(spark, "2026-01-31", "2026-03-31")] == ["2026-02-01", "2026-03-01"]
    assert spine(spark, "2025-07-02", "2025-07-31") == []
    assert spine(spark, "2027-01-01", "2028-01-01") == []
    assert [i for _, i in spine(spark, "2025-01-15", "2025-09-15")] == [6, 7, 8]


def test_spine_equals_the_cross_join(spark):
    rng = random.Random(4)
    rows = []
    for n in range(200):
        start = d("2025-01-01").toordinal() + rng.randrange(500)
        rows.append((f"E{n}", d("2025-01-01").fromordinal(start), d("2025-01-01").fromordinal(start + rng.randrange(1, 400))))
    df = spark.createDataFrame(rows, "entitlement_id string, start_date date, end_date date")
    got = {(r.entitlement_id, r.month) for r in contracts.month_spine(df, "2025-07-01", "2026-06-01").collect()}
    months = [d(f"2025-{m:02d}-01") for m in range(7, 13)] + [d(f"2026-{m:02d}-01") for m in range(1, 7)]
    assert got == {(k, m) for k, s, e in rows for m in months if s <= m < e}


def test_overlap_pairs_equal_the_pair_loop(spark):
    rng = random.Random(9)
    book = Book(spark)
    windows = {}
    for n in range(120):
        sku = (f"C{n % 5 if n % 3 else 0}", f"P{n % 2}")  # one customer holds a third and more
        start = d("2025-01-01").toordinal() + 30 * rng.randrange(24)
        end = start + 30 * rng.randrange(1, 14)
        start, end = d("2025-01-01").fromordinal(start), d("2025-01-01").fromordinal(end)
        book.contract(*sku, start=str(start), end=str(end))
        windows.setdefault(sku, []).append((start, end))
    got = {(r.cust_id, r.product_id): r.pairs for r in contracts.overlap_pairs(book.raw()["entitlements"]).collect()}
    want = {
        sku: sum(a[0] < b[1] and b[0] < a[1] for a, b in itertools.combinations(ws, 2)) for sku, ws in windows.items()
    }
    assert got == want


def test_touching_and_foreign_windows_do_not_overlap(spark):
    book = Book(spark)
    book.contract("C1", "P1", "2025-07-01", "2025-12-01")
    book.contract("C1", "P1", "2025-12-01", "2026-07-01")
    book.contract("C1", "P2", "2025-07-01")
    book.contract("C2", "P1", "2025-07-01")
    book.contract("C2", "P1", "2025-12-01")
    got = {(r.cust_id, r.product_id): r.pairs for r in contracts.overlap_pairs(book.raw()["entitlements"]).collect()}
    assert got == {("C1", "P1"): 0, ("C1", "P2"): 0, ("C2", "P1"): 1}


def test_contract_terms_and_union(spark):
    orders = spark.createDataFrame([(3, 9.335, d("2024-02-29"))], "units_purchased long, unit_price double, start_date date")
    row = contracts.contract_terms(orders).first()
    assert (row.arr, str(row.end_date)) == (28.01, "2025-02-28")
    both = contracts.contract_union(orders, orders).orderBy("is_expansion").collect()
    assert [r.is_expansion for r in both] == [False, True]


def test_features_of_a_contract(spark):
    book = Book(spark)
    book.feature("F1", "P1")
    book.feature("F2", "P1")
    book.contract("C1", "P1")
    book.contract("C1", "P2")
    raw = book.raw()
    got = contracts.contract_features(raw["entitlements"], raw["features"]).collect()
    assert sorted(r.feature_id for r in got) == ["F1", "F2"]
    long = contracts.active_length(contracts.month_spine(
        contracts.contract_features(raw["entitlements"], raw["features"]), "2025-07-01", "2025-12-01"))
    assert {r.active_len for r in long.collect()} == {6}


def test_dense_ids_follow_the_order(spark):
    rng = random.Random(1)
    values = [(rng.randrange(10**6), i) for i in range(5000)] + [(7, i) for i in range(5000, 8000)]
    df = spark.createDataFrame(values, "a long, b long").repartition(6)
    rows = keys.dense_rank_rows(df, ["a", "b"], "n", partitions=7).collect()
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.n)] == sorted(values)
    assert sorted(r.n for r in rows) == list(range(1, len(values) + 1))


def test_copies_of_a_row_get_distinct_ids_and_spread(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    ranked = keys.dense_rank_rows(df.select("k"), ["k"], "n", partitions=8)
    stats = ranked.agg(F.count("*").alias("c"), F.countDistinct("n").alias("u"), F.max("n").alias("m")).first()
    assert (stats.c, stats.u, stats.m) == (20000, 20000, 20000)
    numbered = df.select("k", F.monotonically_increasing_id().alias("row"))
    placed = keys.positions(numbered, ["k", "row"], 8).where("k = 0")
    assert placed.select(F.shiftrightunsigned("_at", 33)).distinct().count() > 1


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, x) for x in range(500)], "a long, b long")
    first, again = ({r.b: r.n for r in keys.dense_rank_rows(d, ["a"], "n", 3).collect()} for d in (df, df.repartition(9)))
    assert first == again == {x: x + 1 for x in range(500)}


def test_surrogate_key_text(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), (None, 4)], "k string, wide int")
    prepared = keys.prepare_keys(df, ["k"])
    assert prepared.columns == ["k", "_n", "_at"]  # no other column of the rows is written
    ids = keys.surrogate_key(df, prepared, ["k"], "id", "E%05d")
    assert ids.columns == ["k", "wide", "id"]
    assert {r.k: r.id for r in ids.collect()} == {None: "E00001", "a": "E00002", "b": "E00003", "c": "E00004"}
    later = spark.createDataFrame([("c", 9), ("new", 9)], df.schema)
    assert {r.k: r.id for r in keys.surrogate_key(later, prepared, ["k"], "id").collect()} == {"c": "4", "new": None}


def test_surrogate_key_of_many_ranges(spark):
    rng = random.Random(2)
    pairs = rng.sample([(a, b) for a in range(90) for b in range(90)], 4000)
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = keys.surrogate_key(df, keys.prepare_keys(df, ["a", "b"], 7), ["a", "b"], "id").collect()
    assert {(r.a, r.b): int(r.id) for r in got} == {pair: n + 1 for n, pair in enumerate(sorted(pairs))}


def test_surrogate_key_refuses_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, wide int")
    ids = keys.surrogate_key(df, keys.prepare_keys(df, ["k"]), ["k"], "id")
    with pytest.raises(Exception, match="a key occurs more than once"):
        ids.collect()


def test_cohorts_have_exact_sizes_and_are_stable(spark):
    df = spark.createDataFrame([(f"C{i}",) for i in range(100)], "cust_id string")
    quotas = {"shelfware": 10, "overage": 15, "spike_drop": 5}

    def draw(frame):
        return {r.cust_id: r.cohort for r in keys.quota_cohort(frame, "cust_id", quotas, "normal", seed="s").collect()}

    first, again = draw(df), draw(df.repartition(5))
    assert first == again
    sizes = {c: list(first.values()).count(c) for c in set(first.values())}
    assert sizes == quotas | {"normal": 70}


def test_buckets(spark):
    rows = spark.range(1000).select(
        keys.hash_bucket(F.col("id").cast("string"), 8).alias("a"), keys.portable_bucket(F.col("id"), 8).alias("b")
    ).collect()
    for name in ("a", "b"):
        assert {r[name] for r in rows} == set(range(8))


def test_expected_volume_is_the_median(spark):
    rng = random.Random(3)
    book = Book(spark)
    counts = {}
    month = [d("2025-07-01")]
    for n in range(600):
        feature = f"F{n % 7 if n % 3 else 0}"
        value = rng.choice([0, rng.randrange(1, 20), rng.randrange(1, 5_000_000)])
        book.events("E1", f"C{n}", "P1", feature, month, [value])
        if value:
            counts.setdefault(feature, []).append(value)
    got = {r.feature_id: r for r in volumes.expected_volume(book.raw()["feature_adoption"]).collect()}
    assert {f: r.expected_active_volume for f, r in got.items()} == {f: statistics.median(c) for f, c in counts.items()}
    assert {f: r.active_user_months for f, r in got.items()} == {f: len(c) for f, c in counts.items()}


def test_thresholds_are_a_fifth_and_four_fifths(spark):
    row = spark.range(1).select(*volumes.feature_thresholds(F.lit(803.0))).first()
    assert (row.meaningful_floor_events, row.deep_threshold_events) == (161, 642)


def test_cohorts_sort_only_where_a_quota_ends(spark, capsys):
    df = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("cust_id"), (F.col("id") % 7).alias("other"))
    quotas = {"a": 1000, "b": 1, "none": 0, "c": 1500}
    got = keys.quota_cohort(df, "cust_id", quotas, "rest", seed="s")
    assert got.columns == ["cust_id", "other", "cohort"]
    order = sorted((r.cust_id for r in df.collect()), key=lambda c: (int(hashlib.md5(f"s{c}".encode()).hexdigest()[:8], 16), c))
    want = dict(zip(order, ["a"] * 1000 + ["b"] + ["c"] * 1500 + ["rest"] * 499, strict=True))
    assert {r.cust_id: r.cohort for r in got.collect()} == want
    assert keys.quota_cohort(df, "cust_id", {"all": 5000}, "rest").where("cohort = 'all'").count() == 3000
    got.explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan and "FileScan" not in plan
