"""What is stored in files: header names, footers, emptied months, extreme quantities."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR, Book, one_sku
from uptake import schemas
from uptake.functions.numeric import rnd_signed
from uptake.operators import contracts
from uptake.operators.staging import sku_month
from uptake.plans import quality
from uptake.sources import tables


def test_csv_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("segment,region,cust_id,extra,cust_name,behavior_profile\nEnterprise,AMER,C1,9,Ann,normal\n")
    row = tables.read_csv(spark, str(folder), schemas.CUSTOMERS).first()
    assert row.asDict() == {
        "cust_id": "C1", "cust_name": "Ann", "region": "AMER", "segment": "Enterprise", "behavior_profile": "normal"
    }
    (folder / "b.csv").write_text("cust_id,region,segment,extra,cust_name,behavior_profile\nC2,AMER,Enterprise,9,Bob,normal\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(folder), schemas.CUSTOMERS).collect()


def test_csv_without_a_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cust_id,region,segment,behavior_profile\nC1,AMER,Enterprise,normal\n")
    with pytest.raises(tables.MissingColumn, match="cust_name"):
        tables.read_csv(spark, str(tmp_path), schemas.CUSTOMERS)
    assert tables.read_csv(spark, str(tmp_path), schemas.CUSTOMERS, strict=False).first().cust_name is None
    stored = tables.stored_schemas(spark, str(tmp_path), "csv", schemas.CUSTOMERS)
    assert quality.schema_matches(stored, schemas.CUSTOMERS) == 4


def test_every_footer_counts(spark, tmp_path):
    whole = one_sku(spark, [0.5]).raw()["features"].coalesce(1)
    path = str(tmp_path / "features")
    n = len(schemas.FEATURES)

    def matches():
        return quality.schema_matches(tables.stored_schemas(spark, path), schemas.FEATURES)

    whole.write.parquet(path)
    assert matches() == n
    whole.drop("feature_name").write.mode("append").parquet(path)
    assert matches() == n - 1
    whole.withColumn("deep_threshold_events", F.col("deep_threshold_events").cast("int")).write.mode("append").parquet(path)
    assert matches() == n - 2
    shutil.rmtree(path)
    whole.drop("feature_name").write.parquet(path)
    with pytest.raises(tables.MissingColumn, match="feature_name"):
        tables.read_parquet(spark, path, schemas.FEATURES, strict=True)


def test_thousands_of_footers_with_a_bad_one(spark, tmp_path):
    whole = one_sku(spark, [0.5]).raw()["features"].coalesce(1)
    good, bad = tmp_path / "good", tmp_path / "bad"
    whole.write.parquet(str(good))
    whole.drop("feature_name").write.parquet(str(bad))
    (one,), (other,) = good.glob("*.parquet"), bad.glob("*.parquet")
    path = tmp_path / "features"
    path.mkdir()
    for k in range(3000):
        shutil.copy(other if k == 1777 else one, path / f"part-{k:05d}.parquet")
    examples = tables.schema_examples(spark, {"features": str(path)})
    assert sorted(r.files for r in examples.collect()) == [1, 2999]
    stored = tables.stored_schemas(spark, str(path))
    assert sorted(len(s) for s in stored) == [len(schemas.FEATURES) - 1, len(schemas.FEATURES)]
    assert quality.schema_matches(stored, schemas.FEATURES) == len(schemas.FEATURES) - 1
    with pytest.raises(tables.MissingColumn, match="feature_name"):
        tables.read_parquet(spark, str(path), schemas.FEATURES, strict=True)


def test_partition_folders_are_part_of_the_schema(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-02-01"), (3, "a b")], "n int, month string")
    rows.where("n < 3").write.partitionBy("month").parquet(str(tmp_path / "months"))
    (only,) = tables.stored_schemas(spark, str(tmp_path / "months"))
    assert only.simpleString() == "struct<n:int,month:date>"
    rows.where("n = 3").write.mode("append").partitionBy("month").parquet(str(tmp_path / "months"))
    kinds = {s["month"].dataType.simpleString() for s in tables.stored_schemas(spark, str(tmp_path / "months"))}
    assert kinds == {"date", "string"}


def test_files_that_tasks_cannot_open_are_asked_through_spark(spark, tmp_path):
    whole = one_sku(spark, [0.5]).raw()["features"].coalesce(1)
    spark.conf.set("fs.viewfs.mounttable.shelf.link./in", f"file://{tmp_path}")
    whole.write.parquet(str(tmp_path / "features"))
    whole.drop("feature_name").write.mode("append").parquet(str(tmp_path / "features"))
    stored = tables.stored_schemas(spark, "viewfs://shelf/in/features")
    assert quality.schema_matches(stored, schemas.FEATURES) == len(schemas.FEATURES) - 1


def test_stored_schemas_reach_the_report(spark):
    raw = one_sku(spark, [0.5]).raw()
    stored = {name: [df.schema] for name, df in raw.items()} | {quality.MART: [schemas.SKU_MONTH_ASSERTED]}
    stored["customers"] = [schemas.CUSTOMERS, schemas.PRODUCTS]
    counts = quality.schema_checks(raw, raw["customers"], stored)
    assert (counts[22], counts[23], counts[28]) == (0, len(schemas.PRODUCTS), len(schemas.SKU_MONTH_ASSERTED))
    assert quality.schema_checks(raw, raw["customers"], stored | {"features": []})[25] == 0


def test_an_emptied_month_is_cleared(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.createDataFrame([(str(m), i) for i, m in enumerate(CALENDAR)], "month string, n int")
    rows = rows.withColumn("month", F.to_date("month"))
    tables.write_by_month(rows, path)
    first, last = str(CALENDAR[0]), str(CALENDAR[11])
    tables.write_by_month(rows.where(F.col("n") > 0).withColumn("n", F.col("n") * 10), path, months=[first, last])
    got = {str(r.month): r.n for r in spark.read.parquet(path).collect()}
    assert got == {str(m): i for i, m in enumerate(CALENDAR) if i} | {last: 110}


def test_very_large_and_very_small_use(spark):
    book = Book(spark)
    for cust, units in (("C1", 1.5e15), ("C2", 4e-7)):
        book.customer(cust)
        for _ in range(2):
            key = book.contract(cust, "P1")
            book.use(key, cust, "P1", CALENDAR[:1], [units])
    book.product("P1")
    raw = book.raw()
    assert {r.cust_id: r.consumed_units for r in sku_month(raw["consumption"]).collect()} == {"C1": 3e15, "C2": 8e-7}
    profile = {r.metric: r.value for r in quality.source_profile(raw).collect()}
    assert profile["accounts without use"] == 0


def test_negative_use_rounds_away_from_zero(spark):
    assert spark.range(1).select(rnd_signed(F.lit(-0.0015), 3).alias("x")).first().x == -0.002


def test_contracts_that_end_before_they_start(spark):
    terms = [
        ("2025-01-01", "2026-01-01"), ("2025-03-01", "2025-03-01"), ("2025-06-01", "2025-02-01"), ("2025-06-01", "2025-02-01"),
        ("2025-03-01", "2025-09-01"), ("2025-02-01", "2025-02-01"), ("2024-12-01", "2025-06-01"), ("2025-09-01", "2025-09-01"),
    ]
    book = Book(spark)
    for start, end in terms:
        book.contract("C1", "P1", start, end)
    book.contract("C2", "P1", "2025-03-01", "2025-03-01")
    want = sum(a[0] < b[1] and b[0] < a[1] for i, a in enumerate(terms) for b in terms[:i])
    got = {r.cust_id: r.pairs for r in contracts.overlap_pairs(book.raw()["entitlements"]).collect()}
    assert got == {"C1": want, "C2": 0}
