"""The two jobs, end to end over files."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR
from tests.test_quality import EXPECT, sound_book
from uptake import jobs, schemas
from uptake.plans import quality
from uptake.sources import tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    tables.write_raw_csv(sound_book(spark).raw(), f"{root}/source")
    return root


def test_build_then_check(spark, folder, capsys):
    source, target, export = (f"{folder}/{x}" for x in ("source", "target", "export"))
    assert jobs.main(["build", source, target, "--format", "csv", "--export", export]) == 0
    for name, schema in schemas.MARTS.items():
        df = jobs.mart(spark, target, name)
        assert df.count() > 0
        assert df.schema.names == schema.names
    assert jobs.main(["check", source, target, "--format", "csv"]) == 1  # other data set's checksums
    expect = quality.pin(jobs.mart(spark, target, "mart_customer_sku_month"), EXPECT)
    (folder / "expect.json").write_text(json.dumps(dataclasses.asdict(expect)))
    capsys.readouterr()
    done = jobs.main(["check", source, target, "--format", "csv", "--expect", str(folder / "expect.json"), "--against", export])
    out = capsys.readouterr().out
    assert done == 0
    assert "36/36 passed" in out
    assert out.count("OK ") == 3


def test_one_month_again(spark, folder):
    source, target = f"{folder}/source", f"{folder}/again"
    raw = tables.read_raw(spark, source, "csv")
    jobs.build(spark, raw, target)
    before = {r.month: r.n for r in _counts(spark, target)}
    month = CALENDAR[11]
    more = raw["consumption"].where((F.col("month") != F.lit(month)) | (F.col("cust_id") != "C2"))
    jobs.build(spark, {**raw, "consumption": more}, target, months=[str(month)])
    after = {r.month: r.n for r in _counts(spark, target)}
    assert after == before | {month: before[month] - 1}


def test_publish(spark, folder):
    source, target, space = f"{folder}/source", f"{folder}/published", "uptake_published"
    jobs.build(spark, tables.read_raw(spark, source, "csv"), target)
    name = f"{space}.mart_customer_sku_month"
    try:
        assert jobs.main(["publish", target, space, "--folder", f"{folder}/warehouse"]) == 0
        for mart, schema in schemas.MARTS.items():
            stored = tables.read_table(spark, f"{space}.{mart}", schema)
            assert stored.exceptAll(jobs.mart(spark, target, mart)).count() == 0 < stored.count()
        first = str(CALENDAR[0])
        tables.write_by_month(jobs.mart(spark, target, "mart_customer_sku_month").where("cust_id <> 'C2'"), target + "/mart_customer_sku_month", [first])
        spark.catalog.refreshByPath(target)
        assert jobs.main(["publish", target, space, "--months", first]) == 0
        stored = tables.read_table(spark, name, schemas.SKU_MONTH)
        fresh = tables.read_parquet(spark, f"{target}/mart_customer_sku_month", schemas.SKU_MONTH)
        assert stored.exceptAll(fresh).count() == fresh.exceptAll(stored).count() == 0
        assert not stored.where((F.col("month") == F.lit(CALENDAR[0])) & (F.col("cust_id") == "C2")).count() and stored.where("cust_id = 'C2'").count()
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {space} CASCADE")


def _counts(spark, target):
    return jobs.mart(spark, target, "mart_customer_sku_month").groupBy("month").agg(F.count("*").alias("n")).collect()


def test_bad_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["build", "only-source"])
