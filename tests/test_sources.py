"""Readers and writers."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR, one_sku
from uptake import schemas
from uptake.catalog import Workspace
from uptake.functions.calendar import day
from uptake.plans import marts
from uptake.sources import shared, tables, warehouse
from uptake.sources.store import Store


@pytest.fixture(scope="module")
def raw(spark):
    return one_sku(spark, [1.0, 0.5, 1.5], events=[10, 50, 90]).raw()


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def test_csv_round_trip(spark, raw, tmp_path):
    tables.write_raw_csv(raw, str(tmp_path))
    back = tables.read_raw(spark, str(tmp_path), "csv")
    for name, df in back.items():
        assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.RAW[name]]
        same(df, raw[name])


def test_parquet_round_trip(spark, raw, tmp_path):
    for name, df in raw.items():
        tables.write_table(df, f"{tmp_path}/{name}")
    for name, df in tables.read_raw(spark, str(tmp_path)).items():
        same(df, raw[name])
    with pytest.raises(ValueError, match="unknown format"):
        tables.read_raw(spark, str(tmp_path), "xml")


def test_bad_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("product_id,product_name,product_platform,unit_of_measure\nP1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), schemas.PRODUCTS).collect()


def test_boolean_repair(spark):
    text = spark.createDataFrame([("true",), ("False",), (None,)], "flag_expansion string")
    fixed = tables.repair_booleans(text, schemas.SKU_MONTH)
    assert [r.flag_expansion for r in fixed.collect()] == [True, False, None]


def test_mart_is_partitioned_and_pruned(spark, raw, tmp_path):
    path = str(tmp_path / "mart")
    mart = marts.customer_sku_month(raw)
    tables.write_by_month(mart, path)
    back = tables.read_parquet(spark, path, schemas.SKU_MONTH)
    same(back, mart)
    plan = back.where(F.col("month") == F.lit(CALENDAR[0])).select("vrs")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "ReadSchema: struct<vrs:double>" in plan


def test_one_month_is_replaced(spark, raw, tmp_path):
    path = str(tmp_path / "mart")
    mart = marts.customer_sku_month(raw)
    tables.write_by_month(mart, path)
    changed = mart.withColumn("vrs", F.lit(1.0))
    tables.write_by_month(changed, path, months=[str(CALENDAR[1])])
    back = {r.month: r.vrs for r in tables.read_parquet(spark, path, schemas.SKU_MONTH).collect()}
    assert back[CALENDAR[1]] == 1.0
    assert back[CALENDAR[0]] == {r.month: r.vrs for r in mart.collect()}[CALENDAR[0]] != 1.0
    assert len(back) == 3


def test_catalog_tables_and_views(spark, raw, tmp_path):
    warehouse.create_namespace(spark, "adoption_test", f"{tmp_path}/adoption")
    try:
        mart = marts.customer_sku_month(raw)
        warehouse.save(mart, "adoption_test.sku_mart")
        same(tables.read_table(spark, "adoption_test.sku_mart", schemas.SKU_MONTH), mart)
        assert list((tmp_path / "adoption" / "sku_mart").glob("month=*"))
        for name, df in raw.items():
            warehouse.save(df, f"adoption_test.{name}")
        same(tables.read_raw(spark, "adoption_test", "table")["features"], raw["features"])
        warehouse.create_views(spark, "adoption_test")
        built = marts.build(raw)
        for name in warehouse.VIEWS:
            same(spark.table(f"adoption_test.{name}"), built[name])
        assert not spark.catalog.getTable("adoption_test.stg_sku_month").isTemporary
        tables.register_views({"stg_sku_month": built["stg_sku_month"]})
        assert spark.sql("SELECT max(lur) AS m FROM stg_sku_month").first().m == 1.5
    finally:
        spark.sql("DROP DATABASE adoption_test CASCADE")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_months_of_a_catalog_table_are_replaced_alone(spark, raw, tmp_path, mode):
    mart = marts.customer_sku_month(raw)
    months = sorted(str(r.month) for r in mart.select("month").distinct().collect())
    warehouse.create_namespace(spark, "adoption_months", f"{tmp_path}/adoption")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        warehouse.save(mart, "adoption_months.sku_mart")
        kept = mart.where(F.col("month") != day(months[0])).withColumn("vrs", F.lit(2.0))
        warehouse.replace_months(kept, "adoption_months.sku_mart", months[:2])
        want = kept.where(F.col("month") == day(months[1])).unionByName(mart.where(~F.col("month").isin(*map(day, months[:2]))))
        same(tables.read_table(spark, "adoption_months.sku_mart", schemas.SKU_MONTH), want)
        with pytest.raises(ValueError):
            warehouse.replace_months(mart, "adoption_months.sku_mart", ["2025-01-01'); --"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.sql("DROP DATABASE adoption_months CASCADE")


def test_exports(spark, raw, tmp_path):
    built = marts.build(raw)
    for name in ("mart_sku_month_full", "mart_feature_full"):
        tables.write_csv(built[name], str(tmp_path / name))
        same(tables.read_csv(spark, str(tmp_path / name), schemas.MARTS[name]), built[name])


def test_store_writes_once(spark):
    calls = []

    def make():
        calls.append(1)
        return spark.createDataFrame([("P1", "Name", "sase", "seats")], schemas.PRODUCTS)

    store = Store(spark)
    for _ in range(2):
        assert store.table("products", make, schemas.PRODUCTS).count() == 1
    assert calls == [1]


def test_shared_folder_follows_the_setting(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared.shared_folder(spark)
    if setting:
        assert folder.startswith(setting)
    assert folder == shared.shared_folder(spark)
    assert shared.fresh_folder(spark, "x") != shared.fresh_folder(spark, "x")


def test_cluster_without_setting_is_refused():
    class Conf:
        def get(self, name, default=None):
            return None

    class Context:
        master, applicationId = "yarn", "app"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


def test_dates_survive_csv(spark, raw, tmp_path):
    tables.write_csv(raw["entitlements"], str(tmp_path / "e"))
    row = tables.read_csv(spark, str(tmp_path / "e"), schemas.ENTITLEMENTS).first()
    assert row.start_date == dt.date(2025, 7, 1)
    assert row.is_expansion is False


def there(path):
    return Path(path.removeprefix("file:")).exists()


def test_scratch_deletes_what_it_does_not_keep(spark):
    with shared.scratch(spark) as outer:
        with shared.scratch(spark) as inner:
            paths = [shared.fresh_folder(spark, name) for name in ("a", "b")]
            for path in paths:
                spark.range(3).write.parquet(path)
            kept = inner.keep_last()
        assert kept == paths[1] and [there(p) for p in paths] == [False, True]
        assert spark.read.parquet(kept).count() == 3
        with pytest.raises(RuntimeError), shared.scratch(spark):
            lost = shared.fresh_folder(spark, "lost")
            spark.range(3).write.parquet(lost)
            raise RuntimeError
        assert not there(lost) and outer.paths == [kept]
    assert not there(kept)


def test_only_own_folders_are_removed(spark, tmp_path):
    for path in (str(tmp_path), f"{shared.shared_folder(spark)}/..", shared.shared_folder(spark), f"{shared.shared_folder(spark)}/"):
        with pytest.raises(ValueError, match="not a folder of this application"):
            shared.remove(spark, path)
    assert tmp_path.exists()


def test_a_store_owns_its_tables(spark):
    with Store(spark) as store:
        schema = spark.range(1).schema
        assert store.table("numbers", lambda: spark.range(5), schema).count() == 5
        path = store._paths["numbers"]
        assert store.has("numbers") and there(path)
        store.drop("numbers")
        assert not store.has("numbers") and not there(path)
        store.drop("numbers")
        assert store.table("numbers", lambda: spark.range(7), schema).count() == 7
        path = store._paths["numbers"]
    assert not there(path)


def test_the_helper_of_the_sources_is_dropped(spark):
    space = Workspace(spark, "/root/testdata/sf0.001")
    rows = {name: df.count() for name, df in space.raw.items()}
    assert not space.store.has("monthly_usage") and all(rows.values())
    paths = list(space.store._paths.values())
    assert len(paths) == len(rows) and all(map(there, paths))
    space.close()
    assert not any(map(there, paths))
    assert space.source("customers").count() == rows["customers"]
    space.close()
