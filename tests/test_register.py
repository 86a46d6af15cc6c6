"""The parameter register: resolution, scoring with stored values, and the jobs that carry it."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR
from tests.test_quality import EXPECT, sound_book
from uptake import jobs, register
from uptake.params import DEFAULTS, HARSH_OVERAGE, Override
from uptake.plans import marts, quality
from uptake.register import Rule
from uptake.sources import tables


def plain(rules, cell):
    """The values of one cell by looking at every rule."""
    segment, platform, month = cell
    out = {n: getattr(DEFAULTS, n) for n in register.NAMES}
    best = {}
    for r in rules:
        reaches = r.segment in (None, segment) and r.platform in (None, platform)
        if reaches and (r.valid_from is None or r.valid_from <= str(month)) and (r.valid_to is None or str(month) < r.valid_to):
            best[r.name] = max(best.get(r.name, (-99, "", 0)), (r.priority, r.valid_from or "0001-01-01", r.value))
    return out | {n: v[2] for n, v in best.items()}


def test_the_best_rule_wins(spark):
    rng = random.Random(3)
    months = [str(m) for m in CALENDAR]
    rules = [
        Rule(rng.choice(["band_low", "use_floor", "fast_days"]), rng.random(), rng.choice([None, "A", "B"]), rng.choice([None, "x", "y"]),
             rng.randrange(3), rng.choice([None, *months]), rng.choice([None, *months]))
        for _ in range(60)
    ]
    cells = [(s, p, m) for s in ("A", "B", None) for p in ("x", "y", "z", None) for m in CALENDAR]
    got = register.resolve(register.rule_table(spark, rules), spark.createDataFrame(cells, "segment string, product_platform string, month date"))
    rows = got.collect()
    assert len(rows) == len(cells)
    for r in rows:
        want = plain(rules, (r.segment, r.product_platform, r.month))
        assert {n: r[f"param_{n}"] for n in register.NAMES} == want


def test_unknown_names_end_the_build(spark):
    rules = register.rule_table(spark, [Rule("no_such", 1.0)])
    with pytest.raises(ValueError, match="no_such"):
        register.resolve(rules, spark.createDataFrame([], "segment string, product_platform string, month date"))


def test_no_rules_change_nothing(spark):
    raw = sound_book(spark).raw()
    kept = register.resolve(register.rule_table(spark, []), register.cells(raw))
    for make in (marts.customer_sku_month, marts.customer_feature_month):
        assert sorted(map(str, make(raw, parameters=kept).collect())) == sorted(map(str, make(raw).collect()))


def test_feature_levels_can_be_overridden(spark):
    raw = sound_book(spark).raw()
    rules = [Rule("feature_idle", 0.1), Rule("feature_active", 0.5, platform="sase", priority=1)]
    kept = register.resolve(register.rule_table(spark, rules), register.cells(raw))
    before = {(r.cust_id, r.feature_id, r.month): r for r in marts.customer_feature_month(raw).collect()}
    for r in marts.customer_feature_month(raw, parameters=kept).collect():
        old = before[r.cust_id, r.feature_id, r.month]
        assert r.adoption_level == old.adoption_level
        assert r.feature_score == {0.3: 0.1, 0.7: 0.5}.get(old.feature_score, old.feature_score)


def test_stored_values_agree_with_literal_overrides(spark):
    raw = sound_book(spark).raw()
    rules = [Rule("overage_score", 0.6, platform="sase"), Rule("weight_speed", 0.05, "Enterprise")]
    literal = [Override({"overage_score": 0.6}, platform="sase"), Override({"weight_speed": 0.05}, segment="Enterprise")]
    kept = register.resolve(register.rule_table(spark, rules), register.cells(raw))
    got = marts.customer_sku_month(raw, parameters=kept).collect()
    assert sorted(map(str, got)) == sorted(map(str, marts.customer_sku_month_overridden(raw, literal).collect()))


def results(rows):
    return {r["test"]: r["val"] for r in rows.collect()}


def test_a_harsher_ceiling_is_no_failure(spark):
    raw = sound_book(spark).raw()
    mart = marts.customer_sku_month(raw, HARSH_OVERAGE)
    assert mart.where("lur > 1.2").count() > 0
    assert results(quality.report(raw, mart, EXPECT))["overage_capped_and_flagged"] > 0
    assert results(quality.report(raw, mart, EXPECT, p=HARSH_OVERAGE))["overage_capped_and_flagged"] == 0


def test_jobs_carry_the_register(spark, tmp_path, capsys):
    tables.write_raw_csv(sound_book(spark).raw(), f"{tmp_path}/source")
    (tmp_path / "rules.json").write_text(
        "\n".join(json.dumps(r) for r in [{"name": "overage_score", "value": 0.5, "valid_from": "2026-01-01"}, {"name": "band_middle", "value": 60, "segment": "Enterprise"}])
    )
    args = [f"{tmp_path}/source", f"{tmp_path}/target", "--format", "csv"]
    assert jobs.main(["build", *args, "--params", f"{tmp_path}/rules.json"]) == 0
    kept = jobs.stored_parameters(spark, f"{tmp_path}/target")
    assert {(str(r.month) >= "2026-01-01", r.param_overage_score) for r in kept.collect()} == {(False, 0.8), (True, 0.5)}
    jobs.main(["check", *args])
    assert "FAIL" not in [line.split()[0] for line in capsys.readouterr().out.splitlines() if "overage_capped" in line]
    sku = jobs.mart(spark, f"{tmp_path}/target", "mart_customer_sku_month").join(
        tables.read_raw(spark, args[0], "csv")["customers"], "cust_id"
    )
    limit = F.when(F.col("segment") == "Enterprise", 60).otherwise(50)
    lost = {(r.cust_id, r.month): r.lost for r in sku.groupBy("cust_id", "month").agg(F.coalesce(F.sum(F.when(F.col("vrs") < limit, F.col("arr"))), F.lit(0.0)).alias("lost")).collect()}
    for r in jobs.mart(spark, f"{tmp_path}/target", "mart_customer_month").collect():
        assert r.arr_at_risk == pytest.approx(lost[r.cust_id, r.month], abs=1)
    assert jobs.stored_parameters(spark, f"{tmp_path}/nowhere") is None
