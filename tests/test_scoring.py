"""The scoring rules on single values, against answers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions import labels, numeric, scoring
from uptake.params import HARSH_OVERAGE, SMOOTH_ACTIVATION, Override, resolve


def evaluate(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return df.select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_utilization_curve(spark):
    points = {0.0: 0.0, 0.0999: 0.0, 0.10: 0.3, 0.35: 0.6, 0.60: 0.9, 0.80: 0.95, 1.0: 1.0, 1.2: 1.0, 1.2001: 0.8}
    got = evaluate(
        spark, [(x,) for x in [*points, None]], "x double", y=scoring.utilization_health(F.col("x"))
    )
    assert [r.y for r in got] == pytest.approx([*points.values(), 0.8])


def test_utilization_variants(spark):
    got = evaluate(
        spark,
        [(0.10,), (0.35,), (0.60,), (2.0,)],
        "x double",
        smooth=scoring.utilization_health(F.col("x"), SMOOTH_ACTIVATION),
        harsh=scoring.utilization_health(F.col("x"), HARSH_OVERAGE),
    )
    assert [r.smooth for r in got] == pytest.approx([0.0, 0.45, 0.9, 0.8])
    assert [r.harsh for r in got] == pytest.approx([0.3, 0.6, 0.9, 0.6])


def test_speed(spark):
    cases = {0: 1.0, -14: 1.0, 30: 1.0, 31: 59 / 60, 60: 0.5, 62: 28 / 60, 90: 0.0, 92: 0.0, None: 0.0}
    got = evaluate(spark, [(x,) for x in cases], "x int", y=scoring.speed_score(F.col("x")))
    assert [r.y for r in got] == pytest.approx(list(cases.values()))


def test_feature_points_and_levels(spark):
    got = evaluate(
        spark,
        [(0,), (19,), (20,), (79,), (80,)],
        "n long",
        y=scoring.feature_points(F.col("n"), F.lit(20), F.lit(80)),
        level=scoring.adoption_level(scoring.feature_points(F.col("n"), F.lit(20), F.lit(80))),
    )
    assert [r.y for r in got] == [0.0, 0.3, 0.7, 0.7, 1.0]
    assert [r.level for r in got] == ["not_enabled", "enabled_idle", "active", "active", "deep"]


@pytest.mark.parametrize(
    ("util", "fa", "sus", "ttv", "has", "grace", "expected"),
    [
        (1.0, 0.7, 1.0, 1.0, True, False, 92.5),
        (0.99, 0.125, 1.0, 1.0, True, False, 77.8),
        (0.0, 0.7, 0.0, 0.0, True, True, 20.6),
        (0.9, 0.0, 0.625, 1.0, False, False, 82.8),
        (0.0, 0.0, 0.0, 0.0, False, True, 0.0),
    ],
)
def test_composite(spark, util, fa, sus, ttv, has, grace, expected):
    names = ("util", "fa", "sus", "ttv", "has", "grace")
    score = scoring.composite(*[F.col(n) for n in names])
    got = evaluate(
        spark,
        [(util, fa, sus, ttv, has, grace)],
        "util double, fa double, sus double, ttv double, has boolean, grace boolean",
        y=numeric.rnd(score, 1),
    )
    assert got[0].y == expected


def test_band_of_stored_score(spark):
    cases = {70.0: v.REALIZED, 69.9: v.DEVELOPING, 50.0: v.DEVELOPING, 49.9: v.AT_RISK, 30.0: v.AT_RISK, 29.9: v.CRITICAL}
    got = evaluate(spark, [(x,) for x in [*cases, None]], "x double", y=scoring.band(F.col("x")))
    assert [r.y for r in got] == [*cases.values(), v.CRITICAL]


def test_raw_score_decides_state_and_stored_score_decides_band(spark):
    raw = F.col("x")
    healthy = dict(
        grace=F.lit(False), prior_lur=F.lit(0.0), sustained=F.lit(1.0), health=F.lit(1.0),
        ever_active=F.lit(1), speed=F.lit(1.0), features=F.lit(1.0),
    )
    got = evaluate(
        spark, [(69.96,)], "x double",
        state=scoring.state(score=raw, **healthy), stored=numeric.rnd(raw, 1), band=scoring.band(numeric.rnd(raw, 1)),
    )[0]
    assert (got.state, got.stored, got.band) == (v.DEVELOPING, 70.0, v.REALIZED)


def test_flags(spark):
    got = evaluate(
        spark,
        [(1.2, 0.2, True), (1.21, 0.5, True), (1.5, 0.2, True), (1.5, 0.2, False)],
        "lur double, fa double, has boolean",
        grow=scoring.expanding(F.col("lur")),
        single=scoring.fragile(F.col("has"), F.col("fa"), F.col("lur")),
    )
    assert [(r.grow, r.single) for r in got] == [(False, True), (True, False), (True, True), (True, False)]


def test_rounding(spark):
    got = evaluate(
        spark, [(0.285,), (2.5,), (None,)], "x double", two=numeric.rnd(F.col("x"), 2), whole=numeric.rnd(F.col("x"), 0)
    )
    # 0.285 * 100 is 28.499999999999996 in binary
    assert [(r.two, r.whole) for r in got] == [(0.28, 0.0), (2.5, 3.0), (None, None)]
    signed = evaluate(spark, [(-2.5,), (-0.01,), (2.44,)], "x double", y=numeric.rnd_signed(F.col("x"), 1))
    assert [repr(r.y) for r in signed] == ["-2.5", "0.0", "2.4"]


def test_weighted_mean_keeps_or_drops_unknown_rows(spark):
    rows = [(1.0, 100.0), (None, 300.0), (0.5, 100.0)]
    df = spark.createDataFrame(rows, "x double, arr double")
    got = df.agg(
        numeric.signal(F.col("x"), F.col("arr")).alias("known"),
        numeric.weighted_mean(F.col("x"), F.col("arr")).alias("all"),
    ).first()
    assert got.known == 0.75
    assert got["all"] == pytest.approx(150 / 500)
    nothing = df.where("x is null").agg(numeric.signal(F.col("x"), F.col("arr")).alias("known")).first()
    assert nothing.known is None
    free = spark.createDataFrame([(90.0, 0.0)], "x double, arr double")
    row = free.agg(
        numeric.weighted_mean(F.col("x"), F.col("arr")).alias("a"), numeric.headline_score(F.col("x"), F.col("arr")).alias("b")
    ).first()
    assert (row.a, row.b) == (None, 0.0)


def test_labels(spark):
    got = evaluate(
        spark,
        [("PX-410 SKU-0123", "sase"), ("Plain name", "mainframe")],
        "name string, code string",
        model=labels.model_name(F.col("name")),
        platform=labels.platform_label(F.col("code")),
    )
    assert [(r.model, r.platform) for r in got] == [("PX-410", "SASE"), ("Plain name", "mainframe")]


def test_play_and_anomaly_ladders_differ(spark):
    facts = "collapse boolean, shelf boolean, grow boolean, single boolean"
    rows = [(True, True, False, False), (False, True, True, False), (False, False, True, True), (False, False, False, True), (False,) * 4]
    c = [F.col(n) for n in ("collapse", "shelf", "grow", "single")]
    got = evaluate(spark, rows, facts, play=labels.play(*c[:3]), anomaly=labels.anomaly(*c))
    assert [(r.play, r.anomaly) for r in got] == [
        ("Win back", "Shelfware"),
        ("Activate", "Shelfware"),
        ("Upsell", "Overage (upsell)"),
        (None, "Single Feature Flag"),
        (None, "—"),
    ]


def test_advice_and_counts_text(spark):
    got = evaluate(
        spark,
        [("Upsell", 1.455), ("Win back", None), (None, None)],
        "play string, lur double",
        advice=labels.play_advice(F.col("play"), F.col("lur")),
    )
    assert [r.advice for r in got] == ["Upsell · Sales (overage 146%)", "Win back · Account teams", "— monitor"]
    texts = evaluate(
        spark, [(2, 0, 1), (0, 0, 0)], "a int, b int, c int",
        t=labels.anomaly_counts_text(F.col("a"), F.col("b"), F.col("c")),
    )
    assert [r.t for r in texts] == ["2 shelfware · 1 overage", "—"]


def test_direction(spark):
    got = evaluate(
        spark, [(0.04,), (0.06,), (-1.0,), (0.0,), (None,)], "x double",
        zone=labels.direction(F.col("x"), 0.05), plain=labels.direction(F.col("x")),
    )
    assert [(r.zone, r.plain) for r in got] == [("flat", "up"), ("up", "up"), ("down", "down"), ("flat", "flat"), (None, None)]


def test_overrides_first_match_wins(spark):
    p = resolve(
        [Override({"overage_score": 0.5}, segment="S", platform="P"), Override({"overage_score": 0.6}, segment="S")]
    )
    got = evaluate(
        spark, [("S", "P"), ("S", "Q"), ("T", "P"), (None, None)], "segment string, product_platform string", y=p.overage_score
    )
    assert [r.y for r in got] == [0.5, 0.6, 0.8, 0.8]
    with pytest.raises(ValueError, match="unknown parameter"):
        resolve([Override({"nonsense": 1.0})])
