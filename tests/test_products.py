import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold, quality, silver
from tidemark.plans import medallion
from tidemark.plans.products import PRODUCT_LINES
from tidemark.profiles import CLINICAL, COMMERCIAL, HEALTH_TECH, MANUFACTURING, PROFILES, ROBOTICS

T0 = datetime(2026, 1, 1)
NAN = float("nan")


def frame(spark, profile, rows):
    stamped = [(T0 + timedelta(milliseconds=20 * i), *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(stamped, profile.schema)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", list(PROFILES))
def test_built_schemas_equal_contracts(spark, name):
    line = PRODUCT_LINES[name]
    made = line.silver.build(spark.createDataFrame([], line.profile.schema))
    assert quality.contract_violations(made.schema, line.silver.contract) == []
    rolled = line.gold.build(made)
    assert quality.contract_violations(rolled.schema, line.gold.contract) == []
    assert quality.forbidden_columns(rolled, line.gold.tests.forbidden) == []


def test_robotics(spark):
    df = frame(
        spark,
        ROBOTICS,
        [
            ("r1", "Apollo-1", [0.5, 2.0, -1.0], "u", "NO_FAILURE", True),
            ("r1", "Apollo-1", [], "u", "GRASP_FAIL", False),
            ("r2", "Apollo-1", None, "u", None, None),
            ("r2", "Atlas-Next", [None, 1.0, NAN], "u", "NO_FAILURE", True),
            (None, "Atlas-Next", [9.0], "u", "NO_FAILURE", True),
            ("r3", None, [1.5], "u", "NO_FAILURE", True),
        ],
    )
    made = silver.silver_robot_signals(df)
    peaks = [r.peak_joint_pos for r in made.orderBy("timestamp").collect()]
    assert peaks[:3] == [2.0, None, None] and math.isnan(peaks[3]) and peaks[4] == 1.5
    # null flag: in the base of the rate, in neither count; null key sorted last
    assert rows(gold.gold_robot_health(made)) == [
        ("Apollo-1", 3, 1, 1, 0.333),
        ("Atlas-Next", 1, 1, 0, 1.0),
        (None, 1, 1, 0, 1.0),
    ]


def test_manufacturing_bounds_are_strict(spark):
    cases = [
        (12.0, 95.0, 9.5, False),
        (16.0, 95.0, 9.5, False),
        (11.9, 70.0, 6.0, True),
        (16.1, 70.0, 6.0, True),
        (14.0, 95.1, 6.0, True),
        (14.0, 70.0, 9.6, True),
        (NAN, 70.0, 6.0, True),
        (None, 96.0, 6.0, True),
        (None, 70.0, 6.0, None),
    ]
    df = frame(spark, MANUFACTURING, [("Texas_Giga_01", "r", v, t, p, True) for v, t, p, _ in cases])
    made = silver.silver_plc_registers(df).orderBy("timestamp")
    assert [r.sla_breach for r in made.collect()] == [c[3] for c in cases]


def test_manufacturing_rollup(spark):
    df = frame(
        spark,
        MANUFACTURING,
        [
            ("Texas_Giga_01", "r", 14.0, 70.0, 6.0, False),
            ("Texas_Giga_01", "r", 17.0, 71.0, 6.5, True),
            ("Texas_Giga_01", "r", None, 71.0, 6.5, None),
            (None, "r", 1.0, 1.0, 1.0, True),
        ],
    )
    assert rows(gold.gold_facility_health(silver.silver_plc_registers(df))) == [
        ("Texas_Giga_01", 3, 15.5, 70.667, 6.333, 1, 1)
    ]


def test_health_outliers_are_nulled_not_dropped(spark):
    hrv = [4, 5, 200, 201, None, 34, 35]
    sleep = [-0.01, 0.0, 1.0, 1.01, None, 0.5, NAN]
    df = frame(spark, HEALTH_TECH, [("p%d" % (i % 2), h, s, "EU") for i, (h, s) in enumerate(zip(hrv, sleep))])
    made = silver.silver_wearable_biometrics(df).orderBy("timestamp").collect()
    assert [r.heart_rate_variability for r in made] == [None, 5, 200, None, None, 34, 35]
    assert [r.sleep_efficiency for r in made] == [None, 0.0, 1.0, None, None, 0.5, None]
    out = rows(gold.gold_cohort_summary(silver.silver_wearable_biometrics(df)))
    assert out == [("EU", 2, 68.5, 0.5, 2)]


def test_commercial(spark):
    df = frame(
        spark,
        COMMERCIAL,
        [
            ("c1", "PRO", "EU", 99.99, 3, True),
            ("c1", "PRO", "EU", 100.01, 2, None),
            ("c2", "FREE", "NA", 0.0, 12, False),
            (None, "FREE", "NA", 5.0, 1, True),
        ],
    )
    made = silver.silver_subscription_events(df)
    assert made.schema["lifetime_value"].dataType.simpleString() == "float"
    assert [round(r[0], 2) for r in made.select("lifetime_value").collect()] == [299.97, 200.02, 0.0]
    # two events of one account count twice
    assert rows(gold.gold_account_health(made)) == [
        ("FREE", 1, 0.0, 0.0, 0, 0.0),
        ("PRO", 2, 100.0, 250.0, 1, 0.5),
    ]


def test_clinical_keeps_only_declared_columns(spark):
    df = frame(
        spark,
        CLINICAL,
        [
            ("p1", "ONC-204", "18-29", "EU", True),
            ("p1", "ONC-204", "18-29", "EU", False),
            ("p2", "ONC-204", "66+", "NA", None),
            (None, "ONC-204", "66+", "NA", True),
        ],
    ).withColumn("full_name", F.lit("someone"))
    made = silver.silver_ecrf_observations(df)
    assert made.columns == CLINICAL.schema.names
    assert rows(gold.gold_study_safety(made)) == [("ONC-204", 2, 3, 1, 0.3333)]


def _raw(spark, n=24):
    return frame(
        spark,
        COMMERCIAL,
        [(f"CUST-{i % 5}", ("FREE", "PRO", "ENTERPRISE")[i % 3], "EU", float(i), i + 1, i % 4 == 0) for i in range(n)],
    )


def test_enforce_publishes_both_tiers(spark, lake, salt):
    house = lake(COMMERCIAL)
    assert medallion.ingest(house, _raw(spark), salt) == 24
    expected = {"silver.silver_subscription_events": 24, "gold.gold_account_health": 3}
    assert medallion.enforce(house, salt) == expected
    assert medallion.enforce(house, salt) == expected
    made = house.read_product("silver", "silver_subscription_events")
    assert made.filter(~F.col("customer_id_hashed").startswith("masked_sha256:")).count() == 0
    assert house.read_product("gold", "gold_account_health").count() == 3


def test_failing_test_stops_before_publishing(spark, lake, salt):
    house = lake(COMMERCIAL)
    medallion.ingest(house, _raw(spark), salt)
    medallion.enforce(house, salt)
    bad = _raw(spark, 6).withColumn("plan_tier", F.lit("GRATIS"))
    medallion.ingest(house, bad, salt)
    with pytest.raises(quality.QualityError, match="accepted:plan_tier': 6"):
        medallion.enforce(house, salt)
    assert house.read_product("silver", "silver_subscription_events").count() == 24
    assert house.read_product("gold", "gold_account_health").count() == 3


def test_null_breach_flag_fails_the_build(spark, lake, salt):
    house = lake(MANUFACTURING)
    medallion.ingest(house, frame(spark, MANUFACTURING, [("Texas_Giga_01", "r", None, 70.0, 6.0, True)]), salt)
    with pytest.raises(quality.QualityError, match="not_null:sla_breach"):
        medallion.enforce(house, salt)


def test_enforce_needs_a_salt(spark, lake, monkeypatch):
    from tidemark.functions.masking import InsecureSaltError

    monkeypatch.delenv("TIDEMARK_MASKING_SALT", raising=False)
    with pytest.raises(InsecureSaltError):
        medallion.enforce(lake(COMMERCIAL))


def test_contract_and_forbidden_columns_stop_the_build(spark, lake):
    from dataclasses import replace

    house, line = lake(MANUFACTURING), PRODUCT_LINES["MANUFACTURING"]
    source = frame(spark, MANUFACTURING, [("Texas_Giga_01", "r", 14.0, 70.0, 6.0, True)])
    wide = replace(line.silver, build=lambda df: line.silver.build(df).withColumn("x", F.lit(1)))
    with pytest.raises(quality.ContractError, match="extra"):
        medallion.build_product(house, wide, source)
    leaky = replace(
        line.silver, tests=replace(line.silver.tests, forbidden=("REGISTER_id",))
    )
    with pytest.raises(quality.QualityError, match="register_id"):
        medallion.build_product(house, leaky, source)
    double_key = replace(line.gold, build=lambda df: line.gold.build(df).union(line.gold.build(df)))
    with pytest.raises(quality.QualityError, match="unique:facility_id"):
        medallion.build_product(house, double_key, line.silver.build(source))
