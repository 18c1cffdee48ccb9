import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tidemark.functions.masking import InsecureSaltError, MaskingKey, assert_salt
from tidemark.operators import governance
from tidemark.profiles import COMMERCIAL, PROFILES


def token(salt, text, length=16):
    digest = hmac.new(salt.encode(), text.encode(), hashlib.sha256).hexdigest()
    return "masked_sha256:" + digest[:length]


@pytest.mark.parametrize(
    "salt",
    ["", "   ", "replace-me", "replace-with-a-long-secret-value", "changeme", "short",
     "local-dev-placeholder", "please-change-me-in-production", "some-local-dev-salt-value"],
)
def test_bad_salts_fail_closed(spark, salt):
    with pytest.raises(InsecureSaltError):
        assert_salt(salt)
    with pytest.raises(InsecureSaltError):
        MaskingKey(spark, salt)


def test_salt_from_environment(monkeypatch, salt):
    monkeypatch.delenv("TIDEMARK_MASKING_SALT", raising=False)
    with pytest.raises(InsecureSaltError):
        assert_salt()
    monkeypatch.setenv("TIDEMARK_MASKING_SALT", f" {salt} ")
    assert assert_salt() == salt


@pytest.mark.parametrize("salt", ["unit-test-salt-1234567890", "x" * 64, "ä" * 50])
def test_tokens_equal_standard_hmac(spark, salt):
    texts = ["line-42", "line-43", "naïve Ünï ☃", "a" * 300, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    key = MaskingKey(spark, salt)
    got = [r[0] for r in df.select(key.mask(F.col("t"))).collect()]
    assert got == [token(salt, t) if t else t for t in texts]
    full = [r[0] for r in df.select(key.mask(F.col("t"), length=64)).collect()]
    assert full[0] == token(salt, "line-42", 64)


def test_role_unmasks_only_when_named(spark, key, salt):
    df = spark.createDataFrame([("classified",)], "t string")

    def read(**kw):
        return df.select(key.mask(F.col("t"), **kw)).first()[0]

    assert read(role="SECURITY_OPERATIONS", unmask_role="SECURITY_OPERATIONS") == "classified"
    assert read(role="ML_RESEARCHER", unmask_role="SECURITY_OPERATIONS") == token(salt, "classified")
    assert read(role=None, unmask_role=None) == token(salt, "classified")


def test_salt_stays_out_of_plans_and_event_log(spark, key, salt):
    from tidemark.functions.masking import key_pads

    df = spark.createDataFrame([("x",)], "t string").select(key.mask(F.col("t")).alias("m"))
    df.collect()
    execution = df._jdf.queryExecution()
    text = execution.toString() + execution.executedPlan().toString()
    logs = [p for p in spark.event_log_folder.rglob("*") if p.is_file() and "local-" in str(p)]
    assert logs
    log = b"".join(p.read_bytes() for p in logs)
    for secret in (salt.encode(), *key_pads(salt)):
        for shown in (secret, secret.hex().encode(), secret.hex().upper().encode()):
            assert shown not in text.encode() and shown not in log


def test_mask_sensitive_keeps_columns(spark, key):
    for profile in PROFILES.values():
        df = spark.createDataFrame([], profile.schema)
        assert governance.mask_sensitive(df, profile, key).columns == df.columns


def test_masked_join_equals_plain_join(spark, key):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "k string, l int")
    right = spark.createDataFrame([("a", 10), ("c", 30)], "k string, r int")
    plain = sorted((r.l, r.r) for r in left.join(right, "k").collect())
    masked = governance.masked_join(
        left.withColumn("k", key.mask(F.col("k"))), right.withColumn("k", key.mask(F.col("k"))), "k"
    )
    assert sorted((r.l, r.r) for r in masked.collect()) == plain


def _accounts(spark):
    return spark.createDataFrame(
        [(None, "c1", "PRO", "EU", 1.0, 2, False)], COMMERCIAL.schema
    )


def test_secure_view_hmac(spark, key, salt):
    df = _accounts(spark)
    seen = governance.secure_view(df, COMMERCIAL, "ML_RESEARCHER", "hmac", key).first()
    assert seen.customer_id_hashed == token(salt, "c1", 64).removeprefix("masked_sha256:")
    for role in ("DATA_GOVERNANCE_ADMIN", "SECURITY_OPERATIONS"):
        assert governance.secure_view(df, COMMERCIAL, role, "hmac").first().customer_id_hashed == "c1"


def test_secure_view_null(spark):
    df = _accounts(spark)

    def rows(*groups):
        return governance.secure_view(df, COMMERCIAL, groups, "null").collect()

    assert rows("security_operations")[0].customer_id_hashed == "c1"
    assert [r.customer_id_hashed for r in rows("data_governance_admins")] == [None]
    assert rows("ml_researcher") == []


def test_secure_view_deny(spark):
    df = _accounts(spark)
    assert "customer_id_hashed" not in governance.secure_view(df, COMMERCIAL, "X", "deny").columns
    with pytest.raises(ValueError):
        governance.secure_view(df, COMMERCIAL, "X", "other")
