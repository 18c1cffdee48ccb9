from tidemark.operators import quality


def _df(spark):
    return spark.createDataFrame(
        [("a", 1, "EU"), ("a", 2, "XX"), ("b", None, None), (None, 4, "NA"), (None, 4, "EU")],
        "k string, n int, Region string",
    )


def test_counts(spark):
    df = _df(spark)
    assert quality.test_not_null(df, "n").first()[0] == 1
    assert quality.test_not_null(df, "k").first()[0] == 2
    assert quality.test_accepted_values(df, "Region", ("EU", "NA")).first()[0] == 1
    assert quality.test_unique(df, "k").first()[0] == 1  # nulls are not judged
    assert quality.test_unique(df.limit(0), "k").first()[0] == 0
    assert quality.test_not_null(df.limit(0), "n").first()[0] in (0, None)


def test_report_is_one_pass_for_row_tests(spark):
    tests = quality.DataTests(
        not_null=("k", "n"), accepted={"Region": ("EU", "NA")}, unique=("k",)
    )
    report = quality.quality_report(_df(spark), tests)
    assert {tuple(r) for r in report.collect()} == {
        ("not_null:k", 2),
        ("not_null:n", 1),
        ("accepted:Region", 1),
        ("unique:k", 1),
    }
    assert quality.quality_report(_df(spark), quality.DataTests()).collect() == []


def test_forbidden_columns_ignore_case(spark):
    out = quality.test_no_sensitive_columns(_df(spark), ("region", "K", "email"))
    assert sorted(map(tuple, out.collect())) == [("Region",), ("k",)]
    assert quality.test_no_sensitive_columns(_df(spark), ("email",)).collect() == []


def test_contract(spark):
    want = spark.createDataFrame([], "n bigint, k string, z double").schema
    out = {tuple(r) for r in quality.check_contract(_df(spark), want).collect()}
    assert out == {
        ("n", "mismatched", "bigint", "int"),
        ("z", "missing", "double", None),
        ("Region", "extra", None, "string"),
    }
    same = spark.createDataFrame([], "Region string, n int, k string").schema
    assert quality.check_contract(_df(spark), same).collect() == []


def test_unique_text_is_told_apart_by_hash_first(spark):
    texts = [("a",), ("b",), ("a",), ("a",), (None,), (None,), ("",), ("",), ("c",)]
    df = spark.createDataFrame(texts, "v string")
    assert quality.test_unique(df, "v").first()["failing"] == 2
    assert quality.test_unique(df.limit(0), "v").first()["failing"] == 0
    alone = df.filter("v in ('b', 'c')")
    assert quality.test_unique(alone, "v").first()["failing"] == 0
    lists = spark.createDataFrame([([1, 2],), ([1, 2],), ([2, 1],)], "v array<int>")
    assert quality.test_unique(lists, "v").first()["failing"] == 1


def test_unique_with_all_hashes_shared(spark, monkeypatch):
    """Values that only share a hash are no repeats."""
    monkeypatch.setattr(quality.F, "xxhash64", lambda column: quality.F.lit(7).cast("bigint"))
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "v string")
    assert quality.test_unique(df, "v").first()["failing"] == 1
