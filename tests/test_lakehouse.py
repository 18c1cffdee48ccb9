import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.profiles import CLINICAL, COMMERCIAL, MANUFACTURING, ROBOTICS
from tidemark.sources.alignment import align_to_schema
from tidemark.sources.lakehouse import Lakehouse


def test_alignment_fills_casts_and_drops(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, extra string")
    target = spark.createDataFrame([], "b string, a bigint").schema
    out = align_to_schema(df, target)
    assert out.schema.simpleString() == "struct<b:string,a:bigint>"
    assert [tuple(r) for r in out.collect()] == [(None, 1), (None, 2)]


def test_lossy_cast_raises_unless_allowed(spark):
    df = spark.createDataFrame([(1.5,)], "a double")
    target = spark.createDataFrame([], "a int").schema
    with pytest.raises(Exception, match="lossy cast of a"):
        align_to_schema(df, target).collect()
    assert align_to_schema(df, target, lossless=False).first()[0] == 1
    whole = spark.createDataFrame([(2.0,), (None,)], "a double")
    assert [r[0] for r in align_to_schema(whole, target).collect()] == [2, None]


def test_append_counts_and_reads_back(spark, lake):
    house = lake(MANUFACTURING)
    batch = spark.range(10).select(F.lit("F").alias("facility_id"))
    assert house.append_product("bronze", "plc", batch, MANUFACTURING.schema) == 10
    assert house.append_product("bronze", "plc", batch, MANUFACTURING.schema) == 10
    back = house.read_product("bronze", "plc")
    assert back.count() == 20 and back.schema.names == MANUFACTURING.schema.names


def test_empty_append_returns_zero(spark, lake):
    house = lake(CLINICAL)
    empty = spark.createDataFrame([], CLINICAL.schema)
    assert house.append_product("bronze", "t", empty) == 0
    assert house.append_product("bronze", "t", empty.filter("1 = 0")) == 0
    assert house.overwrite_product("bronze", "t", empty) == 0
    assert house.read_product("bronze", "t").count() == 0


def test_missing_table_raises(lake):
    with pytest.raises(AnalysisException):
        lake(CLINICAL).read_product("gold", "nothing")


def test_existing_schema_wins_on_append_and_overwrite(spark, lake):
    house = lake(COMMERCIAL)
    house.append_product("gold", "t", spark.createDataFrame([(1, "x")], "a bigint, b string"))
    other = spark.createDataFrame([(2, 5.0)], "a int, c double")
    house.append_product("gold", "t", other)
    assert {tuple(r) for r in house.read_product("gold", "t").collect()} == {(1, "x"), (2, None)}
    house.overwrite_product("gold", "t", other)
    assert [tuple(r) for r in house.read_product("gold", "t").collect()] == [(2, None)]


def test_table_can_be_rebuilt_from_itself(spark, lake):
    house = lake(COMMERCIAL)
    house.append_product("gold", "t", spark.range(100))
    assert house.overwrite_product("gold", "t", house.read_product("gold", "t").filter("id < 7")) == 7
    assert house.read_product("gold", "t").count() == 7
    assert house.append_product("gold", "t", spark.range(3)) == 3
    assert house.read_product("gold", "t").count() == 10


def test_upsert_replaces_by_key(spark, lake):
    house = lake(COMMERCIAL)
    house.append_product("gold", "t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    fresh = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert house.upsert_product("gold", "t", fresh, "k") == 3
    got = {tuple(r) for r in house.read_product("gold", "t").collect()}
    assert got == {(1, "a"), (2, "B"), (3, "c")}
    versions = spark.createDataFrame([(1, "new", 2), (1, "old", 1), (9, "z", 1)], "k int, v string, n int")
    assert house.upsert_product("gold", "t", versions, "k", "n") == 4
    got = {tuple(r) for r in house.read_product("gold", "t").collect()}
    assert got == {(1, "new"), (2, "B"), (3, "c"), (9, "z")}


def test_publish_refuses_a_table_that_changed(spark, lake):
    from tidemark.sources.lakehouse import ConcurrentChangeError

    house = lake(COMMERCIAL)
    house.append_product("gold", "t", spark.range(5))
    staged = house.stage("gold", "t", house.read_product("gold", "t").filter("id < 2"))
    house.append_product("gold", "t", spark.range(100, 103))
    with pytest.raises(ConcurrentChangeError):
        house.publish(staged)
    assert house.read_product("gold", "t").count() == 8  # the append is still there
    first, second = (house.stage("gold", "t", spark.range(n)) for n in (1, 2))
    house.publish(first)
    with pytest.raises(ConcurrentChangeError):
        house.publish(second)
    made = house.stage("gold", "new", spark.range(4))
    house.append_product("gold", "new", spark.range(1))
    with pytest.raises(ConcurrentChangeError):
        house.publish(made)
    assert house.read_product("gold", "t").count() == 1 and house.read_product("gold", "new").count() == 1


def test_upsert_refuses_null_and_repeated_keys(spark, lake):
    house = lake(COMMERCIAL)
    kinds = "k int, v string, n int"
    house.append_product("gold", "t", spark.createDataFrame([(1, "a", 1)], kinds))
    for rows, version in (([(None, "x", 1)], None), ([(None, "x", 1)], "n"), ([(2, "x", 1), (2, "y", 2)], None)):
        with pytest.raises(ValueError, match="null or repeated"):
            house.upsert_product("gold", "t", spark.createDataFrame(rows, kinds), "k", version)
    assert [tuple(r) for r in house.read_product("gold", "t").collect()] == [(1, "a", 1)]


def test_losing_the_create_race_still_appends(spark, lake, monkeypatch):
    house = lake(COMMERCIAL)
    house.append_product("gold", "t", spark.range(2))
    real, calls = Lakehouse.exists, []

    def first_time_missing(self, tier, table):
        calls.append(table)
        return real(self, tier, table) if len(calls) > 2 else False

    monkeypatch.setattr(Lakehouse, "exists", first_time_missing)
    assert house.append_product("gold", "t", spark.range(3)) == 3
    assert house.read_product("gold", "t").count() == 5


def test_first_available_skips_empty_and_missing(spark, lake):
    house = lake(ROBOTICS)
    house.append_product("silver", "a", spark.createDataFrame([(None,)], "x int"))
    house.append_product("bronze", "b", spark.createDataFrame([(None,), (4,)], "x int"))
    wanted = [("silver", "none", "x"), ("silver", "a", "y"), ("silver", "a", "x"), ("bronze", "b", "x")]
    df, column = house.first_available(wanted)
    assert column == "x" and df.count() == 2
    assert house.first_available(wanted[:3]) is None


def test_export(spark, lake, tmp_path):
    house = lake(ROBOTICS)
    house.append_product("bronze", "b", spark.range(5))
    assert spark.read.parquet(house.export_parquet("bronze", "b", str(tmp_path / "drop"))).count() == 5


def test_stream_fed_table_refuses_batch_appends(spark, lake):
    house = lake(CLINICAL)
    house.create_stream_table("bronze", "feed", CLINICAL.schema)
    with pytest.raises(ValueError, match="fed by a stream"):
        house.append_product("bronze", "feed", spark.createDataFrame([], CLINICAL.schema))


def test_old_versions_can_be_removed(spark, lake):
    house = lake(COMMERCIAL)
    for n in (5, 6, 7):
        house.overwrite_product("gold", "t", spark.range(n))
    house.stage("gold", "t", spark.range(9))
    assert house.remove_old_versions("gold", "t") == 3
    assert house.remove_old_versions("gold", "t") == 0
    assert house.read_product("gold", "t").count() == 7


def test_scratch_belongs_to_the_application_and_can_be_cleared(spark, monkeypatch, tmp_path):
    from tidemark import session

    monkeypatch.setattr(session, "checkpoint_root", lambda s: str(tmp_path))
    other = tmp_path / "tidemark" / "another-app"
    other.mkdir(parents=True)
    kept = session.materialize(spark.range(3), "x")
    assert kept.count() == 3
    assert session.clear_scratch(spark) and other.exists()
    assert not session.clear_scratch(spark)


def test_checkpoint_folder_comes_from_the_session(spark):
    from tidemark import session

    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(named.rstrip("/") + "/tidemark/")
