from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.embedding import hashed_words
from tidemark.operators import retrieval
from tidemark.plans import assistant
from tidemark.profiles import COMMERCIAL
from tidemark.streaming.index_feed import stream_index


def _rows(spark, first, last, tier="PRO"):
    return spark.range(first, last).select(
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id_hashed"),
        F.lit(tier).alias("plan_tier"),
        F.lit("EU").alias("region"),
        (F.col("id") / 8).cast("float").alias("monthly_revenue"),
        F.lit(3).alias("tenure_months"),
        F.lit(None).cast("boolean").alias("churned_flag"),
    )


def _append(lake, rows):
    lake.append_product("bronze", COMMERCIAL.bronze_table, rows, COMMERCIAL.schema)


def _ids(lake):
    return Counter(r["id"] for r in lake.read_product("index", COMMERCIAL.index_name).select("id").collect())


def _expected(lake):
    bronze = lake.read_product("bronze", COMMERCIAL.bronze_table)
    return Counter(r["id"] for r in retrieval.build_chunks(bronze, COMMERCIAL).select("id").collect())


def _run(lake, checkpoint, **options):
    query = stream_index(lake, checkpoint, **options)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_only_new_files_are_read_and_copies_count_on(spark, lake, tmp_path):
    own, checkpoint = lake(COMMERCIAL), str(tmp_path / "checkpoint")
    _append(own, _rows(spark, 0, 40))
    assert _run(own, checkpoint) > 0
    assert _ids(own) == _expected(own)
    before = own._content("index", COMMERCIAL.index_name)
    assert _run(own, checkpoint) == 0
    assert own._content("index", COMMERCIAL.index_name) == before
    # Rows known already, twice in one batch, and a new one.
    _append(own, _rows(spark, 10, 12).unionByName(_rows(spark, 10, 12)).unionByName(_rows(spark, 90, 91)))
    _run(own, checkpoint)
    _append(own, _rows(spark, 10, 11))
    _run(own, checkpoint)
    ids = _ids(own)
    assert ids == _expected(own) and max(ids.values()) == 1 and len(ids) == 46
    assert sum(i.endswith("-4") for i in ids) == 1


def test_several_small_batches(spark, lake, tmp_path):
    own = lake(COMMERCIAL)
    for start in range(0, 50, 10):
        _append(own, _rows(spark, start, start + 15))
    _run(own, str(tmp_path / "checkpoint"), files=1)
    assert _ids(own) == _expected(own)


def test_a_batch_broken_after_its_append_adds_nothing_twice(spark, lake, tmp_path, monkeypatch):
    own, checkpoint = lake(COMMERCIAL), str(tmp_path / "checkpoint")
    _append(own, _rows(spark, 0, 10))
    _run(own, checkpoint)
    _append(own, _rows(spark, 5, 12).unionByName(_rows(spark, 5, 6)))
    mark = own.set_table_property

    def broken(tier, table, key, value):
        if key.endswith(".done"):
            raise RuntimeError("the driver is gone")
        mark(tier, table, key, value)

    monkeypatch.setattr(own, "set_table_property", broken)
    with pytest.raises(Exception, match="driver is gone"):
        _run(own, checkpoint)
    monkeypatch.setattr(own, "set_table_property", mark)
    assert sum(_ids(own).values()) == 18
    _run(own, checkpoint)
    assert _ids(own) == _expected(own)


def test_a_batch_broken_before_its_append(spark, lake, tmp_path, monkeypatch):
    own, checkpoint = lake(COMMERCIAL), str(tmp_path / "checkpoint")
    _append(own, _rows(spark, 0, 10))
    append = own.append_product

    def broken(tier, table, df, schema=None):
        if own.exists(tier, table):
            raise RuntimeError("no space")
        return append(tier, table, df, schema)

    monkeypatch.setattr(own, "append_product", broken)
    with pytest.raises(Exception, match="no space"):
        _run(own, checkpoint)
    monkeypatch.setattr(own, "append_product", append)
    _run(own, checkpoint)
    assert _ids(own) == _expected(own)


def test_feed_and_batch_do_not_mix(spark, lake, tmp_path):
    fed, built = lake(COMMERCIAL), lake(COMMERCIAL)
    for own in (fed, built):
        _append(own, _rows(spark, 0, 4))
    _run(fed, str(tmp_path / "one"))
    with pytest.raises(ValueError, match="fed by a stream"):
        assistant.build_index(fed)
    with pytest.raises(Exception, match="filled in another way"):
        _run(fed, str(tmp_path / "another"))
    assistant.build_index(built)
    with pytest.raises(Exception, match="filled in another way"):
        _run(built, str(tmp_path / "two"))
    with pytest.raises(assistant.ModelMismatchError):
        stream_index(fed, str(tmp_path / "one"), hashed_words(64))


def test_rewritten_bronze_is_refused(spark, lake, tmp_path):
    own, checkpoint = lake(COMMERCIAL), str(tmp_path / "checkpoint")
    _append(own, _rows(spark, 0, 4))
    _run(own, checkpoint)
    own.overwrite_product("bronze", COMMERCIAL.bronze_table, _rows(spark, 0, 2))
    with pytest.raises(ValueError, match="rewritten"):
        stream_index(own, checkpoint)


def test_empty_bronze(spark, lake, tmp_path):
    own = lake(COMMERCIAL)
    _append(own, _rows(spark, 0, 0))
    _run(own, str(tmp_path / "checkpoint"))
    _append(own, _rows(spark, 0, 3))
    _run(own, str(tmp_path / "checkpoint"))
    assert _ids(own) == _expected(own)
