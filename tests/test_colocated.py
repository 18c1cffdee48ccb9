from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.colocated import join_stored, store_for_join
from tidemark.profiles import COMMERCIAL


@pytest.fixture
def sides(spark):
    """A hot value on the left, another on the right, one on both, nulls, and values without a partner."""
    left = [("hot", i) for i in range(300)] + [("both", i) for i in range(90)] + [(None, i) for i in range(200)]
    left += [(f"k{i % 20}", i) for i in range(60)] + [("right", 1), ("right", 1), ("lonely", 7)]
    right = [("hot", "x"), ("hot", "x"), ("both", "y"), (None, "n")] + [("right", str(i)) for i in range(250)]
    right += [("both", str(i)) for i in range(70)] + [(f"k{i}", str(i)) for i in range(5, 25)]
    return spark.createDataFrame(left, "id string, a int"), spark.createDataFrame(right, "id string, b string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_the_plain_join(spark, lake, sides, how):
    left, right = sides
    own = lake(COMMERCIAL)
    stored = store_for_join(own, "gold", how, left, right, "id", buckets=4, how=how, slice_rows=25)
    joined = join_stored(own, stored)
    plain = left.join(right, "id", how)
    assert joined.columns == plain.columns
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def test_no_row_moves(lake, sides, capsys):
    left, right = sides
    own = lake(COMMERCIAL)
    stored = store_for_join(own, "gold", "pair", left, right, "id", buckets=4, slice_rows=25)
    joined = join_stored(own, stored)
    joined.count()
    joined.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_hot_values_are_dealt_out(lake, sides):
    left, right = sides
    own = lake(COMMERCIAL)
    stored = store_for_join(own, "gold", "pair", left, right, "id", buckets=4, how="left", slice_rows=25)
    slices = own.read_product("gold", stored.left).groupBy("id", "_slice").count()
    most = {r["id"]: (r["n"], r["most"]) for r in slices.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).collect()}
    assert most["hot"][0] == 12 and most["hot"][1] < 50
    assert most[None][0] == 8 and most["lonely"] == (1, 1)
    # The partner's rows are stored once per slice, all others once.
    copies = {r["id"]: r["count"] for r in own.read_product("gold", stored.right).groupBy("id").count().collect()}
    assert copies["hot"] == 24 and copies["right"] == 250 and None not in copies


def test_without_hot_values_and_without_rows(spark, lake, sides):
    left, right = sides
    own = lake(COMMERCIAL)
    stored = store_for_join(own, "gold", "plain", left, right, "id", buckets=2)
    assert own.read_product("gold", stored.right).count() == right.filter("id IS NOT NULL").count()
    assert join_stored(own, stored).count() == left.join(right, "id").count()
    empty = store_for_join(own, "gold", "empty", left.limit(0), right, "id", buckets=2)
    assert join_stored(own, empty).isEmpty()
    with pytest.raises(ValueError, match="full"):
        store_for_join(own, "gold", "no", left, right, "id", buckets=2, how="full")
