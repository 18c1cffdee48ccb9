"""The plans are the ones meant: pruned scans, few shuffles, no pairing of rows."""

import os
import re

import pytest

import __spark_entry__ as entry_point

FOLDER = os.environ.get("TIDEMARK_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

SILVER = [n for n in entry_point.queries() if n.startswith("silver_")]
GOLD = [n for n in entry_point.queries() if n.startswith("gold_")]


def plan(spark, name):
    df = entry_point.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SILVER + ["mask_sensitive", "score_episodes"])
def test_row_work_needs_no_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_chunks_move_no_rows_where_none_repeats(spark):
    assert "Exchange" not in plan(spark, "build_chunks")


def test_few_repeated_chunks_leave_the_others_in_place(spark):
    from checks import queries
    from tidemark.operators import retrieval
    from tidemark.profiles import COMMERCIAL

    rows = queries._raw_accounts(spark, FOLDER)
    twice = rows.unionByName(rows.limit(3))
    text = retrieval.build_chunks(twice, COMMERCIAL)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", GOLD + ["retrieve", "vector_topk", "signal_downsample", "idle_frames",
                                         "frame_history", "masked_join", "write_training_shards"])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", GOLD)
def test_rollups_aggregate_before_the_shuffle(spark, name):
    assert "partial_count" in plan(spark, name)


def test_scans_read_only_what_is_needed(spark):
    text = plan(spark, "gold_account_health")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
    }
    # the id is only tested for null, so nothing is hashed
    assert "sha2" not in text
    assert "l_orderkey" not in re.search(r"ReadSchema: \S+", plan(spark, "gold_facility_health")).group(0)


def test_top_rows_are_cut_before_the_shuffle(spark):
    text = plan(spark, "retrieve")
    assert "WindowGroupLimit" in text and re.search(r"WindowGroupLimit.*Partial", text)


def test_conditions_reach_the_scan(spark):
    from tidemark.operators.silver import drop_null_identifier
    from tidemark.sources import star_tables

    df = drop_null_identifier(star_tables.table(spark, FOLDER, "customer"), "c_name").filter("c_acctbal > 0")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(c_name)" in text and "GreaterThan(c_acctbal,0.0)" in text
