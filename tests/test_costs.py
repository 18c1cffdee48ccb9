import json

import pytest

from tidemark.operators import costs
from tidemark.sources.run_results import parse_run_results, read_run_results

RUN = {
    "metadata": {"x": 1},
    "results": [
        {"unique_id": "model.a", "status": "success", "execution_time": 1.25, "other": [1]},
        {"unique_id": "model.b", "status": "success", "execution_time": 7.5},
        {"status": None, "execution_time": None},
    ],
}


def test_costs_from_files(spark, tmp_path):
    (tmp_path / "run1.json").write_text(json.dumps(RUN, indent=2))
    (tmp_path / "run2.json").write_text(json.dumps({"results": []}))
    results = read_run_results(spark, str(tmp_path), "CLINICAL")
    rows = costs.sort_by_cost(costs.cost_attribution(results, 0.4), "file", "position").collect()
    assert [(r.node, r.status, r.execution_time_s, r.estimated_cost_usd) for r in rows] == [
        ("model.b", "success", 7.5, 3.0),
        ("model.a", "success", 1.25, 0.5),
        ("?", "?", 0.0, 0.0),
    ]
    assert {r.data_product for r in rows} == {"CLINICAL"}
    assert costs.total_cost(costs.cost_attribution(results, 0.4)).first()[0] == 3.5


def test_missing_artifact_gives_no_rows(spark, tmp_path):
    results = read_run_results(spark, str(tmp_path / "none.json"), "CLINICAL")
    assert results.collect() == []
    assert costs.total_cost(costs.cost_attribution(results)).first()[0] == 0.0


def test_cost_uses_unrounded_seconds_and_stable_order(spark):
    rows = [("p", 0, "a", "ok", 1.00005), ("p", 1, "b", "ok", 1.00004), ("p", 2, "c", "ok", 1.00004)]
    df = spark.createDataFrame(
        rows, "data_product string, position int, unique_id string, status string, execution_time double"
    )
    out = costs.sort_by_cost(costs.cost_attribution(df, 1000.0), "position").collect()
    assert [r.node for r in out] == ["a", "b", "c"]
    assert [r.estimated_cost_usd for r in out] == [1000.05, 1000.04, 1000.04]


def test_parse_documents_in_a_column(spark):
    df = spark.createDataFrame([("k", json.dumps(RUN))], "data_product string, doc string")
    out = parse_run_results(df, "doc").collect()
    assert [(r.data_product, r.position, r.unique_id) for r in out] == [
        ("k", 0, "model.a"), ("k", 1, "model.b"), ("k", 2, None),
    ]


def test_cut_off_documents_fail(spark, tmp_path):
    df = spark.createDataFrame([("k", json.dumps(RUN)), ("bad", "{")], "data_product string, doc string")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        parse_run_results(df, "doc").collect()
    (tmp_path / "run.json").write_text(json.dumps(RUN)[:-4])
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_run_results(spark, str(tmp_path), "p").collect()
