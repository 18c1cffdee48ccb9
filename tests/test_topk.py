import numpy as np
import pandas as pd
import pytest

from tidemark.operators.topk import vector_topk


def _corpus(rng, n, dim):
    vectors = rng.normal(size=(n, dim)).astype(np.float32)
    vectors[: n // 3] = vectors[0]  # a third are copies of one vector
    vectors[-1] = 0
    return pd.DataFrame(
        {"id": [f"c{i:05d}" for i in rng.permutation(n)], "embedding": list(vectors), "tag": rng.choice(["x", "y", "z"], n)}
    )


def _brute(queries, corpus, k):
    out = {}
    c = np.stack(corpus["embedding"]).astype(float)
    for q in queries.itertuples():
        v = np.asarray(q.embedding, float)
        norms = np.linalg.norm(c, axis=1) * np.linalg.norm(v)
        score = np.divide(c @ v, norms, out=np.zeros(len(c)), where=norms > 0)
        keep = np.ones(len(c), bool) if q.only is None else (corpus["tag"] == q.only).to_numpy()
        found = pd.DataFrame({"id": corpus["id"][keep], "s": np.round(score[keep], 10)})
        out[q.query_id] = list(found.sort_values(["s", "id"], ascending=[False, True])["id"][:k])
    return out


@pytest.mark.parametrize("block, k", [(1024, 5), (3, 5), (1024, 1), (1024, 2000)])
def test_equals_brute_force(spark, block, k):
    rng = np.random.default_rng(7)
    corpus = _corpus(rng, 900, 16)
    queries = pd.DataFrame(
        {"query_id": range(8), "embedding": list(rng.normal(size=(8, 16)).astype(np.float32)),
         "only": ["x", None, "y", None, "nothing", None, "z", "x"]}
    )
    queries.at[1, "embedding"] = corpus["embedding"][0]  # ties with all copies
    q = spark.createDataFrame(queries, "query_id bigint, embedding array<float>, only string")
    c = spark.createDataFrame(corpus, "id string, embedding array<float>, tag string").repartition(5)
    out = vector_topk(q, c, k, where={"tag": ("only", "tag")}, block=block).toPandas()
    want = _brute(queries, corpus, k)
    for i in range(8):
        got = out[out.query_id == i].sort_values("rank")
        assert list(got["id"]) == want[i], i
        assert list(got["rank"]) == list(range(1, len(got) + 1))


def test_odd_inputs(spark):
    schema = "id bigint, embedding array<float>"
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [0.0, 2.0])], schema)
    q = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None)], "query_id string, embedding array<float>")
    out = vector_topk(q, corpus, 5).orderBy("rank").collect()
    assert [(r.query_id, r.id, r.score) for r in out] == [("q", 1, 1.0), ("q", 3, 0.0), ("q", 4, 0.0)]
    assert vector_topk(q.limit(0), corpus).collect() == []
    assert vector_topk(q, corpus.limit(0)).collect() == []
    with pytest.raises(Exception, match="dimensions"):
        vector_topk(q, spark.createDataFrame([(1, [1.0])], schema)).collect()


def test_whole_number_scores_do_not_depend_on_batches(spark):
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 3, (500, 256)).astype(np.float32)
    corpus = spark.createDataFrame(
        pd.DataFrame({"id": range(500), "embedding": list(counts)}), "id bigint, embedding array<float>"
    )
    q = spark.createDataFrame(
        pd.DataFrame({"query_id": range(4), "embedding": list(counts[:4])}),
        "query_id bigint, embedding array<float>",
    )
    one = vector_topk(q, corpus.coalesce(1), 9).orderBy("query_id", "rank").collect()
    many = vector_topk(q, corpus.repartition(9), 9).orderBy("query_id", "rank").collect()
    assert one == many


def test_many_queries_scan_the_corpus_once(spark, monkeypatch, tmp_path):
    """5,000 queries in blocks of 700, chunks of some rows: one scan, the same answers."""
    monkeypatch.setattr("tidemark.operators.topk.CHUNK_BYTES", 4_000)
    rng = np.random.default_rng(9)
    corpus = _corpus(rng, 300, 8)
    queries = pd.DataFrame(
        {"query_id": range(5000), "embedding": list(rng.normal(size=(5000, 8)).astype(np.float32)),
         "only": rng.choice(["x", "y", None], 5000)}
    )
    spark.createDataFrame(corpus, "id string, embedding array<float>, tag string").write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    q = spark.createDataFrame(queries, "query_id bigint, embedding array<float>, only string").repartition(7)
    found = vector_topk(q, c, 3, where={"tag": ("only", "tag")}, block=700)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    out = found.toPandas().sort_values(["query_id", "rank"]).groupby("query_id")["id"].agg(list)
    assert out.to_dict() == _brute(queries, corpus, 3)


def test_terms_asked_for_reach_the_scan(spark, tmp_path):
    rows = [(i, [float(i), 1.0], "abcdef"[i % 6]) for i in range(60)]
    spark.createDataFrame(rows, "id bigint, embedding array<float>, tag string").write.parquet(str(tmp_path / "c"))
    q = spark.createDataFrame([(1, [1.0, 0.0], "b"), (2, [1.0, 0.0], "d")], "query_id bigint, embedding array<float>, only string")
    found = vector_topk(q, spark.read.parquet(str(tmp_path / "c")), 1, where={"tag": ("only", "tag")})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tag,b)" in plan and "LessThanOrEqual(tag,d)" in plan
    assert sorted((r.query_id, r.id) for r in found.collect()) == [(1, 55), (2, 57)]


def test_a_task_gives_out_its_best_only(spark, monkeypatch):
    """Many chunks a task, yet at most k rows per query and task, or per flush of what is kept."""
    from tidemark.operators import topk

    monkeypatch.setattr(topk, "CHUNK_BYTES", 2_000)
    rng = np.random.default_rng(10)
    corpus, queries = _corpus(rng, 400, 8), _corpus(rng, 30, 8)
    c = spark.createDataFrame(corpus, "id string, embedding array<float>, tag string").coalesce(2)
    q = spark.createDataFrame(queries, "id string, embedding array<float>, tag string").withColumnRenamed("id", "query_id")
    merge, given = topk._merge, []

    def counted(found, k):
        given.append(found.count())
        return merge(found, k)

    monkeypatch.setattr(topk, "_merge", counted)
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        best = vector_topk(q, c, 3, block=7).collect()
        assert len(best) == 90 and given[0] <= 2 * 30 * 3
        monkeypatch.setattr(topk, "KEPT_BYTES", 100)
        assert sorted(vector_topk(q, c, 3, block=7).collect()) == sorted(best) and given[1] > given[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
