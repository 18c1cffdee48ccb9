import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import vector_index
from tidemark.operators.topk import vector_topk

KINDS = "id bigint, embedding array<float>, kind string"


@pytest.fixture(scope="module")
def corpus(spark):
    """Forty clusters, with copies, zero vectors and rows without a vector."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 12))
    vectors = centers[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 12))
    vectors[rng.random(3000) < 0.2] = vectors[0]
    vectors[[5, 17, 900]] = 0
    rows = [(i, [float(x) for x in v], "abc"[i % 3]) for i, v in enumerate(vectors)] + [(5000, None, "a")]
    return spark.createDataFrame(rows, KINDS).repartition(5).cache()


def _queries(corpus):
    return corpus.where("id % 60 = 5").select(
        F.col("id").alias("query_id"), "embedding", F.when(F.col("id") % 2 == 0, F.col("kind")).alias("only")
    )


def _rows(found):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in found.collect())


@pytest.mark.parametrize("part, block, probes", [(65_536, 4096, 4), (50, 7, 1)])
def test_exact_search_equals_the_full_scan(spark, corpus, monkeypatch, part, block, probes):
    monkeypatch.setattr(vector_index, "PART", part)
    monkeypatch.setattr(vector_index, "BLOCK", block)
    index = vector_index.build(corpus, fields={"kind": "kind"}, lists=30)
    found = vector_index.search(index, _queries(corpus), 5, where={"kind": "only"}, probes=probes)
    want = vector_topk(_queries(corpus), corpus, 5, where={"kind": ("only", "kind")})
    assert _rows(found) == _rows(want)


def test_few_lists_are_read_and_recall_is_high(spark, corpus):
    index = vector_index.build(corpus, lists=30)
    queries = _queries(corpus).where("query_id <> 5 and query_id <> 905")
    near = vector_index.search(index, queries, 5, probes=2, exact=False)
    want = {(q, i) for q, _, i, _ in _rows(vector_topk(queries, corpus, 5))}
    got = {(q, i) for q, _, i, _ in _rows(near)}
    assert len(got & want) >= 0.9 * len(want)
    one = queries.limit(1)
    lists = [r.list for r in one.select("query_id", F.col("embedding").cast("array<double>").alias("vector"), F.lit(None).cast("double").alias("bar"))
             .mapInArrow(vector_index._asked(index, 0, 2), "query_id bigint, vector array<double>, list int").collect()]
    plan = index.rows(spark).where(F.col("list").isin(lists))._jdf.queryExecution().executedPlan().toString()
    assert len(lists) == 2 and "PartitionFilters: [" in plan and "list#" in plan.split("PartitionFilters: [")[1][:40]


def test_every_row_is_in_the_index_and_angles_hold_it(spark, corpus):
    index = vector_index.build(corpus, lists=30)
    rows = index.rows(spark).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    assert {r.id for r in rows if r.list == len(index.centers.vectors)} >= {5, 17, 900}
    for r in rows[::50]:
        if r.list < len(index.centers.vectors):
            unit = np.array(r.vector) / np.linalg.norm(r.vector)
            angle = index.centers.angles(unit[None])[0, r.list]
            assert index.centers.least[r.list] - 1e-9 <= angle <= index.centers.most[r.list] + 1e-9


def test_empty_corpus_and_only_zero_vectors(spark, corpus):
    assert vector_index.build(corpus.limit(0)) is None and vector_index.build(corpus.where("id = 5000")) is None
    zeros = corpus.where("id in (5, 17, 900)")
    index = vector_index.build(zeros)
    found = vector_index.search(index, zeros.select(F.col("id").alias("query_id"), "embedding"), 2)
    assert _rows(found) == [(q, n, i, 0.0) for q in (5, 17, 900) for n, i in ((1, 5), (2, 17))]
    assert vector_index.search(index, zeros.limit(0).select(F.col("id").alias("query_id"), "embedding"), 2).collect() == []


def test_pairs_of_queries_and_lists_are_given_out_in_bounded_batches():
    """Without clusters every query asks for every list; the pairs of a batch must not be held at once."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(300, 8))
    centers /= np.sqrt((centers * centers).sum(axis=1, keepdims=True))
    bounds = vector_index.Centers(centers, np.zeros(300), np.full(300, np.pi))
    index = vector_index.VectorIndex("", None, bounds, {i: 1 for i in range(0, 300, 2)})
    queries = pa.RecordBatch.from_pydict(
        {
            "query": pa.array(range(3000)),
            "vector": pa.array(list(rng.normal(size=(3000, 8))), pa.list_(pa.float64())),
            "bar": pa.array([None] * 3000, pa.float64()),
        }
    )
    given = list(vector_index._asked(index, 0, 300)(iter([queries])))
    assert max(len(batch) for batch in given) <= 10_000
    pairs = {(q, own) for batch in given for q, own in zip(batch["query"].to_pylist(), batch["list"].to_pylist())}
    assert pairs == {(q, own) for q in range(3000) for own in range(0, 300, 2)}
