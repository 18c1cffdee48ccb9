"""Nearest vectors through an index of vector lists.

Directions fitted on a bounded sample are the centers of lists; every corpus row
goes to the list of its nearest center, and the table is stored by list. A list
keeps the least and the greatest angle of its rows to the center, taken over all
of them. A search reads the lists nearest to each query first, only these, and
then those that by their angles may still hold something better than the k-th
found, until none is left. So the answer is exact; stopped after the first round
it is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.operators import topk
from tidemark.session import materialize, scratch_path

#: Rows that the centers are fitted on at most, and such rows to a center.
SAMPLE = 8192
ROWS_PER_LIST = 16
#: Rows of one part of a list, and queries that meet them together.
PART = 65_536
BLOCK = 4096
#: Lists of the first round; each round goes on to this many times as many.
PROBES = 4
GROWTH = 4
#: Pairs of a query and a list that are tested, and that are given out, at once.
TESTED = 250_000
GIVEN = 8192
_ROUNDS = 12
_SLACK = 1e-6


@dataclass(frozen=True)
class Centers:
    """Unit vectors, and the angles between which the rows of each list lie."""

    vectors: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def angles(self, units: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units @ self.vectors.T, -1, 1))

    def ceilings(self, angles: np.ndarray) -> np.ndarray:
        """The best cosine that a row of each list can have."""
        nearest = np.maximum(np.maximum(angles - self.most, self.least - angles) - _SLACK, 0)
        return np.cos(nearest)


@dataclass(frozen=True)
class VectorIndex:
    """The written rows (list, part, id, vector, field_*), their centers and parts per list."""

    path: str
    schema: T.StructType
    centers: Centers
    parts: dict[int, int]
    fields: dict[str, str] = field(default_factory=dict)

    def rows(self, spark) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def _units(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and which are no zero vectors."""
    vectors = topk._matrix(column, dim)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    some = norms > 0
    return np.divide(vectors, norms[:, None], out=np.zeros_like(vectors), where=some[:, None]), some


def _fit(units: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Directions of spherical k-means, the same on each run."""
    random = np.random.default_rng(11)
    centers = units[np.sort(random.choice(len(units), lists, replace=False))]
    for _ in range(rounds):
        near = (units @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, units)
        norms = np.sqrt((sums * sums).sum(axis=1))
        moved = norms > 0
        centers[moved] = sums[moved] / norms[moved, None]
    return centers


def build(
    corpus: DataFrame,
    id_column: str = "id",
    vector: str = "embedding",
    fields: Mapping[str, str] | None = None,
    path: str | None = None,
    lists: int | None = None,
) -> VectorIndex | None:
    """Write the index of a corpus; None without any vector.

    ``fields`` maps a filter's name to a corpus column kept for it. The centers
    come from at most :data:`SAMPLE` rows, chosen by a hash of their ids; every
    row is placed. Rows of zero length have a list of their own, the last.
    """
    spark = corpus.sparkSession
    fields = dict(fields or {})
    own = corpus.select(
        F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        *[F.col(column).cast("string").alias(f"field_{name}") for name, column in fields.items()],
    ).where("vector is not null")
    chosen = own.select("vector", F.xxhash64("id").alias("lot")).orderBy("lot").limit(SAMPLE).select("vector").toArrow()
    if not len(chosen):
        return None
    units, some = _units(chosen.column("vector").combine_chunks(), None)
    dim, units = units.shape[1], units[some]
    number = max(1, min(lists or SAMPLE, len(units) // ROWS_PER_LIST or 1)) if len(units) else 0
    vectors = _fit(units, number) if number else np.zeros((0, dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_units, usable = _units(batch.column("vector"), dim)
            near = np.full(len(batch), number, np.int32)
            angle = np.zeros(len(batch))
            if number:
                score = own_units @ vectors.T
                best = score.argmax(axis=1)
                near[usable] = best[usable]
                angle[usable] = np.arccos(np.clip(score[np.arange(len(batch)), best][usable], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near), pa.array(angle)], [*batch.schema.names, "list", "angle"]
            )

    placed_schema = T.StructType([*own.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    placed = materialize(own.mapInArrow(place, placed_schema), "placed")
    spread = placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("least"), F.max("angle").alias("most"))
    found = {row["list"]: row for row in spread.collect()}  # one short row a list
    least, most = np.zeros(number), np.zeros(number)
    for i in range(number):
        if i in found:
            least[i], most[i] = found[i]["least"], found[i]["most"]
    parts = {i: -(-row["n"] // PART) for i, row in found.items()}
    counts = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    path = path or scratch_path(spark, "vectors")
    dealt = placed.drop("angle").withColumn("part", F.pmod(F.xxhash64("id", "vector"), counts[F.col("list")]).cast("int"))
    dealt.repartition("list", "part").write.partitionBy("list").parquet(path)
    schema = T.StructType([*own.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("list", T.IntegerType())])
    return VectorIndex(path, schema, Centers(vectors, least, most), parts, fields)


def _asked(index: VectorIndex, first: int, stop: int):
    """Queries with each list, from the ``first`` to before the ``stop`` nearest, that may hold better rows."""
    number = len(index.centers.vectors)
    dim = index.centers.vectors.shape[1]

    step = max(1, TESTED // (number + 1))

    def wanted(batch: pa.RecordBatch) -> np.ndarray:
        units, some = _units(batch.column("vector"), dim)
        bar = batch.column("bar").to_numpy(zero_copy_only=False)
        angles = index.centers.angles(units)
        ceiling = index.centers.ceilings(angles)
        ceiling[~some] = 0.0  # a zero vector scores 0 everywhere
        place = angles.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        lists = (place >= first) & (place < stop) & ~(ceiling + 1e-9 < bar[:, None])
        # The list of zero vectors, all of which score 0, comes with the last.
        last = ~(1e-9 < bar) & (stop >= number)
        lists = np.hstack([lists, last[:, None]])
        lists[:, [i for i in range(number + 1) if i not in index.parts]] = False
        return lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [name for name in batch.schema.names if name != "bar"]
            for begin in range(0, len(batch), step):
                # A query may ask for every list, and each pair carries the vector.
                part = batch.slice(begin, step)
                row, own = np.nonzero(wanted(part))
                for start in range(0, len(row), GIVEN):
                    rows = pa.array(row[start : start + GIVEN])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(name).take(rows) for name in names), pa.array(own[start : start + GIVEN].astype(np.int32))],
                        [*names, "list"],
                    )

    return run


def _groups(batches: Iterator[pa.RecordBatch]):
    """(is it queries, batches) for each run of equal list, part, block and asks."""
    names, key, held = ("list", "part", "block", "asks"), None, []
    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in names]
        turn = np.zeros(len(batch), bool)
        for column in columns:
            turn[1:] |= column[1:] != column[:-1]
        cuts = [*np.flatnonzero(turn).tolist(), len(batch)]
        begin = 0
        for stop in cuts:
            if stop == begin:
                continue
            own = tuple(int(column[begin]) for column in columns)
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append(batch.slice(begin, stop - begin))
            begin = stop
    if held:
        yield key, held


def search(
    index: VectorIndex,
    queries: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    vector: str = "embedding",
    where: Mapping[str, str] | None = None,
    probes: int = PROBES,
    exact: bool = True,
) -> DataFrame:
    """The ``k`` nearest rows of each query: (query_id, rank, id, score).

    ``where`` maps a filter of the index to a query column; null does not filter.
    Ties and zero vectors go as in the full scan. Without ``exact`` only the
    ``probes`` nearest lists of each query are read.
    """
    spark = queries.sparkSession
    names = list(where or {})
    asked = materialize(
        queries.select(
            F.col(query_id).alias("query"), F.col(vector).cast("array<double>").alias("vector"),
            *[F.col(column).cast("string").alias(f"term_{name}") for name, column in (where or {}).items()],
        ).where("vector is not null"),
        "queries",
    )
    id_type = to_arrow_type(index.schema["id"].dataType)
    found_schema = T.StructType([
        T.StructField("query", asked.schema["query"].dataType), T.StructField("id", index.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    pair_schema = T.StructType([*asked.schema.fields, T.StructField("list", T.IntegerType())])
    blocks = max(1, -(-asked.count() // BLOCK))
    parts = F.create_map(*[F.lit(x) for pair in index.parts.items() for x in pair])
    everything = len(index.centers.vectors)
    best, first, stop = None, 0, min(probes, everything)
    for _ in range(_ROUNDS):
        bar = asked.withColumn("bar", F.lit(None).cast("double"))
        if best is not None:
            full = best.where(F.col("rank") == k).select("query", F.col("score").alias("bar"))
            bar = asked.join(full, "query", "left")
        pairs = materialize(bar.mapInArrow(_asked(index, first, stop), pair_schema), "probes")
        lists = sorted(row["list"] for row in pairs.select("list").distinct().collect())  # list numbers alone
        if lists:
            found = _scan(index, pairs, lists, parts, blocks, names, k, id_type, found_schema, spark)
            if best is not None:
                found = found.union(best.select("query", "id", "score"))
            best = materialize(topk._merge(found, k).select("query", "rank", "id", "score"), "nearest")
        if not exact or stop >= everything:
            break
        first, stop = stop, min(everything, stop * GROWTH)
    if best is None:
        best = spark.createDataFrame([], found_schema).withColumn("rank", F.lit(0))
    return best.select(F.col("query").alias(query_id), "rank", "id", "score")


def _scan(index, pairs, lists, parts, blocks, names, k, id_type, found_schema, spark) -> DataFrame:
    """The k best of every part of the asked lists for the queries that ask for it."""
    keys = ["list", "part", "block"]
    kinds = {"query": found_schema["query"].dataType, "id": found_schema["id"].dataType}
    terms = [f"term_{name}" for name in names]
    stored = [f"field_{name}" for name in names]

    def none(columns):
        return [F.lit(None).cast(kinds.get(c, T.StringType())).alias(c) for c in columns]

    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    questions = pairs.select(
        "list", F.explode(F.sequence(F.lit(0), parts[F.col("list")] - 1)).alias("part"), block.alias("block"),
        F.lit(0).alias("asks"), "query", *terms, "vector", *none(["id", *stored]),
    )
    # Only the folders of the lists that some query asks for are read.
    rows = index.rows(spark).where(F.col("list").isin(lists)).select(
        "list", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("asks"),
        *none(["query", *terms]), "vector", "id", *stored,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = None, None
        for (*own, asks), group in _groups(batches):
            if not asks:
                held, place = topk._Block.of(pa.Table.from_batches(group), names), own
            elif own == place and len(held.vectors):
                yield from topk._search(held, k, id_type)(iter(group))

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        questions.union(rows).repartition(count, *keys).sortWithinPartitions(*keys, "asks").mapInArrow(run, found_schema)
    )
