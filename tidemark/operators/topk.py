"""Exact nearest vectors by cosine for a batch of queries.

The corpus is scanned once and never paired up with the queries as rows. The
queries are written to the shared folder; a task gathers a chunk of corpus
vectors, reads the queries block by block, multiplies, and keeps the best ``k``
per query from chunk to chunk. So it holds one chunk, one block and the best so
far, and gives out at most ``k`` rows per query; merging what tasks give out is a
two-step top-k.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.session import folder_store, list_folder, scratch_path, shared_folder

#: Most query vectors held in a task at once.
QUERY_BLOCK = 1024
#: Corpus vectors that meet all blocks in turn before the next are read.
CHUNK_BYTES = 64 << 20
#: Best rows that a task keeps from chunk to chunk: one set for each query it has seen.
KEPT_BYTES = 256 << 20
#: Scores equal to this many digits are ties, broken by id; keeps the order free
#: of the last-bit noise of blocked matrix products.
SCORE_DIGITS = 10
_CELLS = 2_000_000
_MERGE_GROUPS = 64


@dataclass(frozen=True)
class _Block:
    """A bounded set of queries as arrays."""

    ids: pa.Array
    vectors: np.ndarray
    norms: np.ndarray
    terms: dict[str, tuple[np.ndarray, list[str]]]

    @classmethod
    def of(cls, table: pa.Table, fields: list[str]) -> "_Block":
        table = table.filter(pc.is_valid(table.column("vector"))).combine_chunks()
        vectors = _matrix(table.column("vector").combine_chunks(), None)
        terms = {}
        for f in fields:
            values = table.column(f"term_{f}").to_pylist()
            known = sorted({v for v in values if v is not None})
            code = {v: i for i, v in enumerate(known)}
            # -1: the query does not filter on this field
            terms[f] = (np.array([-1 if v is None else code[v] for v in values]), known)
        ids = table.column("query").combine_chunks()
        return cls(ids, vectors, np.sqrt((vectors * vectors).sum(axis=1)), terms)


def _matrix(column: pa.Array, dim: int | None) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if dim is None:
        dim = int(lengths[0]) if len(lengths) else 0
    if len(lengths) and not (lengths == dim).all():
        raise ValueError(f"all vectors must have {dim} dimensions")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dim)


def _allowed(batch: pa.RecordBatch, start: int, rows: int, block: _Block) -> np.ndarray | None:
    """Which (row, query) pairs pass the metadata filter; None if all do."""
    allowed = None
    for f, (wanted, known) in block.terms.items():
        if (wanted < 0).all():
            continue
        have = pc.index_in(batch.column(f"field_{f}").slice(start, rows), pa.array(known, pa.string()))
        have = have.fill_null(-2).to_numpy(zero_copy_only=False)
        match = (have[:, None] == wanted[None, :]) | (wanted < 0)[None, :]
        allowed = match if allowed is None else allowed & match
    return allowed


def _best(candidates: pa.Table, k: int) -> pa.Table:
    """First ``k`` per query by score, then id."""
    ordered = candidates.sort_by([("q", "ascending"), ("score", "descending"), ("id", "ascending")])
    q = ordered.column("q").to_numpy()
    first = np.searchsorted(q, q, side="left")
    return ordered.filter(pa.array(np.arange(len(q)) - first < k))


def _named_best(found: pa.Table, k: int) -> pa.Table:
    """First ``k`` of each query by score, then id, of what several chunks gave."""
    codes = found.column("query").combine_chunks().dictionary_encode().indices
    return _best(found.append_column("q", codes), k).drop_columns(["q"])


def _search(block: _Block, k: int, id_type: pa.DataType):
    """The per-task scan: corpus batches in, at most ``k`` rows per query out."""
    queries, dim = block.vectors.shape
    step = max(64, _CELLS // max(1, queries))
    keep_limit = max(_CELLS, 4 * k * queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("q", pa.int32()), ("id", id_type), ("score", pa.float64())])
        best = schema.empty_table()
        pending: list[pa.Table] = []
        held, blocks = 0, 0
        floor = np.full(queries, -np.inf)

        def compact() -> None:
            nonlocal best, pending, held
            best = _best(pa.concat_tables([best, *pending]), k)
            pending, held = [], 0
            q = best.column("q").to_numpy()
            counts = np.bincount(q, minlength=queries)
            full = counts >= k
            lowest = np.full(queries, np.inf)
            np.minimum.at(lowest, q, best.column("score").to_numpy())
            floor[full] = lowest[full]

        for batch in batches:
            if batch.column("vector").null_count:
                batch = batch.filter(batch.column("vector").is_valid())
            for start in range(0, batch.num_rows, step):
                rows = min(step, batch.num_rows - start)
                vectors = _matrix(batch.column("vector").slice(start, rows), dim)
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                scale = norms[:, None] * block.norms[None, :]
                scores = vectors @ block.vectors.T
                np.divide(scores, scale, out=scores, where=scale > 0)
                scores[scale <= 0] = 0.0
                np.round(scores, SCORE_DIGITS, out=scores)
                allowed = _allowed(batch, start, rows, block)
                if allowed is not None:
                    scores[~allowed] = -np.inf
                better = (scores >= floor[None, :]) & (scores > -np.inf)
                if rows > k and np.count_nonzero(better) > 4 * k * queries:
                    # many candidates: only the block's own best k can matter
                    better &= scores >= np.partition(scores, rows - k, axis=0)[rows - k]
                row, q = np.nonzero(better)
                if not len(row):
                    continue
                found = pa.Table.from_arrays(
                    [
                        pa.array(q.astype(np.int32)),
                        batch.column("id").slice(start, rows).take(pa.array(row)).cast(id_type),
                        pa.array(scores[row, q]),
                    ],
                    schema=schema,
                )
                pending.append(found)
                held += found.num_rows
                blocks += 1
                # often at first, to raise the bar early; then only when large
                if held > keep_limit or blocks & (blocks - 1) == 0:
                    compact()
        compact()
        if best.num_rows:
            named = pa.table(
                {
                    "query": block.ids.take(best.column("q").combine_chunks()),
                    "id": best.column("id"),
                    "score": best.column("score"),
                }
            )
            yield from named.to_batches()

    return run


def _merge(found: DataFrame, k: int) -> DataFrame:
    """Top ``k`` per query from per-task results, through bounded groups."""
    order = [F.col("score").desc(), F.col("id").asc()]
    part = Window.partitionBy("query", "_group").orderBy(*order)
    whole = Window.partitionBy("query").orderBy(*order)
    return (
        found.withColumn("_group", F.pmod(F.hash("id"), F.lit(_MERGE_GROUPS)))
        .withColumn("_n", F.row_number().over(part))
        .filter(F.col("_n") <= k)
        .drop("_n", "_group")
        .withColumn("rank", F.row_number().over(whole))
        .filter(F.col("rank") <= k)
    )


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vector: str = "embedding",
    corpus_id: str = "id",
    corpus_vector: str = "embedding",
    where: Mapping[str, tuple[str, str]] | None = None,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` nearest corpus rows of each query: (query_id, rank, id, score).

    ``where`` maps a filter name to (query column, corpus column): a query whose
    column is null does not filter on it, otherwise the corpus must equal it.
    Rows without a vector take no part; a zero vector scores 0. Query ids are
    unique.

    The queries are written to the shared folder when this is called. The corpus
    is read once; each task reads them there in blocks of at most ``block``.
    """
    fields = list(where or {})
    # Rows without a vector are skipped in the scan: a filter here would run an
    # embedding function in front of it a second time.
    wanted = queries.select(
        F.col(query_id).alias("query"),
        F.col(query_vector).alias("vector"),
        *[F.col(q).cast("string").alias(f"term_{f}") for f, (q, _) in (where or {}).items()],
    )
    scanned = corpus.select(
        F.col(corpus_id).alias("id"),
        F.col(corpus_vector).alias("vector"),
        *[F.col(c).cast("string").alias(f"field_{f}") for f, (_, c) in (where or {}).items()],
    )
    result_schema = T.StructType(
        [
            T.StructField("query", wanted.schema["query"].dataType),
            T.StructField("id", scanned.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    id_type = to_arrow_type(scanned.schema["id"].dataType)

    spark = queries.sparkSession
    path = scratch_path(spark, "queries")
    wanted.write.option("maxRecordsPerFile", block).parquet(path)
    asked = _asked_for(spark.read.schema(wanted.schema).parquet(path), fields)
    rows = scanned if asked is None else scanned.filter(asked)
    folder = shared_folder(spark, path)
    names = sorted(name.rsplit("/", 1)[1] for name in list_folder(spark, path) if name.endswith(".parquet"))

    chunk_bytes, kept_bytes = CHUNK_BYTES, KEPT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _Blocks(folder, names, block, fields)
        kept: dict[int, pa.Table] = {}
        for chunk in _chunks(batches, chunk_bytes):
            for number, own in enumerate(read):
                found = [kept[number]] if number in kept else []
                found += [pa.Table.from_batches([b]) for b in _search(own, k, id_type)(iter(chunk))]
                if found:
                    kept[number] = _named_best(pa.concat_tables(found), k)
            if sum(table.nbytes for table in kept.values()) > kept_bytes:
                # So many queries that not even their best fit: given out, and begun anew.
                for table in kept.values():
                    yield from table.to_batches()
                kept = {}
        for table in kept.values():
            yield from table.to_batches()

    return _merge(rows.mapInArrow(run, result_schema), k).select(
        F.col("query").alias(query_id), "rank", F.col("id").alias(corpus_id), "score"
    )


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Blocks:
    """Blocks of the written queries, read anew each time; a single one is kept."""

    def __init__(self, folder: str, names: list[str], most: int, fields: list[str]) -> None:
        self.folder, self.names, self.most, self.fields = folder, names, most, fields
        self.only: _Block | None = None

    def _tables(self) -> Iterator[pa.Table]:
        """Files hold at most ``most`` rows each; small ones are read together."""
        store, root = folder_store(self.folder)
        held, rows = [], 0
        for name in self.names:
            with store.open_input_file(f"{root}/{name}") as file:
                table = pq.read_table(file)
            if held and rows + table.num_rows > self.most:
                yield pa.concat_tables(held)
                held, rows = [], 0
            held.append(table)
            rows += table.num_rows
        if held:
            yield pa.concat_tables(held)

    def __iter__(self) -> Iterator[_Block]:
        if self.only is not None:
            yield self.only
            return
        number, last = 0, None
        for table in self._tables():
            last = _Block.of(table, self.fields)
            number += 1
            if len(last.vectors):
                yield last
        if number == 1 and len(last.vectors):
            self.only = last


def _asked_for(asked: DataFrame, fields: list[str]) -> Column | None:
    """Corpus rows that at least one query may match, by ranges of terms.

    Queries that filter on the same fields share one clause: each of these
    fields lies between the least and the greatest value asked for. So there are
    at most 2**fields clauses, whatever is asked, and they reach the scan. The
    scan itself tests the combination. None if some query has no filter.
    """
    if not fields:
        return None
    ranges = asked.groupBy(*[F.col(f"term_{f}").isNotNull().alias(f"used_{f}") for f in fields]).agg(
        *[F.min(f"term_{f}").alias(f"low_{f}") for f in fields],
        *[F.max(f"term_{f}").alias(f"high_{f}") for f in fields],
    )
    clauses = []
    for row in ranges.collect():
        used = [f for f in fields if row[f"used_{f}"]]
        if not used:
            return None
        clauses.append(
            reduce(
                lambda a, b: a & b,
                [F.col(f"field_{f}").between(row[f"low_{f}"], row[f"high_{f}"]) for f in used],
            )
        )
    return reduce(lambda a, b: a | b, clauses, F.lit(False))
