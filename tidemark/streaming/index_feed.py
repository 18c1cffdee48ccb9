"""The index fed from Bronze: every run reads only the files that are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.embedding import Embedder, hashed_words
from tidemark.operators import retrieval
from tidemark.plans import assistant
from tidemark.plans.assistant import INDEX_TIER, MODEL_PROPERTY
from tidemark.session import delete_path
from tidemark.sources.lakehouse import Lakehouse
from tidemark.streaming.ingest import checkpoint_id, trigger

SOURCE_PROPERTY = "tidemark.index_source"


def _earlier_copies(lake: Lakehouse, batch: DataFrame) -> DataFrame:
    """(base, copies): how often the index already holds what the batch's rows say.

    Of the index only the ids are read; what is shuffled are ids.
    """
    profile = lake.profile
    bases = batch.select(retrieval.chunk_base(profile).alias("base")).distinct()
    base, copy = retrieval.id_parts(profile, F.col("id"))
    known = lake.read_product(INDEX_TIER, profile.index_name).select(base.alias("base"), copy.alias("copy"))
    return known.join(bases, "base", "left_semi").groupBy("base").agg(F.max("copy").alias("copies"))


def _claim(lake: Lakehouse, feed: str, source: str, embedder: Embedder) -> None:
    """Make the index this feed's own; one that something else filled is refused."""
    name = lake.profile.index_name
    if not lake.exists(INDEX_TIER, name):
        nothing = lake.spark.createDataFrame([], lake.profile.schema)
        chunks = retrieval.embed_text(retrieval.build_chunks(nothing, lake.profile), embedder)
        lake.append_product(INDEX_TIER, name, lake.spark.createDataFrame([], chunks.schema))
    owner = lake.table_property(INDEX_TIER, name, assistant.FEED_PROPERTY)
    if owner == feed:
        return
    if owner is not None or not lake.read_product(INDEX_TIER, name).isEmpty():
        raise ValueError(f"index {name} was filled in another way; feed it from an empty one")
    lake.set_table_property(INDEX_TIER, name, MODEL_PROPERTY, embedder.name)
    lake.set_table_property(INDEX_TIER, name, SOURCE_PROPERTY, source)
    lake.set_table_property(INDEX_TIER, name, assistant.FEED_PROPERTY, feed)


def stream_index(
    lake: Lakehouse,
    checkpoint: str,
    embedder: Embedder | None = None,
    once: bool = True,
    interval: str = "5 minutes",
    files: int | None = None,
) -> StreamingQuery:
    """Add the chunks of Bronze files not seen before, with the ids ``build_index`` gives them.

    The checkpoint remembers the files, so a run over unchanged Bronze reads none.
    A row that the index already holds is the next copy of it. How many copies
    were there is written down before a batch is appended: a batch that Spark
    repeats gets the same ids, and those already appended are left out.
    Bronze must only be appended to; a rewritten table is refused, as its files
    would all be new. ``files`` bounds the files of one micro-batch.
    """
    embedder = embedder or hashed_words()
    assistant.assert_same_model(lake, embedder)
    profile, name = lake.profile, lake.profile.index_name
    source = lake.location("bronze", profile.bronze_table)
    if lake.exists(INDEX_TIER, name):
        fed_from = lake.table_property(INDEX_TIER, name, SOURCE_PROPERTY)
        if fed_from is not None and fed_from != source:
            raise ValueError(f"Bronze was rewritten since index {name} was begun; build it anew")

    def add(batch: DataFrame, number: int) -> None:
        feed = checkpoint_id(lake, checkpoint)
        _claim(lake, feed, source, embedder)
        done = lake.table_property(INDEX_TIER, name, f"{assistant.FEED_PROPERTY}.done")
        if done is not None and int(done) >= number:
            return
        noted = f"{lake.root}/{INDEX_TIER}/_feed/{feed}/{number}"
        begun = lake.table_property(INDEX_TIER, name, f"{assistant.FEED_PROPERTY}.begun")
        repeated = begun is not None and int(begun) == number
        lake.spark.catalog.refreshTable(lake.identifier(INDEX_TIER, name))
        if not repeated:
            _earlier_copies(lake, batch).write.mode("overwrite").parquet(noted)
            lake.set_table_property(INDEX_TIER, name, f"{assistant.FEED_PROPERTY}.begun", str(number))
        earlier = lake.spark.read.schema("base string, copies bigint").parquet(noted)
        rows = retrieval.numbered_after(retrieval.with_chunk_id(batch, profile), earlier, profile)
        if repeated:
            known = lake.read_product(INDEX_TIER, name).select("id")
            rows = rows.join(known, "id", "left_anti")
        chunks = retrieval.embed_text(retrieval.build_chunks(rows, profile), embedder)
        lake.append_product(INDEX_TIER, name, chunks)
        # The batch was written by a session of its own; readers of this one look at the files anew.
        lake.spark.catalog.refreshTable(lake.identifier(INDEX_TIER, name))
        lake.set_table_property(INDEX_TIER, name, f"{assistant.FEED_PROPERTY}.done", str(number))
        delete_path(lake.spark, noted)

    reader = lake.spark.readStream
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return (
        reader.table(lake.identifier("bronze", profile.bronze_table))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, interval))
        .foreachBatch(add)
        .start()
    )
