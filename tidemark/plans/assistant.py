"""Index a profile's Bronze rows and answer questions over them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.embedding import Embedder, hashed_words
from tidemark.operators import retrieval
from tidemark.sources.lakehouse import Lakehouse

INDEX_TIER = "index"
MODEL_PROPERTY = "tidemark.embedding_model"
FEED_PROPERTY = "tidemark.index_feed"


class ModelMismatchError(RuntimeError):
    """An index was built by another embedding model."""


def assert_same_model(lake: Lakehouse, embedder: Embedder) -> None:
    """Refuse an index built by another model; one without a name passes."""
    name = lake.profile.index_name
    if not lake.exists(INDEX_TIER, name):
        return
    stored = lake.table_property(INDEX_TIER, name, MODEL_PROPERTY)
    if stored and stored != embedder.name:
        raise ModelMismatchError(
            f"index {name} was built by {stored}, not {embedder.name}; build it anew"
        )


def build_index(lake: Lakehouse, embedder: Embedder | None = None) -> int:
    """Add the chunks of Bronze that the index lacks; returns rows added.

    Ids come from the content, equal rows being numbered, so a chunk with a known
    id is the same chunk: only new ones are embedded and appended, and the index
    is never rewritten. Known rows are sorted out before their text is made.
    The index names its model before it holds anything, so a run that breaks off
    cannot leave chunks that another model would be mixed with. All of Bronze is
    compared; ``streaming.index_feed`` reads only new files, and an index that it
    feeds is refused here, as it would add the same rows once more.
    """
    embedder = embedder or hashed_words()
    assert_same_model(lake, embedder)
    profile = lake.profile
    if lake.exists(INDEX_TIER, profile.index_name) and lake.table_property(
        INDEX_TIER, profile.index_name, FEED_PROPERTY
    ):
        raise ValueError(f"index {profile.index_name} is fed by a stream; run that instead")
    bronze = lake.read_product("bronze", profile.bronze_table)
    fresh = retrieval.with_chunk_id(bronze, profile)
    if lake.exists(INDEX_TIER, profile.index_name):
        known = lake.read_product(INDEX_TIER, profile.index_name).select("id")
        fresh = fresh.join(known, "id", "left_anti")
    chunks = retrieval.embed_text(retrieval.build_chunks(fresh, profile), embedder)
    if not lake.exists(INDEX_TIER, profile.index_name):
        lake.append_product(INDEX_TIER, profile.index_name, lake.spark.createDataFrame([], chunks.schema))
    lake.set_table_property(INDEX_TIER, profile.index_name, MODEL_PROPERTY, embedder.name)
    return lake.append_product(INDEX_TIER, profile.index_name, chunks)


def ask(
    lake: Lakehouse,
    questions: DataFrame,
    embedder: Embedder | None = None,
    k: int = retrieval.NEAREST,
) -> DataFrame:
    """Answer questions (question_id, question) from index and Bronze.

    Where either does not exist yet, nothing is found.
    """
    embedder = embedder or hashed_words()
    assert_same_model(lake, embedder)
    profile = lake.profile
    nothing = lake.spark.createDataFrame([], profile.schema)
    known = lake.exists("bronze", profile.bronze_table)
    bronze = lake.read_product("bronze", profile.bronze_table) if known else nothing
    if lake.exists(INDEX_TIER, profile.index_name):
        index = lake.read_product(INDEX_TIER, profile.index_name)
    else:
        index = retrieval.embed_text(retrieval.build_chunks(nothing, profile), embedder)
    return retrieval.retrieve(
        questions,
        index,
        bronze,
        profile,
        embedder,
        order=["timestamp", *profile.sensitive],
        k=k,
    )
