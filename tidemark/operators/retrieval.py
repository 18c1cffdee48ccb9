"""Chunks, filters and answers over a profile's Bronze rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as texts
from tidemark.functions.embedding import Embedder
from tidemark.operators.topk import vector_topk
from tidemark.profiles import Profile
from tidemark.session import materialize

# --- Fixed values: sizes and the wording of a brief ---------------------------
MATCHING_ROWS = 20
NEAREST = 5
NO_FILTER = "no specific filter"
BRIEF = "Profile '{profile}' brief for: {question}\n  Applied filter: {scope}\n  Retrieved {count} matching record(s) from the lakehouse."
# ------------------------------------------------------------------------------

_ANY = "*"
_ID_DIGITS = 32
_MERGE_GROUPS = 64


def chunk_text(profile: Profile) -> Column:
    """``[PROFILE] name=value, ...`` over every column but the timestamp."""
    pairs = [
        F.concat(F.lit(f"{f.name}="), texts.display(F.col(f.name), f.dataType))
        for f in profile.schema.fields
        if f.name != "timestamp"
    ]
    return F.concat(F.lit(f"[{profile.name}] "), F.concat_ws(", ", *pairs))


def content_id(profile: Profile, content: Column) -> Column:
    """Id from the row's content: stable however rows are ordered or re-read."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    stamp = F.coalesce(micros.cast("string"), F.lit("None"))
    digest = F.sha2(F.concat_ws("|", stamp, content), 256)
    return F.concat(F.lit(f"{profile.name}-"), F.substring(digest, 1, _ID_DIGITS))


def chunk_base(profile: Profile) -> Column:
    """The id of a row's chunk, copies not told apart."""
    return content_id(profile, chunk_text(profile))


def id_parts(profile: Profile, chunk: Column) -> tuple[Column, Column]:
    """A chunk id's base and the number of the copy, from 1."""
    length = len(profile.name) + 1 + _ID_DIGITS
    number = F.when(F.length(chunk) > length, F.substr(chunk, F.lit(length + 2)).cast("bigint"))
    return F.substring(chunk, 1, length), F.coalesce(number, F.lit(1).cast("bigint"))


def _copy_id(base: Column, number: Column) -> Column:
    return F.concat(base, F.when(number > 1, F.concat(F.lit("-"), number.cast("string"))).otherwise(""))


def numbered_after(rows: DataFrame, earlier: DataFrame, profile: Profile) -> DataFrame:
    """Rows of :func:`with_chunk_id`, their copies counted on behind ``earlier`` (base, copies)."""
    base, copy = id_parts(profile, F.col("id"))
    columns = [c for c in rows.columns if c != "id"]
    placed = rows.withColumns({"_base": base, "_copy": copy})
    before = earlier.select(F.col("base").alias("_base"), F.col("copies").alias("_before"))
    joined = placed.join(before, "_base", "left")
    number = F.col("_copy") + F.coalesce(F.col("_before"), F.lit(0).cast("bigint"))
    return joined.select(_copy_id(F.col("_base"), number).alias("id"), *columns)


#: Copies of a row that one task makes out.
_COPIES = 10_000


def _copies(again: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose content repeats, numbered from 1 by content; equal ones travel as one row and a count."""
    alike = F.xxhash64(*columns)
    groups = again.groupBy("_base", alike.alias("_alike")).agg(
        F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    # A group's rows are equal; different rows of one content are few.
    before = Window.partitionBy("_base").orderBy("_alike").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    chunks = groups.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(_COPIES).cast("bigint"))))
    # A stated number: a few short rows would be brought together again otherwise.
    tasks = int(again.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = chunks.filter(F.col("_n") > _COPIES).repartition(tasks, "_base", "_alike", "_from")
    upto = F.least(F.col("_from") + F.lit(_COPIES - 1), F.col("_n"))
    spread = chunks.filter(F.col("_n") <= _COPIES).unionByName(many)
    copies = spread.select("_base", "_row", "_before", F.explode(F.sequence(F.col("_from"), upto)).alias("_copy"))
    return copies.select("_base", (F.col("_before") + F.col("_copy")).alias("_number"), "_row.*")


def with_chunk_id(bronze: DataFrame, profile: Profile) -> DataFrame:
    """Bronze rows with the id of their chunk in front.

    Equal rows are chunks of their own: the second one's id ends in ``-2``, and so
    on. Which of them gets which number does not matter, as they are equal.
    Ids alone are shuffled, and those that repeat written down, so their size is
    known: few are broadcast, and where none repeats no row moves. A row that
    repeats very often is counted, then spread again.
    """
    columns = bronze.columns
    based = bronze.withColumn("_base", chunk_base(profile))
    counts = based.groupBy("_base").agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counts.filter(F.col("_n") > 1).select("_base"), "repeated")
    if repeated.isEmpty():
        return based.select(F.col("_base").alias("id"), *columns)
    alone = based.join(repeated, "_base", "left_anti").select(F.col("_base").alias("id"), *columns)
    numbered = _copies(based.join(repeated, "_base", "left_semi"), columns)
    again = numbered.select(_copy_id(F.col("_base"), F.col("_number")).alias("id"), *columns)
    return alone.unionByName(again)


def build_chunks(bronze: DataFrame, profile: Profile) -> DataFrame:
    """One (id, text, metadata) per Bronze row; metadata holds the non-null terms.

    Rows that already carry their id keep it.
    """
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("key"), F.col(f).cast("string").alias("value"))
            for f in profile.vocabulary
        ],
        F.struct(F.lit("profile").alias("key"), F.lit(profile.name).alias("value")),
    )
    known = F.filter(entries, lambda e: e["value"].isNotNull())
    numbered = bronze if "id" in bronze.columns else with_chunk_id(bronze, profile)
    return numbered.withColumn("text", chunk_text(profile)).select(
        "id",
        "text",
        F.map_from_entries(known).alias("metadata"),
    )


def embed_text(df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    return df.withColumn("embedding", embedder.embed(F.col(text)))


def extract_terms(questions: DataFrame, profile: Profile, text: str = "question") -> DataFrame:
    """Add ``filters``: a map from vocabulary field to the term found in the text."""
    return questions.withColumn("filters", texts.extract_terms(F.col(text), profile.vocabulary))


def metadata_prefilter(terms: Mapping[str, str]) -> Column | None:
    """All terms must hold; no terms, no filter."""
    clauses = [F.col(field) == F.lit(term) for field, term in terms.items()]
    return reduce(lambda a, b: a & b, clauses) if clauses else None


def limit_rows(df: DataFrame, order: Sequence[str], n: int = MATCHING_ROWS) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def filter_by_terms(
    df: DataFrame,
    terms: Mapping[str, str],
    order: Sequence[str],
    n: int = MATCHING_ROWS,
) -> DataFrame:
    """First ``n`` rows, in a stated order, that equal every term."""
    condition = metadata_prefilter(terms)
    return limit_rows(df if condition is None else df.filter(condition), order, n)


def _scope(values: Sequence[Column]) -> Column:
    """Key of a filter combination, ``*`` where a field is not filtered."""
    return F.concat_ws("\x1f", *[F.coalesce(v, F.lit(_ANY)) for v in values])


def _top_per_scope(rows: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows per scope, however large a scope is.

    Each task sends at most ``n`` rows per scope; these meet in a bounded number
    of groups by where they come from, and the groups' best meet in the end.
    """
    part = Window.partitionBy("scope", "_group").orderBy("row")
    whole = Window.partitionBy("scope").orderBy("row")
    return (
        rows.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)))
        .withColumn("_n", F.row_number().over(part))
        .filter(F.col("_n") <= n)
        .drop("_n", "_group")
        .withColumn("_n", F.row_number().over(whole))
        .filter(F.col("_n") <= n)
        .drop("_n")
    )


def matching_rows(
    bronze: DataFrame,
    profile: Profile,
    scopes: DataFrame,
    order: Sequence[str],
    n: int = MATCHING_ROWS,
) -> DataFrame:
    """First ``n`` rows of every asked filter combination, as one array per scope.

    A row belongs to at most two to the number of fields combinations: each field
    either at its own value or unfiltered. Rows of scopes that nobody asks for go
    first, and no row moves for it: the asked scopes are combinations of vocabulary
    terms, so few however many questions there are, and are broadcast. Dealt by
    scope instead, "no filter" would send all of Bronze to one task.
    """
    fields = list(profile.vocabulary)
    masks = F.array(
        *[
            _scope([F.col(f) if keep else F.lit(None) for f, keep in zip(fields, mask)])
            for mask in product((True, False), repeat=len(fields))
        ]
    )
    rows = bronze.select(
        F.explode(F.array_distinct(masks)).alias("scope"),
        F.struct(*order, *[c for c in bronze.columns if c not in order]).alias("row"),
    )
    asked = scopes.select("scope").distinct()
    best = _top_per_scope(rows.join(F.broadcast(asked), "scope", "left_semi"), n)
    return best.groupBy("scope").agg(F.sort_array(F.collect_list("row")).alias("rows"))


def brief(profile: Profile, question: Column, filters: Column, count: Column) -> Column:
    """The answer text for a question."""
    fields = list(profile.vocabulary)
    parts = [F.concat(F.lit(f"{f}="), filters[f]) for f in fields]
    scope = F.concat_ws(", ", *parts)
    scope = F.when(scope == "", NO_FILTER).otherwise(scope)
    head, rest = BRIEF.replace("{profile}", profile.name).split("{question}")
    middle, tail = rest.split("{scope}")
    before, after = tail.split("{count}")
    return F.concat(
        F.lit(head),
        texts.quoted(question),
        F.lit(middle),
        scope,
        F.lit(before),
        count.cast("string"),
        F.lit(after),
    )


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    bronze: DataFrame,
    profile: Profile,
    embedder: Embedder,
    order: Sequence[str],
    k: int = NEAREST,
    n: int = MATCHING_ROWS,
) -> DataFrame:
    """Answer a batch of questions (question_id, question).

    Terms are extracted, the ``k`` nearest chunks within those terms are found in
    ``index`` (id, text, metadata, embedding), the first ``n`` Bronze rows with
    those terms are added, and a brief is worded. One row per question.
    """
    fields = list(profile.vocabulary)
    asked = extract_terms(questions.select("question_id", "question"), profile)
    asked = asked.withColumn("scope", _scope([F.col("filters")[f] for f in fields]))

    vectors = embed_text(asked, embedder, "question").withColumns(
        {f"_q_{f}": F.col("filters")[f] for f in fields}
    )
    corpus = index.select(
        "id", "embedding", *[F.col("metadata")[f].alias(f"_c_{f}") for f in fields]
    )
    near = vector_topk(
        vectors,
        corpus,
        k,
        query_id="question_id",
        where={f: (f"_q_{f}", f"_c_{f}") for f in fields},
    )
    hits = near.groupBy("question_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id"))).alias("_hits")
    )
    rows = matching_rows(bronze, profile, asked, order, n)

    found = F.coalesce(F.col("_hits.id"), F.array().cast("array<string>"))
    return (
        asked.join(hits, "question_id", "left")
        # At most n rows per combination of vocabulary terms, so "no filter",
        # the scope of most questions, need not meet in one task.
        .join(F.broadcast(rows), "scope", "left")
        .select(
            "question_id",
            "question",
            "filters",
            found.alias("matched_ids"),
            F.coalesce("rows", F.array().cast(rows.schema["rows"].dataType)).alias("rows"),
            brief(profile, F.col("question"), F.col("filters"), F.size(found)).alias("answer"),
        )
    )
