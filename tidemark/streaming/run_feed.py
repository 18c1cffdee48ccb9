"""Run-result artifacts as a continuous feed, bad documents set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.run_results import ARTIFACT, explode_results
from tidemark.streaming.ingest import trigger

_BROKEN = "_broken"
_PARSED = T.StructType([*ARTIFACT.fields, T.StructField(_BROKEN, T.StringType())])
FEED_SCHEMA = T.StructType(
    [
        T.StructField("data_product", T.StringType()),
        T.StructField("file", T.StringType()),
        *ARTIFACT.fields,
        T.StructField("document", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def judge_documents(documents: DataFrame, document: str) -> DataFrame:
    """``results`` of each document, or the document itself and the reason it is bad.

    Bad is what is no JSON object of an artifact's types, is cut off, or has no
    list of results. Every document gives exactly one row.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    text = F.col(document)
    parsed = documents.withColumn("_doc", F.from_json(text, _PARSED, options))
    malformed = F.col("_doc").isNull() | F.col(f"_doc.{_BROKEN}").isNotNull() | text.isNull()
    # The parser stops behind the first object. With something after it, the text is no
    # single member of a list, or no single value in an object.
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    keyed = F.json_object_keys(F.concat(F.lit('{"d":'), text, F.lit("}")))
    single = F.coalesce((listed == 1) & (F.size(keyed) == 1), F.lit(False))
    reason = F.when(malformed | ~single, "malformed").when(F.col("_doc.results").isNull(), "no results")
    judged = parsed.withColumn("reason", reason)
    kept = [c for c in documents.columns if c != document]
    return judged.select(
        *kept,
        F.when(F.col("reason").isNull(), F.col("_doc.results")).alias("results"),
        F.when(F.col("reason").isNotNull(), text).alias("document"),
        "reason",
    )


def stream_run_results(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    data_product: str,
    one_per_line: bool = False,
    once: bool = False,
    interval: str = "1 minute",
    files: int = 1000,
) -> StreamingQuery:
    """Follow a folder of artifacts; good and bad documents go to ``target`` in one write.

    The file sink commits a micro-batch as a whole and a restart neither loses
    nor repeats a document. Good and bad ones lie in folders of their own, so
    readers of the results do not touch the quarantine. Spark reads each file once.
    A file without a byte gives Spark no row, so it shows in neither.
    """
    lines = (
        spark.readStream.option("maxFilesPerTrigger", files)
        .text(source, wholetext=not one_per_line)
        .select(
            F.lit(data_product).alias("data_product"),
            F.col("_metadata.file_path").alias("file"),
            F.col("value").alias("text"),
        )
    )
    judged = judge_documents(lines, "text")
    return (
        judged.withColumn("quarantined", F.col("reason").isNotNull())
        .writeStream.format("parquet")
        .partitionBy("quarantined")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, interval))
        .start()
    )


def _read(spark: SparkSession, target: str) -> DataFrame:
    schema = T.StructType([*FEED_SCHEMA.fields, T.StructField("quarantined", T.BooleanType())])
    return spark.read.schema(schema).parquet(target)


def read_feed_results(spark: SparkSession, target: str) -> DataFrame:
    """One row per result of the good documents, as ``read_run_results`` gives them."""
    good = _read(spark, target).filter(~F.col("quarantined"))
    return explode_results(good.select("data_product", "file", "results"), F.col("results")).drop("results")


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """The bad documents, whole, with their file and the reason."""
    return _read(spark, target).filter("quarantined").select("data_product", "file", "reason", "document")
