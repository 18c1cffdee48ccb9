"""Run-result artifacts: nested JSON, one document per run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.profiles import declare

RESULT = declare(
    unique_id=T.StringType(), status=T.StringType(), execution_time=T.DoubleType()
)
ARTIFACT = T.StructType([T.StructField("results", T.ArrayType(RESULT))])


def explode_results(runs: DataFrame, results: Column) -> DataFrame:
    """One row per result; ``position`` is its place in the run."""
    columns = [F.col(c) for c in runs.columns]
    return runs.select(*columns, F.posexplode(results).alias("position", "_r")).select(
        *columns, "position", "_r.unique_id", "_r.status", "_r.execution_time"
    )


def parse_run_results(runs: DataFrame, document: str) -> DataFrame:
    """Results of JSON documents held in a column; other columns are kept.

    A malformed or cut-off document fails the query rather than vanish from it.
    """
    whole = F.from_json(document, ARTIFACT, {"mode": "FAILFAST"})
    parsed = runs.withColumn("_doc", whole).drop(document)
    kept = [c for c in parsed.columns if c != "_doc"]
    return explode_results(parsed, F.col("_doc.results")).select(
        *kept, "position", "unique_id", "status", "execution_time"
    )


def read_run_results(
    spark: SparkSession, path: str, data_product: str, one_per_line: bool = False
) -> DataFrame:
    """Results of every artifact at ``path``; a missing path gives no rows.

    A file holds one document, or one per line, which large files need to be
    read by several tasks. A malformed or cut-off document fails the query.
    """
    try:
        runs = (
            spark.read.schema(ARTIFACT)
            .options(multiLine=not one_per_line, mode="FAILFAST")
            .json(path)
        )
        file = F.col("_metadata.file_path")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        runs, file = spark.createDataFrame([], ARTIFACT), F.lit("")
    runs = runs.select(F.lit(data_product).alias("data_product"), file.alias("file"), "results")
    return explode_results(runs, F.col("results")).drop("results")
