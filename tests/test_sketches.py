from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.profiles import CLINICAL


def _silver(spark, rows, patients):
    return spark.range(rows).select(
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("p"), (F.hash("id") % patients).cast("string"))).alias(
            "patient_id_hashed"
        ),
        F.when(F.col("id") % 3 != 0, F.lit("ONC")).otherwise("CARD").alias("study_id"),
    )


def test_error_bound_by_day_and_merged(spark):
    silver = _silver(spark, 300_000, 80_000)
    stored = sketches.patient_sketches(silver, "study_id")
    for by in (["key", "day"], ["key"], ["day"], []):
        columns = {"key": F.col("study_id"), "day": F.to_date("timestamp")}
        exact = silver.groupBy(*[columns[c].alias(c) for c in by]).agg(
            F.count_distinct("patient_id_hashed").alias("exact"), F.count(F.lit(1)).alias("rows")
        )
        estimates = sketches.distinct_patients(stored, *by)
        both = estimates.join(exact, by) if by else estimates.crossJoin(exact)
        found = both.collect()
        assert len(found) == exact.count()
        for row in found:
            assert row["observation_count"] == row["rows"]
            off = abs(row["patient_count"] - row["exact"])
            assert off <= max(1, 5 * sketches.relative_error() * row["exact"]), row


def test_later_rows_are_merged_without_the_earlier_ones(spark, lake):
    silver = _silver(spark, 20_000, 3_000)
    early = F.col("timestamp") < F.lit("1970-01-08 12:00:00")
    own, whole = lake(CLINICAL), sketches.patient_sketches(silver, "study_id")
    sketches.append_sketches(own, silver.filter(early), "study_id")
    sketches.append_sketches(own, silver.filter(~early), "study_id")
    stored = own.read_product("gold", sketches.SKETCH_TABLE)
    # The day that both halves share has two sketches a study.
    assert stored.count() == whole.count() + 2
    parts = {tuple(r) for r in sketches.distinct_patients(stored, "key", "day").collect()}
    assert parts == {tuple(r) for r in sketches.distinct_patients(whole, "key", "day").collect()}


def test_null_patients_and_empty_silver(spark):
    silver = _silver(spark, 100, 10)
    nobody = silver.withColumn("patient_id_hashed", F.lit(None).cast("string"))
    row = sketches.distinct_patients(sketches.patient_sketches(nobody, "study_id")).first()
    assert (row["patient_count"], row["observation_count"]) == (0, 100)
    nothing = sketches.patient_sketches(silver.limit(0), "study_id")
    assert sketches.distinct_patients(nothing, "key").isEmpty()
