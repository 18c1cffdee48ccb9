"""Time frames by count over one hot stream, beside plain row numbers per stream.

    python -m checks.positions_trial [rows, in millions]

Two thirds of the rows are in one stream. Prints seconds of each way.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import build_session
from tidemark.functions.numeric import whole_division
from tidemark.operators.frames import SAMPLES_PER_FRAME, frame_columns, partials, signal_downsample


def plain(df: DataFrame) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("s").orderBy("t", "id")) - 1
    framed = df.withColumn("frame", whole_division(number, SAMPLES_PER_FRAME))
    return framed.groupBy("s", "frame").agg(*partials("v")).select("s", "frame", *frame_columns("P", "L", "max"))


def main() -> None:
    rows = int(float(sys.argv[1] if len(sys.argv) > 1 else 20) * 1_000_000)
    spark = build_session(
        "positions", master="local[8]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__shuffle__partitions="32",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spread = F.hash("id")
    df = spark.range(rows).select(
        "id",
        F.when(spread % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), (F.abs(spread) % 1000).cast("string"))).alias("s"),
        F.timestamp_micros(F.col("id") * 2_000).alias("t"),
        F.rand(1).alias("v"),
    )
    df.write.mode("overwrite").saveAsTable("positions_trial")
    df = spark.table("positions_trial")
    for name, way in (
        ("row_number per stream", plain),
        ("buckets", lambda d: signal_downsample(d, "v", "s", ["t", "id"], "max", "P", "L")),
        ("buckets of a minute", lambda d: signal_downsample(d, "v", "s", ["t", "id"], "max", "P", "L", width=60)),
    ):
        begin = time.perf_counter()
        way(df).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - begin:.1f} s", flush=True)
    spark.sql("DROP TABLE positions_trial")
    spark.stop()


if __name__ == "__main__":
    main()
