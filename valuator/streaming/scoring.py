"""Error-band report over a stream of scored rows (V5/B3 on readStream).

Scored rows ``(model, key, price, prediction)`` arrive as parquet files in a
folder; each micro-batch is banded with the same expression as the batch
report and the running per-(model, band) aggregates are kept by Spark's state
store (complete mode). ``foreachBatch`` writes each new version of the
report to a table in the checkpoint folder the session names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.operators.segment import error_band

SCORED_SCHEMA = "model string, listing_id long, price double, prediction double"


def band_report_stream(spark: SparkSession, source: str, schema: str = SCORED_SCHEMA,
                       max_files_per_trigger: int = 16) -> DataFrame:
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source))
    err = F.col("price") - F.col("prediction")
    banded = rows.withColumns({"mistake": err, "band": error_band(err)})
    return banded.groupBy("model", "band").agg(
        F.count(F.lit(1)).alias("count"), F.sum(err * err).alias("sse"),
        F.sum(F.abs(err)).alias("sum_abs"), F.max(F.abs(err)).alias("max_mistake"),
        F.min(F.abs(err)).alias("min_mistake"))


def finish_report(agg: DataFrame) -> DataFrame:
    """Turn the running sums into the report columns (rmse, mean |mistake|)."""
    return agg.select("model", "band", "count", F.sqrt(F.col("sse") / F.col("count")).alias("rmse"),
                      (F.col("sum_abs") / F.col("count")).alias("mean_absolute_mistake"),
                      "max_mistake", "min_mistake")


def start_report(spark: SparkSession, source: str, target: str, checkpoint: str, trigger_seconds: int = 60):
    """Run the stream; every micro-batch overwrites ``target`` with the full report."""
    def write(batch: DataFrame, epoch: int) -> None:
        finish_report(batch).write.mode("overwrite").parquet(target)

    return (band_report_stream(spark, source).writeStream.outputMode("complete")
            .option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(processingTime=f"{trigger_seconds} seconds").start())
