"""Replies as a stream: validated as they arrive, each report written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marrow.operators.extract import as_results
from marrow.operators.validate import validate

REPLIES = "report_id string, cancer_type string, raw_text string, received_at timestamp"


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(REPLIES).json(path)


def validated_once(replies: DataFrame, late: str = "7 days") -> DataFrame:
    """Validated records, the first of each report within the watermark."""
    return validate(replies.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["report_id"]))


def write_validated(replies: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append results to ``out``; a batch that is replayed after a failure replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        as_results(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = validated_once(replies).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_status(replies: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts of each status in tumbling windows of arrival time."""
    return validate(replies.withWatermark("received_at", late)).groupBy(F.window("received_at", width), "validation_status").agg(F.count(F.lit(1)).alias("n"))
