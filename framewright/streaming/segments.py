"""Structured Streaming forms: session segments, tumbling windows, micro-batched sinks.

Frame numbers become event times (one frame is one second), so the batch operators have
exact streaming counterparts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def frame_time(frame: Column | str) -> Column:
    return F.timestamp_seconds(F.col(frame) if isinstance(frame, str) else frame)


def frame_number(time: Column | str) -> Column:
    return F.unix_seconds(F.col(time) if isinstance(time, str) else time)


def session_segments(detections: DataFrame, stride: int, tolerance: int, watermark: str | None = None) -> DataFrame:
    """(video_id, start_frame, end_frame, n_detections) by session_window; batch or stream.

    A session holds detections up to stride + tolerance frames apart.  A stream needs a
    watermark; segments then leave it once no detection can join them any more.
    """
    rows = detections.withColumn("_t", frame_time("frame_idx"))
    if watermark:
        rows = rows.withWatermark("_t", watermark)
    # the end of a session window is exclusive, a step of stride + tolerance still joins
    gap = F.session_window("_t", f"{stride + tolerance} seconds 1 milliseconds")
    out = rows.groupBy("video_id", gap.alias("_w")).agg(F.count("*").alias("n_detections"), F.max("frame_idx").alias("_last"))
    return out.select("video_id", frame_number("_w.start").alias("start_frame"), (F.col("_last") + stride - 1).alias("end_frame"), "n_detections")


def tumbling_counts(detections: DataFrame, frames: int, watermark: str | None = None) -> DataFrame:
    """(video_id, window, n_detections): windows of a fixed number of frames from frame 0 on."""
    rows = detections.withColumn("_t", frame_time("frame_idx"))
    if watermark:
        rows = rows.withWatermark("_t", watermark)
    out = rows.groupBy("video_id", F.window("_t", f"{frames} seconds").alias("_w")).agg(F.count("*").alias("n_detections"))
    return out.select("video_id", F.expr(f"cast(unix_seconds(_w.start) div {frames} as int)").alias("window"), "n_detections")


def read_detections(spark: SparkSession, folder: str, schema, files: int = 16) -> DataFrame:
    """Detections as they land in a folder, ``files`` files a micro-batch (backpressure)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def write_once(stream: DataFrame, out: str, checkpoint: str, key: str = "segment_uid", mode: str = "append") -> StreamingQuery:
    """Micro-batched sink that a restart cannot double.

    Each batch overwrites the partition named after it, so a batch that runs again after
    a failure replaces what it wrote before.
    """

    def flush(batch: DataFrame, number: int) -> None:
        unique = batch.dropDuplicates([key]) if key in batch.columns else batch
        unique.write.mode("overwrite").option("compression", "zstd").parquet(f"{out.rstrip('/')}/batch={number}")

    return stream.writeStream.outputMode(mode).foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
