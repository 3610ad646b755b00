"""Sources and sinks: id lists, archives, media listings, reports, shards, status logs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

# Media suffixes that each stage accepts
INGEST_SUFFIXES = (".mp4", ".mkv", ".mov", ".webm", ".avi")
NORMALIZE_SUFFIXES = (".mp4", ".mkv", ".mov", ".avi", ".webm", ".m4v", ".mpg", ".mpeg", ".ts")
DETECT_SUFFIXES = (".mp4", ".mkv", ".mov", ".webm", ".m4v")
REPORT_SCHEMA = (
    "video_id string, src string, dst string, status string, mode string, src_fps double, vfr boolean, out_fps double, "
    "dur_delta_ms double, av_delta_ms double, has_audio boolean, error string, _corrupt_record string"
)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _place() -> Column:
    """Where a row stands: file, part of the file, row; by these, rows of several files keep an order."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, video_id): first CSV column, trimmed, of length 11; file order, repeats kept."""
    rows = spark.read.schema("c0 string").option("mode", "PERMISSIVE").csv(path)
    rows = rows.select(_place().alias("pos"), F.trim("c0").alias("video_id"))
    return rows.where(F.length("video_id") == 11)


def id_archive(spark: SparkSession, path: str) -> DataFrame:
    """(video_id): distinct trimmed lines; no file, no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "video_id string")
    return spark.read.text(path).select(F.trim("value").alias("video_id")).where("video_id <> ''").distinct()


def low_quality_log(spark: SparkSession, path: str) -> DataFrame:
    """(video_id): distinct first columns; the header is data that never is an id."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "video_id string")
    rows = spark.read.schema("c0 string, c1 string").csv(path)
    return rows.select(F.trim("c0").alias("video_id")).where("video_id <> ''").distinct()


def listing(spark: SparkSession, folder: str, suffixes=NORMALIZE_SUFFIXES, recursive: bool = True) -> DataFrame:
    """(path, size) of media files, partial downloads left out; contents are not read.

    Spark's file sources never list empty files, so a file without a byte is not a medium.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    rows = rows.select("path", F.col("length").alias("size"))
    return rows.where(X.suffix("path").isin(*suffixes) & ~F.col("path").endswith(".part"))


def existing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id): distinct ids in the names of non-empty files of a folder."""
    rows = listing(spark, folder, INGEST_SUFFIXES, recursive=False).where("size > 0")
    return rows.select(X.video_id(X.base_name("path")).alias("video_id")).where("video_id is not null").distinct()


def sorted_listing(spark: SparkSession, folder: str, suffixes=NORMALIZE_SUFFIXES) -> DataFrame:
    return listing(spark, folder, suffixes).orderBy("path")


def undone(listed: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose stem is not in done (video_id), in path order."""
    return listed.withColumn("video_id", X.stem("path")).join(done, "video_id", "left_anti").orderBy("path")


def done_list(spark: SparkSession, path: str) -> DataFrame:
    """(video_id): white-space separated names."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "video_id string")
    words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("video_id"))
    return words.where("video_id <> ''").distinct()


def report(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines report with its positions; broken lines and records without an id go."""
    rows = spark.read.schema(REPORT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    rows = rows.withColumn("position", _place())
    return rows.where("_corrupt_record is null and video_id is not null").drop("_corrupt_record")


def shards(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All Parquet shards of a folder under one schema."""
    return spark.read.schema(schema).parquet(folder)


def status_log(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.shard import STATUS_SCHEMA

    if not _exists(spark, folder):
        return spark.createDataFrame([], STATUS_SCHEMA)
    return spark.read.schema(STATUS_SCHEMA).parquet(folder)


def head_tail(spark: SparkSession, folder: str, head: int = 16384) -> DataFrame:
    """(path, length, fingerprint) of files; large files are read at both ends only."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def read(batches):
        import hashlib

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            out = []
            for path, length in zip(pdf["path"], pdf["length"]):
                store, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    raw = f.read_at(min(head, length), 0)
                    if length > 2 * head:
                        raw += f.read_at(head, length - head)
                out.append(hashlib.md5(raw + str(length).encode()).hexdigest()[:16])
            yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "fingerprint": out})

    return listed.mapInPandas(read, "path string, length long, fingerprint string")


# ---------------------------------------------------------------- sinks


def append_archive(ids: DataFrame, folder: str) -> None:
    ids.select("video_id").write.mode("append").text(folder)


def append_low_quality(rows: DataFrame, folder: str) -> None:
    out = rows.select("video_id", F.coalesce("best_available_resolution", F.lit("none")).alias("best_available_resolution"))
    out.write.mode("append").option("header", "true").csv(folder)


def write_report(rows: DataFrame, folder: str) -> None:
    """JSON lines; null fields are left out."""
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(folder)


def write_shards(rows: DataFrame, folder: str, mode: str = "append") -> None:
    rows.write.mode(mode).option("compression", "zstd").parquet(folder)


def compact(spark: SparkSession, folder: str, schema, out: str, files: int = 1) -> None:
    shards(spark, folder, schema).coalesce(files).write.mode("overwrite").option("compression", "zstd").parquet(out)


def write_preview(rows: DataFrame, folder: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", "true").csv(folder)


def append_status(rows: DataFrame, folder: str, bucket: str | None = None) -> None:
    writer = rows.write.mode("append").option("compression", "zstd")
    (writer.partitionBy(bucket) if bucket else writer).parquet(folder)


def run_summary(totals: DataFrame, cfg) -> str:
    """Settings and totals of a run as JSON text; totals is one row."""
    from dataclasses import asdict

    row = totals.first()
    return json.dumps({"params": asdict(cfg), "param_hash": cfg.param_hash(), "totals": row.asDict()}, sort_keys=True, default=str)
