"""Shards, resume and status logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

STATUS_SCHEMA = "window_uid string, status string, error string, body_side_px double, silent_audio_fallback boolean, elapsed_s double"


def with_bucket(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.withColumn("bucket", X.stable_bucket(key, n))


def finished(status: DataFrame, key: str = "window_uid") -> DataFrame:
    """Distinct keys with an ok row in an append-only log."""
    return status.where("status = 'ok'").select(key).distinct()


def pending(manifest: DataFrame, status: DataFrame, key: str = "window_uid") -> DataFrame:
    """Rows of the manifest without an ok row in the log."""
    return manifest.join(finished(status, key), key, "left_anti")


def shard(manifest: DataFrame, status: DataFrame, task: int, tasks: int, limit: int = 0, key: str = "window_uid") -> DataFrame:
    """What one task still has to do, by key; ``limit`` 0 takes all."""
    rows = pending(with_bucket(manifest, key, tasks).where(F.col("bucket") == task), status, key).orderBy(key)
    return rows.limit(limit) if limit else rows


def placed(manifest: DataFrame, tasks: int, key: str = "window_uid") -> DataFrame:
    """The manifest laid out with a partition for each shard, sorted inside."""
    return with_bucket(manifest, key, tasks).repartition(tasks, "bucket").sortWithinPartitions("bucket", key)


def append_status(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both logs by column name; columns that one lacks are null."""
    return old.unionByName(new, allowMissingColumns=True)


def latest_status(log: DataFrame, key: str = "window_uid", order: str = "attempt") -> DataFrame:
    """The last row of every key of an append-only log."""
    rest = [c for c in log.columns if c != key]
    picked = log.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return picked.select(key, *(F.col(f"r.{c}").alias(c) for c in rest)).select(*log.columns)


def render_counters(log: DataFrame) -> DataFrame:
    ok = F.col("status") == "ok"
    return log.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.sum("elapsed_s").alias("elapsed_s"))
