"""Candidate triage and the resolution ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFERRED = (1080, 720)


def first_occurrences(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key by ``order``."""
    rest = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return picked.select(key, *(F.col(f"r.{c}").alias(c) for c in rest)).select(*rows.columns)


def triage(candidates: DataFrame, existing: DataFrame, archive: DataFrame, low_quality: DataFrame, key: str = "video_id") -> DataFrame:
    """Adds ``outcome``: existing, archived, low_quality or queued, the first that holds.

    The three sets meet in one aggregation by key, so candidates are joined once; a key
    set of any size works, and the optimizer broadcasts a small one.
    """
    sets = [(existing, "existing"), (archive, "archived"), (low_quality, "low_quality")]
    marked = None
    for rank, (rows, _) in enumerate(sets):
        part = rows.select(F.col(key), F.lit(rank).alias("_rank"))
        marked = part if marked is None else marked.unionByName(part)
    known = marked.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_rank").alias("_rank"))
    outcome = F.when(F.col("_rank") == 0, sets[0][1]).when(F.col("_rank") == 1, sets[1][1]).when(F.col("_rank") == 2, sets[2][1]).otherwise("queued")
    return candidates.join(known, key, "left").withColumn("outcome", outcome).drop("_rank")


def counts(rows: DataFrame, column: str = "outcome") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def _video(f: Column) -> Column:
    """A format holds video unless its codec says none; a missing codec counts as video."""
    return ~f["vcodec"].eqNullSafe(F.lit("none")) & f["height"].isNotNull()


def heights(formats: Column | str) -> Column:
    """Sorted distinct heights of the formats with video."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(formats, _video), lambda f: f["height"])))


def resolution_ladder(media: DataFrame) -> DataFrame:
    """media (video_id, formats): chosen height, outcome and the best height there is.

    1080 if there, else 720, else the least above 720, else none.
    """
    h = media.withColumn("_h", heights("formats"))
    chosen = F.coalesce(*(F.when(F.array_contains("_h", p), F.lit(p)) for p in PREFERRED), F.array_min(F.filter("_h", lambda x: x > PREFERRED[-1])))
    best = F.array_max("_h")
    out = h.withColumn("chosen_height", chosen).withColumn("best_height", best).drop("_h")
    return out.withColumn("outcome", F.when(F.col("chosen_height").isNull(), "low_quality").otherwise("downloaded")).withColumn(
        "best_available_resolution", F.coalesce(F.concat(F.col("best_height").cast("string"), F.lit("p")), F.lit("none"))
    )


def ladder_rows(formats: DataFrame, key: str) -> DataFrame:
    """The ladder over one row per format (key, vcodec, height): conditional aggregates, no arrays."""
    video = ~F.col("vcodec").eqNullSafe(F.lit("none")) & F.col("height").isNotNull()
    h = F.when(video, F.col("height"))
    return formats.groupBy(key).agg(
        F.coalesce(
            *(F.max(F.when(h == p, h)) for p in PREFERRED),
            F.min(F.when(h > PREFERRED[-1], h)),
        ).alias("chosen_height"),
        F.max(h).alias("best_height"),
    )
