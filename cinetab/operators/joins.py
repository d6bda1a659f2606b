"""As-of, interval, band and same-frame joins on (video_id, time). Nothing compares all rows of a video."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _last_before(points: DataFrame, marks: DataFrame, ts: str, width: float) -> DataFrame:
    """``points`` with ``_mark``: that of the last of ``marks(video_id, _t, _mark)`` at or before the time, or null.

    Marks and points are sorted together inside buckets of ``width`` seconds, so that one long video is many
    groups. The last mark of each bucket, a row a bucket, is carried on to the buckets after it.
    """
    names = points.columns
    bucket = F.floor(F.col("_t") / width).alias("_bucket")
    kind = marks.schema["_mark"].dataType
    none = F.lit(None)
    p = points.select("video_id", F.col(ts).cast("double").alias("_t"), F.lit(1).alias("_kind"), none.cast(kind).alias("_mark"), F.struct(*names).alias("_row"))
    m = marks.select("video_id", F.col("_t").cast("double").alias("_t"), F.lit(0).alias("_kind"), "_mark", none.cast(p.schema["_row"].dataType).alias("_row"))
    both = p.union(m).select("*", bucket)
    here = Window.partitionBy("video_id", "_bucket").orderBy("_t", "_kind")
    found = both.withColumn("_here", F.last("_mark", ignorenulls=True).over(here)).where("_kind = 1")
    last = both.groupBy("video_id", "_bucket").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_t", "_mark"))).alias("_last"))
    earlier = Window.partitionBy("video_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("video_id", "_bucket", F.last("_last._mark", ignorenulls=True).over(earlier).alias("_carried"))
    return found.join(last, ["video_id", "_bucket"]).select("video_id", "_t", "_row", F.coalesce("_here", "_carried").alias("_mark"))


def asof_shot(points: DataFrame, shots: DataFrame, ts: str = "ts", width: float = 3600.0) -> DataFrame:
    """``points`` with shot_id: the last shot that starts at or before the time, clipped to the first and last shot.

    Points of videos without shots get null. Points' own columns are kept.
    """
    s = shots.select("video_id", F.col("start").alias("_t"), F.col("id").cast("int").alias("_mark"))
    first = shots.groupBy("video_id").agg(F.min("id").cast("int").alias("_first"))
    return _last_before(points, s, ts, width).join(first, "video_id", "left").select("_row.*", F.coalesce("_mark", "_first").alias("shot_id"))


def interval_join(points: DataFrame, intervals: DataFrame, ts: str = "ts", id_col: str = "id", out: str = "scene_id", width: float = 3600.0) -> DataFrame:
    """``points`` with the id of the interval that holds them (start <= t < end); others are dropped.

    Intervals of a video do not overlap, so the last start before a point decides: as-of, then the end.
    """
    s = intervals.select("video_id", F.col("start").alias("_t"), F.struct(F.col(id_col).alias("id"), F.col("end").alias("end")).alias("_mark"))
    return _last_before(points, s, ts, width).where(F.col("_t") < F.col("_mark.end")).select("_row.*", F.col("_mark.id").alias(out))


def band_join(points: DataFrame, windows: DataFrame, ts: str, width: float = 60.0) -> DataFrame:
    """Pairs of ``windows(video_id, ..., lo, hi)`` and ``points`` with lo <= t < hi.

    Windows are exploded to the ``width``-second buckets that they touch and meet points by equi-join.
    """
    w = windows.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    p = points.withColumn("_bucket", F.floor(F.col(ts) / width))
    return w.join(p, ["video_id", "_bucket"]).where((F.col(ts) >= F.col("lo")) & (F.col(ts) < F.col("hi"))).drop("_bucket")


def same_frame_pairs(tracks: DataFrame) -> DataFrame:
    """Distinct (video_id, a, b), a < b, of tracks that share a time; ``tracks``: (video_id, ts, track_id)."""
    t = tracks.select("video_id", "ts", "track_id").distinct()
    left, right = t.withColumnRenamed("track_id", "a"), t.withColumnRenamed("track_id", "b")
    return left.join(right, ["video_id", "ts"]).where("a < b").select("video_id", "a", "b").distinct()


def neighbour_blocks(shots: DataFrame, window: int = 6, block: int = 256) -> DataFrame:
    """(video_id, block, shot_id, embedding): runs of ``block`` shots, each with the ``window`` shots on either side.

    Vectors keep their type, so that floats are shuffled as such. A shot is in its own block and, near an end, in the next one as well, so 1 + 2 * window / block copies are shuffled; all pairs around a
    boundary of a block are then in that block, to be compared as one matrix.
    """
    first, last = F.floor((F.col("shot_id") - window) / block), F.floor((F.col("shot_id") + window) / block)
    return shots.select("video_id", F.explode(F.sequence(first, last)).alias("block"), F.col("shot_id").cast("long").alias("shot_id"), "embedding")
