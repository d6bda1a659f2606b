"""From series of probabilities and cut times to shots, sample times and scenes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import interval_join

#: Runs of tiny shots in a group: a run is a few shots, so that a group of one would cost more than its work.
RUNS = 256


def transition_boundaries(frame_probs: DataFrame, videos: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(video_id, frame, boundary): one per maximal run of frames with prob above the threshold.

    Only frames above it reach the shuffle. A run's frame is its half-even middle plus one.
    """
    hot = frame_probs.where(F.col("prob") > threshold).select("video_id", "frame_idx")
    island = F.col("frame_idx") - F.row_number().over(Window.partitionBy("video_id").orderBy("frame_idx"))
    runs = hot.withColumn("island", island).groupBy("video_id", "island").agg(F.min("frame_idx").alias("a"), F.max("frame_idx").alias("b"))
    runs = runs.withColumn("frame", (F.rint((F.col("a") + F.col("b")) / 2) + 1).cast("long"))
    return runs.join(videos.select("video_id", "fps"), "video_id").select("video_id", "frame", (F.col("frame") / F.col("fps")).alias("boundary"))


def shots_from_boundaries(bounds: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, id, start, end): the tiling of [0, duration) by the distinct inner boundaries, at 4 decimals."""
    v = videos.select("video_id", "duration")
    inner = bounds.join(v, "video_id").where((F.col("boundary") > 0) & (F.col("boundary") < F.col("duration")))
    starts = inner.select("video_id", F.round("boundary", 4).alias("start"), "duration").union(v.select("video_id", F.lit(0.0), "duration")).distinct()
    order = Window.partitionBy("video_id").orderBy("start")
    tiles = starts.select("video_id", (F.row_number().over(order) - 1).alias("id"), "start", F.coalesce(F.lead("start").over(order), F.col("duration")).alias("end"))
    return tiles.where(F.col("end") > F.col("start"))


def histogram_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Bhattacharyya distance of two histograms: 0 for the same shape, 1 without a common bin or with an empty one."""
    total = np.sqrt(a.sum() * b.sum())
    return float(np.sqrt(max(0.0, 1 - np.sqrt(a * b).sum() / total))) if total > 0 else 1.0


def merged_tiles(start: list[float], end: list[float], look: Callable[[float, float], np.ndarray], min_len: float, max_dist: float) -> list[tuple[float, float]]:
    """The tiles of one run after its first tiny one joins the neighbour that it looks like, again and again.

    ``look`` gives the histogram of a tile. Tiles before a merge were passed over for good, but for the one beside
    it; so the search goes on from there and not from the first.
    """
    tiles = list(zip(start, end, strict=True))
    i = 0
    while i < len(tiles):
        if tiles[i][1] - tiles[i][0] < min_len and len(tiles) > 1:
            mine = look(*tiles[i])
            distance, j = min((histogram_distance(mine, look(*tiles[k])), k) for k in (i - 1, i + 1) if 0 <= k < len(tiles))
            if distance < max_dist:
                a = min(i, j)
                tiles[a : a + 2] = [(tiles[a][0], tiles[a + 1][1])]
                i = max(0, a - 1)
                continue
        i += 1
    return tiles


def merge_tiny_shots(shots: DataFrame, frame_hists: DataFrame, videos: DataFrame, min_len: float = 0.4, max_dist: float = 0.3) -> DataFrame:
    """``shots`` renumbered after shots under ``min_len`` s joined the neighbour that looks like them, if one does.

    ``frame_hists(video_id, frame_idx, hist)``; a shot looks like its middle frame, or the video's last frame where that
    is missing. Only a tiny shot starts a merge, so shots that neither are tiny nor have a tiny neighbour stay as they are,
    and of two others side by side neither joins the other: they part a video into runs, which are taken by RUNS, each
    with the frames between its first and last shot. Ties go to the left.
    """
    order = Window.partitionBy("video_id").orderBy("start")
    tiny = (F.col("end") - F.col("start") < min_len).cast("int")
    s = shots.select("video_id", "start", "end", tiny.alias("tiny"))
    s = s.withColumn("beside", F.greatest("tiny", F.lag("tiny", 1, 0).over(order), F.lead("tiny", 1, 0).over(order)))
    fresh = (F.lag("tiny", 1, 0).over(order) == 0) & (F.col("tiny") == 0)
    s = s.withColumn("run", F.sum(fresh.cast("int")).over(order))
    alone = s.where("beside = 0").select("video_id", "start", "end")
    runs = s.where("beside = 1").join(videos.select("video_id", "fps"), "video_id")
    frame = lambda t: F.floor(F.col(t) * F.col("fps"))
    span = runs.groupBy("video_id", "run").agg(F.min(frame("start")).alias("start"), F.max(F.greatest(frame("start") + 2, frame("end") + 1)).alias("end"))
    last = frame_hists.groupBy("video_id").agg(F.max("frame_idx").alias("last"))
    runs = runs.join(last, "video_id", "left")
    # Frames belong to one run or none, but for a shared edge, which either run may need.
    inside = interval_join(frame_hists.select("video_id", "frame_idx", "hist"), span, "frame_idx", "run", "run")
    edge = span.select("video_id", "run", F.explode(F.array("start", F.col("end") - 1, F.col("end") - 2)).alias("frame_idx"))
    edge = edge.join(last, "video_id").select("video_id", "run", F.least("frame_idx", "last").alias("frame_idx")).distinct()
    edge = edge.join(frame_hists.select("video_id", "frame_idx", "hist"), ["video_id", "frame_idx"])
    frames = inside.select("video_id", "run", "frame_idx", "hist").union(edge.select("video_id", "run", "frame_idx", "hist"))

    def merge(tiles: pd.DataFrame, frames: pd.DataFrame) -> pd.DataFrame:
        if not len(tiles):
            return pd.DataFrame({"video_id": [], "start": [], "end": []})
        tiles = tiles.sort_values("start")
        place, hists = {k: i for i, k in enumerate(frames["frame_idx"].tolist())}, frames["hist"].to_numpy()
        fps, end = float(tiles.fps.iloc[0]), tiles["last"].iloc[0]

        def look(a: float, b: float) -> np.ndarray:
            first = int(a * fps)
            middle = (first + max(first + 1, int(b * fps))) // 2
            at = place.get(middle if pd.isna(end) else min(middle, int(end)))
            return np.zeros(1) if at is None else np.asarray(hists[at], float)

        start, stop, run, found = tiles.start.tolist(), tiles.end.tolist(), tiles.run.to_numpy(), []
        edges = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            found += merged_tiles(start[low:high], stop[low:high], look, min_len, max_dist)
        return pd.DataFrame({"video_id": tiles.video_id.iloc[0], "start": [a for a, _ in found], "end": [b for _, b in found]})

    block = F.floor(F.col("run") / RUNS).alias("block")
    tiles = runs.select("video_id", block, "run", "start", "end", "fps", "last").groupBy("video_id", "block")
    frames = frames.select("video_id", block, "frame_idx", "hist").groupBy("video_id", "block")
    merged = tiles.cogroup(frames).applyInPandas(merge, "video_id long, start double, end double")
    number = F.row_number().over(Window.partitionBy("video_id").orderBy("start")) - 1
    return alone.union(merged).select("video_id", number.alias("id"), "start", "end")


def keyframe_times(shots: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, shot_id, k, t): 50 % of a shot under a second, else 25, 50 and 75 %, clamped near the end.

    Of keyframes with one time, the last one counts.
    """
    length = F.col("end") - F.col("start")
    at = F.when(length < 1.0, F.array(F.lit(0.5))).otherwise(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    df = shots.join(videos.select("video_id", "duration", "fps"), "video_id").select(
        "video_id", F.col("id").alias("shot_id"), "start", length.alias("length"), (F.col("duration") - 1.5 / F.col("fps")).alias("last"), F.posexplode(at).alias("k", "share")
    )
    df = df.withColumn("t", F.least(F.col("start") + F.col("length") * F.col("share"), F.col("last")))
    order = Window.partitionBy("video_id", "t").orderBy(F.desc("shot_id"), F.desc("k"))
    return df.withColumn("n", F.row_number().over(order)).where("n = 1").select("video_id", "shot_id", "k", "t")


def sample_times(shots: DataFrame, videos: DataFrame, interval: float = 1.0) -> DataFrame:
    """(video_id, t): the grid up to near the end, plus the middle of shots without a grid point.

    A middle within 0.1 s of a grid point is left out. Middles are rounded as decimals: half of a sum like
    0.22499999999999998 counts as 0.225 and goes up.
    """
    v = videos.select("video_id", (F.col("duration") - 1.5 / F.col("fps")).alias("last"))
    count = F.ceil(F.col("last") / interval).cast("int")
    grid = v.where("last > 0").select("video_id", "last", F.explode(F.sequence(F.lit(0), count - 1)).alias("k"))
    grid = grid.select("video_id", F.round(F.col("k") * interval, 2).alias("t"), "last").where("t < last").drop("last")
    first = F.ceil(F.col("start") / interval) * interval
    middle = F.round(F.least((F.col("start") + F.col("end")) / 2, F.col("last")).cast("decimal(30, 15)"), 2).cast("double")
    off = F.abs(middle - F.rint(middle / interval) * interval)
    lone = shots.join(v, "video_id").where((first >= F.col("end")) | (first >= F.col("last"))).where(off >= 0.1).select("video_id", middle.alias("t"))
    return grid.union(lone).distinct()


def scenes_from_cuts(shots: DataFrame, cuts: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(video_id, id, start, end, first_shot, last_shot[, title]): runs of shots; a cut off any shot's start is ignored.

    ``titles(video_id, id, title)`` go by the scene's number; scenes beyond them have none.
    """
    marks = cuts.select("video_id", F.round("time", 4).alias("_at")).distinct().withColumn("_cut", F.lit(1))
    s = shots.withColumn("_at", F.round("start", 4)).join(marks, ["video_id", "_at"], "left")
    order = Window.partitionBy("video_id").orderBy("id")
    flag = F.when((F.col("id") > 0) & F.col("_cut").isNotNull(), 1).otherwise(0)
    s = s.withColumn("_flag", flag).withColumn("scene", F.sum("_flag").over(order))
    scenes = s.groupBy("video_id", "scene").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("id").alias("first_shot"), F.max("id").alias("last_shot")
    ).select("video_id", F.col("scene").alias("id"), "start", "end", "first_shot", "last_shot")
    return scenes if titles is None else scenes.join(titles.select("video_id", "id", "title"), ["video_id", "id"], "left")


def interval_summary(intervals: DataFrame) -> DataFrame:
    length = F.col("end") - F.col("start")
    return intervals.groupBy("video_id").agg(
        F.count("*").alias("n"), F.percentile(length, F.lit(0.5)).alias("median_s"), F.min(length).alias("min_s"), F.max(length).alias("max_s")
    )


def transcript_summary(segments: DataFrame) -> DataFrame:
    text = F.trim("text")
    words = F.when(text == "", 0).otherwise(F.size(F.split(text, r"\s+")))
    return segments.groupBy("video_id").agg(F.count("*").alias("segments"), F.sum(words).alias("words"))


def keyframe_coverage(times: DataFrame, frames: DataFrame, shots: DataFrame) -> DataFrame:
    """(video_id, shot_id, n_frames, frames): which of a shot's keyframes are among ``frames(video_id, t)``, in order; shots without any have 0."""
    got = times.join(frames.select("video_id", "t").distinct(), ["video_id", "t"], "left_semi").groupBy("video_id", "shot_id")
    got = got.agg(F.count("*").alias("n_frames"), F.sort_array(F.collect_list("t")).alias("frames"))
    all_shots = shots.select("video_id", F.col("id").alias("shot_id")).join(got, ["video_id", "shot_id"], "left").fillna(0, ["n_frames"])
    return all_shots.withColumn("frames", F.coalesce("frames", F.array().cast("array<double>")))


def frame_lookup(times: DataFrame, frames: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, t, frame_idx) of requested times whose nearest frame (half-even) exists."""
    t = times.join(videos.select("video_id", "fps"), "video_id").withColumn("frame_idx", F.rint(F.col("t") * F.col("fps")).cast("long"))
    return t.join(frames.select("video_id", "frame_idx").distinct(), ["video_id", "frame_idx"]).select("video_id", "t", "frame_idx")
