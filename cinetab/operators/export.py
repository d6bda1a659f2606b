"""De-duplicated appearances, nested result documents, and report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import hms
from .joins import interval_join


def dedupe_faces(faces: DataFrame) -> DataFrame:
    """Of the detections of a group at one time, the one with the highest score (ties: smallest det_id)."""
    order = Window.partitionBy("video_id", "group", "ts").orderBy(F.desc("det_score"), "det_id")
    return faces.where("group > 0").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def appearance_intervals(appearances: DataFrame, gap: float = 1.5) -> DataFrame:
    """(video_id, scene_id, group, start, end, n): times of a group in a scene, joined across gaps of at most ``gap``."""
    order = Window.partitionBy("video_id", "scene_id", "group").orderBy("ts")
    fresh = F.when(F.col("ts") - F.lag("ts").over(order) <= gap, 0).otherwise(1)
    df = appearances.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order))
    return df.groupBy("video_id", "scene_id", "group", "_run").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("n")).drop("_run")


def scene_appearances(faces: DataFrame, scenes: DataFrame) -> DataFrame:
    """De-duplicated faces with the scene that holds them."""
    return interval_join(dedupe_faces(faces), scenes, "ts", "id", "scene_id")


def scene_face_map(faces: DataFrame, scenes: DataFrame) -> DataFrame:
    """(video_id, scene_id, faces map<string, array<double>>): times of each group; an empty map without faces."""
    seen = scene_appearances(faces, scenes).groupBy("video_id", "scene_id", "group").agg(F.sort_array(F.collect_set(F.round("ts", 2))).alias("times"))
    entry = F.struct(F.concat(F.lit("group"), "group").alias("key"), F.col("times").alias("value"))
    maps = seen.groupBy("video_id", "scene_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("faces"))
    ids = scenes.select("video_id", F.col("id").alias("scene_id"))
    empty = F.create_map().cast("map<string,array<double>>")
    return ids.join(maps, ["video_id", "scene_id"], "left").withColumn("faces", F.coalesce("faces", empty))


def output_doc(shots: DataFrame, scenes: DataFrame, faces: DataFrame, descriptions: DataFrame) -> DataFrame:
    """One row a video: shots and scenes as arrays of structs, with descriptions and face maps.

    A row is as large as one video's timeline.
    """
    tile = lambda: F.struct(F.col("id"), F.round("start", 3).alias("start_seconds"), F.round("end", 3).alias("end_seconds"))
    s = shots.groupBy("video_id").agg(F.array_sort(F.collect_list(tile())).alias("shots"))
    rows = scenes.join(scene_face_map(faces, scenes).withColumnRenamed("scene_id", "id"), ["video_id", "id"])
    rows = rows.join(descriptions.select("video_id", F.col("scene_id").alias("id"), "description"), ["video_id", "id"], "left")
    scene = F.struct(
        "id", F.round("start", 3).alias("start_seconds"), F.round("end", 3).alias("end_seconds"), F.coalesce("description", F.lit("")).alias("description"), "faces"
    )
    order = F.array_sort(F.collect_list(scene), lambda a, b: (a["id"] - b["id"]).cast("int"))
    return s.join(rows.groupBy("video_id").agg(order.alias("scenes")), "video_id", "left").withColumn("scenes", F.coalesce("scenes", F.expr("filter(scenes, x -> false)"), F.col("scenes")))


def extended_doc(
    doc: DataFrame, scenes: DataFrame, answers: DataFrame, appearances: DataFrame, videos: DataFrame, stats: DataFrame, method: DataFrame
) -> DataFrame:
    """The result document with what is known besides: video fields, group statistics, how scenes were found, and of each scene
    first and last shot, title (an answer's, else the scene's own), theme, contributors, events, model, and its groups' times
    and intervals as maps.

    ``scenes`` have an optional title; ``answers`` as ``parse_answers`` gives them, one a scene.
    """
    key = ["video_id", "id"]
    by_group = lambda rows, value: F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("group"), "group").alias("key"), F.col(value).alias("value")))))
    times = appearances.groupBy("video_id", "scene_id", "group").agg(F.transform(F.sort_array(F.collect_list("ts")), hms).alias("v"))
    times = times.groupBy("video_id", F.col("scene_id").alias("id")).agg(by_group(times, "v").alias("faces_hms"))
    spans = appearance_intervals(appearances).groupBy("video_id", "scene_id", "group").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("v"))
    spans = spans.groupBy("video_id", F.col("scene_id").alias("id")).agg(by_group(spans, "v").alias("intervals"))
    own = scenes if "title" in scenes.columns else scenes.withColumn("title", F.lit(None).cast("string"))
    said = answers.select("video_id", F.col("scene_id").alias("id"), F.col("title").alias("_title"), "central_theme", "key_contributors", "events", "model")
    more = own.select(*key, "first_shot", "last_shot", "title").join(said, key, "left").join(times, key, "left").join(spans, key, "left")
    more = more.withColumn("title", F.coalesce("_title", "title")).drop("_title")
    opened = doc.select("video_id", F.explode("scenes").alias("s")).select("video_id", "s.*")
    opened = opened.withColumns({"start_hms": hms(F.col("start_seconds")), "end_hms": hms(F.col("end_seconds"))}).join(more, key, "left")
    opened = opened.withColumns({c: F.coalesce(c, F.map_from_arrays(F.array(), F.array()).cast(dict(more.dtypes)[c])) for c in ("faces_hms", "intervals")})
    numbered = F.collect_list(F.struct(F.col("id"), F.struct(*[c for c in opened.columns if c != "video_id"]).alias("s")))
    full = opened.groupBy("video_id").agg(F.transform(F.array_sort(numbered, lambda a, b: (a["id"] - b["id"]).cast("int")), lambda x: x["s"]).alias("scenes"))
    groups = stats.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("group", "detections", "tracks", "mean_cos_to_centroid", "nearest_group", "nearest_cos"))).alias("groups"))
    return doc.drop("scenes").join(full, "video_id", "left").join(videos, "video_id").join(groups, "video_id", "left").join(method, "video_id", "left")


def folder_counts(appearances: DataFrame, scenes: DataFrame) -> DataFrame:
    """(video_id, scene_id, counts): "groupN: count" by group number, or "no faces"."""
    n = appearances.groupBy("video_id", "scene_id", "group").agg(F.count("*").alias("n"))
    each = F.transform(F.array_sort(F.collect_list(F.struct("group", "n"))), lambda x: F.concat(F.lit("group"), x["group"], F.lit(": "), x["n"]))
    text = n.groupBy("video_id", "scene_id").agg(F.array_join(each, ", ").alias("counts"))
    return scenes.select("video_id", F.col("id").alias("scene_id")).join(text, ["video_id", "scene_id"], "left").fillna("no faces", ["counts"])


def crop_manifest(appearances: DataFrame, scenes: DataFrame) -> DataFrame:
    """(video_id, scene_id, path, det_id): one file a kept face, and a marker for scenes without faces."""
    name = F.format_string("scene_%03d/group%d/t%07.2f.jpg", F.col("scene_id").cast("int"), F.col("group").cast("int"), "ts")
    files = appearances.select("video_id", "scene_id", name.alias("path"), "det_id")
    ids = scenes.select("video_id", F.col("id").alias("scene_id"))
    empty = ids.join(files, ["video_id", "scene_id"], "left_anti")
    return files.union(empty.select("video_id", "scene_id", F.format_string("scene_%03d/_no_faces", F.col("scene_id").cast("int")), F.lit(None).cast("long")))


def scene_report_rows(scenes: DataFrame, appearances: DataFrame, keyframes: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """(video_id, scene_id, shots, group, frames, middle_ts[, frames_at][, title, description]) of each scene and group.

    First, middle and last shot, and each group's middle time. With ``keyframes(video_id, shot_id, k, t)``: the time of each
    of these shots' middle keyframe. With ``words(video_id, scene_id, title, description)``: those.
    """
    key = ["video_id", "scene_id"]
    shot = F.array_distinct(F.array(F.col("first_shot").cast("long"), F.floor((F.col("first_shot") + F.col("last_shot")) / 2).cast("long"), F.col("last_shot").cast("long")))
    rows = scenes.select("video_id", F.col("id").alias("scene_id"), shot.alias("_shots"))
    out = rows.select(*key, F.array_join("_shots", "-").alias("shots"))
    if keyframes is not None:
        each = F.array_sort(F.collect_list(F.struct("k", "t")))
        middle = keyframes.groupBy("video_id", "shot_id").agg(F.element_at(each, (F.floor(F.count("*") / 2) + 1).cast("int"))["t"].alias("t"))
        at = rows.select(*key, F.explode("_shots").alias("shot_id")).join(middle, ["video_id", "shot_id"])
        at = at.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("shot_id", "t"))), lambda x: x["t"]).alias("frames_at"))
        out = out.join(at, key, "left")
    if words is not None:
        out = out.join(words.select(*key, "title", "description"), key, "left")
    times = F.sort_array(F.collect_list("ts"))
    mid = appearances.groupBy(*key, "group").agg(F.count("*").alias("frames"), times.alias("t"))
    mid = mid.select(*key, "group", "frames", F.element_at("t", (F.floor(F.col("frames") / 2) + 1).cast("int")).alias("middle_ts"))
    return out.join(mid, key, "left")
