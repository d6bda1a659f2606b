"""Integrity checks. Each gives violations (video_id, check, severity, entity, detail); a clean input gives none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .faces import identity_agreement


def _found(df: DataFrame, check: str, entity: Column, detail: Column, severity: str = "error") -> DataFrame:
    return df.select("video_id", F.lit(check).alias("check"), F.lit(severity).alias("severity"), entity.cast("string").alias("entity"), detail.cast("string").alias("detail"))


def check_ids(tiles: DataFrame) -> DataFrame:
    """Ids are 0..n-1 in time order."""
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("start", "id")) - 1
    return _found(tiles.withColumn("_n", n).where("_n <> id"), "ids", F.col("id"), F.col("_n"))


def check_coverage(tiles: DataFrame, videos: DataFrame, frames: float = 1.5, exact: bool = False, seconds: float = 0.1) -> DataFrame:
    """Tiles begin at 0 and end at the duration, within ``frames`` frames; a video without tiles fails.

    ``exact``: they begin at 0 exactly and end within ``seconds``.
    """
    ends = tiles.groupBy("video_id").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    df = videos.select("video_id", "duration", "fps").join(ends, "video_id", "left")
    near = F.lit(frames) / F.col("fps")
    bad = F.col("a").isNull() | (F.abs("a") > (F.lit(0.0) if exact else near)) | (F.abs(F.col("b") - F.col("duration")) > (F.lit(seconds) if exact else near))
    return _found(df.where(bad), "coverage", F.col("video_id"), F.concat_ws("-", F.coalesce(F.col("a").cast("string"), F.lit("none")), F.col("b").cast("string")))


def check_contiguity(tiles: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    after = F.lead("start").over(Window.partitionBy("video_id").orderBy("start", "id"))
    return _found(tiles.withColumn("_next", after).where(F.abs(F.col("end") - F.col("_next")) > tolerance), "contiguity", F.col("id"), F.col("_next"))


def check_positive_length(tiles: DataFrame) -> DataFrame:
    return _found(tiles.where("end <= start"), "positive_length", F.col("id"), F.col("end"))


def check_scene_on_shot(scenes: DataFrame, shots: DataFrame) -> DataFrame:
    """A scene's start is some shot's start, at 3 decimals."""
    starts = shots.select("video_id", F.round("start", 3).alias("_at")).distinct()
    return _found(scenes.withColumn("_at", F.round("start", 3)).join(starts, ["video_id", "_at"], "left_anti"), "scene_on_shot", F.col("id"), F.col("start"))


def check_min_scene(scenes: DataFrame, shortest: float = 30.0) -> DataFrame:
    return _found(scenes.where(F.col("end") - F.col("start") < shortest), "min_scene", F.col("id"), F.round(F.col("end") - F.col("start"), 3), "warning")


def check_description(scenes: DataFrame) -> DataFrame:
    return _found(scenes.where("description is null or trim(description) = ''"), "description", F.col("scene_id"), F.lit("blank"))


def check_timecodes(codes: DataFrame, scenes: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """``codes(video_id, scene_id, group, pos, ts)``: no repeats, sorted, inside their scene."""
    order = Window.partitionBy("video_id", "scene_id", "group").orderBy("pos")
    prev = F.lag("ts").over(order)
    df = codes.withColumn("_prev", prev).join(scenes.select("video_id", F.col("id").alias("scene_id"), "start", "end"), ["video_id", "scene_id"], "left")
    what = (
        F.when(F.col("ts") == F.col("_prev"), "duplicate").when(F.col("ts") < F.col("_prev"), "unsorted")
        .when(F.col("start").isNull() | (F.col("ts") < F.col("start") - tolerance) | (F.col("ts") >= F.col("end") + tolerance), "outside")
    )
    return _found(df.withColumn("_w", what).where("_w is not null"), "timecodes", F.concat_ws("/", "scene_id", "group", "ts"), F.col("_w"))


def check_files(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Files and expected paths (video_id, path) match one to one."""
    a = files.select("video_id", "path").distinct().withColumn("_f", F.lit(1))
    b = expected.select("video_id", "path").distinct().withColumn("_e", F.lit(1))
    df = a.join(b, ["video_id", "path"], "full_outer").where("_f is null or _e is null")
    return _found(df, "files", F.col("path"), F.when(F.col("_f").isNull(), "missing file").otherwise("no timecode"))


def check_folders(files: DataFrame, codes: DataFrame, scenes: DataFrame, markers: bool = True) -> DataFrame:
    """The group folders of a scene are the groups of its timecodes; a scene without groups has its marker.

    Without ``markers`` they are left out, as a listing by Spark's readers does not show them.
    """
    parts = F.split("path", "/")
    f = files.select("video_id", F.regexp_extract(parts[0], r"(\d+)", 1).cast("long").alias("scene_id"), parts[1].alias("folder")).distinct()
    e = codes.select("video_id", F.col("scene_id").cast("long").alias("scene_id"), F.concat(F.lit("group"), "group").alias("folder")).distinct()
    ids = scenes.select("video_id", F.col("id").cast("long").alias("scene_id"))
    e = e.union(ids.join(e, ["video_id", "scene_id"], "left_anti").select("video_id", "scene_id", F.lit("_no_faces")))
    if not markers:
        f, e = f.where("folder <> '_no_faces'"), e.where("folder <> '_no_faces'")
    df = f.withColumn("_f", F.lit(1)).join(e.withColumn("_e", F.lit(1)), ["video_id", "scene_id", "folder"], "full_outer").where("_f is null or _e is null")
    return _found(df, "folders", F.concat_ws("/", "scene_id", "folder"), F.when(F.col("_f").isNull(), "missing folder").otherwise("unexpected folder"))


def check_citations(scenes: DataFrame, presence: DataFrame) -> DataFrame:
    """Groups that a description cites are on screen in its scene."""
    cited = scenes.select("video_id", "scene_id", F.explode(F.array_distinct(F.regexp_extract_all("description", F.lit(r"\b(group\d+)\b")))).alias("grp"))
    return _found(cited.join(presence, ["video_id", "scene_id", "grp"], "left_anti"), "citations", F.col("scene_id"), F.col("grp"))


def check_report_links(reports: DataFrame, files: DataFrame, pattern: str = "src='([^']+)'") -> DataFrame:
    """Links in ``reports(video_id, html)`` that are not in ``files(video_id, path)``."""
    links = reports.select("video_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(pattern)))).alias("path"))
    return _found(links.distinct().join(files.select("video_id", "path").distinct(), ["video_id", "path"], "left_anti"), "report_links", F.col("path"), F.lit("missing"))


def check_identity(crops: DataFrame, centroids: DataFrame, least: float = 0.9) -> DataFrame:
    """At least ``least`` of a video's crops are nearest to their own group; no crops pass."""
    n = identity_agreement(crops, centroids).groupBy("video_id").agg(F.sum("total").alias("t"), F.sum("agreeing").alias("a"))
    return _found(n.where(F.col("a") < least * F.col("t")), "identity", F.col("video_id"), F.concat_ws("/", "a", "t"))


SCENE_KEYS = ("id", "start_seconds", "end_seconds", "description", "faces")
SHOT_KEYS = ("id", "start_seconds", "end_seconds")


def check_schema(docs: DataFrame, ordered: bool = True) -> DataFrame:
    """``docs(video_id, json)``: exact keys on every level, numbers where they belong, group names, and descriptions of over 40 characters."""
    number = lambda item, k: F.schema_of_variant(F.try_variant_get(F.try_parse_json(item), f"$.{k}", "variant")).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    same = lambda c, keys: (c == F.array(*map(F.lit, keys))) if ordered else (F.array_sort(c) == F.array_sort(F.array(*map(F.lit, keys))))
    top = docs.where(F.col("json").isNull() | ~F.coalesce(same(F.json_object_keys("json"), ("shots", "scenes")), F.lit(False)))
    out = _found(top, "schema", F.lit("document"), F.lit("keys"))
    for part, keys in (("shots", SHOT_KEYS), ("scenes", SCENE_KEYS)):
        items = F.from_json(F.get_json_object("json", f"$.{part}"), "array<string>")
        each = docs.select("video_id", F.posexplode(items).alias("n", "item"))
        out = out.union(_found(each.where(~F.coalesce(same(F.json_object_keys("item"), keys), F.lit(False))), "schema", F.concat_ws(" ", F.lit(part), "n"), F.lit("keys")))
        typed = number("item", "id") & number("item", "start_seconds") & number("item", "end_seconds")
        out = out.union(_found(each.where(~F.coalesce(typed, F.lit(False))), "schema", F.concat_ws(" ", F.lit(part), "n"), F.lit("types")))
        if part == "scenes":
            groups = each.select("video_id", "n", F.explode(F.json_object_keys(F.get_json_object("item", "$.faces"))).alias("g"))
            out = out.union(_found(groups.where(~F.col("g").rlike(r"^group\d+$")), "schema", F.concat_ws(" ", F.lit("scenes"), "n"), F.col("g")))
            short = F.coalesce(F.length(F.get_json_object("item", "$.description")), F.lit(0)) <= 40
            out = out.union(_found(each.where(short), "schema", F.concat_ws(" ", F.lit("scenes"), "n"), F.lit("description")))
    return out


def validation_summary(violations: DataFrame, videos: DataFrame, messages: int = 50, totals: dict[str, DataFrame] | None = None) -> DataFrame:
    """(video_id, errors, warnings, messages, passed, ...): counts and the first messages of each video.

    ``totals`` names tables whose rows of each video are counted, too.
    """
    order = Window.partitionBy("video_id", "severity").orderBy("check", "entity", "detail")
    v = violations.withColumn("_n", F.row_number().over(order))
    text = F.when(F.col("_n") <= messages, F.concat_ws(" ", "check", "entity", "detail"))
    n = v.groupBy("video_id").agg(
        F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("messages"),
    )
    df = videos.select("video_id").join(n, "video_id", "left").fillna(0, ["errors", "warnings"]).fillna("", ["messages"])
    df = df.withColumn("passed", F.col("errors") == 0)
    for name, table in (totals or {}).items():
        df = df.join(table.groupBy("video_id").agg(F.count("*").alias(name)), "video_id", "left").fillna(0, [name])
    return df
