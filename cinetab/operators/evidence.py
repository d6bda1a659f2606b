"""What goes into description requests, and what comes out of their answers."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip_text, hms, normalise_group
from ..sources.io import checkpointed
from .joins import band_join, interval_join


def _listed(group: str, n: str):
    """Groups by count, most first, as text."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("n"), F.col(group).alias("g"))))
    return F.array_join(F.transform(rows, lambda x: F.concat(F.lit("group"), x["g"])), ",")


def _text(points: DataFrame, windows: DataFrame, out: str) -> DataFrame:
    hit = band_join(points, windows, "mid")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "text"))), lambda x: x["text"]), " ")
    return hit.groupBy("video_id", "cid").agg(text.alias(out))


def candidate_evidence(candidates: DataFrame, segments: DataFrame, faces: DataFrame) -> DataFrame:
    """(video_id, cid, at, depth, groups, before, after) for each candidate cut."""
    c = candidates.select("video_id", "cid", "time", "depth")
    span = lambda a, b: c.select("video_id", "cid", (F.col("time") - a).alias("lo"), (F.col("time") + b).alias("hi"))
    n = band_join(faces.where("group > 0").select("video_id", "ts", "group"), span(60, 60), "ts").groupBy("video_id", "cid", "group").agg(F.count("*").alias("n"))
    groups = n.groupBy("video_id", "cid").agg(_listed("group", "n").alias("groups"))
    seg = segments.select("video_id", "seg_no", ((F.col("start") + F.col("end")) / 2).alias("mid"), "text")
    key = ["video_id", "cid"]
    df = c.join(groups, key, "left").join(_text(seg, span(20, 0), "before"), key, "left").join(_text(seg, span(0, 20), "after"), key, "left")
    df = df.fillna("-", ["groups"]).fillna("", ["before", "after"])
    return df.select(*key, hms(F.col("time")).alias("at"), "depth", "groups", clip_text(F.col("before"), 250, tail=True).alias("before"), clip_text(F.col("after"), 250).alias("after"))


def window_numbers(ends: list[float], starts: list[float], longest: float) -> list[int]:
    """A window for each scene of one video: a new one when a scene ends too far after the window's start."""
    out, number, origin = [], -1, None
    for a, b in zip(starts, ends, strict=True):
        if origin is None or b - origin > longest:
            number, origin = number + 1, a
        out.append(number)
    return out


def description_windows(scenes: DataFrame, longest: float = 600.0) -> DataFrame:
    """(video_id, scene_id, window_id, start, end): scenes dealt greedily to windows; a longer scene stands alone."""

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start", ignore_index=True)
        n = window_numbers(pdf.end.tolist(), pdf.start.tolist(), longest)
        return pd.DataFrame({"video_id": pdf.video_id, "scene_id": pdf.id, "window_id": n, "start": pdf.start, "end": pdf.end})

    rows = scenes.select("video_id", "id", "start", "end")
    return rows.groupBy("video_id").applyInPandas(deal, "video_id long, scene_id long, window_id int, start double, end double")


def top_groups(faces: DataFrame, windows: DataFrame, n: int = 12) -> DataFrame:
    """(video_id, window_id, group, detections, rank): the groups with most detections in each window."""
    hit = interval_join(faces.where("group > 0").select("video_id", "ts", "group"), windows, "ts", "window_id", "window_id")
    count = hit.groupBy("video_id", "window_id", "group").agg(F.count("*").alias("detections"))
    rank = F.row_number().over(Window.partitionBy("video_id", "window_id").orderBy(F.desc("detections"), "group"))
    return count.withColumn("rank", rank).where(F.col("rank") <= n)


def scene_evidence(scenes: DataFrame, segments: DataFrame, faces: DataFrame, interval: float = 1.0) -> DataFrame:
    """(video_id, scene_id, from_hms, to_hms, people, transcript) of each scene."""
    seen = interval_join(faces.where("group > 0").select("video_id", "ts", "group"), scenes, "ts")
    n = seen.groupBy("video_id", "scene_id", "group").agg(F.count("*").alias("n"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "group")))
    people = F.array_join(F.transform(rows, lambda x: F.concat(F.lit("group"), x["group"], F.lit(" "), (-x["n"] * interval).cast("int"), F.lit(" s"))), ", ")
    seg = segments.select("video_id", "seg_no", ((F.col("start") + F.col("end")) / 2).alias("mid"), "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "text"))), lambda x: x["text"]), " ")
    said = interval_join(seg, scenes, "mid").groupBy("video_id", "scene_id").agg(text.alias("transcript"))
    key = ["video_id", "scene_id"]
    df = scenes.withColumnRenamed("id", "scene_id").join(n.groupBy(*key).agg(people.alias("people")), key, "left").join(said, key, "left")
    df = df.fillna("no faces detected", ["people"]).fillna("", ["transcript"])
    return df.select(*key, hms(F.col("start")).alias("from_hms"), hms(F.col("end")).alias("to_hms"), "people", clip_text(F.col("transcript"), 4000).alias("transcript"))


def request_key(requests: DataFrame) -> DataFrame:
    """(request_id, model, key): a hash over model, ordered items and resolution of ``requests(request_id, model, item_no, kind, val, resolution)``."""
    items = F.array_sort(F.collect_list(F.struct("item_no", "kind", "val")))
    whole = F.to_json(F.struct("model", items.alias("items"), F.first("resolution").alias("resolution")))
    return requests.groupBy("request_id", "model").agg(F.sha2(whole, 256).alias("key"))


def request_tokens(items: DataFrame, budget: int = 230_000) -> DataFrame:
    """(request_id, tokens, over): text length div 3, 300 an image, 110 a second of video; ``items``: (request_id, kind, val, seconds)."""
    cost = F.when(F.col("kind") == "text", F.floor(F.length("val") / 3)).when(F.col("kind") == "image", 300).otherwise(F.floor(110 * F.col("seconds")))
    df = items.groupBy("request_id").agg(F.sum(cost.cast("long")).alias("tokens"))
    return df.withColumn("over", F.col("tokens") > budget)


def cache_lookup(keys: DataFrame, cache: DataFrame, models: list[str]) -> DataFrame:
    """(request_id, model, text): the first cached answer of a request in the order of ``models``; keys: (request_id, model, key)."""
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    hit = keys.join(cache.select("key", "text"), "key").withColumn("_r", F.row_number().over(Window.partitionBy("request_id").orderBy(rank, "key")))
    return hit.where("_r = 1").select("request_id", "model", "text")


def append_answers(answers: DataFrame, path: str) -> None:
    """Add ``answers(key, text)`` to the cache at ``path``, but for keys that it has: what is there stays, and adding again adds nothing.

    Of several answers to one key the smallest text is taken. The cache is written once, at the end, so a failed run leaves it as it was.
    """
    fresh = answers.groupBy("key").agg(F.min("text").alias("text"))
    try:
        known = answers.sparkSession.read.parquet(path).select("key")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        fresh = checkpointed(fresh.join(known, "key", "left_anti"))
    fresh.write.mode("append").parquet(path)


def pending_requests(keys: DataFrame, cache: DataFrame) -> DataFrame:
    """(request_id) of requests without a cached answer of any model."""
    done = keys.join(cache.select("key"), "key", "left_semi").select("request_id").distinct()
    return keys.select("request_id").distinct().join(done, "request_id", "left_anti")


ANSWER = "scene_id int, title string, central_theme string, key_contributors array<struct<group: string, role: string, name: string, evidence: string>>, events array<string>, _corrupt_record string"


def parse_answers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of ``raw(video_id, model, json)``; bad ones are not of the answer's schema."""
    parsed = raw.withColumn("a", F.from_json("json", ANSWER, {"mode": "PERMISSIVE"}))
    bad = F.col("a._corrupt_record").isNotNull() | F.col("a.scene_id").isNull() | F.col("a.central_theme").isNull()
    good = parsed.where(~bad).select("video_id", "model", "a.scene_id", "a.title", "a.central_theme", "a.key_contributors", "a.events")
    return good, parsed.where(bad).select("video_id", "model", "json")


def reconcile_answers(wanted: DataFrame, main: DataFrame, fallback: DataFrame) -> DataFrame:
    """(video_id, scene_id, outcome, model): main answers, then fallback ones for missing scenes, then failures; others are dropped."""
    key = ["video_id", "scene_id"]
    got = main.join(wanted, key, "left_semi").groupBy(*key).agg(F.min("model").alias("model"))
    missing = wanted.join(got, key, "left_anti")
    second = fallback.join(missing, key, "left_semi").groupBy(*key).agg(F.min("model").alias("model"))
    failed = missing.join(second, key, "left_anti")
    tag = lambda df, o: df.select(*key, F.lit(o).alias("outcome"), "model")
    return tag(got, "answered").union(tag(second, "fallback")).union(tag(failed.withColumn("model", F.lit(None).cast("string")), "failed"))


def contributors(answers: DataFrame) -> DataFrame:
    """(video_id, scene_id, pos, grp, role, name): one row a contributor, group labels normalised."""
    df = answers.select("video_id", "scene_id", F.posexplode("key_contributors").alias("pos", "c"))
    return df.select("video_id", "scene_id", "pos", normalise_group(F.col("c.group")).alias("grp"), F.col("c.role").alias("role"), F.trim("c.name").alias("name"))


def group_names(answers: DataFrame) -> DataFrame:
    """(video_id, grp, name): most votes, then the longest name, then the first seen."""
    votes = contributors(answers).where("grp is not null and name <> ''")
    n = votes.groupBy("video_id", "grp", "name").agg(F.count("*").alias("n"), F.min(F.struct("scene_id", "pos")).alias("first"))
    order = Window.partitionBy("video_id", "grp").orderBy(F.desc("n"), F.desc(F.length("name")), "first")
    return n.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("video_id", "grp", "name")


def scene_presence(faces: DataFrame, scenes: DataFrame) -> DataFrame:
    """(video_id, scene_id, grp): groups on screen in each scene."""
    seen = interval_join(faces.where("group > 0").select("video_id", "ts", "group"), scenes, "ts")
    return seen.select("video_id", "scene_id", F.concat(F.lit("group"), "group").alias("grp")).distinct()


def compose_description(answers: DataFrame, presence: DataFrame, names: DataFrame) -> DataFrame:
    """(video_id, scene_id, description) from theme, contributors and events."""
    key = ["video_id", "scene_id"]
    c = contributors(answers).join(presence.withColumn("here", F.lit(True)), [*key, "grp"], "left")
    c = c.join(names.withColumnRenamed("name", "voted"), ["video_id", "grp"], "left")
    first = F.row_number().over(Window.partitionBy(*key, "grp").orderBy("pos"))
    c = c.withColumn("n", F.when(F.col("here"), first).otherwise(1)).where("n = 1")
    name = F.coalesce("voted", F.when(F.col("name") != "", F.col("name")))
    own = F.when(F.col("name") != "", F.col("name"))
    text = (
        F.when(F.col("here") & name.isNotNull(), F.concat("grp", F.lit(" ("), name, F.lit(", "), "role", F.lit(")")))
        .when(F.col("here"), F.concat("grp", F.lit(" ("), "role", F.lit(")")))
        .when(own.isNotNull(), F.concat(own, F.lit(" ("), "role", F.lit(", off-screen)")))
        .otherwise(F.concat(F.lit("an off-screen "), "role"))
    )
    who = c.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", text.alias("t")))), lambda x: x["t"]), ", ").alias("who"))
    events = F.array_join(F.transform("events", lambda e, i: F.concat(F.lit("("), i + 1, F.lit(") "), F.rtrim(e, F.lit(".")))), "; ")
    df = answers.select(*key, "central_theme", events.alias("what")).join(who, key, "left").fillna("none identified", ["who"])
    return df.select(
        *key, F.concat(F.lit("Central theme: "), F.rtrim("central_theme", F.lit(".")), F.lit(". Key contributors: "), "who", F.lit(". Events: "), "what", F.lit(".")).alias("description")
    )
