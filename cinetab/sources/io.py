"""Readers and writers: video and caption JSON, transcripts, Parquet tables, result documents, file listings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import prepared

INFO = "id string, title string, channel string, uploader string, duration double, chapters array<struct<title: string, start_time: double, end_time: double>>"
PROBE = "streams array<struct<duration: string, r_frame_rate: string, avg_frame_rate: string, nb_read_packets: string, width: int, height: int>>, format struct<duration: string>"
CAPTIONS = "events array<struct<tStartMs: double, dDurationMs: double, segs: array<struct<utf8: string>>>>"


def _rate(text: F.Column) -> F.Column:
    """A fraction such as 25/1 as a number; null for 0/0."""
    part = F.split(text, "/")
    low = F.coalesce(F.get(part, F.lit(1)).try_cast("double"), F.lit(1.0))
    return F.when(low != 0, part[0].try_cast("double") / low)


def video_metadata(info: DataFrame, probe: DataFrame) -> DataFrame:
    """One row a video from ``info(video_id, json)`` and ``probe(video_id, json)``."""
    i = info.select("video_id", F.from_json("json", INFO).alias("i"))
    p = probe.select("video_id", F.from_json("json", PROBE).alias("p")).select("video_id", F.get("p.streams", F.lit(0)).alias("s"), F.col("p.format.duration").alias("whole"))
    return i.join(p, "video_id").select(
        "video_id", F.col("i.title").alias("title"), F.coalesce("i.channel", "i.uploader").alias("channel"), F.col("i.duration").alias("youtube_duration"),
        F.coalesce(F.col("s.duration").try_cast("double"), F.col("whole").try_cast("double")).alias("duration"),
        F.coalesce(_rate(F.col("s.avg_frame_rate")), _rate(F.col("s.r_frame_rate"))).alias("fps"),
        F.coalesce(F.col("s.nb_read_packets").try_cast("long"), F.lit(0)).alias("n_frames"), F.col("s.width").alias("width"), F.col("s.height").alias("height"),
    )


def chapters(info: DataFrame) -> DataFrame:
    """(video_id, title, start, end); a missing list has none."""
    c = info.select("video_id", F.explode(F.from_json("json", INFO)["chapters"]).alias("c"))
    return c.select("video_id", F.col("c.title").alias("title"), F.col("c.start_time").alias("start"), F.col("c.end_time").alias("end"))


def caption_segments(captions: DataFrame) -> DataFrame:
    """(video_id, seg_no, start, end, text) from ``captions(video_id, json)``; blank events are dropped."""
    e = captions.select("video_id", F.posexplode(F.from_json("json", CAPTIONS)["events"]).alias("seg_no", "e"))
    text = F.array_join(F.transform(F.coalesce("e.segs", F.array().cast("array<struct<utf8: string>>")), lambda s: F.coalesce(s["utf8"], F.lit(""))), "")
    start = F.col("e.tStartMs") / 1000
    df = e.select(
        "video_id", "seg_no", F.round(start, 2).alias("start"), F.round(start + F.coalesce("e.dDurationMs", F.lit(0.0)) / 1000, 2).alias("end"),
        F.trim(F.regexp_replace(text, "\n", " ")).alias("text"),
    )
    return df.where("text <> ''")


def pick_transcript(segments: DataFrame, priority: tuple[str, ...] = ("parakeet", "whisper", "youtube")) -> DataFrame:
    """The whole transcript of each video's first source in the order of ``priority``; unknown sources never count."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("source"))
    df = segments.withColumn("_r", rank).where("_r > 0")
    return df.withColumn("_best", F.min("_r").over(Window.partitionBy("video_id"))).where("_r = _best").drop("_r", "_best")


def clean_segments(raw: DataFrame) -> DataFrame:
    df = raw.withColumn("text", F.trim("text")).where("text <> ''")
    return df.withColumn("start", F.round("start", 2)).withColumn("end", F.round("end", 2))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset.

    On a cluster a warehouse on a local disk is refused: executors would not see each other's files there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    home = spark.conf.get("spark.sql.warehouse.dir")
    if not base and home.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (base or home).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, written once to the shared folder: its lineage ends there, and lost executors cost nothing before it."""
    context = prepared(df.sparkSession).sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, by_video: bool = False) -> None:
    """Parquet, in the folders of a video each if ``by_video``."""
    (df.write.partitionBy("video_id") if by_video else df.write).parquet(path)


def write_bucketed(df: DataFrame, name: str, buckets: int, order: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """Save ``df`` as table ``name`` in ``buckets`` files by video_id, sorted by video_id and ``order``; reads it back.

    Joins and groups of such tables by video_id need no exchange. Rows are dealt by bucket first, so a bucket is one
    file. The files go to ``path``, a new folder of the shared one if left out.
    """
    dealt = df.repartition(buckets, "video_id").write.bucketBy(buckets, "video_id").sortBy("video_id", *order)
    dealt.option("path", path or scratch_path(df.sparkSession, name)).saveAsTable(name)
    return df.sparkSession.table(name)


def write_output_json(docs: DataFrame, path: str) -> None:
    """One JSON line a video."""
    docs.write.json(path)


def crop_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, scene_id, group, ts) of the files below ``root``; contents are not read.

    Spark's readers pass over names that begin with an underscore, such as the markers of scenes without faces.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    part = lambda p: F.regexp_extract("path", p, 1)
    return files.select("path", part(r"scene_(\d+)/").try_cast("int").alias("scene_id"), part(r"group(\d+)/").try_cast("int").alias("group"), part(r"/t([\d.]+)\.jpg$").try_cast("double").alias("ts"))
