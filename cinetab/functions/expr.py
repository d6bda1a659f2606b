"""Scalar expressions over time, boxes, text and vectors. Every function takes and gives columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hms(seconds: Column) -> Column:
    """HH:MM:SS.ss; negative times count as 0."""
    s = F.greatest(seconds, F.lit(0.0))
    return F.format_string("%02d:%02d:%05.2f", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def yaw_ratio(eye_a: tuple[Column, Column], eye_b: tuple[Column, Column], nose: tuple[Column, Column]) -> Column:
    """How far the nose is off the middle of the eyes, by their distance (1 at least)."""
    distance = F.greatest(F.hypot(eye_b[0] - eye_a[0], eye_b[1] - eye_a[1]), F.lit(1.0))
    return F.abs(nose[0] - (eye_a[0] + eye_b[0]) / 2) / distance


def face_tier(score: Column, width: Column, height: Column, sharpness: Column, yaw: Column) -> Column:
    """anchor, weak, or null for detections that are dropped."""
    side = F.least(width, height)
    anchor = (score >= 0.65) & (side >= 48) & (sharpness >= 50) & (yaw <= 0.5)
    return F.when((score < 0.5) | (side < 32), None).when(anchor, "anchor").otherwise("weak")


def detection_quality(score: Column, sharpness: Column) -> Column:
    return score * F.least(F.greatest(sharpness / 200, F.lit(0.1)), F.lit(1.0))


def crop_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, margin: float = 0.25, longest: int = 256) -> Column:
    """struct(left, top, right, bottom, out_width, out_height): a widened box inside the frame, scaled down to ``longest``."""
    w, h = x2 - x1, y2 - y1
    left, top = (F.greatest(a - margin * b, F.lit(0.0)).cast("int") for a, b in ((x1, w), (y1, h)))
    right, bottom = (F.least(a + margin * b, c).cast("int") for a, b, c in ((x2, w, width), (y2, h, height)))
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(right - left, bottom - top))
    return F.struct(
        left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"),
        F.rint((right - left) * scale).cast("int").alias("out_width"), F.rint((bottom - top) * scale).cast("int").alias("out_height"),
    )


def frame_size(width: Column, height: Column, longest: int) -> Column:
    """struct(width, height) with the longer side at ``longest`` at most."""
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(width, height))
    return F.struct(F.rint(width * scale).cast("int").alias("width"), F.rint(height * scale).cast("int").alias("height"))


def clip_text(text: Column, n: int, tail: bool = False) -> Column:
    """The first (or last) n characters and an ellipsis; short texts stay."""
    cut = F.concat(F.lit("..."), F.right(text, F.lit(n))) if tail else F.concat(F.substring(text, 1, n), F.lit("..."))
    return F.when(F.length(text) <= n, text).otherwise(cut)


def normalise_group(label: Column) -> Column:
    """group<number> for a label that names one, else null."""
    digits = F.regexp_extract(label, r"(?i)group\s*_?(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("group"), F.regexp_replace(digits, r"^0+(?=\d)", "")))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(a: Column) -> Column:
    """The vector over its length; a zero vector stays."""
    length = F.sqrt(dot(a, a))
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length)).otherwise(F.transform(a, lambda x: x.cast("double")))

