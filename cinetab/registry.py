"""Every registered query of the video operators over tables derived from the test data, with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .functions import expr
from .operators import checks, evidence, export, faces, identities, joins, segments, timeline
from .plans import jobs
from .sources import crops, io
from .sources.session import prepared

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """Derived tables by name, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepared(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in fixtures.VIEWS:
            raise AttributeError(name)
        found = fixtures.table(self.spark, self.sf_dir, name)
        setattr(self, name, found)  # asked for once a query
        return found

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def detections(self) -> DataFrame:
        """Kept detections with vectors."""
        f = self.faces.withColumn("vec_id", F.col("det_id") % self.n_vecs.scalar())
        return f.join(self.read("embeddings").select("vec_id", "embedding"), "vec_id").drop("vec_id")


def query(sql: str = "", views: tuple[str, ...] = ()):
    """Register a function of Tables under its name, with its oracle."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[f.__name__] = lambda spark, sf_dir: _plain(f(Tables(spark, sf_dir)))
        if sql:
            _ORACLES[f.__name__] = (fixtures.with_sql(views, fixtures.DUCK_T) if views else "") + sql
            if "RECURSIVE" in sql:
                _ORACLES[f.__name__] = _ORACLES[f.__name__].replace("WITH ", "WITH RECURSIVE ", 1)
        return f

    return add


def _plain(df: DataFrame) -> DataFrame:
    """Columns that SQL has reserved words for get the oracles' names; doubles are rounded."""
    df = df.withColumnsRenamed({"start": "start_s", "end": "end_s", "group": "grp", "order": "ord"})
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t in ("double", "float")})


# --- time lines -----------------------------------------------------------------------------------
@query(
    """, hot AS (SELECT video_id, frame_idx, frame_idx - row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) AS i FROM frame_probs WHERE prob > 0.5),
    r AS (SELECT video_id, min(frame_idx) AS a, max(frame_idx) AS b FROM hot GROUP BY video_id, i)
    SELECT video_id, CAST(round_even((a + b) / 2.0, 0) + 1 AS BIGINT) AS frame, round((round_even((a + b) / 2.0, 0) + 1) / 25.0, 6) AS boundary FROM r""",
    ("frame_probs",),
)
def transition_boundaries(t):
    return timeline.transition_boundaries(t.frame_probs, t.fvideos)


@query(
    """, hot AS (SELECT video_id, frame_idx, frame_idx - row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) AS i FROM frame_probs WHERE prob > 0.5),
    r AS (SELECT video_id, (round_even((min(frame_idx) + max(frame_idx)) / 2.0, 0) + 1) / 25.0 AS b FROM hot GROUP BY video_id, i),
    st AS (SELECT DISTINCT r.video_id, round(b, 4) AS start_s FROM r JOIN fvideos v ON r.video_id = v.video_id WHERE b > 0 AND b < duration UNION SELECT video_id, 0.0 FROM fvideos)
    SELECT st.video_id, row_number() OVER w - 1 AS id, round(start_s, 6) AS start_s, round(coalesce(lead(start_s) OVER w, duration), 6) AS end_s
    FROM st JOIN fvideos v ON st.video_id = v.video_id WINDOW w AS (PARTITION BY st.video_id ORDER BY start_s)""",
    ("fvideos",),
)
def shots_from_boundaries(t):
    return timeline.shots_from_boundaries(timeline.transition_boundaries(t.frame_probs, t.fvideos), t.fvideos)


@query(
    """, k AS (SELECT s.video_id, s.id AS shot_id, u.k, least(s.start_s + (s.end_s - s.start_s) * u.share, v.duration - 1.5 / v.fps) AS t
      FROM shots s JOIN videos v ON s.video_id = v.video_id JOIN (VALUES (0, 0.5, 1), (0, 0.25, 0), (1, 0.5, 0), (2, 0.75, 0)) u(k, share, short)
      ON u.short = CASE WHEN s.end_s - s.start_s < 1.0 THEN 1 ELSE 0 END)
    SELECT video_id, shot_id, k, round(t, 6) AS t FROM (SELECT *, row_number() OVER (PARTITION BY video_id, t ORDER BY shot_id DESC, k DESC) AS n FROM k) q WHERE n = 1""",
    ("shots", "videos"),
)
def keyframe_times(t):
    return timeline.keyframe_times(t.shots, t.videos)


@query(
    """, g AS (SELECT video_id, CAST(range AS DOUBLE) AS t FROM videos, range(0, 2160) WHERE range < duration - 1.5 / fps),
    m AS (SELECT s.video_id, CAST(round(CAST(CAST(least((s.start_s + s.end_s) / 2, v.duration - 1.5 / v.fps) AS VARCHAR) AS DECIMAL(30, 15)), 2) AS DOUBLE) AS t FROM shots s JOIN videos v ON s.video_id = v.video_id
      WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.video_id = s.video_id AND g.t >= s.start_s AND g.t < s.end_s))
    SELECT video_id, round(t, 6) AS t FROM g UNION SELECT video_id, round(t, 6) AS t FROM m WHERE abs(t - round_even(t, 0)) >= 0.1""",
    ("shots", "videos"),
)
def sample_times(t):
    return timeline.sample_times(t.shots, t.videos)


@query(
    """SELECT d.det_id, d.video_id, coalesce((SELECT max(id) FROM shots s WHERE s.video_id = d.video_id AND s.start_s <= d.ts), 0) AS shot_id FROM raw_dets d""",
    ("raw_dets", "shots"),
)
def assign_shot(t):
    return joins.asof_shot(t.raw_dets.select("video_id", "det_id", "ts"), t.shots).select("det_id", "video_id", "shot_id")


@query("SELECT video_id, id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, first_shot, last_shot, CASE WHEN id < 7 THEN 'Scene ' || CAST(id AS VARCHAR) END AS title FROM scenes", ("scenes",))
def scenes_from_cuts(t):
    titles = t.scenes.where("id < 7").select("video_id", "id", F.concat(F.lit("Scene "), "id").alias("title"))
    return timeline.scenes_from_cuts(t.shots, t.cuts, titles)


def _middle(start: str, end: str) -> str:
    """The place in a video's list of frames of the one in the middle of a tile."""
    return f"CAST(1 + least(fr.n - 1, floor((floor({start} * 25) + greatest(floor({start} * 25) + 1, floor({end} * 25))) / 2)) AS BIGINT)"


def _apart(a: str, b: str) -> str:
    """The distance of two histograms of four bins."""
    return f"CASE WHEN list_sum({a}) * list_sum({b}) > 0 THEN sqrt(greatest(0, 1 - list_sum(list_transform(range(1, 5), lambda k: sqrt({a}[k] * {b}[k]))) / sqrt(list_sum({a}) * list_sum({b})))) ELSE 1 END"


#: Edges and looks of each video's tiles, and the distances of neighbours; a step takes away the edge between the first tiny tile and the neighbour that it looks like.
@query(
    """, /* RECURSIVE */ hot AS (SELECT video_id, frame_idx, frame_idx - row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) AS i FROM frame_probs WHERE prob > 0.5),
    r AS (SELECT video_id, (round_even((min(frame_idx) + max(frame_idx)) / 2.0, 0) + 1) / 25.0 AS b FROM hot GROUP BY video_id, i),
    st AS (SELECT r.video_id, CAST(round(b, 4) AS DOUBLE) AS e FROM r JOIN fvideos v ON r.video_id = v.video_id WHERE b > 0 AND b < duration UNION SELECT video_id, CAST(0 AS DOUBLE) FROM fvideos UNION SELECT video_id, duration FROM fvideos),
    fr AS (SELECT video_id, list([h0, h1, h2, h3] ORDER BY frame_idx) AS h, count(*) AS n FROM frame_looks GROUP BY video_id),
    s0 AS (SELECT video_id, list(e ORDER BY e) AS edges FROM st GROUP BY video_id),
    s1 AS (SELECT s0.video_id, edges, list_transform(range(1, len(edges)), lambda i: fr.h[{at}]) AS looks FROM s0 JOIN fr ON fr.video_id = s0.video_id),
    tl AS (SELECT video_id, CAST(0 AS BIGINT) AS step, edges, looks, list_transform(range(1, len(looks)), lambda i: {d_all}) AS d FROM s1
      UNION ALL SELECT video_id, step + 1, list_concat(edges[:b - 1], edges[b + 1:]), list_concat(list_append(CASE WHEN b > 2 THEN looks[:b - 2] ELSE [] END, look), looks[b + 1:]),
        list_concat(CASE WHEN b > 3 THEN d[:b - 3] ELSE [] END, list_concat(CASE WHEN b > 2 THEN [{d_left}] ELSE [] END, list_concat(CASE WHEN b < len(looks) THEN [{d_right}] ELSE [] END, d[b + 1:]))) FROM (
        SELECT z.*, list_transform([b - 1], lambda i: fr.h[{at_merged}])[1] AS look FROM (
          SELECT video_id, step, edges, looks, d, list_filter(list_transform(range(1, len(edges)), lambda i: CASE WHEN edges[i + 1] - edges[i] >= 0.2 THEN NULL
            WHEN coalesce(d[i - 1], 9) <= coalesce(d[i], 9) THEN CASE WHEN d[i - 1] < 0.3 THEN i END WHEN d[i] < 0.3 THEN i + 1 END), lambda x: x IS NOT NULL)[1] AS b FROM tl) z JOIN fr ON fr.video_id = z.video_id WHERE b IS NOT NULL) y),
    fe AS (SELECT video_id, arg_max(edges, step) AS edges FROM tl GROUP BY video_id)
    SELECT video_id, unnest(range(0, len(edges) - 1)) AS id, round(unnest(edges[:-2]), 6) AS start_s, round(unnest(edges[2:]), 6) AS end_s FROM fe""".format(at=_middle("edges[i]", "edges[i + 1]"), at_merged=_middle("edges[i]", "edges[i + 2]"), d_all=_apart("looks[i]", "looks[i + 1]"), d_left=_apart("looks[b - 2]", "look"), d_right=_apart("look", "looks[b + 1]")),
    ("frame_probs", "frame_looks", "fvideos"),
)
def merge_tiny_shots(t):
    looks = t.frame_looks.select("video_id", "frame_idx", F.array(*[f"h{k}" for k in range(4)]).alias("hist"))
    shots = timeline.shots_from_boundaries(timeline.transition_boundaries(t.frame_probs, t.fvideos), t.fvideos)
    return timeline.merge_tiny_shots(shots, looks, t.fvideos, min_len=0.2)


@query(
    """SELECT video_id, count(*) AS n, round(median(end_s - start_s), 6) AS median_s, round(min(end_s - start_s), 6) AS min_s, round(max(end_s - start_s), 6) AS max_s FROM shots GROUP BY video_id""",
    ("shots",),
)
def interval_summary(t):
    return timeline.interval_summary(t.shots)


@query(
    r"""SELECT video_id, count(*) AS segments, CAST(sum(len(regexp_split_to_array(trim(text), '\s+'))) AS BIGINT) AS words FROM segments GROUP BY video_id""",
    ("segments",),
)
def transcript_summary(t):
    return timeline.transcript_summary(t.segments)


@query(
    """SELECT s.video_id, s.id AS shot_id, count(f.frame_idx) AS n_frames, coalesce(string_agg(CAST(f.frame_idx AS VARCHAR), ','), '') AS frames FROM shots s LEFT JOIN (SELECT DISTINCT video_id, frame_idx FROM frame_probs) f
    ON s.video_id = f.video_id AND f.frame_idx = CAST(round_even(least((s.start_s + s.end_s) / 2, 2160 - 1.5 / 25), 0) AS BIGINT) GROUP BY s.video_id, s.id""",
    ("shots", "frame_probs"),
)
def keyframe_coverage(t):
    times = t.shots.select("video_id", F.col("id").alias("shot_id"), F.rint(F.least((F.col("start") + F.col("end")) / 2, F.lit(2160 - 1.5 / 25))).alias("t"))
    found = timeline.keyframe_coverage(times, t.frame_probs.select("video_id", F.col("frame_idx").cast("double").alias("t")), t.shots)
    return found.withColumn("frames", F.array_join(F.transform("frames", lambda x: x.cast("long")), ","))


@query(
    """SELECT s.video_id, round(s.start_s, 6) AS t, f.frame_idx FROM shots s JOIN frame_probs f ON s.video_id = f.video_id AND f.frame_idx = CAST(round_even(s.start_s * 25, 0) AS BIGINT)""",
    ("shots", "frame_probs"),
)
def frame_lookup(t):
    return timeline.frame_lookup(t.shots.select("video_id", F.col("start").alias("t")), t.frame_probs, t.videos)


# --- scalar expressions ---------------------------------------------------------------------------
@query(
    """SELECT video_id, id, printf('%02d:%02d:%05.2f', CAST(floor(start_s / 3600) AS INT), CAST(floor((start_s % 3600) / 60) AS INT), start_s % 60) AS hms FROM shots""",
    ("shots",),
)
def hms(t):
    return t.shots.select("video_id", "id", expr.hms(F.col("start")).alias("hms"))


@query(
    """SELECT det_id, CASE WHEN det_score < 0.5 OR least(x2 - x1, y2 - y1) < 32 THEN NULL WHEN det_score >= 0.65 AND least(x2 - x1, y2 - y1) >= 48 AND sharpness >= 50 AND yaw_ratio <= 0.5
    THEN 'anchor' ELSE 'weak' END AS tier, round(100 * (det_score * least(greatest(sharpness / 200, 0.1), 1.0)), 6) AS percent FROM raw_dets""",
    ("raw_dets",),
)
def face_quality_tier(t):
    c = F.col
    tier = expr.face_tier(c("det_score"), c("x2") - c("x1"), c("y2") - c("y1"), c("sharpness"), c("yaw_ratio"))
    return t.raw_dets.select("det_id", tier.alias("tier"), (100 * expr.detection_quality(c("det_score"), c("sharpness"))).alias("percent"))


@query(
    """SELECT det_id, round(abs((x1 + 5) - (x1 + x2) / 2) / greatest(sqrt((x2 - x1) * (x2 - x1) + 9), 1.0), 6) AS yaw FROM raw_dets""",
    ("raw_dets",),
)
def yaw_ratio(t):
    c = F.col
    return t.raw_dets.select("det_id", expr.yaw_ratio((c("x1"), c("y1")), (c("x2"), c("y1") + 3), (c("x1") + 5, c("y2"))).alias("yaw"))


@query(
    """, b AS (SELECT det_id, CAST(trunc(greatest(x1 - 0.25 * (x2 - x1), 0)) AS INT) AS l, CAST(trunc(greatest(y1 - 0.25 * (y2 - y1), 0)) AS INT) AS tp,
      CAST(trunc(least(x2 + 0.25 * (x2 - x1), 1000)) AS INT) AS r, CAST(trunc(least(y2 + 0.25 * (y2 - y1), 600)) AS INT) AS bt FROM raw_dets),
    s AS (SELECT *, least(1.0::DOUBLE, 100.0::DOUBLE / greatest(r - l, bt - tp)) AS f FROM b)
    SELECT det_id, l AS left_px, tp AS top_px, r AS right_px, bt AS bottom_px, CAST(round_even((r - l) * f, 0) AS INT) AS out_w, CAST(round_even((bt - tp) * f, 0) AS INT) AS out_h FROM s""",
    ("raw_dets",),
)
def crop_box(t):
    c = F.col
    box = expr.crop_box(c("x1"), c("y1"), c("x2"), c("y2"), F.lit(1000.0), F.lit(600.0), longest=100)
    df = t.raw_dets.where("x1 < 1000 and y1 < 600").select("det_id", box.alias("b"))
    names = {"left": "left_px", "top": "top_px", "right": "right_px", "bottom": "bottom_px", "out_width": "out_w", "out_height": "out_h"}
    return df.select("det_id", *[F.col(f"b.{k}").alias(v) for k, v in names.items()])


@query(
    """SELECT p_partkey, CAST(round_even((p_size * 100) * least(1.0::DOUBLE, 512.0::DOUBLE / greatest(p_size * 100, 300)), 0) AS INT) AS width,
    CAST(round_even(300 * least(1.0::DOUBLE, 512.0::DOUBLE / greatest(p_size * 100, 300)), 0) AS INT) AS height FROM part"""
)
def frame_size(t):
    return t.read("part").select("p_partkey", expr.frame_size(F.col("p_size") * 100, F.lit(300), 512).alias("s")).select("p_partkey", "s.width", "s.height")


@query(
    """SELECT conv_id, turn, CASE WHEN length(text) <= 40 THEN text ELSE substr(text, 1, 40) || '...' END AS head, CASE WHEN length(text) <= 40 THEN text ELSE '...' || right(text, 40) END AS tail FROM conversations"""
)
def clip_text(t):
    text = F.col("text")
    return t.read("conversations").select("conv_id", "turn", expr.clip_text(text, 40).alias("head"), expr.clip_text(text, 40, tail=True).alias("tail"))


@query(
    r"""SELECT event_id, CASE WHEN regexp_matches(label, '(?i)group\s*_?(\d+)') THEN 'group' || CAST(CAST(regexp_extract(label, '(?i)group\s*_?(\d+)', 1) AS BIGINT) AS VARCHAR) END AS grp
    FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Group_0' || CAST(user_id AS VARCHAR) WHEN 1 THEN 'the group ' || CAST(user_id AS VARCHAR) || ' (left)' WHEN 2 THEN 'nobody' END AS label FROM events) q"""
)
def normalise_group(t):
    n = F.col("user_id").cast("string")
    k = F.col("event_id") % 4
    label = F.when(k == 0, F.concat(F.lit("Group_0"), n)).when(k == 1, F.concat(F.lit("the group "), n, F.lit(" (left)"))).when(k == 2, "nobody")
    return t.read("events").select("event_id", expr.normalise_group(label).alias("group"))


# --- joins and signals ----------------------------------------------------------------------------
@query(
    """SELECT f.det_id, s.id AS scene_id FROM faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s""",
    ("faces", "scenes"),
)
def interval_join(t):
    return joins.interval_join(t.faces, t.scenes).select("det_id", "scene_id")


@query(
    """SELECT DISTINCT a.video_id, a.grp AS a, b.grp AS b FROM faces a JOIN faces b ON a.video_id = b.video_id AND a.ts = b.ts AND a.grp < b.grp""",
    ("faces",),
)
def same_frame_pairs(t):
    return joins.same_frame_pairs(t.faces.select("video_id", "ts", F.col("group").alias("track_id")))


VISUAL = """, p AS (SELECT a.video_id, a.shot_id AS i, b.shot_id AS j, list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim FROM shot_vecs a JOIN shot_vecs b ON a.video_id = b.video_id AND b.shot_id > a.shot_id AND b.shot_id <= a.shot_id + 11)
    SELECT b.video_id, b.shot_id, round(max(p.sim), 6) AS sim_v FROM bounds b JOIN p ON p.video_id = b.video_id AND p.i >= b.shot_id - 6 AND p.i < b.shot_id AND p.j >= b.shot_id AND p.j < b.shot_id + 6 GROUP BY b.video_id, b.shot_id"""


@query(VISUAL, ("shot_vecs", "bounds"))
def visual_link(t):
    return segments.visual_link(t.shot_vecs)


PEOPLE = """, pv AS (SELECT b.video_id, b.shot_id, f.grp, count(*) FILTER (WHERE f.ts < b.time) AS left_n, count(*) FILTER (WHERE f.ts >= b.time) AS right_n
    FROM bounds b JOIN faces f ON f.video_id = b.video_id AND f.ts >= b.time - 60 AND f.ts < b.time + 60 AND f.grp > 0 GROUP BY b.video_id, b.shot_id, f.grp) """


@query(PEOPLE + "SELECT * FROM pv", ("bounds", "faces"))
def people_vectors(t):
    return segments.people_vectors(t.faces, t.bounds)


@query(
    PEOPLE + """SELECT video_id, shot_id, CASE WHEN sum(left_n * left_n) > 0 AND sum(right_n * right_n) > 0 THEN round(sum(left_n * right_n) / sqrt(sum(left_n * left_n) * sum(right_n * right_n)), 6) END AS sim_p FROM pv GROUP BY video_id, shot_id""",
    ("bounds", "faces"),
)
def people_similarity(t):
    return segments.people_similarity(segments.people_vectors(t.faces, t.bounds))


TEXTS = """, bt AS (SELECT b.video_id, b.shot_id,
    coalesce(string_agg(s.text, ' ' ORDER BY s.seg_no) FILTER (WHERE (s.start_s + s.end_s) / 2 < b.time), '') AS left_text,
    coalesce(string_agg(s.text, ' ' ORDER BY s.seg_no) FILTER (WHERE (s.start_s + s.end_s) / 2 >= b.time), '') AS right_text
    FROM bounds b LEFT JOIN segments s ON s.video_id = b.video_id AND (s.start_s + s.end_s) / 2 >= b.time - 60 AND (s.start_s + s.end_s) / 2 < b.time + 60 GROUP BY b.video_id, b.shot_id) """


@query(TEXTS + "SELECT * FROM bt", ("bounds", "segments"))
def boundary_text(t):
    return segments.boundary_text(t.segments, t.bounds)


def _text_vectors(t, texts):
    """A stand-in encoder: the vector of a text is chosen by its length."""
    n = t.read("embeddings").count()
    distinct = texts.select(F.explode(F.array("left_text", "right_text")).alias("text")).where("text <> ''").distinct()
    return distinct.withColumn("vec_id", F.length("text") % n).join(t.read("embeddings").select("vec_id", "embedding"), "vec_id").select("text", "embedding")


@query(
    TEXTS + """, tv AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT bt.video_id, bt.shot_id, CASE WHEN left_text <> '' AND right_text <> '' THEN round(list_cosine_similarity(a.e, b.e), 6) END AS sim_t
    FROM bt, n_vecs c, tv a, tv b WHERE a.vec_id = length(left_text) % c.n AND b.vec_id = length(right_text) % c.n""",
    ("bounds", "segments", "n_vecs"),
)
def text_similarity(t):
    texts = segments.boundary_text(t.segments, t.bounds)
    return segments.text_similarity(texts, _text_vectors(t, texts))


@query(
    TEXTS + """, en AS (SELECT *, list_transform(['a', 'e', 'i', 'o', 'u'], lambda c: CAST(length(left_text) - length(replace(left_text, c, '')) + 1 AS DOUBLE)) AS l,
      list_transform(['a', 'e', 'i', 'o', 'u'], lambda c: CAST(length(right_text) - length(replace(right_text, c, '')) + 1 AS DOUBLE)) AS r FROM bt)
    SELECT video_id, shot_id, CASE WHEN left_text <> '' AND right_text <> '' THEN round(list_cosine_similarity(l, r), 6) END AS sim_t FROM en""",
    ("bounds", "segments"),
)
def encode_texts(t):
    """Texts are encoded as counts of vowels."""
    texts = segments.boundary_text(t.segments, t.bounds)
    return segments.text_similarity(texts, segments.encode_texts(texts, lambda some: [[x.count(c) + 1 for c in "aeiou"] for x in some]))


@query(
    """, v AS (SELECT video_id, shot_id, CASE WHEN shot_id % 7 = 0 THEN NULL ELSE sim END AS sim FROM boundaries)
    SELECT video_id, shot_id, CASE WHEN sim IS NULL THEN NULL WHEN count(sim) OVER w < 2 OR stddev_pop(sim) OVER w = 0 THEN 0.0 ELSE round((sim - avg(sim) OVER w) / stddev_pop(sim) OVER w, 6) END AS z
    FROM v WINDOW w AS (PARTITION BY video_id)""",
    ("boundaries",),
)
def zscore(t):
    df = t.boundaries.select("video_id", "shot_id", F.when(F.col("shot_id") % 7 != 0, F.col("sim")).alias("sim"))
    return segments.zscore(df, "sim", "z").select("video_id", "shot_id", "z")


@query(
    """SELECT video_id, shot_id, CASE WHEN shot_id % 3 = 0 AND shot_id % 2 = 0 THEN 0.0 ELSE round(
      (CASE WHEN shot_id % 3 <> 0 THEN 0.35 * sim + 0.2 * (1 - sim) ELSE 0 END + CASE WHEN shot_id % 2 <> 0 THEN 0.45 * sim * sim ELSE 0 END)
      / (CASE WHEN shot_id % 3 <> 0 THEN 0.55 ELSE 0 END + CASE WHEN shot_id % 2 <> 0 THEN 0.45 ELSE 0 END), 6) END AS combined FROM boundaries""",
    ("boundaries",),
)
def combine_signals(t):
    s = F.col("sim")
    third, half = F.col("shot_id") % 3 != 0, F.col("shot_id") % 2 != 0
    df = t.boundaries.select("video_id", "shot_id", F.when(third, s).alias("sim_v"), F.when(half, s * s).alias("sim_t"), F.when(third, 1 - s).alias("sim_p"))
    return segments.combine_signals(df, out="combined").select("video_id", "shot_id", "combined")


DEPTH = """, n AS (SELECT *, CASE WHEN lag(sim) OVER w IS NULL OR lag(sim) OVER w < sim THEN sim END AS l, CASE WHEN lead(sim) OVER w IS NULL OR lead(sim) OVER w < sim THEN sim END AS r FROM boundaries WINDOW w AS (PARTITION BY video_id ORDER BY shot_id)),
    d AS (SELECT video_id, shot_id, time, sim, (last_value(l IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY shot_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sim)
      + (first_value(r IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY shot_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - sim) AS depth FROM n) """


@query(DEPTH + "SELECT video_id, shot_id, round(depth, 6) AS depth FROM d", ("boundaries",))
def depth_score(t):
    return segments.depth_score(t.boundaries).select("video_id", "shot_id", "depth")


#: Of each video: its boundaries in order, the depths with the bonus of each chapter in turn, then the walk over the deepest.
BOOSTED = DEPTH + """, /* RECURSIVE */ ch AS (SELECT video_id, start_s, row_number() OVER (PARTITION BY video_id ORDER BY start_s) AS k FROM chapters WHERE start_s > 0),
    al AS (SELECT video_id, list(shot_id ORDER BY time) AS ids, list(time ORDER BY time) AS ts, list(depth ORDER BY time) AS ds FROM d GROUP BY video_id),
    bo AS (SELECT video_id, CAST(0 AS BIGINT) AS k, ds FROM al
      UNION ALL SELECT bo.video_id, ch.k, list_transform(range(1, len(bo.ds) + 1), lambda i: bo.ds[i] + CASE WHEN abs(al.ts[i] - ch.start_s) <= 3 THEN 0.5 * list_aggregate(bo.ds, 'stddev_pop') ELSE 0 END)
      FROM bo JOIN ch ON ch.video_id = bo.video_id AND ch.k = bo.k + 1 JOIN al ON al.video_id = bo.video_id),
    bl AS (SELECT video_id, arg_max(ds, k) AS bs FROM bo GROUP BY video_id),
    bd AS (SELECT al.video_id, unnest(ids) AS shot_id, unnest(ts) AS time, unnest(ds) AS depth, unnest(bs) AS boosted FROM al JOIN bl ON al.video_id = bl.video_id) """
#: Scenes over a length fall apart at their deepest boundary, from ``iv(video_id, a, b)``; ``sp`` has the cuts.
SPLIT = """, pt AS (SELECT video_id, list({{'boosted': boosted, 'before': -time}}) AS points FROM bd GROUP BY video_id),
    fa AS (SELECT video_id, a, b, CAST(NULL AS DOUBLE) AS cut FROM iv
      UNION ALL SELECT video_id, unnest([a, mid]), unnest([mid, b]), mid FROM (SELECT fa.video_id, a, b,
        -list_max(list_filter(points, lambda p: -p.before >= fa.a + 30 AND -p.before <= fa.b - 30)).before AS mid FROM fa JOIN pt ON pt.video_id = fa.video_id WHERE b - a > {longest}) x WHERE mid IS NOT NULL),
    sp AS (SELECT DISTINCT video_id, cut AS time FROM fa WHERE cut IS NOT NULL) """
CUTS = BOOSTED + """, rk AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY boosted DESC, time) AS n FROM bd),
    li AS (SELECT video_id, duration, greatest(0, round_even(duration / 90, 0) - 1) AS wanted, avg(depth) - 0.5 * stddev_pop(depth) AS least FROM bd JOIN videos USING (video_id) GROUP BY video_id, duration),
    wk AS (SELECT video_id, CAST(0 AS BIGINT) AS n, [CAST(0 AS DOUBLE), duration] AS edges FROM li
      UNION ALL SELECT wk.video_id, rk.n, CASE WHEN list_min(list_transform(wk.edges, lambda e: abs(e - rk.time))) >= 30 THEN list_append(wk.edges, rk.time) ELSE wk.edges END
      FROM wk JOIN rk ON rk.video_id = wk.video_id AND rk.n = wk.n + 1 JOIN li ON li.video_id = wk.video_id WHERE len(wk.edges) - 2 < wanted AND boosted >= least),
    ed AS (SELECT video_id, list_sort(arg_max(edges, n)) AS edges FROM wk GROUP BY video_id),
    iv AS (SELECT video_id, unnest(edges[:-2]) AS a, unnest(edges[2:]) AS b FROM ed)""" + SPLIT.format(longest=300) + """,
    cu AS (SELECT video_id, shot_id, time, depth FROM bd JOIN (SELECT video_id, b AS time FROM iv UNION SELECT * FROM sp) c USING (video_id, time)) """


@query(CUTS + "SELECT video_id, shot_id, round(time, 6) AS time, round(depth, 6) AS depth FROM cu", ("boundaries", "videos", "chapters"))
def select_cuts(t):
    return segments.select_cuts(segments.depth_score(t.boundaries), t.videos, t.chapters)


CANDIDATES = CUTS + """, od AS (SELECT d.*, row_number() OVER (PARTITION BY d.video_id ORDER BY d.depth DESC, d.time) AS n FROM d LEFT JOIN cu USING (video_id, shot_id) WHERE cu.time IS NULL),
    pk AS (SELECT video_id, CAST(0 AS BIGINT) AS n, coalesce(list(time) FILTER (WHERE time IS NOT NULL), []) AS times FROM (SELECT DISTINCT video_id FROM d) v LEFT JOIN cu USING (video_id) GROUP BY video_id
      UNION ALL SELECT pk.video_id, od.n, CASE WHEN coalesce(list_min(list_transform(pk.times, lambda t: abs(t - od.time))), 15) >= 15 THEN list_append(pk.times, od.time) ELSE pk.times END
      FROM pk JOIN od ON od.video_id = pk.video_id AND od.n = pk.n + 1 WHERE len(pk.times) < 60),
    pl AS (SELECT video_id, unnest(arg_max(times, n)) AS time FROM pk GROUP BY video_id),
    cd AS (SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY pl.time) AS INT) AS cid, d.shot_id, pl.time, round(d.depth, 3) AS depth, cu.time IS NOT NULL AS chosen_locally
      FROM pl JOIN d USING (video_id, time) LEFT JOIN cu USING (video_id, time))"""
#: Without the edges of short scenes, from the cuts of a table; ``mk`` has the rest.
SHORT = """, ms AS (SELECT video_id, CAST(0 AS BIGINT) AS n, list({{'time': time, 'depth': coalesce(depth, 0)}} ORDER BY time) AS cuts FROM {cuts} GROUP BY video_id
      UNION ALL SELECT video_id, n + 1, list_concat(cuts[:gone - 1], cuts[gone + 1:]) FROM (
        SELECT video_id, n, cuts, CASE WHEN pos = 1 THEN 1 WHEN pos > len(cuts) THEN len(cuts) WHEN cuts[pos - 1].depth <= cuts[pos].depth THEN pos - 1 ELSE pos END AS gone FROM (
          SELECT *, list_position(lengths, list_min(lengths)) AS pos FROM (
            SELECT ms.video_id, n, cuts, list_transform(range(1, len(cuts) + 2), lambda i: coalesce(cuts[i].time, duration) - CASE WHEN i = 1 THEN 0 ELSE cuts[i - 1].time END) AS lengths
            FROM ms JOIN videos ON videos.video_id = ms.video_id WHERE len(cuts) > 0) x WHERE list_min(lengths) < 30) y) z),
    mk AS (SELECT video_id, unnest(arg_max(cuts, n), recursive := true) FROM ms GROUP BY video_id)"""
#: Cuts of a table moved back: how far each would move by the length of its run, then cut after cut; ``sn`` has both times.
SNAP = """, sf AS (SELECT DISTINCT video_id, shot_id FROM faces), sv AS (SELECT video_id, shot_id, CAST(embedding AS DOUBLE[]) AS e FROM shot_vecs),
    cn AS (SELECT video_id, id AS b, start_s AS sb, row_number() OVER (PARTITION BY video_id ORDER BY id) AS n FROM shots JOIN (SELECT DISTINCT video_id, round(time, 4) AS at4 FROM {cuts}) c USING (video_id) WHERE round(start_s, 4) = at4),
    bk AS (SELECT cn.video_id, b, k, p.start_s AS sp, p.id >= 1 AND sf.shot_id IS NULL AND sb - p.start_s <= 15 AS fits FROM cn CROSS JOIN range(1, 5) x(k)
      LEFT JOIN shots p ON p.video_id = cn.video_id AND p.id = b - k LEFT JOIN sf ON sf.video_id = cn.video_id AND sf.shot_id = b - k),
    fl AS (SELECT video_id, b, list({{'fits': fits, 'sp': sp}} ORDER BY k) AS flags FROM bk GROUP BY video_id, b),
    lk AS (SELECT bk.video_id, b, k, o.shot_id - b AS off, list_dot_product(j.e, o.e) AS sim FROM bk JOIN sv j ON j.video_id = bk.video_id AND j.shot_id = b - k
      JOIN sv o ON o.video_id = bk.video_id AND o.shot_id >= b - 10 AND o.shot_id < b + 6),
    nb AS (SELECT video_id, b, r, k, coalesce(max(sim) FILTER (WHERE off >= -r - 6 AND off < -r), '-infinity') > coalesce(max(sim) FILTER (WHERE off >= 0), '-infinity') AS stays FROM lk JOIN range(1, 5) y(r) ON k <= r GROUP BY video_id, b, r, k),
    mv AS (SELECT video_id, b, r, coalesce(min(k) FILTER (WHERE stays) - 1, r) AS moves FROM nb GROUP BY video_id, b, r),
    sw AS (SELECT video_id, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS held, CAST(NULL AS DOUBLE) AS sb FROM cn WHERE n = 1
      UNION ALL SELECT q.video_id, q.n, s.start_s, q.sb FROM (SELECT cn.video_id, cn.n, cn.b, cn.sb,
        coalesce(list_position(list_transform(fl.flags, lambda x: coalesce(x.fits AND x.sp - sw.held >= 30, false)), false) - 1, 4) AS r
        FROM sw JOIN cn ON cn.video_id = sw.video_id AND cn.n = sw.n + 1 JOIN fl ON fl.video_id = cn.video_id AND fl.b = cn.b) q
        LEFT JOIN mv ON mv.video_id = q.video_id AND mv.b = q.b AND mv.r = q.r JOIN shots s ON s.video_id = q.video_id AND s.id = q.b - coalesce(mv.moves, 0)),
    sn AS (SELECT video_id, held AS time, sb AS from_time FROM sw WHERE n > 0)"""


@query(
    CANDIDATES + "SELECT video_id, cid, shot_id, round(time, 6) AS time, round(depth, 6) AS depth, chosen_locally FROM cd",
    ("boundaries", "videos", "chapters"),
)
def refine_candidates(t):
    depth = segments.depth_score(t.boundaries)
    return segments.refine_candidates(depth, segments.select_cuts(depth, t.videos, t.chapters))


@query(CUTS + SHORT.format(cuts="cu") + "SELECT video_id, round(time, 6) AS time, round(depth, 6) AS depth FROM mk", ("boundaries", "videos", "chapters"))
def enforce_min_scene(t):
    return segments.enforce_min_scene(segments.select_cuts(segments.depth_score(t.boundaries), t.videos, t.chapters), t.videos)


@query(BOOSTED + "SELECT video_id, shot_id, round(time, 6) AS time, round(depth, 6) AS depth, round(boosted, 6) AS boosted FROM bd", ("boundaries", "chapters"))
def chapter_bonus(t):
    return segments.chapter_bonus(segments.depth_score(t.boundaries), t.chapters)


@query(
    BOOSTED + """, gv AS (SELECT video_id, time FROM bounds WHERE shot_id % 150 = 0), ea AS (SELECT video_id, CAST(0 AS DOUBLE) AS time FROM (SELECT DISTINCT video_id FROM bd) v UNION SELECT * FROM gv UNION SELECT video_id, duration FROM videos),
    iv AS (SELECT * FROM (SELECT video_id, time AS a, lead(time) OVER (PARTITION BY video_id ORDER BY time) AS b FROM ea) x WHERE b IS NOT NULL)""" + SPLIT.format(longest=120) + """
    SELECT video_id, shot_id, round(time, 6) AS time FROM bd JOIN (SELECT * FROM gv UNION SELECT * FROM sp) c USING (video_id, time)""",
    ("boundaries", "bounds", "videos", "chapters"),
)
def split_long(t):
    """Long scenes of every fifteenth cut that the bonus would choose from."""
    depth = segments.depth_score(t.boundaries)
    cuts = t.bounds.where("shot_id % 150 = 0")
    return segments.split_long(segments.chapter_bonus(depth, t.chapters), cuts, t.videos, max_scene=120.0)


@query(", /* RECURSIVE */ " + SNAP.format(cuts="cuts")[2:] + "SELECT video_id, round(time, 6) AS time, round(from_time, 6) AS from_time FROM sn", ("cuts", "shots", "faces", "shot_vecs"))
def snap_establishing(t):
    return segments.snap_establishing(t.cuts, t.shots, t.faces, t.shot_vecs)


@query(
    CANDIDATES + ", kp AS (SELECT * FROM cd WHERE cid % 2 = 1)" + SHORT.format(cuts="kp") + SNAP.format(cuts="mk") + """,
    sc AS (SELECT shots.*, count(sn.time) OVER (PARTITION BY shots.video_id ORDER BY id) AS scene FROM shots LEFT JOIN (SELECT DISTINCT video_id, time FROM sn) sn ON sn.video_id = shots.video_id AND round(sn.time, 4) = round(start_s, 4) AND id > 0)
    SELECT video_id, scene AS id, round(min(start_s), 6) AS start_s, round(max(end_s), 6) AS end_s, min(id) AS first_shot, max(id) AS last_shot FROM sc GROUP BY video_id, scene""",
    ("boundaries", "videos", "chapters", "shots", "faces", "shot_vecs"),
)
def apply_refinement(t):
    """Every second candidate is kept."""
    depth = segments.depth_score(t.boundaries)
    candidates = segments.refine_candidates(depth, segments.select_cuts(depth, t.videos, t.chapters))
    answers = t.videos.select("video_id", F.array(*[F.lit(k) for k in range(1, 200, 2)]).alias("keep"))
    return segments.apply_refinement(candidates, answers, t.videos, t.shots, t.faces, t.shot_vecs)


@query("SELECT video_id, id AS cid FROM shots WHERE EXISTS (SELECT 1 FROM ev WHERE ev.video_id = shots.video_id AND ev.event_id % 300 = id AND ev.value > 100)", ("ev", "shots"))
def kept_candidates(t):
    """Events name the ids to keep: some twice, some of no shot."""
    answers = t.ev.where("value > 100").groupBy("video_id").agg(F.collect_list((F.col("event_id") % 300).cast("int")).alias("keep"))
    return segments.kept_candidates(t.shots.select("video_id", F.col("id").cast("int").alias("cid")), answers)


@query(
    """, q AS (SELECT shots.video_id, shots.id, count(b.time) OVER (PARTITION BY shots.video_id ORDER BY shots.id) AS scene FROM shots LEFT JOIN boundaries b ON b.video_id = shots.video_id AND b.shot_id = shots.id AND shots.id % 30 = 0 AND b.sim < 0.7),
    x AS (SELECT video_id, min(id) AS first_shot, max(id) AS last_shot FROM q GROUP BY video_id, scene), y AS (SELECT video_id, first_shot, last_shot FROM scenes),
    z AS ((SELECT * FROM x EXCEPT SELECT * FROM y) UNION ALL (SELECT * FROM y EXCEPT SELECT * FROM x))
    SELECT DISTINCT video_id, CASE WHEN video_id IN (SELECT video_id FROM z) THEN 'refined' ELSE 'local' END AS method FROM scenes""",
    ("shots", "boundaries", "scenes"),
)
def scene_method(t):
    """Refined scenes lack the cuts between shots that are alike."""
    return segments.scene_method(t.scenes, timeline.scenes_from_cuts(t.shots, t.boundaries.where("shot_id % 30 = 0 AND sim < 0.7").select("video_id", "time")))


def _unit(raw: str) -> str:
    return f"list_transform({raw}, lambda x: x / sqrt(list_dot_product({raw}, {raw})))"


def _text(vector: str) -> str:
    """A vector's components at 6 decimals, joined; the same digits from both engines."""
    return f"array_to_string(list_transform({vector}, lambda x: printf('%.6f', round(x, 6) + 0.0)), ',')"


def _joined(vector: str) -> F.Column:
    @F.arrow_udf("string")
    def texts(vectors: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(vectors).fill_null(0).to_numpy()
        numbers = (np.round(vectors.flatten().to_numpy(zero_copy_only=False).astype(float), 6) + 0.0).tolist()
        made, at = [], 0
        for size in sizes.tolist():
            made.append(",".join(["%.6f"] * size) % tuple(numbers[at : at + size]))
            at += size
        return pc.if_else(vectors.is_valid(), pa.array(made, pa.string()), None)

    return texts(vector)


@query(
    f""", k AS (SELECT s.video_id, s.id AS shot_id, CAST(e.embedding AS DOUBLE[]) AS emb FROM shots s, n_vecs c, range(0, 3) r(k), embeddings e WHERE s.id % 9 <> 0 AND e.vec_id = (s.video_id * 97 + s.id * 3 + r.k) % c.n),
    u AS (SELECT video_id, shot_id, {_unit('emb')} AS emb FROM k),
    m AS (SELECT video_id, shot_id, p, avg(v) AS v FROM (SELECT video_id, shot_id, unnest(emb) AS v, generate_subscripts(emb, 1) AS p FROM u) q GROUP BY ALL),
    l AS (SELECT video_id, shot_id, list(v ORDER BY p) AS raw FROM m GROUP BY ALL)
    SELECT s.video_id, s.id AS shot_id, coalesce({_text(_unit('raw'))}, array_to_string(list_transform(range(0, 64), lambda x: '0.000000'), ',')) AS vec FROM shots s LEFT JOIN l ON s.video_id = l.video_id AND s.id = l.shot_id""",
    ("shots", "n_vecs"),
)
def shot_vectors(t):
    n = t.read("embeddings").count()
    k = t.shots.select("video_id", F.col("id").alias("shot_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).where("shot_id % 9 <> 0")
    k = k.withColumn("vec_id", (F.col("video_id") * 97 + F.col("shot_id") * 3 + F.col("k")) % n).join(t.read("embeddings"), "vec_id")
    return segments.shot_vectors(k, t.shots, 64).select("video_id", "shot_id", _joined("embedding").alias("vec"))


# --- faces ----------------------------------------------------------------------------------------
@query(
    """, st AS (SELECT *, dense_rank() OVER (PARTITION BY video_id, shot_id ORDER BY ts) AS step FROM faces),
    p AS (SELECT a.video_id, a.shot_id, a.det_id AS det_a, b.det_id AS det_b, (a.x2 - a.x1) * (a.y2 - a.y1) AS sa, (b.x2 - b.x1) * (b.y2 - b.y1) AS sb,
      greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS i
      FROM st a JOIN st b ON a.video_id = b.video_id AND a.shot_id = b.shot_id AND b.step = a.step + 1)
    SELECT video_id, shot_id, det_a, det_b, round(i / (sa + sb - i + 1e-9), 6) AS iou FROM p""",
    ("faces",),
)
def pairwise_iou(t):
    return faces.pairwise_iou(t.faces)


#: Kept detections with vectors, and a track of every fiftieth.
DETS = """, d AS (SELECT f.*, f.det_id % 50 AS track_id, f.det_score * least(greatest(f.sharpness / 200, 0.1), 1.0) AS q, CAST(e.embedding AS DOUBLE[]) AS emb FROM faces f, n_vecs c, embeddings e WHERE e.vec_id = f.det_id % c.n)"""
CENTRES = DETS + f""", m AS (SELECT video_id, grp, p, avg(v) AS v FROM (SELECT video_id, grp, unnest(emb) AS v, generate_subscripts(emb, 1) AS p FROM d WHERE grp > 0 AND tier = 'anchor') q GROUP BY ALL),
    l AS (SELECT video_id, grp, list(v ORDER BY p) AS raw FROM m GROUP BY ALL), ce AS (SELECT video_id, grp, {_unit('raw')} AS cen FROM l)"""


def _tracked(t):
    return faces.build_tracks(t.detections().withColumn("shot_id", F.floor(F.col("ts") / 60).cast("int")), min_iou=0.01, min_cos=-1.0)


@query()
def build_tracks(t):
    return _tracked(t).select("video_id", "det_id", "track_id")


@query(
    DETS + f""", m AS (SELECT video_id, track_id, p, sum(q * v) AS v FROM (SELECT video_id, track_id, q, unnest(emb) AS v, generate_subscripts(emb, 1) AS p FROM d WHERE tier = 'anchor') x GROUP BY ALL),
    l AS (SELECT video_id, track_id, list(v ORDER BY p) AS raw FROM m GROUP BY ALL), n AS (SELECT video_id, track_id, count(*) AS n_dets, count(*) FILTER (WHERE tier = 'anchor') AS n_anchor FROM d GROUP BY ALL),
    fr AS (SELECT video_id, track_id, string_agg(printf('%.2f', ts), ',' ORDER BY ts) AS frames FROM (SELECT DISTINCT video_id, track_id, ts FROM d) x GROUP BY ALL)
    SELECT n.video_id, n.track_id, n_dets, n_anchor, frames, coalesce({_text('list_transform(raw, lambda x: x / (sqrt(list_dot_product(raw, raw)) + 1e-9))')}, '') AS vec
    FROM n JOIN fr ON n.video_id = fr.video_id AND n.track_id = fr.track_id LEFT JOIN l ON n.video_id = l.video_id AND n.track_id = l.track_id""",
    ("faces", "n_vecs"),
)
def track_embeddings(t):
    df = faces.track_embeddings(t.detections().withColumn("track_id", F.col("det_id") % 50))
    frames = F.array_join(F.transform("frames", lambda x: F.format_string("%.2f", x)), ",")
    return df.select("video_id", "track_id", "n_dets", "n_anchor", frames.alias("frames"), F.coalesce(_joined("embedding"), F.lit("")).alias("vec"))


def _track_table(t):
    """Tracks of every fiftieth detection, so that many have anchors, with a cluster of ten."""
    return identities.track_table(t.detections().withColumn("track_id", F.col("det_id") % 50))


@query()
def link_tracks(t):
    return identities.link_tracks(_track_table(t))


@query()
def resolve_conflicts(t):
    return identities.resolve_conflicts(_track_table(t).withColumn("cluster", F.col("track_id") % 10))


@query()
def rescue_tracks(t):
    return identities.rescue_tracks(_track_table(t).withColumn("cluster", F.when(F.col("track_id") % 3 == 0, F.col("track_id") % 10).otherwise(-1)), 0.05)


@query()
def merge_close_groups(t):
    return identities.merge_close_groups(_track_table(t).withColumn("cluster", F.col("track_id")), 0.05)


@query()
def rescue_weak_tracks(t):
    return identities.rescue_weak_tracks(identities.track_table(_tracked(t), weak_only=True).withColumn("cluster", F.when(F.col("n_anchor") > 0, F.col("track_id") % 10).otherwise(-1)), 0.1)


@query()
def cluster_tracks(t):
    return identities.cluster_tracks(_tracked(t)).select("video_id", "det_id", "cluster")


@query(
    """, k AS (SELECT video_id, CASE WHEN det_id % 40 = 0 THEN 100 + det_id ELSE grp END AS cluster, det_id AS track_id, 1 + det_id % 4 AS n_dets FROM faces),
    c AS (SELECT video_id, cluster, count(*) AS n, sum(n_dets) AS d FROM k GROUP BY video_id, cluster)
    SELECT k.video_id, k.track_id, CASE WHEN c.n = 1 AND c.d < 3 THEN -1 ELSE k.cluster END AS cluster FROM k JOIN c ON k.video_id = c.video_id AND k.cluster = c.cluster""",
    ("faces",),
)
def dissolve_tiny(t):
    cluster = F.when(F.col("det_id") % 40 == 0, 100 + F.col("det_id")).otherwise(F.col("group"))
    k = t.faces.select("video_id", cluster.alias("cluster"), F.col("det_id").alias("track_id"), (1 + F.col("det_id") % 4).alias("n_dets"))
    return faces.dissolve_tiny(k)


@query(
    """, k AS (SELECT video_id, det_id, CASE WHEN grp > 0 THEN grp ELSE -1 END AS cluster FROM faces),
    r AS (SELECT video_id, cluster, row_number() OVER (PARTITION BY video_id ORDER BY count(*) DESC, cluster) AS g FROM k WHERE cluster >= 0 GROUP BY video_id, cluster)
    SELECT k.video_id, k.det_id, coalesce(r.g, -1) AS grp FROM k LEFT JOIN r ON k.video_id = r.video_id AND k.cluster = r.cluster""",
    ("faces",),
)
def rank_groups(t):
    return faces.rank_groups(t.faces.withColumnRenamed("group", "cluster")).select("video_id", "det_id", "group")


@query(
    CENTRES + """, n AS (SELECT video_id, grp, count(*) AS detections, count(DISTINCT track_id) AS tracks FROM d WHERE grp > 0 GROUP BY ALL),
    own AS (SELECT d.video_id, d.grp, avg(list_dot_product(emb, cen)) AS c FROM d JOIN ce ON d.video_id = ce.video_id AND d.grp = ce.grp WHERE tier = 'anchor' GROUP BY ALL),
    nr AS (SELECT a.video_id, a.grp, b.grp AS other, list_dot_product(a.cen, b.cen) AS cos, row_number() OVER (PARTITION BY a.video_id, a.grp ORDER BY list_dot_product(a.cen, b.cen) DESC, b.grp) AS r FROM ce a JOIN ce b ON a.video_id = b.video_id AND a.grp <> b.grp)
    SELECT n.video_id, n.grp, detections, tracks, round(own.c, 6) AS mean_cos_to_centroid, nr.other AS nearest_group, coalesce(round(nr.cos, 6), 0.0) AS nearest_cos
    FROM n JOIN own ON n.video_id = own.video_id AND n.grp = own.grp LEFT JOIN nr ON n.video_id = nr.video_id AND n.grp = nr.grp AND nr.r = 1""",
    ("faces", "n_vecs"),
)
def group_stats(t):
    return faces.group_stats(t.detections().withColumn("track_id", F.col("det_id") % 50))


@query(
    """, r AS (SELECT video_id, grp, det_id, row_number() OVER (PARTITION BY video_id, grp ORDER BY ts, det_id) - 1 AS i, count(*) OVER (PARTITION BY video_id, grp) AS n FROM faces WHERE grp > 0),
    s AS (SELECT *, unnest(range(0, least(n, 64))) AS place FROM r)
    SELECT video_id, grp, det_id, place, CAST(floor(place / 8.0) AS BIGINT) AS sheet_row, place % 8 AS sheet_col FROM s WHERE i = round_even(place * (n - 1) / greatest(least(n, 64) - 1, 1)::DOUBLE, 0)""",
    ("faces",),
)
def even_sample(t):
    return faces.even_sample(t.faces).select("video_id", "group", "det_id", "place", "sheet_row", "sheet_col")


@query(
    """, h AS (SELECT f.*, s.id AS window_id, det_score * least(greatest(sharpness / 200, 0.1), 1.0) AS q FROM faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s WHERE f.grp > 0),
    k AS (SELECT * FROM (SELECT *, max(CASE WHEN tier = 'anchor' THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, window_id, grp) AS has FROM h) x WHERE has = 0 OR tier = 'anchor'),
    r AS (SELECT *, row_number() OVER (PARTITION BY video_id, window_id, grp ORDER BY q DESC, det_id) AS r FROM k),
    o AS (SELECT *, row_number() OVER (PARTITION BY video_id, window_id, grp ORDER BY ts, det_id) - 1 AS i, count(*) OVER (PARTITION BY video_id, window_id, grp) AS n FROM r WHERE r <= 16),
    p AS (SELECT *, unnest(range(0, least(n, 4))) AS place FROM o)
    SELECT video_id, window_id, grp, det_id, place FROM p WHERE i = round_even(place * (n - 1) / greatest(least(n, 4) - 1, 1)::DOUBLE, 0)""",
    ("faces", "scenes"),
)
def best_crops(t):
    windows = t.scenes.withColumnRenamed("id", "window_id")
    return faces.best_crops(t.faces, windows).select("video_id", "window_id", "group", "det_id", "place")


@query(
    """SELECT video_id, left(sha256(string_agg(CAST(det_id AS VARCHAR) || ':' || CAST(grp AS VARCHAR), ',' ORDER BY det_id)), 16) AS signature FROM faces GROUP BY video_id""",
    ("faces",),
)
def grouping_signature(t):
    return faces.grouping_signature(t.faces)


AGREEMENT = CENTRES + """, b AS (SELECT d.video_id, d.grp, d.det_id, ce.grp AS other, row_number() OVER (PARTITION BY d.video_id, d.det_id ORDER BY list_dot_product(d.emb, ce.cen) DESC, ce.grp) AS r FROM d JOIN ce ON d.video_id = ce.video_id WHERE d.grp > 0),
    ag AS (SELECT video_id, grp, count(*) AS total, count(*) FILTER (WHERE other = grp) AS agreeing FROM b WHERE r = 1 GROUP BY ALL) """


@query(AGREEMENT + "SELECT * FROM ag", ("faces", "n_vecs"))
def identity_agreement(t):
    d = t.detections().where("group > 0")
    return faces.identity_agreement(d.withColumnRenamed("det_id", "crop_id"), faces.group_centroids(d))


@query(
    AGREEMENT + """, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY agreeing / total::DOUBLE, grp) AS n FROM ag)
    SELECT video_id, CAST(sum(total) AS BIGINT) AS total, CAST(sum(agreeing) AS BIGINT) AS agreeing, string_agg('group' || CAST(grp AS VARCHAR) || ' ' || CAST(agreeing AS VARCHAR) || '/' || CAST(total AS VARCHAR), ', ' ORDER BY n) FILTER (WHERE n <= 3) AS lowest FROM r GROUP BY video_id""",
    ("faces", "n_vecs"),
)
def agreement_summary(t):
    d = t.detections().where("group > 0")
    return faces.agreement_summary(faces.identity_agreement(d.withColumnRenamed("det_id", "crop_id"), faces.group_centroids(d)))


# --- evidence and answers -------------------------------------------------------------------------
@query(
    """, h AS (SELECT s.video_id, s.id AS window_id, f.grp, count(*) AS detections FROM faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s WHERE f.grp > 0 GROUP BY ALL)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, window_id ORDER BY detections DESC, grp) AS rank FROM h) q WHERE rank <= 3""",
    ("faces", "scenes"),
)
def top_groups(t):
    return evidence.top_groups(t.faces, t.scenes.withColumnRenamed("id", "window_id"), 3)


@query(
    """, o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_s) AS n FROM scenes),
    r AS /* RECURSIVE */ (SELECT video_id, id, n, start_s, end_s, 0 AS window_id, start_s AS origin FROM o WHERE n = 1
      UNION ALL SELECT o.video_id, o.id, o.n, o.start_s, o.end_s, CASE WHEN o.end_s - r.origin > 600 THEN r.window_id + 1 ELSE r.window_id END, CASE WHEN o.end_s - r.origin > 600 THEN o.start_s ELSE r.origin END
      FROM r JOIN o ON o.video_id = r.video_id AND o.n = r.n + 1)
    SELECT video_id, id AS scene_id, window_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM r""",
    ("scenes",),
)
def description_windows(t):
    return evidence.description_windows(t.scenes)


@query(
    """, n AS (SELECT b.video_id, b.shot_id, f.grp, count(*) AS n FROM bounds b JOIN faces f ON f.video_id = b.video_id AND f.ts >= b.time - 60 AND f.ts < b.time + 60 AND f.grp > 0 GROUP BY ALL),
    g AS (SELECT video_id, shot_id, string_agg('group' || CAST(grp AS VARCHAR), ',' ORDER BY n DESC, grp) AS groups FROM n GROUP BY ALL),
    sg AS (SELECT *, (start_s + end_s) / 2 AS mid FROM segments),
    b4 AS (SELECT b.video_id, b.shot_id, string_agg(s.text, ' ' ORDER BY s.seg_no) AS x FROM bounds b JOIN sg s ON s.video_id = b.video_id AND s.mid >= b.time - 20 AND s.mid < b.time GROUP BY ALL),
    af AS (SELECT b.video_id, b.shot_id, string_agg(s.text, ' ' ORDER BY s.seg_no) AS x FROM bounds b JOIN sg s ON s.video_id = b.video_id AND s.mid >= b.time AND s.mid < b.time + 20 GROUP BY ALL)
    SELECT b.video_id, b.shot_id AS cid, printf('%02d:%02d:%05.2f', CAST(floor(b.time / 3600) AS INT), CAST(floor((b.time % 3600) / 60) AS INT), b.time % 60) AS at, 0.5 AS depth, coalesce(g.groups, '-') AS groups,
    CASE WHEN length(coalesce(b4.x, '')) <= 250 THEN coalesce(b4.x, '') ELSE '...' || right(b4.x, 250) END AS before, CASE WHEN length(coalesce(af.x, '')) <= 250 THEN coalesce(af.x, '') ELSE substr(af.x, 1, 250) || '...' END AS after
    FROM bounds b LEFT JOIN g ON b.video_id = g.video_id AND b.shot_id = g.shot_id LEFT JOIN b4 ON b.video_id = b4.video_id AND b.shot_id = b4.shot_id LEFT JOIN af ON b.video_id = af.video_id AND b.shot_id = af.shot_id""",
    ("bounds", "faces", "segments"),
)
def candidate_evidence(t):
    c = t.bounds.select("video_id", F.col("shot_id").alias("cid"), "time", F.lit(0.5).alias("depth"))
    return evidence.candidate_evidence(c, t.segments, t.faces)


@query(
    """, n AS (SELECT s.video_id, s.id AS scene_id, f.grp, count(*) AS n FROM scenes s JOIN faces f ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s AND f.grp > 0 GROUP BY ALL),
    pe AS (SELECT video_id, scene_id, string_agg('group' || CAST(grp AS VARCHAR) || ' ' || CAST(n AS VARCHAR) || ' s', ', ' ORDER BY n DESC, grp) AS people FROM n GROUP BY ALL),
    tr AS (SELECT s.video_id, s.id AS scene_id, string_agg(g.text, ' ' ORDER BY g.seg_no) AS x FROM scenes s JOIN segments g ON g.video_id = s.video_id AND (g.start_s + g.end_s) / 2 >= s.start_s AND (g.start_s + g.end_s) / 2 < s.end_s GROUP BY ALL)
    SELECT s.video_id, s.id AS scene_id, printf('%02d:%02d:%05.2f', CAST(floor(s.start_s / 3600) AS INT), CAST(floor((s.start_s % 3600) / 60) AS INT), s.start_s % 60) AS from_hms,
    printf('%02d:%02d:%05.2f', CAST(floor(s.end_s / 3600) AS INT), CAST(floor((s.end_s % 3600) / 60) AS INT), s.end_s % 60) AS to_hms, coalesce(people, 'no faces detected') AS people,
    CASE WHEN length(coalesce(x, '')) <= 4000 THEN coalesce(x, '') ELSE substr(x, 1, 4000) || '...' END AS transcript
    FROM scenes s LEFT JOIN pe ON s.video_id = pe.video_id AND s.id = pe.scene_id LEFT JOIN tr ON s.video_id = tr.video_id AND s.id = tr.scene_id""",
    ("scenes", "faces", "segments"),
)
def scene_evidence(t):
    return evidence.scene_evidence(t.scenes, t.segments, t.faces)


@query(
    """SELECT conv_id AS request_id, CAST(sum(CASE WHEN turn % 3 = 0 THEN floor(length(text) / 3.0) WHEN turn % 3 = 1 THEN 300 ELSE floor(110 * length(text) / 7.0::DOUBLE) END) AS BIGINT) AS tokens,
    sum(CASE WHEN turn % 3 = 0 THEN floor(length(text) / 3.0) WHEN turn % 3 = 1 THEN 300 ELSE floor(110 * length(text) / 7.0::DOUBLE) END) > 5000 AS over FROM conversations GROUP BY conv_id"""
)
def request_tokens(t):
    k = F.col("turn") % 3
    items = t.read("conversations").select(
        F.col("conv_id").alias("request_id"), F.when(k == 0, "text").when(k == 1, "image").otherwise("video").alias("kind"), F.col("text").alias("val"), (F.length("text") / 7.0).alias("seconds")
    )
    return evidence.request_tokens(items, 5000)


def _keys(t):
    rows = t.read("conversations").select(F.col("conv_id").alias("request_id"), F.explode(F.array(F.lit("main"), F.lit("spare"))).alias("model"), F.col("turn").alias("item_no"), F.col("role").alias("kind"), F.col("text").alias("val"), F.lit("low").alias("resolution"))
    return evidence.request_key(rows)


def _cache(t, keys):
    """Main answers for conversations that open with a system turn, spare ones for those with five turns or more."""
    turns = t.read("conversations").groupBy(F.col("conv_id").alias("request_id")).agg(F.count_if(F.col("role") == "system").alias("system"), F.count("*").alias("n"))
    hit = ((F.col("model") == "main") & (F.col("system") > 0)) | ((F.col("model") == "spare") & (F.col("n") >= 5))
    return keys.join(turns, "request_id").where(hit).select("key", F.concat("model", F.lit("-"), "request_id").alias("text"))


CACHED = """WITH tn AS (SELECT conv_id, count(*) FILTER (WHERE role = 'system') AS system, count(*) AS n FROM conversations GROUP BY conv_id),
    hi AS (SELECT conv_id, CASE WHEN system > 0 THEN 'main' WHEN n >= 5 THEN 'spare' END AS model FROM tn) """


@query(
    """SELECT conv_id AS request_id, m.model, sha256(to_json({'model': m.model, 'items': list({'item_no': turn, 'kind': role, 'val': text} ORDER BY turn, role, text), 'resolution': 'low'})) AS key
    FROM conversations, (VALUES ('main'), ('spare')) m(model) GROUP BY conv_id, m.model"""
)
def request_key(t):
    return _keys(t)


@query(CACHED + "SELECT conv_id AS request_id, model, model || '-' || CAST(conv_id AS VARCHAR) AS text FROM hi WHERE model IS NOT NULL")
def cache_lookup(t):
    keys = _keys(t)
    return evidence.cache_lookup(keys, _cache(t, keys), ["main", "spare"])


@query(CACHED + "SELECT conv_id AS request_id FROM hi WHERE model IS NULL")
def pending_requests(t):
    keys = _keys(t)
    return evidence.pending_requests(keys, _cache(t, keys))


@query(CACHED + "SELECT CASE WHEN model IS NULL THEN 'later-' ELSE model || '-' END || CAST(conv_id AS VARCHAR) AS text FROM hi UNION ALL SELECT 'spare-' || CAST(conv_id AS VARCHAR) FROM tn WHERE system > 0 AND n >= 5")
def append_answers(t):
    """A cache on disk, to which the answers of what is pending are added, twice, along with answers that are there."""
    keys, path = _keys(t), io.scratch_path(t.spark, "answers")
    known = _cache(t, keys)
    evidence.append_answers(known, path)
    pending = evidence.pending_requests(keys, known).join(keys.where("model = 'main'"), "request_id")
    fresh = pending.select("key", F.concat(F.lit("later-"), "request_id").alias("text"))
    for _ in range(2):
        evidence.append_answers(fresh.union(known.select("key", F.lit("too late"))), path)
    return t.spark.read.parquet(path).select("text")


@query(
    """, fi AS (SELECT DISTINCT video_id, CAST(floor(event_id % 3000 / 10.0) AS BIGINT) AS scene_id, event_id % 10 AS kind FROM ev)
    SELECT s.video_id, s.id AS scene_id, CASE WHEN a.kind IS NOT NULL THEN 'answered' WHEN b.kind IS NOT NULL THEN 'fallback' ELSE 'failed' END AS outcome, CASE WHEN a.kind IS NOT NULL THEN 'main' WHEN b.kind IS NOT NULL THEN 'spare' END AS model
    FROM scenes s LEFT JOIN fi a ON a.video_id = s.video_id AND a.scene_id = s.id AND a.kind = 1 LEFT JOIN fi b ON b.video_id = s.video_id AND b.scene_id = s.id AND b.kind = 2""",
    ("ev", "scenes"),
)
def reconcile_answers(t):
    """Events answer: by their last digit for one model or the other, for scenes that are there or not."""
    said = t.ev.select("video_id", F.floor(F.col("event_id") % 3000 / 10).cast("long").alias("scene_id"), (F.col("event_id") % 10).alias("kind"))
    of = lambda kind, model: said.where(F.col("kind") == kind).select("video_id", "scene_id", F.lit(model).alias("model"))
    return evidence.reconcile_answers(t.scenes.select("video_id", F.col("id").alias("scene_id")), of(1, "main"), of(2, "spare"))


ANSWERS = """, ans AS (SELECT video_id, id AS scene_id FROM scenes), con AS (
    SELECT video_id, scene_id, 0 AS pos, 'group' || CAST(1 + scene_id % 10 AS VARCHAR) AS grp, 'host' AS role, 'Person ' || CAST(scene_id % 4 AS VARCHAR) AS name FROM ans
    UNION ALL SELECT video_id, scene_id, 1, 'group' || CAST(1 + scene_id % 10 AS VARCHAR), 'guest', 'Other' FROM ans
    UNION ALL SELECT video_id, scene_id, 2, 'group' || CAST(1 + (scene_id + 3) % 10 AS VARCHAR), 'guest', CASE WHEN scene_id % 2 = 0 THEN '' END FROM ans
    UNION ALL SELECT video_id, scene_id, 3, NULL, 'narrator', CASE WHEN scene_id % 5 = 0 THEN 'A Voice' END FROM ans),
    nm AS (SELECT video_id, grp, name FROM (SELECT *, row_number() OVER (PARTITION BY video_id, grp ORDER BY n DESC, length(name) DESC, f, p) AS r FROM (
      SELECT video_id, grp, name, count(*) AS n, min(scene_id) AS f, min(scene_id * 10 + pos) AS p FROM con WHERE grp IS NOT NULL AND name <> '' GROUP BY video_id, grp, name) a) b WHERE r = 1) """


def _answers(t):
    """Answers as a model would give them, one per scene, through their JSON."""
    s = t.scenes.select("video_id", F.col("id").alias("scene_id"))
    n = F.col("scene_id")
    person = lambda g, role, name: F.struct(g.alias("group"), F.lit(role).alias("role"), name.alias("name"))
    people = F.array(
        person(F.concat(F.lit("group"), 1 + n % 10), "host", F.concat(F.lit("Person "), n % 4)),
        person(F.concat(F.lit("Group_0"), 1 + n % 10), "guest", F.lit("Other")),
        person(F.concat(F.lit("group "), 1 + (n + 3) % 10), "guest", F.when(n % 2 == 0, "")),
        person(F.lit(None).cast("string"), "narrator", F.when(n % 5 == 0, "A Voice")),
    )
    body = F.to_json(F.struct("scene_id", F.lit("Title").alias("title"), F.lit("A talk.").alias("central_theme"), people.alias("key_contributors"), F.array(F.lit("They meet."), F.lit("They part")).alias("events")))
    return s.select("video_id", F.lit("main").alias("model"), F.when(n % 13 == 12, F.lit('{"scene_id": "x"')).otherwise(body).alias("json"))


@query(
    """SELECT video_id, 'main' AS model, true AS good, id AS scene_id, 'Title' AS title, 'A talk.' AS theme, 'group' || CAST(1 + id % 10 AS VARCHAR) || ' host Person ' || CAST(id % 4 AS VARCHAR)
      || '; Group_0' || CAST(1 + id % 10 AS VARCHAR) || ' guest Other; group ' || CAST(1 + (id + 3) % 10 AS VARCHAR) || ' guest ' || CASE WHEN id % 2 = 0 THEN '' ELSE '-' END || '; - narrator ' || CASE WHEN id % 5 = 0 THEN 'A Voice' ELSE '-' END AS people,
      'They meet.;They part' AS events, NULL AS json FROM scenes WHERE id % 13 <> 12
    UNION ALL SELECT video_id, 'main', false, NULL, NULL, NULL, NULL, NULL, '{"scene_id": "x"' FROM scenes WHERE id % 13 = 12""",
    ("scenes",),
)
def parse_answers(t):
    good, bad = evidence.parse_answers(_answers(t))
    person = lambda c: F.concat_ws(" ", *[F.coalesce(c[x], F.lit("-")) for x in ("group", "role", "name")])
    good = good.select(
        "video_id", "model", F.lit(True).alias("good"), F.col("scene_id").cast("long").alias("scene_id"), "title", F.col("central_theme").alias("theme"),
        F.array_join(F.transform("key_contributors", person), "; ").alias("people"), F.array_join("events", ";").alias("events"), F.lit(None).cast("string").alias("json"),
    )
    none = [F.lit(None).cast(k) for k in ("long", "string", "string", "string", "string")]
    return good.union(bad.select("video_id", "model", F.lit(False), *none, "json"))


@query(ANSWERS.replace("FROM scenes)", "FROM scenes WHERE id % 13 <> 12)") + "SELECT * FROM nm", ("scenes",))
def group_names(t):
    return evidence.group_names(evidence.parse_answers(_answers(t))[0])


@query(
    """SELECT DISTINCT f.video_id, s.id AS scene_id, 'group' || CAST(f.grp AS VARCHAR) AS grp FROM faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s WHERE f.grp > 0""",
    ("faces", "scenes"),
)
def scene_presence(t):
    return evidence.scene_presence(t.faces, t.scenes)


@query(
    ANSWERS.replace("FROM scenes)", "FROM scenes WHERE id % 13 <> 12)")
    + """, pr AS (SELECT DISTINCT f.video_id, s.id AS scene_id, 'group' || CAST(f.grp AS VARCHAR) AS grp FROM faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s WHERE f.grp > 0),
    c AS (SELECT con.*, pr.grp IS NOT NULL AS here, row_number() OVER (PARTITION BY con.video_id, con.scene_id, con.grp ORDER BY pos) AS n, nm.name AS voted FROM con
      LEFT JOIN pr ON con.video_id = pr.video_id AND con.scene_id = pr.scene_id AND con.grp = pr.grp LEFT JOIN nm ON con.video_id = nm.video_id AND con.grp = nm.grp)
    SELECT video_id, scene_id, 'Central theme: A talk. Key contributors: ' || string_agg(CASE WHEN here AND coalesce(voted, nullif(name, '')) IS NOT NULL THEN grp || ' (' || coalesce(voted, name) || ', ' || role || ')'
      WHEN here THEN grp || ' (' || role || ')' WHEN nullif(name, '') IS NOT NULL THEN name || ' (' || role || ', off-screen)' ELSE 'an off-screen ' || role END, ', ' ORDER BY pos) || '. Events: (1) They meet; (2) They part.' AS description
    FROM c WHERE NOT here OR n = 1 GROUP BY video_id, scene_id""",
    ("scenes", "faces"),
)
def compose_description(t):
    good = evidence.parse_answers(_answers(t))[0]
    return evidence.compose_description(good, evidence.scene_presence(t.faces, t.scenes), evidence.group_names(good))


# --- documents and checks -------------------------------------------------------------------------
@query("SELECT video_id, det_id, ts, grp FROM best_faces", ("best_faces",))
def dedupe_faces(t):
    return export.dedupe_faces(t.faces).select("video_id", "det_id", "ts", "group")


@query(
    """, a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= 1.5 THEN 0 ELSE 1 END AS fresh FROM appearances WINDOW w AS (PARTITION BY video_id, scene_id, grp ORDER BY ts)),
    b AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id, scene_id, grp ORDER BY ts) AS run FROM a)
    SELECT video_id, scene_id, grp, min(ts) AS start_s, max(ts) AS end_s, count(*) AS n FROM b GROUP BY video_id, scene_id, grp, run""",
    ("appearances",),
)
def appearance_intervals(t):
    return export.appearance_intervals(export.scene_appearances(t.faces, t.scenes))


@query(
    """, m AS (SELECT video_id, scene_id, grp, string_agg(printf('%.2f', ts), ',' ORDER BY ts) AS ts FROM appearances GROUP BY ALL)
    SELECT s.video_id, s.id AS scene_id, coalesce(string_agg('group' || CAST(m.grp AS VARCHAR) || '=' || m.ts, ';' ORDER BY m.grp), '') AS faces FROM scenes s LEFT JOIN m ON s.video_id = m.video_id AND s.id = m.scene_id GROUP BY ALL""",
    ("appearances", "scenes"),
)
def scene_face_map(t):
    entries = F.array_sort(F.transform(F.map_entries("faces"), lambda e: F.struct(F.substring(e["key"], 6, 9).cast("int").alias("g"), F.array_join(F.transform(e["value"], lambda x: F.format_string("%.2f", x)), ",").alias("t"))))
    text = F.array_join(F.transform(entries, lambda e: F.concat(F.lit("group"), e["g"], F.lit("="), e["t"])), ";")
    return export.scene_face_map(t.faces, t.scenes).select("video_id", "scene_id", text.alias("faces"))


def _document(t):
    words = t.scenes.select("video_id", F.col("id").alias("scene_id"), F.concat(F.lit("Scene "), "id").alias("description"))
    return export.output_doc(t.shots, t.scenes, t.faces, words)


def _face_text(faces_map) -> F.Column:
    """A face map as "group=times" by group number."""
    entries = F.array_sort(F.transform(F.map_entries(faces_map), lambda e: F.struct(F.substring(e["key"], 6, 9).cast("int").alias("g"), F.array_join(F.transform(e["value"], lambda x: F.format_string("%.2f", x)), ",").alias("t"))))
    return F.array_join(F.transform(entries, lambda e: F.concat(F.lit("group"), e["g"], F.lit("="), e["t"])), ";")


def _opened(doc):
    """Every shot and scene of result documents, a row each."""
    shots = doc.select("video_id", F.posexplode("shots").alias("n", "x")).select("video_id", "n", F.lit("shot").alias("kind"), "x.id", "x.start_seconds", "x.end_seconds", F.lit("").alias("description"), F.lit("").alias("faces"))
    scenes = doc.select("video_id", F.posexplode("scenes").alias("n", "x"))
    return shots.union(scenes.select("video_id", "n", F.lit("scene"), "x.id", "x.start_seconds", "x.end_seconds", "x.description", _face_text("x.faces")))


DOCUMENT = """, m AS (SELECT video_id, scene_id, grp, string_agg(printf('%.2f', ts), ',' ORDER BY ts) AS ts FROM appearances GROUP BY ALL),
    fc AS (SELECT video_id, scene_id, string_agg('group' || CAST(grp AS VARCHAR) || '=' || ts, ';' ORDER BY grp) AS faces FROM m GROUP BY ALL)
    SELECT video_id, CAST(id AS INT) AS n, 'shot' AS kind, id, round(start_s, 3) AS start_seconds, round(end_s, 3) AS end_seconds, '' AS description, '' AS faces FROM shots
    UNION ALL SELECT s.video_id, CAST(s.id AS INT), 'scene', s.id, round(s.start_s, 3), round(s.end_s, 3), 'Scene ' || CAST(s.id AS VARCHAR), coalesce(fc.faces, '') FROM scenes s LEFT JOIN fc ON s.video_id = fc.video_id AND s.id = fc.scene_id"""


@query(DOCUMENT, ("shots", "scenes", "appearances"))
def output_doc(t):
    return _opened(_document(t))


@query(DOCUMENT, ("shots", "scenes", "appearances"))
def write_output_json(t):
    """The documents as JSON lines in the shared folder, read back."""
    docs = _document(t)
    path = io.scratch_path(t.spark, "documents")
    io.write_output_json(docs, path)
    return _opened(t.spark.read.schema(docs.schema).json(path))


@query(
    """, n AS (SELECT video_id, count(*) AS detections, max(ts) AS last_ts FROM faces GROUP BY video_id), c AS (SELECT video_id, count(*) AS scenes FROM scenes GROUP BY video_id)
    SELECT video_id, detections, round(last_ts, 6) AS last_ts, scenes FROM n JOIN c USING (video_id)""",
    ("faces", "scenes"),
)
def write_bucketed(t):
    """Two tables in buckets by video, joined without an exchange."""
    name = f"cinetab_{uuid.uuid4().hex}"
    found = io.write_bucketed(t.faces, f"{name}_faces", 8, ("ts",)).groupBy("video_id").agg(F.count("*").alias("detections"), F.max("ts").alias("last_ts"))
    tiles = io.write_bucketed(t.scenes, f"{name}_scenes", 8, ("id",)).groupBy("video_id").agg(F.count("*").alias("scenes"))
    return found.join(tiles, "video_id")


@query("SELECT video_id, det_id, ts, grp FROM faces", ("faces",))
def read_table(t):
    """Faces written by video to the shared folder, four columns of them read back."""
    path = io.scratch_path(t.spark, "faces")
    io.write_table(t.faces, path, by_video=True)
    return io.read_table(t.spark, path, ["video_id", "det_id", "ts", "group"]).withColumn("video_id", F.col("video_id").cast("long"))


@query(
    ANSWERS.replace("FROM scenes)", "FROM scenes WHERE id % 13 <> 12)")
    + """, a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= 1.5 THEN 0 ELSE 1 END AS fresh FROM appearances WINDOW w AS (PARTITION BY video_id, scene_id, grp ORDER BY ts)),
    b AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id, scene_id, grp ORDER BY ts) AS run FROM a),
    iv AS (SELECT video_id, scene_id, grp, run, printf('%.2f', min(ts)) || '-' || printf('%.2f', max(ts)) AS x FROM b GROUP BY ALL),
    ig AS (SELECT video_id, scene_id, grp, string_agg(x, ',' ORDER BY run) AS x FROM iv GROUP BY ALL),
    it AS (SELECT video_id, scene_id, string_agg('group' || CAST(grp AS VARCHAR) || '=' || x, ';' ORDER BY grp) AS intervals FROM ig GROUP BY ALL),
    hg AS (SELECT video_id, scene_id, grp, string_agg(printf('%02d:%02d:%05.2f', CAST(floor(ts / 3600) AS INT), CAST(floor((ts % 3600) / 60) AS INT), ts % 60), ',' ORDER BY ts) AS x FROM appearances GROUP BY ALL),
    ht AS (SELECT video_id, scene_id, string_agg('group' || CAST(grp AS VARCHAR) || '=' || x, ';' ORDER BY grp) AS faces_hms FROM hg GROUP BY ALL)
    SELECT s.video_id, s.id, first_shot, last_shot, CASE WHEN s.id % 13 <> 12 THEN 'Title' ELSE 'Scene ' || CAST(s.id AS VARCHAR) END AS title, CASE WHEN s.id % 13 <> 12 THEN 'A talk.' END AS theme,
      CASE WHEN s.id % 13 <> 12 THEN 4 ELSE 0 END AS n_contributors, CASE WHEN s.id % 13 <> 12 THEN 'They meet.;They part' ELSE '' END AS events, CASE WHEN s.id % 13 <> 12 THEN 'main' END AS model,
      printf('%02d:%02d:%05.2f', CAST(floor(round(s.end_s, 3) / 3600) AS INT), CAST(floor((round(s.end_s, 3) % 3600) / 60) AS INT), round(s.end_s, 3) % 60) AS end_hms, coalesce(faces_hms, '') AS faces_hms, coalesce(intervals, '') AS intervals,
      2160.0::DOUBLE AS duration, 'local' AS method, (SELECT count(DISTINCT grp) FROM faces f WHERE f.video_id = s.video_id AND f.grp > 0 AND f.tier = 'anchor') AS n_groups
    FROM scenes s LEFT JOIN it ON s.video_id = it.video_id AND s.id = it.scene_id LEFT JOIN ht ON s.video_id = ht.video_id AND s.id = ht.scene_id""",
    ("scenes", "appearances", "faces"),
)
def extended_doc(t):
    stats = faces.group_stats(t.detections().withColumn("track_id", F.col("det_id") % 50))
    titled = t.scenes.withColumn("title", F.concat(F.lit("Scene "), "id"))
    doc = export.extended_doc(_document(t), titled, evidence.parse_answers(_answers(t))[0], export.scene_appearances(t.faces, t.scenes), t.videos, stats, segments.scene_method(t.scenes, t.scenes))
    each = doc.select("video_id", "duration", "method", F.size("groups").cast("long").alias("n_groups"), F.explode("scenes").alias("x"))
    number = lambda e: F.substring(e["key"], 6, 9).cast("int")
    text = lambda m, f: F.array_join(F.transform(F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct(number(e).alias("g"), F.array_join(f(e["value"]), ",").alias("t")))), lambda e: F.concat(F.lit("group"), e["g"], F.lit("="), e["t"])), ";")
    spans = lambda v: F.transform(v, lambda i: F.format_string("%.2f-%.2f", i["start"], i["end"]))
    return each.select(
        "video_id", "x.id", "x.first_shot", "x.last_shot", "x.title", F.col("x.central_theme").alias("theme"), F.size(F.coalesce("x.key_contributors", F.array())).alias("n_contributors"),
        F.coalesce(F.array_join("x.events", ";"), F.lit("")).alias("events"), "x.model", "x.end_hms", text("x.faces_hms", lambda v: v).alias("faces_hms"), text("x.intervals", spans).alias("intervals"), "duration", "method", "n_groups",
    )


@query(
    """, m AS (SELECT video_id, scene_id, grp, count(*) AS n FROM appearances GROUP BY ALL)
    SELECT s.video_id, s.id AS scene_id, coalesce(string_agg('group' || CAST(m.grp AS VARCHAR) || ': ' || CAST(m.n AS VARCHAR), ', ' ORDER BY m.grp), 'no faces') AS counts FROM scenes s LEFT JOIN m ON s.video_id = m.video_id AND s.id = m.scene_id GROUP BY ALL""",
    ("appearances", "scenes"),
)
def folder_counts(t):
    return export.folder_counts(export.scene_appearances(t.faces, t.scenes), t.scenes)


MANIFEST = """, man AS (SELECT video_id, scene_id, printf('scene_%03d/group%d/t%07.2f.jpg', scene_id, grp, ts) AS path, det_id FROM appearances
    UNION ALL SELECT s.video_id, s.id, printf('scene_%03d/_no_faces', s.id), NULL FROM scenes s WHERE NOT EXISTS (SELECT 1 FROM appearances a WHERE a.video_id = s.video_id AND a.scene_id = s.id)) """


@query(MANIFEST + "SELECT * FROM man", ("appearances", "scenes"))
def crop_manifest(t):
    return export.crop_manifest(export.scene_appearances(t.faces, t.scenes), t.scenes)


@query(
    """, m AS (SELECT video_id, scene_id, grp, count(*) AS frames, list(ts ORDER BY ts) AS l FROM appearances GROUP BY ALL)
    , sh AS (SELECT video_id, id AS scene_id, list_sort(list_distinct([first_shot, CAST(floor((first_shot + last_shot) / 2.0) AS BIGINT), last_shot])) AS shots FROM scenes),
    kf AS (SELECT sh.video_id, sh.scene_id, string_agg(printf('%.3f', (s.start_s + s.end_s) / 2), ' ' ORDER BY s.id) AS frames_at FROM sh JOIN shots s ON s.video_id = sh.video_id AND list_contains(sh.shots, s.id) GROUP BY ALL)
    SELECT s.video_id, s.id AS scene_id, array_to_string(sh.shots, '-') AS shots, kf.frames_at, 'Scene ' || CAST(s.id AS VARCHAR) AS title, 'About ' || CAST(s.id AS VARCHAR) AS description, m.grp, m.frames, m.l[CAST(floor(m.frames / 2.0) AS BIGINT) + 1] AS middle_ts
    FROM scenes s JOIN sh ON s.video_id = sh.video_id AND s.id = sh.scene_id LEFT JOIN kf ON s.video_id = kf.video_id AND s.id = kf.scene_id LEFT JOIN m ON s.video_id = m.video_id AND s.id = m.scene_id""",
    ("appearances", "scenes", "shots"),
)
def scene_report_rows(t):
    middle = ((F.col("start") + F.col("end")) / 2).alias("t")
    keyframes = t.shots.select("video_id", F.col("id").alias("shot_id"), F.lit(0).alias("k"), middle)
    words = t.scenes.select("video_id", F.col("id").alias("scene_id"), F.concat(F.lit("Scene "), "id").alias("title"), F.concat(F.lit("About "), "id").alias("description"))
    rows = export.scene_report_rows(t.scenes, export.scene_appearances(t.faces, t.scenes), keyframes, words)
    return rows.withColumn("frames_at", F.array_join(F.transform("frames_at", lambda x: F.format_string("%.3f", x)), " "))


@query(
    MANIFEST + """SELECT video_id, 'files' AS "check", 'error' AS severity, path AS entity, 'missing file' AS detail FROM man WHERE det_id % 97 = 0 UNION ALL SELECT video_id, 'files', 'error', 'scene_999/orphan.jpg', 'no timecode' FROM videos""",
    ("appearances", "scenes", "videos"),
)
def check_files(t):
    made = export.crop_manifest(export.scene_appearances(t.faces, t.scenes), t.scenes)
    files = made.where("det_id is null or det_id % 97 <> 0").select("video_id", "path").union(t.videos.select("video_id", F.lit("scene_999/orphan.jpg")))
    return checks.check_files(files, made)


@query(
    MANIFEST + """SELECT video_id, path, CAST(scene_id AS INT) AS scene_id, CASE WHEN det_id IS NOT NULL THEN CAST(regexp_extract(path, 'group([0-9]+)', 1) AS INT) END AS grp,
    CASE WHEN det_id IS NOT NULL THEN round(CAST(regexp_extract(path, 't([0-9.]+)[.]jpg', 1) AS DOUBLE), 6) END AS ts, CAST(coalesce(length('crop ' || CAST(det_id AS VARCHAR)), 0) AS BIGINT) AS length FROM man""",
    ("appearances", "scenes"),
)
def crop_listing(t):
    """The manifest's files, written by tasks and listed again; what stands for a crop is its detection's number."""
    made = export.crop_manifest(export.scene_appearances(t.faces, t.scenes), t.scenes)
    root = io.scratch_path(t.spark, "crops")
    crops.write_crops(made.select("video_id", "path", F.concat(F.lit("crop "), "det_id").alias("content")), root)
    return crops.list_crops(t.spark, root)


@query(
    """SELECT video_id, 'folders' AS "check", 'error' AS severity, '999/orphan.jpg' AS entity, 'unexpected folder' AS detail FROM videos""",
    ("videos",),
)
def check_folders(t):
    seen = export.scene_appearances(t.faces, t.scenes)
    files = export.crop_manifest(seen, t.scenes).select("video_id", "path").union(t.videos.select("video_id", F.lit("scene_999/orphan.jpg")))
    return checks.check_folders(files, seen, t.scenes)


def _damaged(t):
    """Scenes of which some are short, shifted or renumbered."""
    n = F.col("id") % 10
    s = t.scenes
    s = s.withColumn("end", F.when(n == 3, F.col("start")).otherwise(F.col("end")))
    s = s.withColumn("start", F.when(n == 5, F.col("start") + 0.5).otherwise(F.col("start")))
    return s.withColumn("id", F.when(n == 7, F.col("id") + 1000).otherwise(F.col("id")))


@query(
    """, b AS (SELECT video_id, CASE WHEN id % 10 = 7 THEN id + 1000 ELSE id END AS id, CASE WHEN id % 10 = 5 THEN start_s + 0.5 ELSE start_s END AS start_s, CASE WHEN id % 10 = 3 THEN start_s ELSE end_s END AS end_s FROM scenes),
    o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_s, id) - 1 AS n, lead(start_s) OVER (PARTITION BY video_id ORDER BY start_s, id) AS nx FROM b),
    v AS (SELECT video_id, 'ids' AS c, 'error' AS s, id FROM o WHERE n <> id UNION ALL SELECT video_id, 'contiguity', 'error', id FROM o WHERE abs(end_s - nx) > 1e-6 UNION ALL SELECT video_id, 'positive_length', 'error', id FROM o WHERE end_s <= start_s
      UNION ALL SELECT video_id, 'min_scene', 'warning', id FROM o WHERE end_s - start_s < 30
      UNION ALL SELECT o.video_id, 'scene_on_shot', 'error', o.id FROM o WHERE NOT EXISTS (SELECT 1 FROM shots t WHERE t.video_id = o.video_id AND round(t.start_s, 3) = round(o.start_s, 3))
      UNION ALL SELECT o.video_id, 'coverage', 'error', o.video_id FROM o GROUP BY o.video_id HAVING abs(min(start_s)) > 0.06 OR abs(max(end_s) - 2160) > 0.06
      UNION ALL SELECT o.video_id, 'coverage', 'error', o.video_id FROM o GROUP BY o.video_id HAVING min(start_s) <> 0 OR abs(max(end_s) - 2160) > 0.1)
    SELECT video_id, c AS "check", s AS severity, CAST(id AS VARCHAR) AS entity FROM v""",
    ("scenes", "shots"),
)
def check_tiles(t):
    s = _damaged(t)
    parts = [checks.check_ids(s), checks.check_contiguity(s), checks.check_positive_length(s), checks.check_min_scene(s), checks.check_scene_on_shot(s, t.shots), checks.check_coverage(s, t.videos), checks.check_coverage(s, t.videos, exact=True)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.drop("detail")


@query(
    """, b AS (SELECT DISTINCT video_id, 'positive_length ' || CAST(id AS VARCHAR) || ' ' || CAST(start_s AS VARCHAR) AS x, row_number() OVER (PARTITION BY video_id ORDER BY CAST(id AS VARCHAR)) AS n FROM scenes WHERE id % 10 = 3),
    e AS (SELECT video_id, count(*) AS errors, string_agg(x, '; ' ORDER BY x) FILTER (WHERE n <= 50) AS messages FROM b GROUP BY video_id)
    SELECT v.video_id, coalesce(errors, 0) AS errors, CAST(0 AS BIGINT) AS warnings, coalesce(messages, '') AS messages, coalesce(errors, 0) = 0 AS passed,
      (SELECT count(*) FROM shots s WHERE s.video_id = v.video_id) AS n_shots, (SELECT count(*) FROM scenes s WHERE s.video_id = v.video_id) AS n_scenes, (SELECT count(*) FROM appearances s WHERE s.video_id = v.video_id) AS n_timecodes
    FROM videos v LEFT JOIN e ON v.video_id = e.video_id""",
    ("scenes", "videos", "shots", "appearances"),
)
def validation_summary(t):
    totals = {"n_shots": t.shots, "n_scenes": t.scenes, "n_timecodes": export.scene_appearances(t.faces, t.scenes)}
    return checks.validation_summary(checks.check_positive_length(_damaged(t)), t.videos, totals=totals)


@query(
    """, o AS (SELECT video_id, scene_id, grp, ts, row_number() OVER (PARTITION BY video_id, scene_id, grp ORDER BY ts) AS pos FROM appearances),
    c AS (SELECT video_id, scene_id, grp, pos, CASE WHEN pos % 3 = 2 THEN ts - 5000 ELSE ts END AS ts FROM o),
    p AS (SELECT c.*, lag(ts) OVER (PARTITION BY video_id, scene_id, grp ORDER BY pos) AS prev FROM c)
    SELECT p.video_id, 'timecodes' AS "check", 'error' AS severity, CAST(p.scene_id AS VARCHAR) || '/' || CAST(p.grp AS VARCHAR) || '/' || CAST(ts AS VARCHAR) AS entity,
      CASE WHEN ts = prev THEN 'duplicate' WHEN ts < prev THEN 'unsorted' ELSE 'outside' END AS detail
    FROM p JOIN scenes s ON p.video_id = s.video_id AND p.scene_id = s.id WHERE coalesce(ts <= prev, false) OR ts < s.start_s - 1e-6 OR ts >= s.end_s + 1e-6""",
    ("appearances", "scenes"),
)
def check_timecodes(t):
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("video_id", "scene_id", "group").orderBy("ts"))
    codes = export.scene_appearances(t.faces, t.scenes).withColumn("pos", pos)
    codes = codes.withColumn("ts", F.when(F.col("pos") % 3 == 2, F.col("ts") - 5000).otherwise(F.col("ts")))
    return checks.check_timecodes(codes, t.scenes)


@query(
    """SELECT s.video_id, 'citations' AS "check", 'error' AS severity, CAST(s.id AS VARCHAR) AS entity, 'group' || CAST(1 + s.id % 12 AS VARCHAR) AS detail FROM scenes s
    WHERE NOT EXISTS (SELECT 1 FROM appearances a WHERE a.video_id = s.video_id AND a.scene_id = s.id AND a.grp = 1 + s.id % 12)""",
    ("scenes", "appearances"),
)
def check_citations(t):
    d = t.scenes.select("video_id", F.col("id").alias("scene_id"), F.concat(F.lit("Here is group"), 1 + F.col("id") % 12, F.lit(" and nobody else.")).alias("description"))
    return checks.check_citations(d, evidence.scene_presence(t.faces, t.scenes))


@query("""SELECT video_id, 'description' AS "check", 'error' AS severity, CAST(id AS VARCHAR) AS entity, 'blank' AS detail FROM scenes WHERE id % 4 = 0""", ("scenes",))
def check_description(t):
    return checks.check_description(t.scenes.select("video_id", F.col("id").alias("scene_id"), F.when(F.col("id") % 4 != 0, "text").otherwise(" ").alias("description")))


@query(
    """SELECT DISTINCT page_id AS video_id, 'report_links' AS "check", 'error' AS severity, l AS entity, 'missing' AS detail FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS l FROM pages) q WHERE length(l) % 2 = 1"""
)
def check_report_links(t):
    pages = t.read("pages").select(F.col("page_id").alias("video_id"), "html")
    pattern = 'href="([^"]+)"'
    links = pages.select("video_id", F.explode(F.regexp_extract_all("html", F.lit(pattern))).alias("path"))
    return checks.check_report_links(pages, links.where(F.length("path") % 2 == 0), pattern)


@query(
    AGREEMENT + """, tt AS (SELECT video_id, sum(total) AS t, sum(agreeing) AS a FROM ag GROUP BY video_id)
    SELECT video_id, 'identity' AS "check", 'error' AS severity, CAST(video_id AS VARCHAR) AS entity, CAST(a AS VARCHAR) || '/' || CAST(t AS VARCHAR) AS detail FROM tt WHERE a < 0.9 * t""",
    ("faces", "n_vecs"),
)
def check_identity(t):
    d = t.detections().where("group > 0")
    return checks.check_identity(d.withColumnRenamed("det_id", "crop_id"), faces.group_centroids(d))


@query(
    """, v AS (SELECT video_id, 'document' AS entity, 'keys' AS detail FROM videos WHERE video_id % 3 = 0
      UNION ALL SELECT video_id, 'scenes ' || CAST(id AS VARCHAR), 'description' FROM scenes
      UNION ALL SELECT video_id, 'shots ' || CAST(id AS VARCHAR), 'types' FROM shots WHERE video_id % 4 = 1)
    SELECT video_id, 'schema' AS "check", 'error' AS severity, entity, detail FROM v""",
    ("videos", "scenes", "shots"),
)
def check_schema(t):
    """Documents of which some have their keys in another order, or shot numbers as text."""
    texts = F.transform("shots", lambda x: x.withField("id", x["id"].cast("string")))
    swapped, wrong = F.col("video_id") % 3 == 0, F.col("video_id") % 4 == 1
    body = lambda shots: F.when(swapped, F.to_json(F.struct("scenes", shots.alias("shots")))).otherwise(F.to_json(F.struct(shots.alias("shots"), "scenes")))
    return checks.check_schema(_document(t).select("video_id", F.when(wrong, body(texts)).otherwise(body(F.col("shots"))).alias("json")))


# --- whole jobs -----------------------------------------------------------------------------------
@query()
def job_identities(t):
    return jobs.identities(t.detections().withColumn("shot_id", F.floor(F.col("ts") / 60).cast("int")).drop("group"))[0].select("video_id", "det_id", "track_id", "group")


@query()
def job_scenes(t):
    bounds = segments.boundary_text(t.segments, t.bounds)
    return jobs.scenes(t.videos, t.shots, t.shot_vecs, t.segments, t.faces, t.chapters, _text_vectors(t, bounds))


@query()
def job_documents(t):
    """Violations in the documents of all videos, with the files that the crops would be in."""
    return jobs.documents(t.videos, t.shots, t.scenes, t.faces, evidence.parse_answers(_answers(t))[0])[1]


# --- sources --------------------------------------------------------------------------------------
@query(
    """SELECT video_id, CASE WHEN video_id % 2 = 0 THEN 'c' || CAST(video_id AS VARCHAR) ELSE 'u' END AS channel, duration, CASE WHEN video_id % 3 = 0 THEN 30.0 ELSE 25.0 END AS fps, CASE WHEN video_id % 5 = 0 THEN 0 ELSE 54000 END AS n_frames FROM videos""",
    ("videos",),
)
def video_metadata(t):
    n = F.col("video_id")
    info = t.videos.select("video_id", F.to_json(F.struct(n.cast("string").alias("id"), F.when(n % 2 == 0, F.concat(F.lit("c"), n)).alias("channel"), F.lit("u").alias("uploader"), F.col("duration"))).alias("json"))
    stream = F.struct(F.lit("25/1").alias("r_frame_rate"), F.when(n % 3 == 0, "30/1").otherwise("0/0").alias("avg_frame_rate"), F.when(n % 5 != 0, "54000").alias("nb_read_packets"))
    probe = t.videos.select("video_id", F.to_json(F.struct(F.array(stream).alias("streams"), F.struct(F.col("duration").cast("string").alias("duration")).alias("format"))).alias("json"))
    return io.video_metadata(info, probe).select("video_id", "channel", "duration", "fps", "n_frames")


@query("SELECT video_id, title, start_s, end_s FROM chapters", ("chapters",))
def chapters(t):
    c = F.struct("title", F.col("start").alias("start_time"), F.col("end").alias("end_time"))
    info = t.chapters.groupBy("video_id").agg(F.to_json(F.struct(F.collect_list(c).alias("chapters"))).alias("json"))
    return io.chapters(info)


@query(
    """SELECT video_id, round(seg_no * 1.5, 2) AS start_s, round(seg_no * 1.5 + CASE WHEN seg_no % 2 = 0 THEN 0.7 ELSE 0 END, 2) AS end_s, trim(replace(text || chr(10) || 'x', chr(10), ' ')) AS text FROM segments WHERE seg_no % 4 <> 0""",
    ("segments",),
)
def caption_segments(t):
    k = F.col("seg_no")
    piece = lambda x: F.struct(x.alias("utf8"))
    e = F.struct((k * 1500).alias("tStartMs"), F.when(k % 2 == 0, 700).alias("dDurationMs"), F.when(k % 4 != 0, F.array(piece(F.col("text")), piece(F.lit("\nx")))).otherwise(F.array(piece(F.lit(" \n")))).alias("segs"))
    raw = t.segments.groupBy("video_id").agg(F.to_json(F.struct(F.collect_list(e).alias("events"))).alias("json"))
    return io.caption_segments(raw).drop("seg_no")


@query(
    """SELECT video_id, CASE WHEN video_id % 2 = 0 THEN 'parakeet' ELSE 'whisper' END AS source, seg_no FROM segments""",
    ("segments",),
)
def pick_transcript(t):
    s = t.segments.select("video_id", "source", "seg_no")
    better = s.where("video_id % 2 = 0").withColumn("source", F.lit("parakeet"))
    return io.pick_transcript(s.union(better).union(s.withColumn("source", F.lit("youtube"))))


@query("SELECT video_id, seg_no, round(start_s, 2) AS start_s, round(end_s, 2) AS end_s, trim(text) AS text FROM segments WHERE seg_no % 3 <> 0", ("segments",))
def clean_segments(t):
    raw = t.segments.withColumn("text", F.when(F.col("seg_no") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "text")))
    return io.clean_segments(raw).select("video_id", "seg_no", "start", "end", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
