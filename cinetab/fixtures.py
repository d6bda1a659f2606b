"""Video tables derived from the given test tables, as SQL that Spark and DuckDB both read.

Only the expression for the time of an event differs. Tables use start_s and end_s here, as ``end`` is a
reserved word; ``table`` renames them to start and end for the operators.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPARK_T = "round(timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01', ts) / 1200000000.0D, 2)"
DUCK_T = "round((epoch_us(ts) - 1704067200000000) / 1200000000.0, 2)"

#: name -> (views it needs, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """SELECT event_id, user_id, event_type, CAST(value AS DOUBLE) AS value, CAST(floor(user_id / 10.0) AS BIGINT) AS video_id, {t} AS t FROM events"""),
    "videos": (("ev",), "SELECT DISTINCT video_id, CAST(2160 AS DOUBLE) AS duration, CAST(25 AS DOUBLE) AS fps FROM ev"),
    "shots": (("ev",), """SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY t) - 1 AS BIGINT) AS id,
        CASE WHEN row_number() OVER (PARTITION BY video_id ORDER BY t) = 1 THEN CAST(0 AS DOUBLE) ELSE t END AS start_s,
        coalesce(lead(t) OVER (PARTITION BY video_id ORDER BY t), CAST(2160 AS DOUBLE)) AS end_s
        FROM (SELECT DISTINCT video_id, t FROM ev) p"""),
    "raw_dets": (("ev",), """SELECT video_id, event_id AS det_id, CAST(floor(t) AS DOUBLE) AS ts, CAST((event_id * 37) % 1000 AS DOUBLE) AS x1, CAST((event_id * 53) % 500 AS DOUBLE) AS y1,
        CAST((event_id * 37) % 1000 + 20 + event_id % 120 AS DOUBLE) AS x2, CAST((event_id * 53) % 500 + 20 + (event_id * 7) % 120 AS DOUBLE) AS y2,
        CAST(40 + event_id % 60 AS DOUBLE) / 100 AS det_score, value AS sharpness, CAST(event_id % 10 AS DOUBLE) / 10 AS yaw_ratio, user_id, event_type FROM ev"""),
    "faces": (("raw_dets", "shots"), """SELECT d.video_id, d.det_id, d.ts, d.x1, d.y1, d.x2, d.y2, d.det_score, d.sharpness, d.yaw_ratio,
        CASE WHEN d.det_score >= 0.65 AND least(d.x2 - d.x1, d.y2 - d.y1) >= 48 AND d.sharpness >= 50 AND d.yaw_ratio <= 0.5 THEN 'anchor' ELSE 'weak' END AS tier,
        CASE WHEN d.event_type = 'error' THEN -1 ELSE CAST(1 + d.user_id % 10 AS INT) END AS grp, s.id AS shot_id
        FROM raw_dets d JOIN shots s ON d.video_id = s.video_id AND d.ts >= s.start_s AND d.ts < s.end_s
        WHERE NOT (d.det_score < 0.5 OR least(d.x2 - d.x1, d.y2 - d.y1) < 32)"""),
    "frame_probs": ((), """SELECT CAST(floor(l_suppkey / 10.0) AS BIGINT) AS video_id,
        CAST(row_number() OVER (PARTITION BY floor(l_suppkey / 10.0) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS BIGINT) AS frame_idx,
        round(CAST(l_discount AS DOUBLE) * 10, 6) AS prob FROM lineitem"""),
    "frame_looks": ((), """SELECT CAST(floor(l_suppkey / 10.0) AS BIGINT) AS video_id,
        CAST(row_number() OVER (PARTITION BY floor(l_suppkey / 10.0) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS BIGINT) AS frame_idx,
        CAST(l_quantity AS DOUBLE) AS h0, CAST(l_linenumber AS DOUBLE) * 5 AS h1, CAST(l_tax AS DOUBLE) * 300 AS h2, CAST(l_partkey % 20 AS DOUBLE) AS h3 FROM lineitem"""),
    "fvideos": (("frame_probs",), "SELECT video_id, CAST(25 AS DOUBLE) AS fps, count(*) / CAST(25 AS DOUBLE) AS duration FROM frame_probs GROUP BY video_id"),
    "segments": ((), """SELECT video_id, 'whisper' AS source, CAST(row_number() OVER (PARTITION BY video_id ORDER BY conv_id, turn) AS BIGINT) AS seg_no,
        base + (total - n) * CAST(0.4 AS DOUBLE) AS start_s, base + total * CAST(0.4 AS DOUBLE) AS end_s, text FROM (
        SELECT conv_id, turn, text, CAST(floor(conv_id / 7.0) AS BIGINT) AS video_id, CAST((conv_id % 7) * 300 AS DOUBLE) AS base, CAST(n AS DOUBLE) AS n,
        CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS total
        FROM (SELECT conv_id, turn, text, length(text) - length(replace(text, ' ', '')) + 1 AS n FROM conversations) a) b"""),
    "chapters": (("ev",), "SELECT video_id, 'chapter' AS title, t AS start_s, t + 60 AS end_s FROM ev WHERE event_type = 'signup' AND event_id % 50 = 0"),
    "n_vecs": ((), "SELECT count(*) AS n FROM embeddings"),
    "shot_vecs": (("shots", "n_vecs"), """SELECT s.video_id, s.shot_id, e.embedding FROM (SELECT video_id, id AS shot_id, (video_id * 97 + id) % (SELECT n FROM n_vecs) AS vec_id FROM shots) s
        JOIN embeddings e ON e.vec_id = s.vec_id"""),
    "bounds": (("shots",), "SELECT video_id, id AS shot_id, start_s AS time FROM shots WHERE id >= 1"),
    "boundaries": (("ev", "shots"), """SELECT s.video_id, s.id AS shot_id, s.start_s AS time, CAST(floor(min(e.value)) AS BIGINT) % 10 / CAST(10 AS DOUBLE) AS sim
        FROM shots s JOIN ev e ON e.video_id = s.video_id AND e.t = s.start_s WHERE s.id >= 1 GROUP BY s.video_id, s.id, s.start_s"""),
    "cuts": (("shots",), "SELECT video_id, start_s AS time FROM shots WHERE id % 30 = 0 AND id > 0"),
    "scenes": (("shots",), """SELECT video_id, CAST(floor(id / 30.0) AS BIGINT) AS id, min(start_s) AS start_s, max(end_s) AS end_s, min(id) AS first_shot, max(id) AS last_shot
        FROM shots GROUP BY video_id, CAST(floor(id / 30.0) AS BIGINT)"""),
    "best_faces": (("faces",), """SELECT video_id, det_id, ts, det_score, grp FROM (SELECT *, row_number() OVER (PARTITION BY video_id, grp, ts ORDER BY det_score DESC, det_id) AS rn FROM faces WHERE grp > 0) q WHERE rn = 1"""),
    "appearances": (("best_faces", "scenes"), """SELECT f.video_id, s.id AS scene_id, f.grp, f.ts, f.det_id FROM best_faces f JOIN scenes s ON f.video_id = s.video_id AND f.ts >= s.start_s AND f.ts < s.end_s"""),
}
#: Names that DuckDB needs other than the operators.
RENAMED = {"start_s": "start", "end_s": "end", "grp": "group"}


def needed(names: tuple[str, ...]) -> list[str]:
    """The views and all that they need, in order."""
    out: list[str] = []
    for name in names:
        for x in [*needed(VIEWS[name][0]), name]:
            if x not in out:
                out.append(x)
    return out


def with_sql(names: tuple[str, ...], time: str) -> str:
    """A WITH clause that defines the views."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1].format(t=time)})" for n in needed(names)) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table with the operators' column names, read through Spark from the tables of ``sf_dir``."""
    body = with_sql((name,), SPARK_T)
    used = {}
    for source in ("events", "lineitem", "conversations", "embeddings"):
        named = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", body)
        if named != body:
            body, used[source] = named, spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(body + f"SELECT * FROM {name}", **used).withColumnsRenamed(RENAMED)
