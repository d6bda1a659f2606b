"""Crop files, bucketed tables, encoded texts and vectors compared in blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinetab.operators import checks, evidence, export, faces, segments, timeline
from cinetab.sources import crops, io


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_crop_files(spark, tmp_path):
    """Every file of a manifest is written and listed, the markers of faceless scenes as well, and the checks are silent on the listing."""
    seen = spark.createDataFrame([(v, s, g, float(t)) for v in range(1, 70) for s, g, t in [(0, 1, 2), (0, 3, 2), (0, 1, 7), (12, 10, 1234.5)]], "video_id long, scene_id int, group int, ts double").withColumn("det_id", F.monotonically_increasing_id())
    scenes = spark.createDataFrame([(v, s) for v in range(1, 70) for s in (0, 5, 12)], "video_id long, id int")
    made = export.crop_manifest(seen, scenes)
    assert rows(crops.list_crops(spark, str(tmp_path / "none")), "path") == []
    for _ in range(2):  # a second run replaces the files
        crops.write_crops(made.select("video_id", "path", F.when(F.col("det_id") % 2 == 0, "jpeg").alias("content")), f"file:{tmp_path}")
    found = crops.list_crops(spark, str(tmp_path)).cache()
    assert rows(found, "video_id", "path") == rows(made, "video_id", "path")
    assert rows(found.where("video_id = 3"), "scene_id", "group", "ts") == sorted([(0, 1, 2.0), (0, 3, 2.0), (0, 1, 7.0), (12, 10, 1234.5), (5, None, None)], key=str)
    assert {r.length for r in found.collect()} == {0, 4}
    assert checks.check_folders(found, seen, scenes).count() == 0 and checks.check_files(found, made).count() == 0
    marker = tmp_path / "video_7" / "scene_005" / "_no_faces"
    assert marker.exists()
    marker.unlink()
    assert rows(checks.check_folders(crops.list_crops(spark, str(tmp_path)), seen, scenes), "video_id", "detail") == [(7, "missing folder")]
    for path in ("../outside", "/etc/outside", ""):
        with pytest.raises(Exception, match="not a path below"):
            crops.write_crops(spark.createDataFrame([(1, path, b"x")], "video_id long, path string, content binary"), str(tmp_path))


def test_bucketed_tables_join_without_exchange(spark):
    data = spark.range(500).selectExpr("id % 23 AS video_id", "CAST(id AS DOUBLE) AS ts")
    left = io.write_bucketed(data, "left_rows", 4, ("ts",))
    right = io.write_bucketed(data.groupBy("video_id").agg(F.count("*").alias("n")), "right_rows", 4)
    joined = left.join(right, "video_id").groupBy("video_id").agg(F.sum("n").alias("n"), F.max("ts").alias("ts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined, "video_id", "n", "ts") == rows(data.groupBy("video_id").agg((F.count("*") * F.count("*")).alias("n"), F.max("ts").alias("ts")), "video_id", "n", "ts")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE left_rows")
        spark.sql("DROP TABLE right_rows")


def test_each_text_is_encoded_once(spark):
    texts = [("a", "b"), ("b", "a"), ("", "a"), ("c", ""), ("b", "c")] * 20
    bound = spark.createDataFrame([(1, k, *t) for k, t in enumerate(texts)], "video_id long, shot_id int, left_text string, right_text string").repartition(5)
    asked, largest = spark.sparkContext.accumulator(0), 2

    def encode(some):
        assert 0 < len(some) <= largest
        asked.add(len(some))
        return np.array([[ord(x), 1.0] for x in some])

    vectors = segments.encode_texts(bound, encode, batch=largest)
    assert rows(vectors, "text", "embedding") == [(x, [float(ord(x)), 1.0]) for x in "abc"]
    assert asked.value == 3
    sim = {r.shot_id: r.sim_t for r in segments.text_similarity(bound, vectors).collect()}
    assert sim[2] is None and sim[3] is None and sim[0] == pytest.approx((97 * 98 + 1) / np.hypot(97, 1) / np.hypot(98, 1)) and len(sim) == 100


@pytest.mark.parametrize("block", [4, 256])
def test_visual_link_by_loop(spark, block):
    """Blocks of any size give the best of all pairs around each boundary; shots may be missing."""
    rng = np.random.default_rng(6)
    shots = [(v, k, rng.normal(size=3).tolist()) for v in range(3) for k in range(40 + v) if not (v == 2 and k in (7, 8, 9, 20))] + [(9, 0, [1.0, 0.0, 0.0])]
    expected = []
    for video in (0, 1, 2, 9):
        vec = {k: np.array(e) for v, k, e in shots if v == video}
        for b in range(50):
            pairs = [float(vec[i] @ vec[j]) for i in range(b - 6, b) for j in range(b, b + 6) if i in vec and j in vec]
            if pairs:
                expected.append((video, b, round(max(pairs), 9)))
    df = spark.createDataFrame(shots, "video_id long, shot_id int, embedding array<double>").repartition(3)
    linked = segments.visual_link(df, 6, block)
    assert rows(linked.withColumn("sim_v", F.round("sim_v", 9)), "video_id", "shot_id", "sim_v") == sorted(expected, key=str)
    assert linked._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert segments.visual_link(df.limit(0)).count() == 0


def test_centroids_in_blocks(spark):
    """Agreement and nearest groups against loops, with crops of one video in several blocks and crops without a vector."""
    rng = np.random.default_rng(7)
    middles = {(v, g): rng.normal(size=4) for v in range(3) for g in range(1, 6)}
    data = [(v, k, int(rng.integers(1, 7)), rng.normal(size=4).tolist() if k % 11 else None) for v in range(3) for k in range(150)]
    got = faces.identity_agreement(
        spark.createDataFrame(data, "video_id long, crop_id long, group int, embedding array<double>").repartition(3),
        spark.createDataFrame([(v, g, c.tolist()) for (v, g), c in middles.items()], "video_id long, group int, centroid array<double>"), block=40,
    )
    expected = {}
    for v, _, g, e in data:
        if e is not None:
            best = max(range(1, 6), key=lambda o: (float(np.dot(e, middles[v, o])), -o))
            total, agree = expected.get((v, g), (0, 0))
            expected[v, g] = (total + 1, agree + (best == g))
    assert rows(got, "video_id", "group", "total", "agreeing") == sorted(((*k, *x) for k, x in expected.items()), key=str)
    pdf = pd.DataFrame([(v, k, g, "anchor", k % 4, e) for v, k, g, e in data if e is not None and (v != 2 or g == 1)], columns=["video_id", "det_id", "group", "tier", "track_id", "embedding"])
    centre = {k: np.mean(np.stack(x.embedding.to_list()), axis=0) for k, x in pdf.groupby(["video_id", "group"])}
    centre = {k: m / np.linalg.norm(m) for k, m in centre.items()}
    for r in faces.group_stats(spark.createDataFrame(pdf)).collect():
        others = {g: float(m @ centre[r.video_id, r.group]) for (v, g), m in centre.items() if v == r.video_id and g != r.group}
        near = max(others, key=others.get) if others else None
        assert r.nearest_group == near and r.nearest_cos == pytest.approx(others[near] if others else 0.0)


def test_answers_are_added_once(spark, tmp_path):
    """What is cached stays; adding again, or adding another answer to a known key, adds nothing."""
    path, kind = str(tmp_path / "answers"), "key string, text string"
    evidence.append_answers(spark.createDataFrame([("a", "1"), ("b", "9"), ("b", "2")], kind), path)
    for _ in range(2):
        evidence.append_answers(spark.createDataFrame([("a", "other"), ("c", "3"), ("c", "3")], kind), path)
    evidence.append_answers(spark.createDataFrame([], kind), path)
    assert rows(spark.read.parquet(path), "key", "text") == [("a", "1"), ("b", "2"), ("c", "3")]


def test_tiny_shots_of_many_videos_under_the_settings(spark):
    """Every video's runs meet their frames, whatever the number of partitions."""
    rng = np.random.default_rng(9)
    shots, hists = [], []
    for video in range(30):
        edges = np.cumsum(rng.choice([0.1, 0.3], 30)).round(4)
        shots += [(video, k, float(a), float(b)) for k, (a, b) in enumerate(zip([0.0, *edges[:-1]], edges, strict=True))]
        hists += [(video, k, [1.0, 2.0]) for k in range(int(edges[-1] * 10) + 1)]
    tables = spark.createDataFrame(shots, "video_id long, id int, start double, end double"), spark.createDataFrame(hists, "video_id long, frame_idx long, hist array<double>")
    for parts in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = timeline.merge_tiny_shots(*tables, spark.createDataFrame([(v, 10.0) for v in range(30)], "video_id long, fps double"), 0.2)
        left = {r.video_id: r["count"] for r in found.groupBy("video_id").count().collect()}
        tiny = {v: sum(b - a < 0.2 for w, _, a, b in shots if w == v) for v in range(30)}
        assert all(left[v] <= 30 - tiny[v] // 2 for v in range(30))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
