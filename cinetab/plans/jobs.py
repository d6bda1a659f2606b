"""The library's three jobs, each a composition of operators over all videos at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, evidence, export, faces, segments, timeline
from ..operators.identities import cluster_tracks


def identities(dets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detections (with shot_id, tier, embedding) to (faces with track_id, cluster and group, statistics of the groups)."""
    found = faces.rank_groups(cluster_tracks(faces.build_tracks(dets)))
    return found, faces.group_stats(found)


def scenes(
    videos: DataFrame, shots: DataFrame, shot_vecs: DataFrame, transcript: DataFrame, found: DataFrame, chapters: DataFrame, text_vecs: DataFrame
) -> DataFrame:
    """Shots, their vectors, a transcript and faces to scenes: three signals, their depth, cuts, and cuts moved to establishing shots."""
    bounds = shots.where("id >= 1").select("video_id", F.col("id").alias("shot_id"), F.col("start").alias("time"))
    key = ["video_id", "shot_id"]
    signals = bounds.join(segments.visual_link(shot_vecs), key, "left")
    signals = signals.join(segments.text_similarity(segments.boundary_text(transcript, bounds), text_vecs), key, "left")
    signals = signals.join(segments.people_similarity(segments.people_vectors(found, bounds)), key, "left")
    for name in ("sim_v", "sim_t", "sim_p"):
        signals = segments.zscore(signals, name, name)
    depth = segments.depth_score(segments.combine_signals(signals))
    cuts = segments.select_cuts(depth, videos, chapters)
    cuts = cuts.join(videos.select("video_id", "duration"), "video_id").where("time < duration")  # no scene begins at the end
    return timeline.scenes_from_cuts(shots, segments.snap_establishing(cuts, shots, found, shot_vecs))


def documents(videos: DataFrame, shots: DataFrame, tiles: DataFrame, found: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scenes, faces and answers to (result documents, their violations)."""
    presence = evidence.scene_presence(found, tiles)
    words = evidence.compose_description(answers, presence, evidence.group_names(answers))
    docs = export.output_doc(shots, tiles, found, words)
    seen = export.scene_appearances(found, tiles)
    described = tiles.select("video_id", F.col("id").alias("scene_id")).join(words, ["video_id", "scene_id"], "left")
    made = export.crop_manifest(seen, tiles)
    parts = [checks.check_schema(docs.select("video_id", F.to_json(F.struct("shots", "scenes")).alias("json"))), checks.check_scene_on_shot(tiles, shots), checks.check_min_scene(tiles)]
    parts += [check(x) for x in (shots, tiles) for check in (checks.check_ids, checks.check_contiguity, checks.check_positive_length)]
    parts += [checks.check_coverage(x, videos) for x in (shots, tiles)]
    parts += [checks.check_description(described), checks.check_citations(described, presence), checks.check_folders(made, seen, tiles)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return docs, out
