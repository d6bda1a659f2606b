"""The entry works, names are unique, and oracles exist only for registered queries."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from cinetab.operators import checks, segments
from cinetab.registry import Tables

DATA = "/root/testdata/sf0.001"
SAMPLE = ["transition_boundaries", "people_vectors", "crop_manifest", "check_tiles", "group_names", "description_windows", "group_stats", "output_doc", "check_schema"]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    expected = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({entry.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(str(round(float(x), 5)) if isinstance(x, (int, float)) else str(x) for x in r)
    assert sorted(map(key, expected)) == sorted(key([r[c] for c in columns]) for r in df.collect())


def test_enforce_min_scene_takes_all_chosen_cuts(spark):
    """Every chosen cut takes part: none is missing but those that leave a scene too short."""
    kept = {(r.video_id, r.time) for r in entry.queries()["enforce_min_scene"](spark, DATA).collect()}
    chosen = {}
    for r in entry.queries()["select_cuts"](spark, DATA).collect():
        chosen.setdefault(r.video_id, []).append((r.time, r.depth or 0.0))
    expected = set()
    for video, cuts in chosen.items():
        times, depths = zip(*sorted(cuts), strict=True)
        expected |= {(video, times[i]) for i in segments.short_scene_drops(list(times), list(depths), 2160.0, 30.0)}
    assert kept == expected and any(len(c) > 1 for c in chosen.values())


def test_candidates_take_all_boundaries(spark):
    """The chosen cuts, then the deepest boundaries at least 15 s from each other, up to 60."""
    t = Tables(spark, DATA)
    depth = {}
    for r in segments.depth_score(t.boundaries).collect():
        depth.setdefault(r.video_id, []).append((r.time, r.depth))
    cuts = {(r.video_id, r.time) for r in entry.queries()["select_cuts"](spark, DATA).collect()}
    expected = set()
    for video, rows in depth.items():
        picked = [time for time, _ in rows if (video, round(time, 6)) in cuts]
        for time, _ in sorted(rows, key=lambda r: (-r[1], r[0])):
            if len(picked) < 60 and all(abs(time - p) >= 15 for p in picked):
                picked.append(time)
        expected |= {(video, k + 1, round(time, 6)) for k, time in enumerate(sorted(picked))}
    assert {(r.video_id, r.cid, r.time) for r in entry.queries()["refine_candidates"](spark, DATA).collect()} == expected


def test_jobs(spark):
    """The whole jobs: groups are numbered by size, scenes tile their videos, and only what is wrong in the answers is reported."""
    sizes = {}
    for r in entry.queries()["job_identities"](spark, DATA).collect():
        sizes.setdefault(r.video_id, {}).setdefault(r.grp, set()).add(r.det_id)
    for groups in sizes.values():
        counts = [len(groups[k]) for k in sorted(groups) if k > 0]
        assert sorted(k for k in groups if k > 0) == list(range(1, len(counts) + 1)) and counts == sorted(counts, reverse=True)
    t = Tables(spark, DATA)
    tiles = entry.queries()["job_scenes"](spark, DATA).withColumnsRenamed({"start_s": "start", "end_s": "end"})
    tiles = spark.createDataFrame(tiles.collect(), tiles.schema)
    assert tiles.groupBy("video_id").count().where("count > 10").count() == t.videos.count()
    for bad in (checks.check_ids(tiles), checks.check_contiguity(tiles), checks.check_coverage(tiles, t.videos), checks.check_scene_on_shot(tiles, t.shots)):
        assert bad.count() == 0
    unanswered = {(r.video_id, r.id) for r in t.scenes.where("id % 13 = 12").collect()}
    found = entry.queries()["job_documents"](spark, DATA).collect()
    assert {(r.video_id, int(r.entity)) for r in found if r.check == "description"} == unanswered
    assert {(r.video_id, int(r.entity.split()[1])) for r in found if r.check == "schema"} == unanswered
    assert {r.check for r in found} <= {"description", "schema", "min_scene", "citations"}


def test_entry_without_the_training_data_queries(tmp_path):
    """Whatever keeps those from being imported, the entry imports with the others and says why."""
    (tmp_path / "public_tokenizers.py").write_text("raise ImportError('no files here')")
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(x for x in e.queries() if x.startswith('op') and x[2].isdigit()))"
    env = os.environ | {"PYTHONPATH": f"{tmp_path}:{os.path.dirname(entry.__file__)}"}
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, cwd=tmp_path, check=True)
    assert said.stdout.split()[-1] == "[]" and int(said.stdout.split()[-2]) > 90 and "training-data queries are left out" in said.stderr
