"""Hand-made cases and plain Python versions of the order-dependent helpers."""

import itertools

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinetab.functions import expr, vectors
from cinetab.operators import checks, export, faces, joins, segments, timeline
from cinetab.operators.evidence import window_numbers
from cinetab.sources import io


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def videos(spark, duration=100.0, fps=25.0):
    return spark.createDataFrame([(1, duration, fps)], "video_id long, duration double, fps double")


def test_transitions(spark):
    probs = [0.5, 0.9, 0.1, 0.6, 0.7, 0.2, 0.9, 0.9, 0.9, 0.9]
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(probs)], "video_id long, frame_idx long, prob double")
    found = timeline.transition_boundaries(df, videos(spark))
    assert rows(found, "frame") == [(2,), (5,), (9,)]  # (3 + 4) / 2 and (6 + 9) / 2 go to the even middle
    shots = timeline.shots_from_boundaries(found.unionByName(found), videos(spark))
    assert rows(shots, "id", "start", "end") == [(0, 0.0, 0.08), (1, 0.08, 0.2), (2, 0.2, 0.36), (3, 0.36, 100.0)]


def test_shots_without_boundaries(spark):
    none = spark.createDataFrame([], "video_id long, boundary double")
    assert rows(timeline.shots_from_boundaries(none, videos(spark)), "id", "start", "end") == [(0, 0.0, 100.0)]


def test_asof_clips_at_both_ends(spark):
    shots = spark.createDataFrame([(1, 0, 5.0, 10.0), (1, 1, 10.0, 20.0)], "video_id long, id int, start double, end double")
    points = spark.createDataFrame([(1, 0.0), (1, 10.0), (1, 9.99), (1, 50.0)], "video_id long, ts double")
    assert rows(joins.asof_shot(points, shots), "ts", "shot_id") == [(0.0, 0), (9.99, 0), (10.0, 1), (50.0, 1)]
    assert rows(joins.interval_join(points, shots), "ts", "scene_id") == [(9.99, 0), (10.0, 1)]


def test_intervals_join_at_the_gap(spark):
    df = spark.createDataFrame([(1, 0, 1, t) for t in (0.0, 1.5, 3.1, 3.2)], "video_id long, scene_id long, group int, ts double")
    assert rows(export.appearance_intervals(df), "start", "end", "n") == [(0.0, 1.5, 2), (3.1, 3.2, 2)]


def test_depth_climbs_plateaus(spark):
    sims = [0.5, 0.5, 0.2, 0.4, 0.4, 0.1]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(sims)], "video_id long, shot_id long, sim double")
    found = [round(r.depth, 6) for r in segments.depth_score(df).orderBy("shot_id").collect()]
    assert found == [0.0, 0.0, 0.5, 0.0, 0.0, 0.3]


def test_expressions(spark):
    df = spark.range(1)
    got = df.select(
        expr.hms(F.lit(452.5)), expr.hms(F.lit(-3.0)), expr.normalise_group(F.lit("the Group_07")), expr.normalise_group(F.lit("none")), expr.normalise_group(F.lit("GROUP 0099999999999999999999")), expr.normalise_group(F.lit("group 000")),
        expr.clip_text(F.lit("abcdef"), 3), expr.clip_text(F.lit("abcdef"), 3, tail=True), expr.clip_text(F.lit("abc"), 3),
    ).first()
    assert tuple(got) == ("00:07:32.50", "00:00:00.00", "group7", None, "group99999999999999999999", "group0", "abc...", "...def", "abc")


def test_checks_are_silent_on_clean_tiles(spark):
    tiles = spark.createDataFrame([(1, 0, 0.0, 40.0), (1, 1, 40.0, 100.0)], "video_id long, id long, start double, end double")
    for check in (checks.check_ids, checks.check_contiguity, checks.check_positive_length, checks.check_min_scene):
        assert check(tiles).count() == 0
    assert checks.check_coverage(tiles, videos(spark)).count() == 0
    assert checks.check_coverage(tiles.limit(0), videos(spark)).count() == 1


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10**6))
def test_assignment_is_cheapest(n, m, seed):
    cost = np.random.default_rng(seed).random((n, m))
    found = faces.assign(cost)
    small, large = sorted((n, m))
    wide = cost if n <= m else cost.T
    best = min(sum(wide[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(large), small))
    assert len(found) == small and abs(sum(cost[i, j] for i, j in found) - best) < 1e-9


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6))
def test_average_linkage(n, seed):
    x = np.random.default_rng(seed).random((n, n))
    d = (x + x.T) / 2
    groups = [[i] for i in range(n)]
    while len(groups) > 1:
        pairs = [(np.mean([d[i, j] for i in a for j in b]), p, q) for (p, a), (q, b) in itertools.combinations(enumerate(groups), 2)]
        least, p, q = min(pairs)
        if least >= 0.4:
            break
        groups[p] = groups[p] + groups.pop(q)
    label = faces.average_linkage(d, 0.4)
    assert sorted(map(sorted, groups)) == sorted(np.flatnonzero(label == k).tolist() for k in np.unique(label))


def group_all(people, pdf):
    """All steps over one video at once: link, resolve, dissolve, rescue, merge, and then the tracks without anchors."""
    strong, weak = np.flatnonzero(pdf.n_anchor > 0), np.flatnonzero(pdf.n_anchor == 0)
    part = faces.People(people.vectors[strong], people.clash[np.ix_(strong, strong)], people.label[strong])
    if len(strong):
        part.link()
        part.resolve()
        part.dissolve(pdf.n_dets.to_numpy()[strong])
        part.rescue()
        part.merge(pdf.n_anchor.to_numpy()[strong])
    people.label[strong] = part.label
    if len(weak):
        people.rescue_weak(faces.unit_rows(np.stack([np.asarray(v, float) for v in pdf.all_vec.iloc[weak]])), weak)


def test_groups_of_orthogonal_people():
    v = np.array([[1, 0, 0], [0.99, 0.14, 0], [0, 1, 0], [0, 0, 1.0]])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    frames = [{1}, {2}, {1}, {9}, {5}, {5}, {6}]
    clash = np.array([[i != j and bool(a & b) for j, b in enumerate(frames)] for i, a in enumerate(frames)])
    weak = np.array([[1, 0, 0], [1, 0, 0], [0, 0, 1.0]])
    n = len(frames)
    pdf = pd.DataFrame({"n_anchor": [5, 5, 5, 1, 0, 0, 0], "n_dets": [5, 5, 5, 1, 1, 1, 1], "all_vec": [*v, *weak]})
    people = faces.People(np.concatenate([v, np.zeros((3, 3))]), clash)
    group_all(people, pdf)
    label = people.label
    assert label[0] == label[1] != label[2] and label[3] == -1 and len(label) == n
    assert label[4] == label[0] and label[5] == -1 and label[6] == -1


def middle(vectors, members, weight=None):
    total = sum((1 if weight is None else weight[m]) * vectors[m] for m in members)
    total = total if weight is not None else total / len(members)
    return total / (np.linalg.norm(total) + 1e-9)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6))
def test_group_steps_by_loops(n, seed):
    """Repair, rescue and merge of groups against loops over sets of frames."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    frames = [set(rng.integers(0, 12, rng.integers(1, 4)).tolist()) for _ in range(n)]
    clash = np.array([[i != j and bool(a & b) for j, b in enumerate(frames)] for i, a in enumerate(frames)])
    start, anchors = rng.integers(-1, 4, n), rng.integers(1, 6, n)
    members = lambda label, k: [i for i in range(n) if label[i] == k]
    groups = lambda label: sorted({int(x) for x in label if x >= 0})
    seen = lambda label, k: set().union(*(frames[i] for i in members(label, k)))

    label, people = start.copy(), faces.People(v, clash, start)
    people.resolve()
    for k in groups(label):
        held, mine = set(), members(label, k)
        for i in sorted(mine, key=lambda i: -round(float(v[i] @ middle(v, mine)), 9)):
            if frames[i] & held:
                label[i] = -1
            held |= frames[i] if label[i] >= 0 else set()
    assert people.label.tolist() == label.tolist()

    people.rescue(0.2)
    for i in members(label, -1):
        options = [(float(v[i] @ middle(v, members(label, k))), k) for k in groups(label) if not frames[i] & seen(label, k)]
        if options and max(options)[0] >= 0.2:
            label[i] = max(options)[1]
    assert people.label.tolist() == label.tolist()

    people.merge(anchors, 0.1)
    while True:
        pairs = [(-float(middle(v, members(label, a), anchors) @ middle(v, members(label, b), anchors)), a, b) for a, b in itertools.combinations(groups(label), 2) if not seen(label, a) & seen(label, b)]
        if not pairs or -min(pairs)[0] < 0.1:
            break
        label[label == min(pairs)[2]] = min(pairs)[1]
    assert people.label.tolist() == label.tolist()


def restarted_merge(tiles, look, min_len, max_dist):
    """Tiny tiles join a neighbour, from the first one again after each merge."""
    tiles = list(tiles)
    changed = True
    while changed:
        changed = False
        for i, (a, b) in enumerate(tiles):
            if b - a >= min_len or len(tiles) == 1:
                continue
            d, j = min((timeline.histogram_distance(look(a, b), look(*tiles[j])), j) for j in (i - 1, i + 1) if 0 <= j < len(tiles))
            if d < max_dist:
                i, j = sorted((i, j))
                tiles[i : j + 1] = [(tiles[i][0], tiles[j][1])]
                changed = True
                break
    return tiles


def test_tiny_shots_join_what_they_look_like(spark):
    rng = np.random.default_rng(4)
    fps, shots, hists = 10.0, [], []
    for video in range(12):
        edges = np.concatenate([[0], np.cumsum(rng.choice([0.2, 0.3, 0.5, 1.0, 2.0], 25))]).round(4)
        shots += [(video, k, float(a), float(b)) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        frames = int(edges[-1] * fps) - video % 3  # the last frames may be missing
        hists += [(video, k, rng.choice([0.0, 1.0, 5.0], 4).tolist()) for k in range(frames)]
    tables = spark.createDataFrame(shots, "video_id long, id int, start double, end double"), spark.createDataFrame(hists, "video_id long, frame_idx long, hist array<double>")
    clips = spark.createDataFrame([(v, fps) for v in range(12)], "video_id long, fps double")
    found = rows(timeline.merge_tiny_shots(*tables, clips, 0.4, 0.4), "video_id", "id", "start", "end")
    expected = []
    for video in range(12):
        frames = [np.array(h) for v, _, h in hists if v == video]

        def look(a, b, frames=frames):
            first = int(a * fps)
            return frames[min((first + max(first + 1, int(b * fps))) // 2, len(frames) - 1)]

        tiles = restarted_merge([(a, b) for v, _, a, b in shots if v == video], look, 0.4, 0.4)
        expected += [(video, k, a, b) for k, (a, b) in enumerate(tiles)]
    assert found == expected and 12 * 5 < len(found) < len(shots)
    assert timeline.merge_tiny_shots(tables[0].limit(0), tables[1], clips).count() == 0
    # Without frames nothing looks alike.
    assert rows(timeline.merge_tiny_shots(tables[0], tables[1].limit(0), clips), "video_id", "id", "start", "end") == shots


def test_cuts_move_to_establishing_shots(spark):
    rng = np.random.default_rng(5)
    shots, dets, vectors, cuts = [], [], [], []
    for video in range(15):
        edges = np.concatenate([[0], np.cumsum(rng.choice([2.0, 4.0, 9.0], 60))])
        shots += [(video, k, float(a), float(b)) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        dets += [(video, int(k)) for k in np.flatnonzero(rng.random(60) < 0.4)]
        vectors += [(video, k, rng.integers(0, 3, 3).astype(float).tolist()) for k in range(60)]
        cuts += [(video, float(edges[k])) for k in sorted(rng.choice(np.arange(1, 60), 8, replace=False))]
    expected = []
    for video in range(15):
        start = [a for v, _, a, _ in shots if v == video]
        with_faces = {k for v, k in dets if v == video}
        x = np.array([e for v, _, e in vectors if v == video])
        sim, prev = x @ x.T, 0.0
        for t in [t for v, t in cuts if v == video]:
            b = start.index(t)
            run = b
            for k in range(b - 1, 0, -1):
                if b - k > 4 or k in with_faces or t - start[k] > 15 or start[k] - prev < 30:
                    break
                run = k
            home = b
            for j in range(b - 1, run - 1, -1):
                before, after = sim[j, max(0, run - 6) : run], sim[j, b : b + 6]
                if len(before) and before.max() > after.max():
                    break
                home = j
            prev = start[home]
            expected.append((video, start[home], t))
    tables = [
        spark.createDataFrame(cuts + [(0, 0.5)], "video_id long, time double"), spark.createDataFrame(shots, "video_id long, id int, start double, end double"),
        spark.createDataFrame(dets, "video_id long, shot_id int"), spark.createDataFrame(vectors, "video_id long, shot_id int, embedding array<double>"),
    ]
    found = rows(segments.snap_establishing(*tables), "video_id", "time", "from_time")
    assert found == sorted(expected) and any(a != b for _, a, b in found)
    assert segments.snap_establishing(tables[0].limit(0), *tables[1:]).count() == 0
    # The composition: candidates that are kept, without short scenes, moved, as scenes.
    candidates = tables[0].selectExpr("video_id", "cast(row_number() over (partition by video_id order by time) as int) as cid", "time", "0.5D as depth")
    answers = spark.createDataFrame([(v, [1, 3, 5, 7, 7, 99]) for v in range(15)], "video_id long, keep array<int>")
    lengths = spark.createDataFrame([(v, max(b for w, _, _, b in shots if w == v)) for v in range(15)], "video_id long, duration double")
    scenes = segments.apply_refinement(candidates, answers, lengths, *tables[1:])
    for check in (checks.check_ids, checks.check_contiguity, checks.check_positive_length):
        assert check(scenes).count() == 0
    assert checks.check_scene_on_shot(scenes, tables[1]).count() == 0 and scenes.count() > 20


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 199), max_size=25, unique=True), st.integers(0, 10**6))
def test_short_scenes_by_restarts(times, seed):
    times = sorted(map(float, times))
    depths = np.random.default_rng(seed).integers(0, 4, len(times)).astype(float).tolist()
    kept = list(range(len(times)))
    while kept:
        edges = [0.0, *(times[k] for k in kept), 200.0]
        lengths = [b - a for a, b in itertools.pairwise(edges)]
        k = lengths.index(min(lengths))
        if lengths[k] >= 30:
            break
        kept.remove(min((kept[i] for i in (k - 1, k) if 0 <= i < len(kept)), key=lambda i: depths[i]))
    assert segments.short_scene_drops(times, depths, 200.0, 30.0) == kept


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 1999), min_size=1, max_size=60, unique=True), st.lists(st.integers(0, 2000), max_size=4), st.integers(0, 10**6))
def test_cuts_by_plain_walk(times, chapters, seed):
    times = np.array(sorted(times), float)
    depths = np.random.default_rng(seed).integers(0, 6, len(times)) / 4.0
    boosted = depths.copy()
    for c in sorted(chapters):
        if c > 0:
            boosted = np.where(np.abs(times - c) <= 3, boosted + 0.5 * boosted.std(), boosted)
    chosen = []
    for i in sorted(range(len(times)), key=lambda i: (-boosted[i], times[i])):
        if len(chosen) == max(0, round(2000 / 90) - 1) or boosted[i] < depths.mean() - 0.5 * depths.std():
            break
        if min(abs(times[i] - e) for e in [0.0, 2000.0, *times[chosen]]) >= 30:
            chosen.append(i)
    while True:
        edges = sorted([0.0, 2000.0, *times[chosen]])
        inner = [[i for i in range(len(times)) if a + 30 <= times[i] <= b - 30] if b - a > 300 else [] for a, b in itertools.pairwise(edges)]
        long = next((x for x in inner if x), None)
        if long is None:
            break
        chosen.append(max(long, key=lambda i: (boosted[i], -times[i])))
    assert segments.pick_cuts(times, depths, 2000.0, [float(c) for c in chapters]) == sorted(chosen)


def test_asof_in_buckets(spark):
    """Starts long before a point, in other buckets, are carried on."""
    rng = np.random.default_rng(6)
    starts = sorted({float(x) for x in rng.integers(0, 1000, 12)})
    tiles = [(1, k, a, b) for k, (a, b) in enumerate(itertools.pairwise([*starts, 900.0])) if b > a]
    points = [(1, float(t)) for t in rng.integers(0, 1100, 200)] + [(2, 5.0)]
    tiles_df, points_df = spark.createDataFrame(tiles, "video_id long, id int, start double, end double"), spark.createDataFrame(points, "video_id long, ts double")
    last = lambda t: max([k for _, k, a, _ in tiles if a <= t], default=tiles[0][1])
    found = sorted((r.video_id, r.ts, -1 if r.shot_id is None else r.shot_id) for r in joins.asof_shot(points_df, tiles_df, width=50.0).collect())
    assert found == sorted((v, t, last(t) if v == 1 else -1) for v, t in points)
    inside = sorted((t, k) for v, t in points if v == 1 for _, k, a, b in tiles if a <= t < b)
    assert rows(joins.interval_join(points_df, tiles_df, width=50.0), "ts", "scene_id") == inside


def test_vectors(spark):
    rng = np.random.default_rng(7)
    data = [(k % 5, rng.normal(size=4).tolist(), float(rng.random())) for k in range(60)]
    df = spark.createDataFrame(data, "k long, v array<float>, w double").repartition(7)
    total = {r.k: r.vector for r in vectors.vector_sum(df, ["k"], F.col("v"), F.col("w")).collect()}
    mean = {r.k: r.vector for r in vectors.vector_mean(df, ["k"], F.col("v")).collect()}
    for k in range(5):
        mine = [(np.array(v, np.float32).astype(float), w) for j, v, w in data if j == k]
        assert np.allclose(total[k], sum(w * v for v, w in mine)) and np.allclose(mean[k], sum(v for v, _ in mine) / len(mine))


def test_files_and_listing(spark, tmp_path):
    (tmp_path / "scene_002" / "group3").mkdir(parents=True)
    (tmp_path / "scene_002" / "group3" / "t0012.50.jpg").write_bytes(b"x")
    (tmp_path / "scene_004").mkdir()
    (tmp_path / "scene_004" / "_no_faces").write_bytes(b"x")
    found = sorted(((r.scene_id, r.group, r.ts) for r in io.crop_listing(spark, str(tmp_path)).collect()))
    assert found == [(2, 3, 12.5)]


def test_windows_and_short_scenes():
    assert window_numbers([300, 600, 601, 1900], [0, 300, 600, 601], 600) == [0, 0, 1, 2]
    assert segments.short_scene_drops([10.0, 50.0], [0.9, 0.1], 100.0, 30.0) == [1]
    assert segments.pick_cuts(np.array([45.0, 90.0]), np.array([0.1, 0.9]), 180.0, []) == [1]


def test_tracks_cross_a_gap(spark):
    box = lambda d, ts, x: (1, 0, d, ts, x, 0.0, x + 50, 50.0, "weak", [1.0, 0.0])
    df = spark.createDataFrame(
        [box(1, 0.0, 0.0), box(2, 0.0, 200.0), box(3, 2.0, 205.0), box(4, 2.0, 5.0), box(5, 3.0, 500.0)],
        "video_id long, shot_id int, det_id long, ts double, x1 double, y1 double, x2 double, y2 double, tier string, embedding array<double>",
    )
    assert rows(faces.build_tracks(df), "det_id", "track_id") == [(1, 0), (2, 1), (3, 1), (4, 0), (5, 2)]


def track_shot(pdf, min_iou, min_cos):
    """A track number for each detection of one shot, time after time; rows sorted by time."""
    boxes, track, following, before = pdf[["x1", "y1", "x2", "y2"]].to_numpy(float), np.full(len(pdf), -1), 0, []
    vectors = [v if t == "anchor" else None for v, t in zip(pdf.embedding, pdf.tier, strict=True)]
    for _, now in sorted(pdf.groupby("ts").indices.items()):
        rows = [*now, *before]
        for j, i in faces.matched(boxes[rows], [vectors[k] for k in rows], len(now), min_iou, min_cos):
            track[now[j]] = track[before[i]]
        for j in now:
            if track[j] < 0:
                track[j], following = following, following + 1
        before = list(now)
    return track


def random_shot(rng, steps):
    found = []
    for t in range(steps):
        for _ in range(rng.integers(1, 5)):
            x, y = rng.random(2) * 30
            v = rng.normal(size=2)
            found.append((float(t * 2), x, y, x + 40 + rng.random(), y + 40 + rng.random(), str(rng.choice(["anchor", "weak"])), (v / np.linalg.norm(v)).tolist()))
    return pd.DataFrame(found, columns=["ts", "x1", "y1", "x2", "y2", "tier", "embedding"])


def test_tracks_of_many_shots(spark):
    """Linked times and chains give the tracks of a walk through each shot, numbered by shot, time and detection."""
    rng = np.random.default_rng(11)
    shots = [random_shot(rng, steps).assign(video_id=v, shot_id=s) for v in range(4) for s, steps in enumerate([1, 7, 40, 3])]
    pdf = pd.concat(shots, ignore_index=True).reset_index(names="det_id")
    expected, base = [], {}
    for (video, _), part in pdf.groupby(["video_id", "shot_id"]):
        track = track_shot(part.reset_index(drop=True), 0.3, 0.3) + base.get(video, 0)
        base[video] = int(track.max()) + 1
        expected += zip(part.det_id.tolist(), track.tolist(), strict=True)
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(3)
    assert rows(faces.build_tracks(df), "det_id", "track_id") == sorted(expected)
    assert faces.build_tracks(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5), st.integers(0, 10**6))
def test_tracks_by_all_permutations(steps, seed):
    """Each sampled time's detections join those of the time before at the least total cost over all ways to pair them."""
    rng = np.random.default_rng(seed)
    found, at = [], []
    for t in range(steps):
        for _ in range(rng.integers(1, 5)):
            x, y = rng.random(2) * 30
            found.append((float(t * 2), x, y, x + 40 + rng.random(), y + 40 + rng.random(), rng.choice(["anchor", "weak"]), rng.normal(size=2)))
            at.append(t)
    pdf = pd.DataFrame(found, columns=["ts", "x1", "y1", "x2", "y2", "tier", "embedding"])
    pdf["embedding"] = [v / np.linalg.norm(v) for v in pdf.embedding]
    got = track_shot(pdf, 0.3, 0.3)

    def cost(i, j):
        a, b = pdf.iloc[i], pdf.iloc[j]
        inter = max(0, min(a.x2, b.x2) - max(a.x1, b.x1)) * max(0, min(a.y2, b.y2) - max(a.y1, b.y1))
        iou = inter / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - inter + 1e-9)
        near = not (a.tier == b.tier == "anchor") or float(a.embedding @ b.embedding) >= 0.3
        return 1 - iou if iou >= 0.3 and near else 10.0

    track, following, before = {}, 0, []
    for t in range(steps):
        now = [k for k in range(len(at)) if at[k] == t]
        short, long = sorted((before, now), key=len)
        ways = [list(zip(short, p, strict=True)) for p in itertools.permutations(long, len(short))]
        ways = [[(i, j) if short is before else (j, i) for i, j in way] for way in ways]
        for i, j in min(ways, key=lambda way: sum(cost(i, j) for i, j in way)):
            if cost(i, j) < 10:
                track[j] = track[i]
        for j in now:
            if j not in track:
                track[j], following = following, following + 1
        before = now
    assert got.tolist() == [track[k] for k in range(len(at))]
