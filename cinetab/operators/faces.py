"""Face identities: tracks inside shots, track vectors, clusters, repair and rescue, group statistics."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import detection_quality, dot, unit
from ..functions.vectors import vector_mean, vector_sum
from .graph import chain_starts

FORBIDDEN = 10.0


def pairwise_iou(dets: DataFrame) -> DataFrame:
    """(video_id, shot_id, det_a, det_b, iou) for detections at consecutive sampled times of a shot."""
    step = F.dense_rank().over(Window.partitionBy("video_id", "shot_id").orderBy("ts"))
    d = dets.select("video_id", "shot_id", step.alias("step"), "det_id", "x1", "y1", "x2", "y2")
    box = lambda s: F.struct("x1", "y1", "x2", "y2").alias(s)
    a = d.select("video_id", "shot_id", (F.col("step") + 1).alias("step"), F.col("det_id").alias("det_a"), box("a"))
    b = d.select("video_id", "shot_id", "step", F.col("det_id").alias("det_b"), box("b"))
    area = lambda s: (F.col(f"{s}.x2") - F.col(f"{s}.x1")) * (F.col(f"{s}.y2") - F.col(f"{s}.y1"))
    across = lambda k: F.greatest(F.least(f"a.{k}2", f"b.{k}2") - F.greatest(f"a.{k}1", f"b.{k}1"), F.lit(0.0))
    inter = across("x") * across("y")
    return a.join(b, ["video_id", "shot_id", "step"]).select("video_id", "shot_id", "det_a", "det_b", (inter / (area("a") + area("b") - inter + 1e-9)).alias("iou"))


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of a one-to-one assignment with the least total cost (shortest augmenting paths)."""
    if cost.shape[0] > cost.shape[1]:
        return sorted((i, j) for j, i in assign(cost.T))
    n, m = cost.shape
    owner, u, v = np.full(m + 1, -1), np.zeros(n), np.zeros(m + 1)
    for i in range(n):
        owner[m], j = i, m
        least, back, done = np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while True:
            done[j] = True
            row = owner[j]
            open_cols = np.flatnonzero(~done[:m])
            reach = cost[row, open_cols] - u[row] - v[open_cols]
            better = reach < least[open_cols]
            least[open_cols[better]] = reach[better]
            back[open_cols[better]] = j
            k = open_cols[np.argmin(least[open_cols])]
            delta = least[k]
            u[owner[np.flatnonzero(done)]] += delta
            v[np.flatnonzero(done)] -= delta
            least[open_cols] -= delta
            j = k
            if owner[j] < 0:
                break
        while j != m:
            owner[j] = owner[back[j]]
            j = back[j]
    return sorted((int(owner[j]), j) for j in range(m) if owner[j] >= 0)


def matched(boxes: np.ndarray, vectors: list, fresh: int, min_iou: float, min_cos: float) -> list[tuple[int, int]]:
    """Pairs (i, j) of the ``fresh`` first rows and those before them: which detection goes on which, at the least total cost.

    ``vectors`` holds those of anchors, else None. Pairs need an overlap, and two anchors a likeness as well.
    """
    if fresh == len(boxes) or not fresh:
        return []
    a, b = boxes[fresh:, None], boxes[None, :fresh]
    inter = np.prod(np.clip(np.minimum(a[..., 2:], b[..., 2:]) - np.maximum(a[..., :2], b[..., :2]), 0, None), axis=2)
    size = lambda x: np.prod(x[..., 2:] - x[..., :2], axis=-1)
    iou = inter / (size(a) + size(b) - inter + 1e-9)
    cost = np.where(iou >= min_iou, 1 - iou, FORBIDDEN)
    for i, j in zip(*np.nonzero(cost < FORBIDDEN), strict=True):
        x, y = vectors[fresh + i], vectors[j]
        if x is not None and y is not None and float(np.dot(x, y)) < min_cos:
            cost[i, j] = FORBIDDEN
    return [(j, i) for i, j in assign(cost) if cost[i, j] < FORBIDDEN]


def frame_links(dets: DataFrame, min_iou: float, min_cos: float) -> DataFrame:
    """(video_id, node, before): the detection of the sampled time before that each detection goes on, or null.

    A shot's times follow one another where they have detections. Each detection is dealt to its own time and to the next one, so a group holds
    two times of a shot, however long that is; groups are read in sorted order, many to a batch.
    """
    key = ["video_id", "shot_id", "ts"]
    following = F.lead("ts").over(Window.partitionBy("video_id", "shot_id").orderBy("ts"))
    times = dets.select(*key).distinct().select(*key, following.alias("next"))
    rows = dets.join(times, key).select(
        "video_id", "shot_id", "det_id", F.array("x1", "y1", "x2", "y2").cast("array<double>").alias("box"), F.when(F.col("tier") == "anchor", F.col("embedding")).alias("vec"),
        F.explode(F.array(F.struct(F.lit(0).alias("old"), F.col("ts").alias("at")), F.struct(F.lit(1).alias("old"), F.col("next").alias("at")))).alias("g"),
    ).where("g.at IS NOT NULL").select("video_id", "shot_id", "g.at", "g.old", "det_id", "box", "vec")
    order = ["video_id", "shot_id", "at"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            change = np.flatnonzero(np.logical_or.reduce([pdf[c].to_numpy()[1:] != pdf[c].to_numpy()[:-1] for c in order])) + 1
            last = int(change[-1]) if len(change) else 0
            rest = pdf.iloc[last:].reset_index(drop=True)
            yield link(pdf.iloc[:last], change)
        if rest is not None:
            yield link(rest, np.zeros(0, int))

    def link(pdf: pd.DataFrame, change: np.ndarray) -> pd.DataFrame:
        ids, old = pdf.det_id.to_numpy(), pdf.old.to_numpy()
        before = np.full(len(pdf), -1)
        cuts = [0, *change[change < len(pdf)].tolist(), len(pdf)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            fresh = int((old[a:b] == 0).sum())
            if 0 < fresh < b - a:
                vectors = [None if v is None else np.asarray(v, float) for v in pdf.vec.iloc[a:b]]  # as given in the shuffle
                for j, i in matched(np.stack(pdf.box.iloc[a:b].to_numpy()), vectors, fresh, min_iou, min_cos):
                    before[a + j] = a + fresh + i
        at = np.flatnonzero(old == 0)
        found = pd.array(np.where(before[at] < 0, 0, ids[before[at]]) if len(ids) else [], dtype="Int64")
        found[before[at] < 0] = pd.NA
        return pd.DataFrame({"video_id": pdf.video_id.to_numpy()[at], "node": ids[at], "before": found})

    return rows.repartition(*order).sortWithinPartitions(*order, "old", "det_id").mapInPandas(work, "video_id long, node long, before long")


def build_tracks(dets: DataFrame, min_iou: float = 0.3, min_cos: float = 0.3) -> DataFrame:
    """``dets`` with track_id: numbered in a video by (shot, first time, first detection). A group is two times of a shot."""
    chains = chain_starts(frame_links(dets, min_iou, min_cos))
    first = dets.join(chains.where("node = start").select("video_id", F.col("node").alias("det_id")), ["video_id", "det_id"])
    number = F.row_number().over(Window.partitionBy("video_id").orderBy("shot_id", "ts", "det_id")) - 1
    numbers = first.select("video_id", F.col("det_id").alias("start"), number.cast("long").alias("track_id"))
    found = chains.join(numbers, ["video_id", "start"]).select("video_id", F.col("node").alias("det_id"), "track_id")
    return dets.join(found, ["video_id", "det_id"])


def track_embeddings(tracked: DataFrame) -> DataFrame:
    """(video_id, track_id, embedding, n_dets, n_anchor, frames): quality-weighted unit vector over anchors (null without)."""
    q = detection_quality(F.col("det_score"), F.col("sharpness"))
    vec = vector_sum(tracked.where("tier = 'anchor'"), ["video_id", "track_id"], F.col("embedding"), q, "raw")
    length = F.sqrt(dot(F.col("raw"), F.col("raw"))) + 1e-9
    vec = vec.select("video_id", "track_id", F.transform("raw", lambda x: x / length).alias("embedding"))
    counts = tracked.groupBy("video_id", "track_id").agg(
        F.count("*").alias("n_dets"), F.count_if(F.col("tier") == "anchor").alias("n_anchor"), F.sort_array(F.collect_set("ts")).alias("frames")
    )
    return counts.join(vec, ["video_id", "track_id"], "left")


def average_linkage(distance: np.ndarray, threshold: float) -> np.ndarray:
    """Labels 0.. (by first member) of merging the closest clusters while their average distance is below the threshold.

    Each cluster keeps its nearest one, so a merge looks at the clusters whose nearest is gone, not at all pairs.
    """
    n = len(distance)
    label, size = np.arange(n), np.ones(n)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    if n < 2:
        return label
    near = d.argmin(axis=1)
    least = d[np.arange(n), near]
    while True:
        i = int(least.argmin())
        j = int(near[i])
        if not least[i] < threshold:
            return np.unique(label, return_inverse=True)[1]
        i, j = min(i, j), max(i, j)
        d[i] = d[:, i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
        size[i] += size[j]
        label[label == j] = i
        least[j] = np.inf
        again = np.flatnonzero((near == i) | (near == j) | (d[i] < least) | (d[i] == least) & (i < near))
        for k in {i, *again.tolist()} - {j}:
            near[k] = d[k].argmin()
            least[k] = d[k, near[k]]


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=-1, keepdims=True) + 1e-9)


def merge_order(total: np.ndarray, may: Callable[[int, int], bool], join: Callable[[int, int], None], least: float, step: int = 512) -> Iterator[tuple[int, int]]:
    """(a, b), a < b: rows of ``total`` that become one, the largest cosine first, while one reaches ``least``; b's sum is added to a's.

    ``may`` says whether two rows can join, ``join`` is told that they do. Pairs that reach ``least`` wait in a heap, out of date once a
    side has changed; cosines are taken in blocks of rows.
    """
    total, version, gone = total.astype(float).copy(), np.zeros(len(total), int), np.zeros(len(total), bool)
    unit, heap = unit_rows(total), []
    for at in range(0, len(total), step):
        cos = unit[at : at + step] @ unit.T
        heap += [(-cos[i, j], at + int(i), int(j), 0, 0) for i, j in zip(*np.nonzero(cos >= least), strict=True) if at + i < j]
    heapq.heapify(heap)
    while heap:
        _, a, b, seen_a, seen_b = heapq.heappop(heap)
        if gone[a] or gone[b] or version[a] != seen_a or version[b] != seen_b or not may(a, b):
            continue
        join(a, b)
        yield a, b
        gone[b], version[a] = True, version[a] + 1
        total[a] += total[b]
        unit[a] = unit_rows(total[a])
        cos = unit @ unit[a]
        for k in np.flatnonzero((cos >= least) & ~gone):
            if k != a:
                i, j = min(a, int(k)), max(a, int(k))
                heapq.heappush(heap, (-cos[k], i, j, version[i], version[j]))


class People:
    """The tracks of one video while they are put into groups: ``label`` is a track's group, -1 for none.

    ``clash`` says which tracks are seen at one time and so cannot be one person.
    """

    def __init__(self, vectors: np.ndarray, clash: np.ndarray, label: np.ndarray | None = None):
        self.vectors, self.clash = vectors, clash
        self.label = np.full(len(vectors), -1) if label is None else label.copy()

    def link(self, threshold: float = 0.55) -> None:
        """Average linkage over cosine distances; tracks that clash are 2 apart, which alone does not keep them apart."""
        distance = np.clip(1 - self.vectors @ self.vectors.T, 0, 2)
        distance[self.clash] = 2.0
        self.label = average_linkage(distance, threshold)

    def resolve(self) -> None:
        """In each group the tracks nearest to its middle stay, earlier ones first in ties; one that clashes with any of those leaves."""
        for k in np.unique(self.label[self.label >= 0]):
            members = np.flatnonzero(self.label == k)
            near = self.vectors[members] @ unit_rows(self.vectors[members].mean(axis=0))
            blocked = np.zeros(len(self.label), bool)
            for i in members[np.argsort(-near.round(9), kind="stable")]:
                if blocked[i]:
                    self.label[i] = -1
                else:
                    blocked |= self.clash[i]

    def dissolve(self, n_dets: np.ndarray, least: int = 3) -> None:
        """A group of one track with few detections is none."""
        groups, at, size = np.unique(self.label, return_inverse=True, return_counts=True)
        self.label[(size[at] == 1) & (n_dets < least)] = -1

    def _groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The groups, which track is in which (0 or 1), and which tracks clash with which group."""
        groups = np.unique(self.label[self.label >= 0])
        member = (self.label[:, None] == groups[None]).astype(float)
        return groups, member, self.clash.astype(float) @ member > 0

    def rescue(self, min_cos: float = 0.45) -> None:
        """Tracks without a group join the nearest one that they do not clash with, one after another; ties to the later group."""
        groups, member, taken = self._groups()
        if not len(groups):
            return
        total = member.T @ self.vectors
        for i in np.flatnonzero(self.label < 0):
            cos = np.where(taken[i], -np.inf, unit_rows(total) @ self.vectors[i])
            k = len(groups) - 1 - int(np.argmax(cos[::-1]))
            if cos[k] >= min_cos:
                self.label[i] = groups[k]
                total[k] += self.vectors[i]
                taken[:, k] |= self.clash[i]

    def merge(self, n_anchor: np.ndarray, min_cos: float = 0.30) -> None:
        """The two nearest groups (by means weighted by anchors) that do not clash become one, again and again."""
        groups, member, taken = self._groups()
        apart = member.T @ taken.astype(float) > 0

        def join(a: int, b: int) -> None:
            apart[a] |= apart[b]
            apart[:, a] |= apart[:, b]

        for a, b in merge_order((member * n_anchor[:, None]).T @ self.vectors, lambda a, b: not apart[a, b], join, min_cos):
            self.label[self.label == groups[b]] = groups[a]

    def rescue_weak(self, vectors: np.ndarray, weak: np.ndarray, min_cos: float = 0.55) -> None:
        """Tracks ``weak`` (places) with ``vectors`` join groups, best cosines first, where they clash with none in it."""
        strong = np.setdiff1d(np.arange(len(self.label)), weak)
        groups, member, taken = self._groups()
        if not len(groups) or not len(weak):
            return
        count = np.maximum(member[strong].sum(axis=0), 1)[:, None]
        cos = vectors @ unit_rows(member[strong].T @ self.vectors[strong] / count).T
        row, group = np.nonzero(cos >= min_cos)
        for t in np.lexsort((group, row, -cos[row, group])):
            i, g = weak[row[t]], group[t]
            if self.label[i] < 0 and not taken[i, g]:
                self.label[i] = groups[g]
                taken[:, g] |= self.clash[i]


def dissolve_tiny(tracks: DataFrame, min_detections: int = 3) -> DataFrame:
    """(video_id, track_id, cluster): a cluster of one track with few detections becomes -1; ``tracks``: (…, cluster, n_dets)."""
    w = Window.partitionBy("video_id", "cluster")
    tiny = (F.count("*").over(w) == 1) & (F.sum("n_dets").over(w) < min_detections)
    return tracks.select("video_id", "track_id", F.when(tiny, -1).otherwise(F.col("cluster")).alias("cluster"))


def rank_groups(faces: DataFrame) -> DataFrame:
    """``faces(…, cluster)`` with group: 1.. by detections of the video's clusters, ties by cluster; -1 without one."""
    n = faces.where("cluster >= 0").groupBy("video_id", "cluster").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("n"), "cluster"))
    return faces.join(n.select("video_id", "cluster", rank.alias("_g")), ["video_id", "cluster"], "left").withColumn("group", F.coalesce("_g", F.lit(-1))).drop("_g")


def group_centroids(faces: DataFrame) -> DataFrame:
    """(video_id, group, centroid): unit mean vector of a group's anchors."""
    mean = vector_mean(faces.where("group > 0 and tier = 'anchor'"), ["video_id", "group"], F.col("embedding"), "m")
    return mean.select("video_id", "group", unit(F.col("m")).alias("centroid"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in column.to_pylist()])


def _nearest_groups(table: pa.Table) -> pa.Table:
    """Of each centroid of one video the nearest other one, in blocks, ties to the smaller group; a video's only group has none."""
    step = 512
    table = table.sort_by("group")
    group, x, rows = table.column("group").to_numpy(), _matrix(table.column("centroid")), []
    for at in range(0, len(x) if len(x) > 1 else 0, step):
        cos = x[at : at + step] @ x.T
        cos[np.arange(len(cos)), at + np.arange(len(cos))] = -np.inf
        best = cos.argmax(axis=1)
        rows += zip(group[at : at + step].tolist(), group[best].tolist(), cos[np.arange(len(cos)), best].tolist(), strict=True)
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    video = pa.array([table.column("video_id")[0].as_py()] * len(rows), pa.int64())
    return pa.table([video, pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())], ["video_id", "group", "nearest_group", "nearest_cos"])


def group_stats(faces: DataFrame) -> DataFrame:
    """(video_id, group, detections, tracks, mean_cos_to_centroid, nearest_group, nearest_cos) of groups with anchors."""
    centre = group_centroids(faces)
    counts = faces.where("group > 0").groupBy("video_id", "group").agg(F.count("*").alias("detections"), F.count_distinct("track_id").alias("tracks"))
    own = faces.where("group > 0 and tier = 'anchor'").join(centre, ["video_id", "group"])
    own = own.groupBy("video_id", "group").agg(F.avg(dot(F.col("embedding"), F.col("centroid"))).alias("mean_cos_to_centroid"))
    near = centre.groupBy("video_id").applyInArrow(_nearest_groups, "video_id long, group int, nearest_group int, nearest_cos double")
    return counts.join(own, ["video_id", "group"]).join(near, ["video_id", "group"], "left").fillna(0.0, ["nearest_cos"])


def even_places(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """Up to n evenly spaced rows of each key, with ``place`` 0..: half-even positions of a line from first to last."""
    w = Window.partitionBy(*keys)
    df = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    k = F.least(F.col("_n"), F.lit(n))
    spot = lambda j: F.rint(j * (F.col("_n") - 1) / F.greatest(k - 1, F.lit(1)))
    df = df.withColumn("_at", F.transform(F.sequence(F.lit(0), k - 1), spot))
    return df.withColumn("place", F.array_position("_at", F.col("_i").cast("double")) - 1).where("place >= 0").drop("_i", "_n", "_at")


def even_sample(faces: DataFrame, n: int = 64, columns: int = 8) -> DataFrame:
    """Up to n evenly spaced faces of each group by time, with their row and column on a sheet."""
    df = even_places(faces.where("group > 0"), ["video_id", "group"], ["ts", "det_id"], n)
    return df.withColumn("sheet_row", F.floor(F.col("place") / columns)).withColumn("sheet_col", F.pmod("place", F.lit(columns)))


def best_crops(faces: DataFrame, windows: DataFrame, k: int = 4) -> DataFrame:
    """k evenly spaced of the 4k best detections of a group in each of ``windows(video_id, window_id, start, end)``."""
    from .joins import interval_join

    df = interval_join(faces.where("group > 0"), windows, "ts", "window_id", "window_id")
    key = ["video_id", "window_id", "group"]
    df = df.withColumn("_any", F.max(F.col("tier") == "anchor").over(Window.partitionBy(*key))).where(~F.col("_any") | (F.col("tier") == "anchor"))
    best = Window.partitionBy(*key).orderBy(F.desc(detection_quality(F.col("det_score"), F.col("sharpness"))), "det_id")
    df = df.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= 4 * k).drop("_r", "_any")
    return even_places(df, key, ["ts", "det_id"], k)


def grouping_signature(faces: DataFrame) -> DataFrame:
    """(video_id, signature): 16 hex digits that name the assignment of detections to groups."""
    pairs = F.array_sort(F.collect_list(F.struct("det_id", "group")))
    text = F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["det_id"], p["group"])), ",")
    return faces.groupBy("video_id").agg(F.left(F.sha2(text, 256), F.lit(16)).alias("signature"))


def identity_agreement(crops: DataFrame, centroids: DataFrame, block: int = 1024) -> DataFrame:
    """(video_id, group, total, agreeing): crops whose nearest centroid is their own group's; ties to the smaller group.

    Crops are dealt into blocks of some ``block`` rows, each of which meets its video's centroids as one matrix and gives a row a group.
    """
    crops = crops.where("embedding IS NOT NULL").select("video_id", "crop_id", F.col("group").cast("int").alias("group"), "embedding")
    sizes = crops.groupBy("video_id").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = crops.join(sizes, "video_id").select("video_id", F.pmod(F.xxhash64("crop_id"), F.col("blocks")).cast("int").alias("block"), "group", "embedding")
    known = centroids.join(sizes, "video_id").select(F.col("video_id").alias("of_video"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("of_block"), F.col("group").cast("int").alias("other"), "centroid")

    def score(rows: pa.Table, middles: pa.Table) -> pa.Table:
        names = ["video_id", "group", "total", "agreeing"]
        if not len(rows) or not len(middles):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names)
        middles = middles.sort_by("other")
        best = middles.column("other").to_numpy()[(_matrix(rows.column("embedding")) @ _matrix(middles.column("centroid")).T).argmax(axis=1)]
        own = rows.column("group").to_numpy()
        groups, at = np.unique(own, return_inverse=True)
        counts = [np.bincount(at, minlength=len(groups)), np.bincount(at[best == own], minlength=len(groups))]
        return pa.table([pa.array([rows.column("video_id")[0].as_py()] * len(groups), pa.int64()), pa.array(groups, pa.int32()), *(pa.array(c, pa.int64()) for c in counts)], names)

    found = dealt.groupBy("video_id", "block").cogroup(known.groupBy("of_video", "of_block")).applyInArrow(score, "video_id long, group int, total long, agreeing long")
    return found.groupBy("video_id", "group").agg(F.sum("total").alias("total"), F.sum("agreeing").alias("agreeing"))


def agreement_summary(agreement: DataFrame, lowest: int = 3) -> DataFrame:
    """(video_id, total, agreeing, lowest): sums over ``identity_agreement``, and the groups that agree least, as "groupN a/t"."""
    order = Window.partitionBy("video_id").orderBy(F.col("agreeing") / F.col("total"), "group")
    text = F.concat(F.lit("group"), "group", F.lit(" "), "agreeing", F.lit("/"), "total")
    rows = agreement.withColumn("n", F.row_number().over(order))
    low = F.array_sort(F.collect_list(F.when(F.col("n") <= lowest, F.struct("n", text.alias("t")))))
    return rows.groupBy("video_id").agg(F.sum("total").alias("total"), F.sum("agreeing").alias("agreeing"), F.array_join(F.transform(low, lambda x: x["t"]), ", ").alias("lowest"))
