"""Exact top-k by inner product: ball trees over shards, searched best bound first with a shared k-th score.

Vectors are scaled to whole numbers and dealt into shards by row. Each shard is a ball tree, built once: a node keeps
centre and radius, so no vector below it has an inner product with q above q.centre + |q| * radius. A task holds the trees
of one stripe of shards and takes queries in blocks; a block goes down a tree by a queue of nodes, the largest bound first,
and a node is left out for the queries whose k-th score it cannot reach. The k-th score is carried from shard to
shard; a first round searches one stripe for each query, and its k-th scores start the search of all others.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, operator

#: Vectors a shard and shards a stripe: a task holds some 8 MB of trees at 64 components.
SHARD = 2_048
STRIPE = 8
#: Queries that meet a stripe in one task, and those that are searched together.
GROUP = 2_048
BLOCK = 512
LEAF = 48
SCALE = 1024
#: Components beyond this are taken as this, scores beyond a long as the nearest long.
LARGEST = 1e300
LONG = (1 << 63) - 1


def scaled_rows(vectors: DataFrame, queries: Column, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, query, dim, x): floor(SCALE * component) of each usable vector, as 4-byte integers or 8-byte doubles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            lists = batch.column(2)
            cuts = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            usable = np.isfinite(flat)
            bad = np.concatenate([[0], np.cumsum(~usable)])
            fine = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (bad[cuts[1:]] == bad[cuts[:-1]]))
            whole = np.floor(np.clip(np.where(usable, flat, 0), -LARGEST, LARGEST) * SCALE)
            parts = [whole[cuts[i] : cuts[i + 1]] for i in fine]
            out = [(x.astype("<i4") if not len(x) or np.abs(x).max() < 1 << 31 else x).tobytes() for x in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(len(fine))), batch.column(0).take(pa.array(fine)), batch.column(1).take(pa.array(fine)),
                    pa.array([len(x) for x in parts], pa.int32()), pa.array(out, pa.binary()),
                ], ["row", "id", "query", "dim", "x"],
            )
            row += len(fine)

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("query"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(work, "row long, id long, query boolean, dim int, x binary")


def matrix(parts: list[bytes], dim: int) -> np.ndarray:
    """The vectors of ``dim`` components that ``scaled_rows`` has written."""
    if dim == 0:
        return np.zeros((len(parts), 0))
    return np.stack([np.frombuffer(x, "<i4" if len(x) == 4 * dim else "<f8") for x in parts]).astype(float)


class BallTree:
    """Vectors in the order of a tree: node j holds those from ``nodes[j][0]`` up to ``nodes[j][1]``, its children are ``nodes[j][2]`` and the next."""

    def __init__(self, *parts: np.ndarray):
        self.x, self.ids, self.known, self.rows, self.nodes, self.centres, self.radii = parts

    @classmethod
    def build(cls, x: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray) -> BallTree:
        order, nodes, centres, radii = np.arange(len(x)), [[0, len(x), -1]], [], []
        for node in nodes:  # grows as nodes are split
            start, end, _ = node
            some = x[order[start:end]]
            with np.errstate(over="ignore", invalid="ignore"):
                centre = some.mean(0)
                far = np.nan_to_num(np.sqrt(((some - centre) ** 2).sum(1)), nan=np.inf)
                radius = far.max()
                if end - start > LEAF and 0 < radius < np.inf:
                    one = some[far.argmax()]
                    other = some[((some - one) ** 2).sum(1).argmax()]
                    half = (end - start) // 2
                    order[start:end] = order[start:end][np.argpartition(some @ (other - one), half)]
                    node[2] = len(nodes)
                    nodes += [[start, start + half, -1], [start + half, end, -1]]
            centres.append(centre)
            radii.append(radius)
        return cls(x[order], ids[order], known[order], rows[order], np.array(nodes), np.array(centres), np.array(radii))

    def dump(self) -> bytes:
        out = io.BytesIO()
        x = self.x.astype("<i4") if np.abs(self.x).max(initial=0) < 1 << 31 else self.x
        for part in (x, self.ids, self.known, self.rows, self.nodes, self.centres, self.radii):
            np.save(out, part, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BallTree:
        file = io.BytesIO(data)
        x, *rest = (np.load(file, allow_pickle=False) for _ in range(7))
        return cls(x.astype(float), *rest)

    def bounds(self, node: int, q: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """What no inner product of a vector below ``node`` exceeds, with room for rounding."""
        n = min(q.shape[1], self.centres.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            centre = self.centres[node]
            room = 1e-9 * norms * (np.sqrt((centre**2).sum()) + self.radii[node]) + 1
            return np.nan_to_num(q[:, :n] @ centre[:n] + norms * self.radii[node] + room, nan=np.inf)


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as longs; the shorter side counts as zero beyond its end."""
    n = min(q.shape[1], x.shape[1])
    q, x = q[:, :n], x[:, :n]
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * n < 1 << 53:
        return (q @ x.T).astype(np.int64)  # every partial sum is a whole number that a double holds
    whole = lambda a: np.array([[int(v) for v in row] for row in a], object)
    return np.array([[max(-LONG, min(LONG, v)) for v in row] for row in whole(q) @ whole(x).T], np.int64)


class Best:
    """The k best vectors of each query so far, and the score that a further one has to reach."""

    def __init__(self, rows: np.ndarray, floor: np.ndarray, k: int):
        shape = (len(rows), k)
        self.own, self.floor, self.k = rows, floor.copy(), k
        self.there, self.scores = np.zeros(shape, bool), np.zeros(shape, np.int64)
        self.ids, self.known, self.rows = np.zeros(shape, np.int64), np.zeros(shape, bool), np.zeros(shape, np.int64)

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray) -> None:
        """Scores of the queries ``which`` with some vectors; a query's own row does not count."""
        fits = (scores >= self.floor[which][:, None]) & (rows[None, :] != self.own[which][:, None])
        some = np.flatnonzero(fits.any(1))
        if not len(some):
            return
        at, wide = which[some], (len(some), len(ids))
        there = np.hstack([self.there[at], fits[some]])
        columns = [
            np.hstack([mine[at], np.broadcast_to(new, wide)])
            for mine, new in ((self.scores, scores[some]), (self.ids, ids), (self.known, known), (self.rows, rows))
        ]
        order = np.lexsort((columns[3], columns[1], ~columns[2], -columns[0], ~there), axis=1)[:, : self.k]
        take = lambda a: np.take_along_axis(a, order, 1)
        self.there[at] = take(there)
        self.scores[at], self.ids[at], self.known[at], self.rows[at] = map(take, columns)
        full = at[self.there[at].all(1)]
        self.floor[full] = self.scores[full, -1]


def search(tree: BallTree, q: np.ndarray, best: Best) -> int:
    """Offer to ``best`` what a tree has for the queries ``q``, the node with the largest bound first; the number of inner products taken."""
    with np.errstate(over="ignore"):
        norms = np.sqrt((q**2).sum(1))
    everyone = np.arange(len(q))
    bounds = tree.bounds(0, q, norms)
    queue, taken, no = [(-bounds.max(initial=-np.inf), 0, 0, everyone, bounds)], 0, 1
    while queue:
        _, _, node, which, bounds = heapq.heappop(queue)
        which = which[bounds >= best.floor[which]]
        if not len(which):
            continue
        start, end, left = tree.nodes[node]
        if left < 0:
            best.offer(which, inner(q[which], tree.x[start:end]), tree.ids[start:end], tree.known[start:end], tree.rows[start:end])
            taken += len(which) * (end - start)
            continue
        for child in (left, left + 1):
            below = tree.bounds(child, q[which], norms[which])
            reach = below >= best.floor[which]
            if reach.any():
                heapq.heappush(queue, (-below.max(), no, child, which[reach], below[reach]))
                no += 1
    return taken


def plant(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, tree): rows dealt evenly into some ``shards`` tasks; a tree has up to SHARD vectors of one length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = TaskContext.get().partitionId(), {}

        def tree(dim: int) -> pa.RecordBatch:
            row, ids, known, x = zip(*held.pop(dim), strict=True)
            grown = BallTree.build(matrix(x, dim), np.array(ids), np.array(known), np.array(row))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([grown.dump()], pa.binary())], ["shard", "tree"])

        total = 0
        for batch in batches:
            for row, one, dim, x in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held.setdefault(dim, []).append((row, 0 if one is None else one, one is not None, x))
                total += dim + 8
                if len(held[dim]) == SHARD or total > SHARD * 1024:
                    yield from (tree(d) for d in ([dim] if len(held[dim]) == SHARD else list(held)))
                    total = sum(d * len(v) for d, v in held.items())
        yield from (tree(dim) for dim in list(held))

    return rows.select("row", "id", "dim", "x").repartition(shards, "row").mapInArrow(work, "shard int, tree binary")


_FOUND = "query_row long, query_id long, row long, id long, score long"


def _meet(trees: DataFrame, queries: DataFrame, parts: int, k: int) -> DataFrame:
    """The k best of each query in each stripe that it is dealt to, of those that reach its floor.

    ``trees(stripe, team, tree)`` and ``queries(stripe, team, row, id, dim, x, floor)`` meet by (stripe, team of queries).
    """
    nothing = lambda kind: F.lit(None).cast(kind)
    both = trees.select("stripe", "team", F.lit(0).alias("kind"), nothing("int").alias("dim"), nothing("long").alias("row"), nothing("long").alias("id"), F.col("tree").alias("x"), nothing("long").alias("floor")).unionByName(
        queries.select("stripe", "team", F.lit(1).alias("kind"), "dim", "row", "id", "x", "floor")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, trees, block = None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            if block and trees:
                q = matrix([b[2] for b in block], here[2])
                best = Best(np.array([b[0] for b in block]), np.array([-LONG if b[3] is None else b[3] for b in block]), k)
                for tree in trees:
                    search(tree, q, best)
                at, place = np.nonzero(best.there)
                ids = pa.array(best.ids[at, place], mask=~best.known[at, place])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(best.own[at]), pa.array([b[1] for b in block], pa.int64()).take(pa.array(at)), pa.array(best.rows[at, place]), ids,
                        pa.array(best.scores[at, place]),
                    ], ["query_row", "query_id", "row", "id", "score"],
                )
            block.clear()

        for batch in batches:
            for stripe, team, kind, dim, row, one, x, floor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (stripe, team, dim) != here or len(block) == BLOCK:
                    yield from found()
                if kind == 0:
                    if here is None or here[:2] != (stripe, team):
                        trees = []
                    trees.append(BallTree.load(x))
                else:
                    if here is not None and here[:2] != (stripe, team):
                        trees = []
                    block.append((row, one, x, floor))
                here = (stripe, team, dim)
        yield from found()

    return both.repartition(parts, "stripe", "team").sortWithinPartitions("stripe", "team", "kind", "dim", "row").mapInArrow(work, _FOUND)


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order))


@operator
def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_row, query_id, rank, row, id, score): of each row that ``queries`` holds for, the k other rows with the largest inner products.

    Components are floor(1024 * x). ``row`` numbers the usable rows, so rows that repeat an id, or have none, are
    queries and candidates of their own. Ties go to the smaller id (null last), then row. Vectors that are null or hold a null
    or a non-finite component take no part; an empty vector scores 0, and the shorter of two vectors counts as zero beyond its
    end. Scores beyond a long are the nearest long. Fewer than k other rows are all returned; an empty table, or one
    without a query, gives no rows. Other columns are not read, whatever their names. A very long vector is held
    whole by the tasks that it reaches.
    """
    rows = materialize(scaled_rows(vectors, queries, id_col, vector_col), "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("query")).first()
    shards = max(1, -(-n // SHARD))
    stripes, teams = -(-shards // STRIPE), max(1, -(-asked // GROUP))
    trees = materialize(plant(rows, shards).select(F.pmod("shard", F.lit(stripes)).alias("stripe"), "tree"), "trees")
    numbers = lambda size: F.sequence(F.lit(0), F.lit(size - 1))
    first = F.pmod(F.col("team"), F.lit(stripes)) == F.col("stripe")
    dealt = trees.select("stripe", F.explode(numbers(teams)).alias("team"), "tree")
    query = rows.where("query").select(F.pmod(F.xxhash64("row"), F.lit(teams)).cast("int").alias("team"), "row", "id", "dim", "x")
    home = query.select(F.pmod("team", F.lit(stripes)).alias("stripe"), "*", F.lit(None).cast("long").alias("floor"))
    best = materialize(_meet(dealt.where(first), home, teams, k), "best")
    if stripes == 1:
        return _ranked(best).select("query_row", "query_id", "rank", "row", "id", "score")
    floors = best.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor")).withColumnRenamed("query_row", "row")
    others = query.join(floors, "row", "left").select(F.explode(numbers(stripes)).alias("stripe"), "*").where(~first)
    rest = materialize(_meet(dealt.where(~first), others, teams * (stripes - 1), k), "rest")
    return _ranked(best.unionByName(rest)).where(F.col("rank") <= k).select("query_row", "query_id", "rank", "row", "id", "score")
