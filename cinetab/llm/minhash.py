"""MinHash near-duplicate detection by a forest of sorted signature orders.

Every distinct shingle set gets one signature of 128 minimum hashes. A tree of the forest sorts all
signatures from another starting value on. In each order the length of the common prefix of neighbours is
computed, and a row's candidates are the neighbours with its longest common prefix. So the depth at which
rows meet follows from the region: where signatures are sparse, ``min_depth`` values are enough; where
thousands crowd together, only those with far longer prefixes meet, one or two a row. A row's key in a
tree is half of its signature, so that neighbours are compared where they stand, without a join; those
whose keys agree enough are confirmed on the full shingle sets.

These neighbours connect most of each crowd with few comparisons. Then the search goes back up the trees:
in every region of ``min_depth`` values whose rows are of different components, all rows of different
components meet, in blocks of bounded size. Those whose whole signatures agree enough are confirmed on
full sets: the best of each row and component first, then, of those still apart, all, where a block of
one component's sets and the rows to try against it stand together. Nothing is left out by rank or count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .shared import LOWERED, Words, binaries, free_name, materialize, mix64, ngram_hashes, operator, passes

#: Minimum hashes of a signature, two bytes each; a tree starts STRIDE values after the one before and holds WINDOW.
VALUES, STRIDE, WINDOW = 128, 8, 64
TREES = VALUES // STRIDE
#: Values that rows of a region share; four of two bytes make 64 bits, so rows rarely meet by chance.
MIN_DEPTH = 4
#: Rows of a block, shingles of a block of sets, and pairs that one numpy pass compares.
BLOCK, VOLUME, PAIRS = 2048, 2_000_000, 50_000
_MULTIPLIERS = np.random.default_rng(20_240).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle, no words none."""
    grams = ngram_hashes(words.hashes, size)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(ngram_hashes(words.hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_key); the key tells rows apart that repeat an id with another text."""
    text = F.col(text_col).cast("string")
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def signatures(texts: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, signature) of ``keyed`` rows; set_a and set_b name the set by 128 bits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in passes(batch.column(1)):
                sets = shingle_sets(Words(data, bounds, LOWERED), size)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                signature = np.zeros((len(sets), VALUES), np.uint16)
                names = np.zeros((2, len(sets)), np.uint64)
                if len(full):
                    joined = np.concatenate([sets[i] for i in full])
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    for k, m in enumerate(_MULTIPLIERS):
                        signature[full, k] = (mix64(np.minimum.reduceat(joined * m, starts)) & np.uint64(0xFFFF)).astype(np.uint16)
                    names[0, full] = np.add.reduceat(mix64(joined + np.uint64(11)), starts)
                    names[1, full] = np.add.reduceat(mix64(joined + np.uint64(12)), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(2).slice(row, end - row), pa.array(sizes.astype(np.int64)),
                     pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)), binaries(list(signature))],
                    ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "signature"],
                )

    return texts.select("doc_id", "text", "text_key").mapInArrow(
        work, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, signature binary"
    )


def least_agreement(percent: int, values: int = WINDOW, deviations: int = 3) -> int:
    """Of ``values``, those that must agree: so many standard deviations fewer than sets that are ``percent`` similar have on average."""
    similar = percent / 100
    return max(0, int(values * similar - deviations * (values * similar * (1 - similar)) ** 0.5))


def _values(column: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, count)


def forest_candidates(signed: DataFrame, agreement: int, trees: int = TREES, min_depth: int = MIN_DEPTH) -> DataFrame:
    """Distinct pairs (a < b) of neighbours in one tree whose common prefix is the longest that one of them has there.

    ``signed``: (id, signature). The prefix has ``min_depth`` values at least, and of the tree's WINDOW values
    ``agreement`` are equal. Each order is one global sort by range, which cuts hot regions anywhere; rows on
    both sides of a cut are neighbours in the other trees. A row is in two pairs of a tree at most, so pairs
    grow with the rows and not with a region's square.
    """
    key = F.expr(f"substring(concat(signature, signature), tree * {2 * STRIDE} + 1, {2 * WINDOW})")
    rows = signed.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))).select("tree", key.alias("key"), "id")
    parts = max(1, int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    def pairs(ids: np.ndarray, same: np.ndarray, common: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
        """Of the neighbours (k, k + 1) those that are near; ``depth``: each row's longest common prefix with a neighbour."""
        lo = np.flatnonzero((common >= min_depth) & ((common == depth[:-1]) | (common == depth[1:])))
        lo = lo[same[lo].sum(axis=1) >= agreement]
        a, b = ids[lo], ids[lo + 1]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last two rows wait for the next batch: how deep the last one goes is not known before.
        tree, keys, ids = np.zeros(0, np.int32), np.zeros((0, WINDOW), np.uint16), np.zeros(0, np.int64)
        above = 0  # common prefix of the first row here with the one before it
        for batch in _and_none(batches):
            if batch is not None:
                if not batch.num_rows:
                    continue
                tree = np.concatenate([tree, batch.column(0).to_numpy()])
                keys = np.concatenate([keys, _values(batch.column(1), WINDOW)])
                ids = np.concatenate([ids, batch.column(2).to_numpy()])
            if len(ids) < 2:
                continue
            same = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
            common = np.where(same.all(axis=1), WINDOW, (~same).argmax(axis=1))
            depth = np.maximum(np.concatenate([[above], common]), np.concatenate([common, [0]]))
            done = len(common) if batch is None else len(common) - 1
            yield pairs(ids[: done + 1], same[:done], common[:done], depth[: done + 1])
            if done:
                above = common[done - 1]
            tree, keys, ids = tree[done:], keys[done:], ids[done:]

    return rows.mapInArrow(neighbours, "a long, b long").where("a <> b").distinct()


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def apart_candidates(signed: DataFrame, agreement: int, block: int = BLOCK) -> DataFrame:
    """(right, right_part, part, home, lefts, agree, best) of all rows that may be near a row of another part.

    ``signed``: (id, signature, part, home); ``home`` is the block of sets of its part that a row is in. ``lefts``
    are rows of ``part`` in ``home`` that share a region of MIN_DEPTH values and ``agreement`` values or more with
    ``right``; ``best`` is one that shares most. A pair comes once, in the first region that it shares. Regions of
    one part have no pair and are left out. In the others the rows outside the largest part meet all rows:
    both sides are dealt into blocks of about ``block`` rows by a hash, every block of one with every block of
    the other, so a hot region is shared by many tasks. Rows sent and returned grow with the rows of a region and
    of its blocks, not with the square of a crowd.
    """

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _values(batch.column(1), VALUES)
                starts = np.concatenate([values, values[:, :MIN_DEPTH]], axis=1)
                prefix = np.stack([np.ascontiguousarray(starts[:, t * STRIDE : t * STRIDE + MIN_DEPTH]).view(np.int64)[:, 0] for t in range(TREES)], axis=1)
                columns = [np.repeat(batch.column(k).to_numpy(), TREES) for k in (0, 2, 3)]
                tree = np.tile(np.arange(TREES, dtype=np.int32), len(values))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tree, prefix.ravel(), *columns)], ["tree", "prefix", "id", "part", "home"])

    region = ["tree", "prefix"]
    rows = signed.select("id", "signature", "part", "home").mapInArrow(regions, "tree int, prefix long, id long, part long, home int")
    mixed = rows.groupBy(*region).agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select(*region)
    rows = materialize(rows.join(mixed, region), "regions")
    counts = rows.groupBy(*region, "part").agg(F.count("*").alias("n")).groupBy(*region).agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    counts = counts.select(*region, F.col("top.part").alias("largest"), blocks(F.col("n")).alias("lefts"), blocks(F.col("n") - F.col("top.n")).alias("rights"))
    dealt = rows.join(counts, region).withColumn("common", F.col("part") == F.col("largest"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [F.col(x) for x in ("common", "id", "part", "home")]
    left = dealt.select(*region, own("lefts").alias("i"), each("rights").alias("j"), F.lit(False).alias("right"), *columns)
    right = dealt.where("not common").select(*region, each("lefts").alias("i"), own("rights").alias("j"), F.lit(True).alias("right"), *columns)
    sides = left.union(right).join(signed.select("id", "signature"), "id").select(*region, "i", "j", "right", "common", "id", "part", "home", "signature")
    sides = sides.repartition(*region, "i", "j").sortWithinPartitions(*region, "i", "j", "right", "id")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in _and_none(batches):
            now = None
            if batch is not None:
                if not batch.num_rows:
                    continue
                now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(9)] + [_values(batch.column(9), VALUES)]
            if held is not None:
                now = held if now is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            if now is None:
                continue
            change = np.zeros(len(now[0]) - 1, bool)
            for x in now[:4]:
                change |= x[1:] != x[:-1]
            starts = np.flatnonzero(np.concatenate([[True], change]))
            done = len(now[0]) if batch is None else starts[-1]
            held = [x[done:] for x in now]
            yield from _compared([x[:done] for x in now], starts[starts < done], agreement)

    return sides.mapInArrow(meet, "right long, right_part long, part long, home int, lefts array<long>, agree int, best long")


def _compared(rows: list[np.ndarray], starts: np.ndarray, agreement: int) -> Iterator[pa.RecordBatch]:
    """The candidates in whole blocks; ``rows`` are sorted by block, in each the left rows first, and begin at ``starts``."""
    tree, _, _, _, right, common, ids, part, home, signature = rows
    at = np.flatnonzero(right)
    if not len(at):
        return
    block = np.searchsorted(starts, at, "right") - 1
    first = starts[block]
    before = np.concatenate([[0], np.cumsum(right)])
    ends = np.concatenate([starts[1:], [len(right)]])
    n_left = (ends - starts - (before[ends] - before[starts]))[block]
    total = np.cumsum(n_left)
    k = 0
    while k < len(at):
        end = max(k + 1, int(np.searchsorted(total, total[k] - n_left[k] + PAIRS, "right")))
        n = n_left[k:end]
        b = np.repeat(at[k:end], n)
        a = np.arange(len(b)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[k:end], n)
        k = end
        # Of two rows outside the largest part, each meets the other; one meeting counts.
        pair = (part[a] != part[b]) & (common[a] | (ids[a] < ids[b]))
        a, b = a[pair], b[pair]
        same = signature[a] == signature[b]
        agree = same.sum(axis=1)
        pair = agree >= agreement
        a, b, agree, same = a[pair], b[pair], agree[pair], same[pair]
        shared = np.stack([same[:, t * STRIDE : t * STRIDE + MIN_DEPTH].all(axis=1) for t in range(TREES)], axis=1) if len(a) else np.zeros((0, 1), bool)
        pair = shared.argmax(axis=1) == tree[b]
        a, b, agree = a[pair], b[pair], agree[pair]
        if not len(a):
            continue
        order = np.lexsort((-agree, home[a], part[a], b))
        a, b, agree = a[order], b[order], agree[order]
        head = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (part[a[1:]] != part[a[:-1]]) | (home[a[1:]] != home[a[:-1]])]))
        lefts = pa.ListArray.from_arrays(pa.array(np.append(head, len(a)).astype(np.int32)), pa.array(ids[a]))
        x, y = a[head], b[head]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[y]), pa.array(part[y]), pa.array(part[x]), pa.array(home[x]), lefts, pa.array(agree[head].astype(np.int32)), pa.array(ids[x])],
            ["right", "right_part", "part", "home", "lefts", "agree", "best"],
        )


def set_table(wanted: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(id, set) of ``wanted`` (id, first_id, text_key): the sorted shingle hashes, as bytes, from ``keyed`` texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in passes(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), binaries(shingle_sets(Words(data, bounds, LOWERED), size))], ["id", "set"])

    # Always a merge join: whether the ids would fit in a broadcast must not change the plan with the size.
    key = ["doc_id", "text_key"]
    rows = texts.join(wanted.withColumnRenamed("first_id", "doc_id").hint("merge"), key).dropDuplicates(key)
    return materialize(rows.select("id", "text").mapInArrow(work, "id long, set binary"), "shingle-sets")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= ``percent`` * union of two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirm(pairs: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) whose full shingle sets are similar; ``sets``: (id, first_id, text_key)."""
    names = pairs.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in both), percent)
                for both in zip(batch.column(len(names)), batch.column(len(names) + 1), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep, pa.bool_())) for x in batch.columns[:-2]], names)

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    full = set_table(sets.select("id", "first_id", "text_key").join(wanted, "id"), texts, size)
    left = full.select(F.col("id").alias("a"), F.col("set").alias("left_set"))
    right = full.select(F.col("id").alias("b"), F.col("set").alias("right_set"))
    both = pairs.join(left, "a").join(right, "b").select(*names, "left_set", "right_set")
    return both.mapInArrow(compare, ", ".join(f"{n} {t}" for n, t in pairs.dtypes))


def confirm_blocks(rest: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b) of parts with a link, for ``rest`` (right, right_part, part, home, lefts).

    Every block of a part's sets is sent once and held by one task; the rows to try against it come there, so
    sets move once a block and not once a pair. ``sets``: (id, first_id, text_key, part, home).
    """
    block = ["part", "home"]
    tries = rest.groupBy("right", "right_part", *block).agg(F.flatten(F.collect_list("lefts")).alias("lefts"))
    tries = materialize(tries, "tries")
    held = sets.join(tries.select(*block).distinct(), block).select("id", *block)
    held = materialize(held, "held")
    wanted = held.select("id").union(tries.select("right")).distinct()
    full = set_table(sets.select("id", "first_id", "text_key").join(wanted, "id"), texts, size)
    none = F.lit(None)
    sides = held.join(full, "id").select(*block, F.lit(0).alias("side"), "id", none.cast("long").alias("right_part"), none.cast("array<long>").alias("lefts"), "set")
    sides = sides.union(tries.join(full, tries["right"] == full["id"]).select(*block, F.lit(1).alias("side"), "right", "right_part", "lefts", "set"))
    sides = sides.repartition(*block).sortWithinPartitions(*block, "side", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[int, int] | None = None
        known: dict[int, np.ndarray] = {}
        linked: set[int] = set()
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = (batch.column(k).to_pylist() for k in range(6))
            for part, home, side, one, right_part, lefts, whole in zip(*columns, batch.column(6), strict=True):
                if here != (part, home):
                    here, known, linked = (part, home), {}, set()
                shingles = np.frombuffer(whole.as_buffer(), np.uint64)
                if side == 0:
                    known[one] = shingles
                # One link joins two parts: what follows of the same two need not be tried.
                elif right_part not in linked and any(similar(known[x], shingles, percent) for x in lefts):
                    linked.add(right_part)
                    found.append((right_part, part))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return sides.mapInArrow(work, "a long, b long")


@operator
def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, size: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, first) for every row of ``documents``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of whole texts with A-Z lower-cased. Two sets are linked at
    100 * intersection >= ``percent`` * union. Texts with the same set share one signature, so groups of
    copies cost one row each in the forest. ``text_key`` is a hash of the text; ``first`` is true for the
    rows with the set that stands for its component: of the smallest id, one set. A very long text is one set of all its
    shingles, which the task that compares it holds.

    Null or blank texts: no shingles, a component of their own. Null ids: component null, kept.
    Rows that repeat an id: each is judged by its own text, under that id. Empty table: empty result.
    Columns other than id and text are not read.
    """
    texts = keyed(documents, id_col, text_col)
    signed = materialize(signatures(texts, size), "signatures")
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc_id", "text_key")).alias("one"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n_shingles")
    )
    # Written once, so that the numbers by which the sets are named stay.
    sets = materialize(
        sets.select(F.monotonically_increasing_id().alias("id"), "set_a", "set_b", F.col("one.doc_id").alias("first_id"), "one.text_key", "signature", "n_shingles"), "sets"
    )
    pairs = materialize(forest_candidates(sets, least_agreement(percent)), "candidates")
    first = connected_components(materialize(confirm(pairs, sets, texts, percent, size), "links"))
    apart = sets.join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    blocks = apart.groupBy("part").agg(F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("n_shingles") / F.lit(VOLUME))).cast("int").alias("blocks"))
    apart = apart.join(blocks.where("blocks > 1"), "part", "left").withColumn("home", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    apart = materialize(apart.select("id", "set_a", "set_b", "first_id", "text_key", "signature", "part", "home"), "apart")

    tries = materialize(apart_candidates(apart, least_agreement(percent, VALUES, 4)), "candidates")
    # One link joins a row with a part: try the best pair of each first, then all pairs that are still apart.
    best = tries.groupBy("right", "right_part", "part").agg(F.max(F.struct("agree", "best")).alias("b"))
    best = best.select(F.col("right").alias("a"), F.col("b.best").alias("b"), "right_part", "part")
    edges = materialize(confirm(materialize(best, "best"), apart, texts, percent, size).select(F.col("right_part").alias("a"), F.col("part").alias("b")), "links")
    parts = connected_components(edges)
    of = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    rest = tries.join(of("right_part"), "right_part", "left").join(of("part"), "part", "left")
    rest = rest.where(F.coalesce("of_right_part", "right_part") != F.coalesce("of_part", "part")).select("right", "right_part", "part", "home", "lefts")
    parts = connected_components(edges.union(confirm_blocks(rest, apart, texts, percent, size)))

    named = apart.join(parts.withColumnRenamed("node", "part"), "part", "left").select("set_a", "set_b", "first_id", F.coalesce("component", "part").alias("class"))
    named = materialize(named, "named")
    least = named.groupBy("class").agg(F.min(F.struct("first_id", "set_a", "set_b")).alias("least"))
    classes = named.join(least, "class").select(
        "set_a", "set_b", F.col("least.first_id").alias("component"), ((F.col("set_a") == F.col("least.set_a")) & (F.col("set_b") == F.col("least.set_b"))).alias("stands")
    )
    out = signed.select("doc_id", "text_key", "n_shingles", "set_a", "set_b").join(materialize(classes, "classes"), ["set_a", "set_b"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_key", (kept & (alone | F.col("stands"))).alias("first"))


def drop_near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that stand for their group of near duplicates, with all columns: one row a group.

    That is the row of the smallest id; of rows that repeat it with different near texts, one text, and of rows that
    repeat id and text, one row. Rows without an id or without words all stay.
    """
    judged = near_duplicates(documents, id_col, text_col, **options)
    key = ["doc_id", "text_key"]
    seen = judged.where("doc_id is not null").groupBy(*key).agg(F.count("*").alias("n"), F.min("first").alias("first"), F.min("n_shingles").alias("words"))
    several = materialize(seen.where("first and n > 1 and words > 0").select(*key), "repeated")
    gone = materialize(seen.where("not first").select(*key).union(several), "duplicates")
    # The key columns get names that the table does not have.
    at, name = (free_name(documents, x) for x in ("id", "key"))
    both = documents.withColumns({at: F.col(id_col).cast("long"), name: F.xxhash64(F.col(text_col).cast("string"))})
    same = lambda rows: (both[at] == rows["doc_id"]) & (both[name] == rows["text_key"])
    out = both.join(gone, same(gone), "left_anti")
    if several.limit(1).count():
        out = out.union(both.join(several, same(several), "left_semi").dropDuplicates([at, name]))
    return out.drop(at, name)

