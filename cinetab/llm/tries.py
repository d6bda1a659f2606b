"""A prefix trie of rebuilt conversations from composable fingerprints, without building the conversations.

Fingerprints form a monoid: a run of turns has (product, length), and the product of two runs after one another is
``first * M**length(second) + second`` modulo 2**64, in two lanes. A rebuilt conversation is a head of its base and a tail of
its own turns, so each of its prefixes has the product of the own prefix plus a constant of the conversation times a power
of M. Rows carry a reference (conversation, place) to the stored turn that ends the prefix; no text is built or moved with it.
Products of long conversations are composed from those of the ranges of rows that tasks hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, operator

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WRAP = 1 << 64
INVERSES = tuple(pow(m, -1, WRAP) for m in MULTIPLIERS)
#: Depths of one conversation that a window holds.
DEPTHS = 4_096


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** n modulo 2**64."""
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** each exponent modulo 2**64, by squaring."""
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.astype(np.int64)
    while left.any():
        out = np.where(left & 1, out * np.uint64(square), out)
        square, left = square * square % WRAP, left >> 1
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def stored_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, seed: int) -> DataFrame:
    """(conv_id, turn, role, text, m1, m2): the two lanes of each turn's fingerprint, the first 16 bytes of a SHA-256."""
    said = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.length("role"), F.concat("role", "text")), 256)
    lane = lambda a, b: F.conv(F.substr(digest, F.lit(a), F.lit(b)), 16, -10).cast("long")
    return said.withColumns({"m1": lane(1, 16), "m2": lane(17, 16)})


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)


def _products(keys: np.ndarray, lanes: list[np.ndarray], carry: tuple[int, int, int, int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and prefix products of the turns in each run of one conversation; ``carry``: (conversation, place, lane, lane) before the first."""
    starts = _runs(keys)
    run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    place = np.arange(1, len(keys) + 1) - starts[run]
    follows = (keys == keys[0]) & (run == 0) & (carry[0] == keys[0])
    out = []
    for lane, m, inverse, before in zip(lanes, MULTIPLIERS, INVERSES, carry[2:], strict=True):
        total = np.concatenate([[np.uint64(0)], np.cumsum(lane * _powers(inverse, len(keys))[1:])])
        power = _powers(m, len(keys))
        own = (total[1:] - total[starts[run]]) * power[np.arange(1, len(keys) + 1)]
        out.append(own + np.where(follows, np.uint64(before) * power[place], np.uint64(0)))
    return place + np.where(follows, carry[1], 0), out


def prefix_products(turns: DataFrame, parts: int) -> DataFrame:
    """(conv_id, place, p1, p2, m1, m2, chars): every turn's place in its conversation and the product of the turns up to it.

    Sorted by ranges of (conversation, turn), so that a long conversation is spread over tasks. Each task numbers its rows and
    multiplies them from 1; what the last row of each task holds (one row a task) is then composed for those after it.
    """
    small = turns.select("conv_id", "turn", "m1", "m2", F.char_length("text").alias("chars"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry, waiting = TaskContext.get().partitionId(), (None, 0, 0, 0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                yield waiting
            keys = batch.column(0).to_numpy()
            place, lanes = _products(keys, [_unsigned(batch.column(i)) for i in (2, 3)], carry)
            carry = (int(keys[-1]), int(place[-1]), int(lanes[0][-1]), int(lanes[1][-1]))
            last = np.zeros(len(keys), bool)
            waiting = pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), part, np.int32)), batch.column(0), pa.array(place), *map(_signed, lanes), *(batch.column(i) for i in (2, 3, 4)), pa.array(last)],
                ["part", "conv_id", "place", "p1", "p2", "m1", "m2", "chars", "last"],
            )
        if waiting is not None:
            last[-1] = True
            yield waiting.set_column(8, "last", pa.array(last))

    kinds = "conv_id long, place long, p1 long, p2 long, m1 long, m2 long, chars int"
    order = ["conv_id", "turn", "m1", "m2"]
    local = materialize(small.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(work, f"part int, {kinds}, last boolean"), "products")
    before: dict[int, tuple[int, int, int, int]] = {}
    held = (None, 0, 0, 0)
    for r in local.where("last").orderBy("part").collect():  # one row a task
        before[r.part] = held
        lanes = [r.p1 % WRAP, r.p2 % WRAP]
        # The last row's conversation continues from the tasks before only if it began there, that is if it is the task's only one.
        held = (r.conv_id, r.place, *lanes) if held[0] != r.conv_id else (
            r.conv_id, held[1] + r.place, *((h * pow(m, r.place, WRAP) + p) % WRAP for h, m, p in zip(held[2:], MULTIPLIERS, lanes, strict=True)))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, keys, place = (batch.column(i).to_numpy() for i in range(3))
            lanes, place = [_unsigned(batch.column(i)).copy() for i in (3, 4)], place.copy()
            for p in np.unique(part):
                conv, n, *products = before[int(p)]
                if conv is None:
                    continue
                at = np.flatnonzero((part == p) & (keys == conv))
                if len(at):
                    for lane, m, product in zip(lanes, MULTIPLIERS, products, strict=True):
                        lane[at] += np.uint64(product) * _power(m, place[at])
                    place[at] += n
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(place), *map(_signed, lanes), *(batch.column(i) for i in (5, 6, 7))], ["conv_id", "place", "p1", "p2", "m1", "m2", "chars"])

    return local.drop("last").mapInArrow(compose, kinds)


def rebuilt_prefixes(products: DataFrame, base: Column, head: Column, longest_head: int) -> DataFrame:
    """A row for each rebuilt conversation and depth, the root's 0 included.

    (conv_id, depth, f1, f2: the prefix; g1, g2: the prefix one turn shorter; m1, m2, chars, ref_conv, ref_place: its last
    turn, by the place where it is stored; ends: whether the conversation ends here).
    """
    turn = F.struct("place", "p1", "p2", "m1", "m2", "chars")
    convs = products.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("place") <= longest_head, turn))).alias("first"))
    heads = convs.select(F.col("conv_id").alias("base_id"), F.col("first").alias("base_first"))
    joined = convs.select("conv_id", "n", "first", base.cast("long").alias("base_id"), head.cast("int").alias("h")).join(heads, "base_id", "left")
    joined = joined.withColumn("used", F.slice(F.coalesce("base_first", F.slice("first", 1, 0)), F.lit(1), F.col("h")))
    lane = lambda array, at, name: F.coalesce(F.get(array, at)[name], F.lit(0))
    tail = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = materialize(
        joined.select(
            "conv_id", "h", "base_id", "used", F.size("used").alias("hl"), (F.size("used") + tail).alias("length"),
            *(lane(F.col("used"), F.size("used") - 1, p).alias(f"b{p[1]}") for p in ("p1", "p2")), *(lane(F.col("first"), F.col("h") - 1, p).alias(f"o{p[1]}") for p in ("p1", "p2")),
        ), "plan",
    )
    zero = lambda *names: (F.lit(0).cast("long").alias(x) for x in names)
    root = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", *zero("steps", "p1", "p2", "b1", "b2", "o1", "o2", "m1", "m2"), F.lit(0).alias("chars"), *(F.lit(None).cast("long").alias(x) for x in ("ref_conv", "ref_place")))
    shared = plan.select("conv_id", "base_id", "length", F.explode("used").alias("t")).select(
        "conv_id", F.col("t.place").alias("depth"), "length", *zero("steps"), "t.p1", "t.p2", *zero("b1", "b2", "o1", "o2"), "t.m1", "t.m2", "t.chars", F.col("base_id").alias("ref_conv"), F.col("t.place").alias("ref_place"),
    )
    own = products.join(plan.drop("used"), "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("hl")).alias("depth"), "length", (F.col("place") - F.col("h")).alias("steps"), "p1", "p2", "b1", "b2", "o1", "o2", "m1", "m2", "chars", F.col("conv_id").alias("ref_conv"), F.col("place").alias("ref_place"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            steps, prefix, shorter = column["steps"].to_numpy(), [], []
            for lane, m, inverse in zip("12", MULTIPLIERS, INVERSES, strict=True):
                p, b, o, t = (_unsigned(column[x + lane]) for x in "pbom")
                prefix.append(p + (b - o) * _power(m, steps))
                shorter.append((prefix[-1] - t) * np.uint64(inverse))
            ends = pa.array(column["depth"].to_numpy() == column["length"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [column["conv_id"], column["depth"], *map(_signed, prefix + shorter), *(column[x] for x in ("m1", "m2", "chars", "ref_conv", "ref_place")), ends],
                ["conv_id", "depth", "f1", "f2", "g1", "g2", "m1", "m2", "chars", "ref_conv", "ref_place", "ends"],
            )

    rows = root.unionByName(shared).unionByName(own)
    return rows.mapInArrow(work, "conv_id long, depth long, f1 long, f2 long, g1 long, g2 long, m1 long, m2 long, chars int, ref_conv long, ref_place long, ends boolean")


def end_hashes(ends: DataFrame, parts: int) -> DataFrame:
    """(depth, f1, f2, ends_sha256): the SHA-256 of the ascending decimal ids of each key, comma-joined.

    Ranges of (key, id) join their ids to one text a batch; these are fed to the hash in order. A hash is one
    chain, so a key's texts meet in one task, which holds one of them at a time.
    """
    key = ["depth", "f1", "f2"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(4)]
            change = np.zeros(batch.num_rows, bool)
            for c in columns[:3]:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(np.concatenate([[True], change[1:]]))
            cuts = [*starts, batch.num_rows]
            texts = [",".join(map(str, columns[3][a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[starts]) for c in columns), pa.array(texts)], [*key, "first", "ids"])

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = running = None
        for batch in batches:
            done = []
            for *at, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == here:
                    running.update(b",")
                else:
                    if here is not None:
                        done.append((*here, running.hexdigest()))
                    here, running = at, hashlib.sha256()
                running.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*key, "ends_sha256"])
        if here is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*here, running.hexdigest())], [*key, "ends_sha256"])

    rows = ends.select(*key, "conv_id").repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    texts = rows.mapInArrow(join, "depth long, f1 long, f2 long, first long, ids string")
    return texts.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(feed, "depth long, f1 long, f2 long, ends_sha256 string")


def chain_totals(chains: DataFrame) -> DataFrame:
    """(conv_id, leaves, saved): the sums of ``chains(conv_id, above, leaves, saved)`` over each chain and all that hang below it.

    Ancestors are followed by doubling: after round k a chain has the sums of all less than 2**k below it.
    """
    now = materialize(chains.select("conv_id", F.col("above").alias("up"), "leaves", "saved"), "chains")
    while now.where("up IS NOT NULL").limit(1).count():
        given = now.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = now.select(F.col("conv_id").alias("up"), F.col("up").alias("up_up"))
        more = lambda x: (F.col(x) + F.coalesce(f"more_{x}", F.lit(0))).alias(x)
        now = materialize(now.join(given, "conv_id", "left").join(further, "up", "left").select("conv_id", F.col("up_up").alias("up"), more("leaves"), more("saved")), "chains")
    return now.drop("up")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with n_leaves and saved_tokens over their subtrees, from (conv_id, depth, parent_conv_id, leaf, saving).

    The nodes named by one conversation are one chain of depths, which hangs on a node of another: totals of
    chains first, then sums from the end of each chain up, in blocks of depths.
    """
    chains = materialize(
        nodes.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"), F.min_by("parent_conv_id", "depth").alias("above"), (F.min("depth") - 1).alias("at")), "chains"
    )
    totals = chain_totals(chains)
    hung = chains.where("above IS NOT NULL").select("conv_id", "above", "at").join(totals, "conv_id").groupBy(F.col("above").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    full = materialize(
        nodes.join(hung, ["conv_id", "depth"], "left").withColumns({
            "leaf": F.col("leaf") + F.coalesce("hung_leaves", F.lit(0)), "saving": F.col("saving") + F.coalesce("hung_saved", F.lit(0)), "block": F.floor(F.col("depth") / DEPTHS),
        }).drop("hung_leaves", "hung_saved"), "nodes",
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = full.groupBy("conv_id", "block").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    blocks = blocks.select("conv_id", "block", F.sum("leaf").over(later).alias("later_leaves"), F.sum("saving").over(later).alias("later_saved"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda one, rest: F.sum(one).over(inside) + F.coalesce(rest, F.lit(0))
    return full.join(blocks, ["conv_id", "block"]).withColumns({"n_leaves": total("leaf", "later_leaves"), "saved_tokens": total("saving", "later_saved")})


@operator
def prefix_trie(
    turns: DataFrame, base: Column | None = None, head: Column | None = None, longest_head: int = 5,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The trie of all rebuilt conversations: a row for each distinct sequence of first turns, from the textless root.

    Conversation c is rebuilt from the first ``head`` turns of conversation ``base`` (all if fewer, none if it is absent) and its own
    turns after the first ``head``; both are expressions of ``conv_id``, and no head exceeds ``longest_head``. Returns conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and turn_conv, turn_place: where the node's last turn is
    stored (the root: null).

    Turns are ordered by turn, null first, turns of one number by their fingerprints; a repeated row is a turn of its own. Null role or text
    is empty, rows without a conversation's id belong to none. An empty table has no node. Other columns are not read.
    Texts of any length move once, to be compared, and never with their prefixes.

    Groups of equal fingerprints are verified through the turns that they refer to: members of a group refer to stored turns of one
    fingerprint, and stored turns of one fingerprint have one role and text. Otherwise all is fingerprinted anew with another seed.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = F.col("conv_id") - F.col("conv_id") % 100 if base is None else base
    head = F.crc32(F.col("conv_id").cast("string")) % 6 if head is None else head
    seed = 0
    while True:
        stored = stored_turns(turns, conv_col, turn_col, role_col, text_col, seed)
        members = materialize(rebuilt_prefixes(prefix_products(stored, parts), base, head, longest_head), "members")
        lowest = [F.min(x).alias(x) for x in ("conv_id", "g1", "g2", "m1", "m2")]
        nodes = materialize(
            members.groupBy("depth", "f1", "f2").agg(
                *lowest, F.max("m1").alias("x1"), F.max("m2").alias("x2"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
                F.min("ref_conv").alias("turn_conv"), F.min_by("ref_place", "ref_conv").alias("turn_place"),
            ), "nodes",
        )
        mixed = nodes.where("m1 <> x1 OR m2 <> x2").limit(1).count()
        twice = stored.select("m1", "m2", "role", "text").distinct().groupBy("m1", "m2").count().where("count > 1").limit(1).count()
        if not mixed and not twice:
            break
        seed += 1
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.count("*").alias("n_children"))
    linked = nodes.join(parents, ["depth", "g1", "g2"], "left").join(children, ["depth", "f1", "f2"], "left").join(end_hashes(members.where("ends"), parts), ["depth", "f1", "f2"], "left")
    linked = materialize(
        linked.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "turn_conv", "turn_place",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saving"),
        ), "linked",
    )
    return subtree_sums(linked).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_conv", "turn_place")
