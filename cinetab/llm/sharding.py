"""Sharding by a hierarchical weighted hash tree, with gapless slots.

Regions hold racks, racks hold shards, and every place of a region's racks is in the tree, whether its shard exists or not. For a key each
region has a row of attempts: one hash gives the attempt's time (times are sums of exponential steps at the rate of all places), and
the draws by which it descends to a rack and to a place in it. An attempt stands if a last draw is within the place's weight; a
place without a shard weighs nothing. The key's shard is the one of the earliest attempt that stands. A new shard, or a heavier one, turns
attempts at its own place into ones that stand and changes nothing else: keys move only into it, whatever the number of
shards; a lighter one only gives keys away. A region that is full of equal shards takes one hash a key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, materialize

#: Attempts that a region has at most: of equal shards beside a full region (a later attempt would matter with probability 2 ** -64), and
#: otherwise (one shard in twelve places stands by then but for 10 ** -38). A key without any goes to the first shard that has weight.
ATTEMPTS, ATTEMPTS_ALONE = 64, 1024


def _bits(digest: str, first: int, digits: int) -> str:
    """SQL: hexadecimal digits of ``digest`` as a number."""
    return f"cast(conv(substr({digest}, {first}, {digits}), 16, 10) as double)"


def _step(digest: str, rate: str) -> str:
    """SQL: an exponential step at ``rate``, from 60 bits."""
    return f"(-ln(({_bits(digest, 1, 15)} + 0.5D) / 1152921504606846976.0D) / {rate})"


def _place(digest: str, region: str, rack_size: int, racks: int) -> str:
    """SQL: the shard at the end of the descent: a rack, then a place in it, by 24 bits each."""
    draw = lambda first, n: f"cast(floor({_bits(digest, first, 6)} * {n} / 16777216) as int)"
    return f"({region} * {rack_size * racks} + {draw(16, racks)} * {rack_size} + {draw(22, rack_size)})"


def assign_shard(
    df: DataFrame, key: str, shards: int, out: str, rack_size: int = 4, racks: int = 3, weights: tuple[float, ...] | None = None
) -> DataFrame:
    """Add ``out``: the shard of ``key`` among ``shards``, by key, shard count and weights alone (null is a key like others).

    ``weights``: one a shard, 1 by default; a shard of weight 0 gets nothing, and the largest must be 1 at least. Weights are cut into
    layers, up to 1, 2, 4 and so on, of which a region has attempts of its own, so that a change of weights moves keys between the changed
    shards and the rest alone. A key costs a hash a full region and layer, and some more where places are missing or in part
    of a layer; with many shards, larger racks keep the regions few.
    """
    weights = tuple(float(w) for w in weights or (1.0,) * shards)
    if len(weights) != shards or max(weights) < 1 or min(weights) < 0:
        raise ValueError("one weight a shard, none below 0 and one at least 1")
    size = rack_size * racks
    layers = [(0.0, 1.0), *((2.0**k, 2.0 ** (k + 1)) for k in range(math.ceil(math.log2(max(weights)))))]
    full, rest = [], []
    for region in range(-(-shards // size)):
        held = weights[region * size : (region + 1) * size]
        for layer, (low, high) in enumerate(layers):
            unit = f"struct('{region}{f'+{layer}' * (layer > 0)}' as tag, {region} as g, {low!r}D as low, {high - low!r}D as width, {size * (high - low)!r}D as rate)"
            if len(held) == size and min(held) >= high:
                full.append(unit)
            elif any(w > low for w in held):
                rest.append(unit)
    digest = lambda unit, attempt: f"md5(concat(coalesce(cast(`{key}` as string), ''), ':', {unit}.tag, ':', {attempt}))"
    place = lambda x: _place(f"{x}.h", f"{x}.u.g", rack_size, racks)
    hashed = lambda unit, attempt: f"struct({unit} as u, {digest(unit, attempt)} as h)"
    # A column name that the table does not have; best: (time, shard).
    best = free_name(df, "best")
    first = f"array_min(transform(transform(array({', '.join(full)}), u -> {hashed('u', 1)}), x -> struct({_step('x.h', 'x.u.rate')} as at, {place('x')} as shard)))"
    none = f"struct(double('infinity') as at, {next(s for s, w in enumerate(weights) if w > 0)} as shard)"
    df = df.withColumn(best, F.expr(first if full else none))
    if rest:
        table = "array(" + ", ".join(f"{w!r}D" for w in weights) + ")"
        stands = f"{_bits('x.h', 28, 5)} / 1048576D * x.u.width < coalesce(get({table}, {place('x')}), 0D) - x.u.low"
        # Attempts until one stands or is later than the best so far; a shard of -1 is none yet.
        tried = f"struct(t.at + {_step('x.h', 'x.u.rate')} as at, if({stands}, {place('x')}, -1) as shard)"
        later = f"if(t.shard >= 0 or t.at >= b.at, t, element_at(transform(array({hashed('u', 'j')}), x -> {tried}), 1))"
        attempts = f"aggregate(sequence(1, {ATTEMPTS if full and max(weights) == min(weights) == 1 else ATTEMPTS_ALONE}), struct(0D as at, -1 as shard), (t, j) -> {later})"
        nearer = f"element_at(transform(array({attempts}), r -> if(r.shard >= 0 and r.at < b.at, r, b)), 1)"
        df = df.withColumn(best, F.expr(f"aggregate(array({', '.join(rest)}), `{best}`, (b, u) -> {nearer})"))
    return df.withColumn(out, F.col(best)["shard"]).drop(best)


def shard(
    documents: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rack_size: int = 4, racks: int = 3,
    buckets: int = 1024, weights: tuple[float, ...] | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) for every row; ``slot`` counts from 0 within a shard.

    ``grown_shard``: with one more shard, of weight 1. A shard's rows are numbered by hash bucket and, in a bucket, by id:
    ``buckets`` spread a shard over many tasks, and only (shard, bucket) counts, bounded by shards * buckets, are
    summed up and broadcast. Null texts have size 8 and the checksum of nothing. Rows with a null or repeated id share a
    shard and have slots of their own; in a bucket they go by checksum, then size. Empty table: empty result. Other columns are not
    read. A very long text is read once, for its size and checksum.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = assign_shard(rows, "doc_id", shards, "shard", rack_size, racks, weights)
    rows = assign_shard(rows, "doc_id", shards + 1, "grown_shard", rack_size, racks, (*weights, 1.0) if weights else None)
    # The text's checksum is in the bucket, so that rows of one id (or none) spread too.
    bucket = F.pmod(F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32")), F.lit(buckets)).cast("int")
    rows = materialize(rows.withColumn("bucket", bucket), "sharded")
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"), "grown_shard"
    )
