"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Targets: every source gets the total size in proportion to its weight; a source that would pass
``max_epochs`` times its size stops there and the excess is dealt to the others by weight, until none
is above. That is one water level over the sources, ordered by cap per weight: running sums give the
level at which the first k sources are capped, and the first level that fits is the answer.

Sampling: a source that must be taken m times is taken floor(m) times whole; for the fraction, its
documents are put into a seeded random order and taken until the words run out, the last one in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, materialize

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source, three numbers each.

    Sources are ranked by code point, null last, and weighed by ``weights``, repeating. The water level needs all of them
    in one place: one task sorts some 50 bytes a source, so a few million sources are what this is made for.
    """
    every = Window.partitionBy()
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    df = sources.select(
        "source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        F.sum("source_size").over(every).alias("total"),
    )
    df = df.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.partitionBy().orderBy("full_at", F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    df = df.withColumn("level", (F.col("total") - capped) / open_weight)
    level = F.max(F.when(F.col("full_at") >= F.col("level"), F.col("level"))).over(every)
    return df.select("source", "source_size", F.least("cap", F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def _draw(seed: int, id_col: str, text_col: str) -> Column:
    """A number of 60 bits from the MD5 of seed, id and text, by which a source's rows are put in order."""
    parts = [F.lit(str(seed)), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _bucket(draw: Column, buckets: int) -> Column:
    """Ranges of the draw, in its order."""
    return F.floor(draw / F.lit((1 << 60) // buckets)).cast("int")


def mix(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3.0, seed: int = 17, buckets: int = 1024,
) -> DataFrame:
    """(doc_id, draw, source, size, source_size, target, times, part, taken) for every row.

    ``size``: words ``[^\\x20\\x09-\\x0D]+`` of the text (null: 0). The mix takes the document ``times`` times whole
    and ``part`` further words (only one document of a source has a part); ``taken`` is the words in all, so a
    source's taken words are its target, rounded. The order is a hash of seed, id and text: reruns agree.

    A source's rows are spread over ``buckets`` ranges of the hash; running sums over (source, bucket) rows
    find the bucket where the fraction ends, and only there rows are summed one by one. Null ids and
    repeated rows are rows like others; sources of size 0 have target 0. Empty table: empty result. Rows with one draw go
    by id, then size. A very long text is counted whole, and taken in part if the fraction ends in it.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"), _draw(seed, id_col, text_col).alias("draw"),
    )
    rows = materialize(rows.withColumn("bucket", _bucket(F.col("draw"), buckets)), "mixed")
    # A null source is told from "null" by its flag, so that plain equi-joins find it.
    key = [F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none")]
    rows = rows.select("*", *key)
    parts = materialize(rows.groupBy("name", "none", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    sources = parts.groupBy("name", "none").agg(F.sum("bucket_size").alias("source_size"))
    sources = sources.select(F.when(~F.col("none"), F.col("name")).alias("source"), "source_size")
    goal = targets(sources, weights, max_epochs).select("source_size", "target", *key)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + F.lit(1e-12))
    goal = goal.withColumn("whole", whole).withColumn("rest", F.greatest(F.rint(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"), F.lit(0)))
    before = Window.partitionBy("name", "none").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    plan = materialize(starts.join(goal, ["name", "none"]), "mix-plan")
    df = rows.join(plan, ["name", "none", "bucket"])
    inside = Window.partitionBy("name", "none", "bucket").orderBy("draw", "doc_id", "size")
    at = F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    df = df.withColumn("extra", F.least(F.greatest(F.col("rest") - at, F.lit(0)), F.col("size")))
    full = (F.col("extra") == F.col("size")) & (F.col("size") > 0)
    times = F.col("whole") + F.when(full, 1).otherwise(0)
    return df.select(
        "doc_id", "draw", "source", "size", "source_size", "target", times.cast("int").alias("times"),
        F.when(full, 0).otherwise(F.col("extra")).cast("long").alias("part"), (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )


def repeat_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options) -> DataFrame:
    """``documents`` as the mix takes them: each row as often as ``mix`` says, with all columns.

    A document that is taken in part is taken once more if that is half of it at least. Rows that repeat
    both id and text take the same number of copies each, rounded up.
    """
    plan = mix(documents, id_col, text_col, source_col, seed=seed, **options)
    copies = (F.col("times") + F.when(2 * F.col("part") >= F.greatest("size", F.lit(1)), 1).otherwise(0)).cast("int")
    # The added columns get names that the table does not have.
    at, n, copy = (free_name(documents, x) for x in ("draw", "copies", "copy"))
    plan = plan.groupBy(F.col("draw").alias(at)).agg(F.ceil(F.avg(copies)).cast("int").alias(n)).where(F.col(n) > 0)
    taken = documents.withColumn(at, _draw(seed, id_col, text_col)).join(plan, at)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in documents.columns])
