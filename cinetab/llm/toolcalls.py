"""Chat formatting: link tool calls and their results, order them, validate arguments, write canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, operator

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def canonical(value: object) -> str:
    """JSON with sorted keys, no blanks and unescaped text; ValueError for what JSON or UTF-8 cannot hold."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text.encode()
    return text


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def parsed(text: str | None) -> tuple[object, str] | None:
    """A JSON text's value and canonical form; null for other texts, and for nesting, numbers or characters that cannot be written back."""
    try:
        value = json.loads(text or "", parse_constant=_no_constant)
        return value, canonical(value)
    except (ValueError, RecursionError):
        return None


def argument_errors(arguments: object, schema: dict) -> list[str]:
    """What is wrong with arguments under {"required": [...], "properties": {name: {"type": ...}}}, sorted."""
    if not isinstance(arguments, dict):
        return ["not an object"]
    known = schema.get("properties") or {}
    errors = [f"missing {x}" for x in schema.get("required") or [] if x not in arguments]
    for name, value in arguments.items():
        kind = (known.get(name) or {}).get("type")
        if name not in known:
            errors.append(f"unknown {name}")
        elif kind in TYPES and (not isinstance(value, TYPES[kind]) or (isinstance(value, bool) and kind != "boolean")):
            errors.append(f"{name} is not {kind}")
    return sorted(errors)


def _validated(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Add ``errors`` (joined by "; ") and canonical ``arguments`` (null where they are not JSON)."""
    names = calls.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, written = [], []
            for name, text in zip(batch.column(names.index("name")).to_pylist(), batch.column(names.index("arguments")).to_pylist(), strict=True):
                found = parsed(text)
                if found is None:
                    errors.append("not JSON")
                    written.append(None)
                    continue
                errors.append("; ".join(argument_errors(found[0], schemas[name]) if name in schemas else ["unknown tool"]))
                written.append(found[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(errors, pa.string()), pa.array(written, pa.string())], [*names, "errors", "canonical"])

    return calls.mapInArrow(work, ", ".join(f"{n} {t}" for n, t in calls.dtypes) + ", errors string, canonical string")


def _levels(edges: DataFrame) -> DataFrame:
    """(node, depth, cyclic) for every node of ``edges(node, needs)``: its longest path of needs; null in or above a cycle.

    Rounds of joins over the open edges (node, need, w): "node stands w above need at least". Where the need's depth is
    known, it goes into the node's floor. Where the need has one open edge left, the edge jumps over it, with its
    floor and distance, so that a chain or a tree of any length takes rounds with its logarithm. Nodes without
    open edges are done. An edge that comes back to its node, or is longer than there are nodes, is a
    cycle; so is all that is left after a round that changes nothing. No component, chain or hot node is ever in one task.
    """
    opened = materialize(edges.select("node", F.col("needs").alias("need"), F.lit(1).cast("long").alias("w")).distinct(), "open")
    nodes = materialize(opened.select("node").union(opened.select("need")).distinct(), "nodes")
    total = nodes.count()
    floors = opened.select("node", F.lit(0).cast("long").alias("floor")).distinct()
    leaves = nodes.join(floors, "node", "left_anti")
    done = materialize(leaves.select("node", F.lit(0).cast("long").alias("depth"), F.lit(False).alias("cyclic")), "levels")
    found = [done]

    def gathered(floors: DataFrame, rows: DataFrame) -> DataFrame:
        """Per node its floor, whether it has open edges, and whether one of them is cyclic."""
        both = floors.select("node", "floor", F.lit(False).alias("waits"), F.lit(False).alias("cyclic"))
        both = both.union(rows.select("node", "floor", F.col("need").isNotNull(), "cyclic"))
        return both.groupBy("node").agg(F.max("floor").alias("floor"), F.max("waits").alias("waits"), F.max("cyclic").alias("cyclic"))

    while True:
        # Depths of the last round go into floors.
        met = opened.join(done.withColumnRenamed("node", "need"), "need", "left").select(
            "node", F.coalesce(F.col("depth") + F.col("w"), F.lit(0)).alias("floor"), F.when(F.col("cyclic").isNull(), F.col("need")).alias("need"), "w",
            F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        )
        met = materialize(met, "met")
        seen = materialize(gathered(floors, met), "seen")
        still = seen.where("waits and not cyclic").select("node", "floor")
        kept = met.where("need is not null").join(still, "node", "left_semi")
        # Edges jump over needs that have one open edge.
        single = kept.groupBy("node").agg(F.count("*").alias("n"), F.max("need").alias("next"), F.max("w").alias("far")).where("n = 1")
        single = single.join(still, "node").select(F.col("node").alias("need"), "next", "far", F.col("floor").alias("below"))
        jumps = kept.select("node", "need", "w").join(single, "need", "left").select(
            "node", F.coalesce(F.col("below") + F.col("w"), F.lit(0)).alias("floor"), F.coalesce("next", "need").alias("need"),
            (F.col("w") + F.coalesce("far", F.lit(0))).alias("w"), F.col("next").isNotNull().alias("moved"),
        )
        jumps = materialize(jumps.withColumn("cyclic", (F.col("need") == F.col("node")) | (F.col("w") > total)), "jumps")
        after = materialize(gathered(still, jumps), "after")
        ended = seen.where("cyclic or not waits").select("node", "floor", "cyclic").union(after.where("cyclic").select("node", "floor", "cyclic"))
        done = materialize(ended.select("node", F.when(~F.col("cyclic"), F.col("floor")).alias("depth"), "cyclic"), "levels")
        found.append(done)
        floors = after.where("not cyclic").select("node", "floor")
        opened = jumps.groupBy("node", "need").agg(F.max("w").alias("w"))
        opened = materialize(opened.join(after.where("cyclic").select("node"), "node", "left_anti"), "open")
        if not done.limit(1).count() and not jumps.where("moved").limit(1).count():
            break
    left = floors.select("node", F.lit(None).cast("long").alias("depth"), F.lit(True).alias("cyclic"))
    return reduce(DataFrame.union, [*found, left])


@operator
def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call of ``calls(conv_id, call_id, name, arguments, needs array<string>)``.

    Returns (conv_id, call_id, status, depth, place, errors, message): ``status`` is ok, invalid (arguments
    against their tool's schema), no_result, missing_need (a need that is no call of the conversation) or
    cyclic, the last that applies. ``depth`` is the longest chain of needs below the call (null in or above
    a cycle); ``place`` orders a conversation's calls topologically: by depth, cyclic ones last, then by a hash of call_id.
    ``message`` is canonical JSON of id, name, arguments and result.

    Calls and ``results(conv_id, call_id, result)`` meet in a hash join on both ids. Of calls or results
    that repeat an id, the smallest by value counts. Null ids are dropped: nothing can refer to them. Null
    arguments are not JSON; nor are NaN, numbers beyond a double, half surrogates and nesting beyond Python's depth. Empty tables: empty result. Other columns are not read.
    Arguments and results of any length are read whole, one at a time.
    """
    key = ["conv_id", "call_id"]
    ids = [F.col("conv_id").cast("long").alias("conv_id"), F.col("call_id").cast("string").alias("call_id")]
    first = F.struct(F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"), F.col("needs").cast("array<string>").alias("needs"))
    one = calls.select(*ids, first.alias("c")).dropna(subset=key).groupBy(*key).agg(F.min("c").alias("c")).select(*key, "c.*")
    one = materialize(_validated(one.withColumn("node", F.xxhash64(*key)), schemas), "calls")
    answers = results.select(*ids, F.col("result").cast("string").alias("result")).dropna(subset=key).groupBy(*key).agg(F.min("result").alias("result"), F.lit(True).alias("answered"))
    needs = one.select("conv_id", "node", F.explode(F.array_distinct("needs")).alias("call_id"))
    known = needs.join(one.select(*key, F.col("node").alias("needs")).hint("shuffle_hash"), key, "left")
    edges = materialize(known.select("node", "needs"), "needs")
    missing = edges.where("needs is null").select("node").distinct().withColumn("lost", F.lit(True))
    alone = edges.where("node = needs").select("node").distinct().withColumn("selfish", F.lit(True))
    levels = _levels(edges.where("needs is not null and node <> needs"))
    df = one.join(answers.hint("shuffle_hash"), key, "left").join(missing, "node", "left").join(alone, "node", "left").join(levels, "node", "left")
    cyclic = F.coalesce("cyclic", F.lit(False)) | F.coalesce("selfish", F.lit(False))
    status = (
        F.when(cyclic, "cyclic").when(F.col("lost"), "missing_need").when(F.col("answered").isNull(), "no_result")
        .when(F.col("errors") != "", "invalid").otherwise("ok")
    )
    df = materialize(df.select(*key, "name", "errors", "canonical", "result", status.alias("status"), F.when(~cyclic, F.coalesce("depth", F.lit(0))).alias("depth")), "linked")
    return _messages(_placed(df))


def _placed(df: DataFrame, buckets: int = 1024, levels: int = 256) -> DataFrame:
    """Add ``place``: the row's number in its conversation by (depth, nulls last, range, call_id).

    A long conversation is spread over groups of ``levels`` depths and, in a depth, over ranges of the call ids' hash:
    rows are numbered inside (conversation, depth, range), then shifted by what stands before in the group
    and before the group.
    """
    df = df.withColumn("level", F.coalesce("depth", F.lit(np.iinfo(np.int64).max)))
    df = df.withColumns({"stage": F.expr(f"level div {levels}"), "range": F.pmod(F.xxhash64("call_id"), F.lit(buckets))})
    group = ["conv_id", "stage", "level", "range"]
    counts = materialize(df.groupBy(*group).agg(F.count("*").alias("n")), "places")
    above = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda window: F.coalesce(F.sum("n").over(window), F.lit(0))
    stages = counts.groupBy("conv_id", "stage").agg(F.sum("n").alias("n"))
    stages = stages.select("conv_id", "stage", sums(above("conv_id").orderBy("stage")).alias("before_stage"))
    counts = counts.select(*group, sums(above("conv_id", "stage").orderBy("level", "range")).alias("before"))
    inside = Window.partitionBy(*group).orderBy("call_id")
    numbered = df.withColumn("nth", F.row_number().over(inside)).join(counts, group).join(stages, ["conv_id", "stage"])
    return numbered.withColumn("place", F.col("before_stage") + F.col("before") + F.col("nth") - 1)


def _messages(df: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for call, name, arguments, result in zip(*(batch.column(i).to_pylist() for i in (1, 6, 7, 8)), strict=True):
                out.append(canonical({"id": call, "name": name, "arguments": json.loads(arguments) if arguments else None, "result": result}))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(out, pa.string())], ["conv_id", "call_id", "status", "depth", "place", "errors", "message"]
            )

    rows = df.select("conv_id", "call_id", "status", "depth", "place", "errors", "name", "canonical", "result")
    return rows.mapInArrow(work, "conv_id long, call_id string, status string, depth long, place long, errors string, message string")
