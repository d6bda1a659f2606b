"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokens
from .balltree import top_k
from .fmindex import decontaminate
from .minhash import near_duplicates
from .mixing import mix
from .quality import classify
from .rules import ledger, rejects
from .secrets import find_secrets
from .sharding import shard
from .suffixes import repeated_substrings
from .tokens import token_output
from .toolcalls import link_calls
from .tries import prefix_trie

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(_read(spark, sf_dir, "documents"), 24)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(F.filter("found", lambda x: x["kind"] != "entropy")), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(_read(spark, sf_dir, "documents"), TOKENIZER)


def op7_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn stands for a call, and the turn after it for its result.

    A call needs the one two turns before and, now and then, the conversation's first. Some need a call that
    is not there, a few the one after them. Arguments hold all words of the turn.
    """
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    arguments = F.to_json(
        F.struct(
            words.alias("terms"), F.when(F.col("turn") % 5 != 4, F.size(words)).alias("limit"),
            F.when(F.size(words) % 7 == 0, "exact").alias("mode"),
        )
    )
    number = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(1000))
    call = lambda turn: F.concat(F.lit("call-"), turn)
    needs = F.filter(
        F.array(
            F.when(F.col("turn") >= 2, call(F.col("turn") - 2)), F.when((F.col("turn") > 3) & (number % 8 == 0), call(F.lit(1))),
            F.when(number == 501, F.lit("call-none")), F.when(number == 502, call(F.col("turn") + 2)),
        ),
        lambda x: x.isNotNull(),
    )
    calls = turns.where("role = 'assistant'").select(
        "conv_id", call(F.col("turn")).alias("call_id"), F.when(F.size(words) % 2 == 0, "search").otherwise("lookup").alias("name"),
        arguments.alias("arguments"), needs.alias("needs"),
    )
    results = turns.where("role = 'user' and turn > 0").select("conv_id", F.concat(F.lit("call-"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("result"))
    return link_calls(calls, results, TOOLS)


TOOLS = {
    "search": {"required": ["terms", "limit"], "properties": {"terms": {"type": "array"}, "limit": {"type": "integer"}, "mode": {"type": "string"}}},
    "lookup": {"required": ["terms"], "properties": {"terms": {"type": "array"}, "limit": {"type": "integer"}}},
}


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_substrings(_read(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return ledger(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & ~rejects(2)).alias("kept"), "failed",
    )


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie(_read(spark, sf_dir, "conversations"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_read(spark, sf_dir, "documents"), TOKENIZER, PIECES, groups=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_minhash, op2_quality, op3_sharding, op4_mixing, op5_secrets, op6_tokens, op7_toolcalls, op8_decontamination, op9_substrings, op10_rules, op11_trie, op12_topk, op13_alignment)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
