"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over its bits.

All of it is DataFrame expressions over one row at a time; the ledger needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the ledger's measurements; its place in RULES is its bit."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("upper_case", "10 * n_upper > 6 * n_letters"),
)
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES = {
    1: (*BASE, "symbols", "duplicate_lines"),
    2: (*BASE, "symbols", "duplicate_lines", "long_words", "short_words", "upper_case"),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << [r.name for r in rules].index(n) for n in names)


def measure(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_letters) of whole texts.

    A column that a lambda reads is used twice at least, so that it stays a column of its own and is
    not evaluated again for every element. Windows are compared by 64-bit hashes inside one text, by
    sorting, so that a long text costs n log n.
    """
    df = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    df = df.select(
        "doc_id", "text", F.filter(F.split("text", SPACES), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    df = df.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[A-Za-z]")).cast("long").alias("n_letters"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    measured = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_letters"]
    grams = F.when(F.size("h") >= 5, F.expr("transform(sequence(0, size(h) - 5), i -> struct(xxhash64(h[i], h[i+1], h[i+2], h[i+3], h[i+4]) as g, i as i))"))
    df = df.select(*measured, F.sort_array(grams).alias("s"))
    df = df.select(*measured, F.expr("sort_array(transform(filter(s, (x, j) -> get(s, j - 1).g <=> x.g or get(s, j + 1).g <=> x.g), x -> x.i))").alias("p"))
    covered = F.expr(
        "aggregate(p, struct(-5 as last, 0L as total), (a, i) -> struct(i as last, a.total + least(5, i - a.last) as total), a -> a.total)"
    )
    return df.select(*measured, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def ledger(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements of every row and ``failed``: bit k is set if rule k fails.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null or blank texts have no words and fail few_words alone. Null and
    repeated ids stay row by row. Empty table: empty ledger. Other columns are not read.
    """
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0))
    return measure(documents, id_col, text_col).withColumn("failed", bits)


def rejects(policy: int, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row fails a rule of the policy of this version."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy], rules))) != 0


def ablation(entries: DataFrame, policy: int, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the policy rejects without it.

    The ledger is first reduced to its distinct bit patterns; their number is bounded by the rules.
    """
    whole = mask(POLICIES[policy], rules)
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, r in enumerate(rules) if whole >> k & 1])
    each = patterns.select("bits", "n", F.explode(names).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rest = F.col("bits").bitwiseXOR(F.when(hit, F.col("bit")).otherwise(F.lit(0)))
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum(F.when(hit & (rest == 0), F.col("n"))), F.lit(0)).alias("only_this"),
        F.coalesce(F.sum(F.when(rest != 0, F.col("n"))), F.lit(0)).alias("rejected_without"),
    )
