"""Secret scans: three patterns, and sliding-window Shannon entropy over candidate strings.

Everything is an expression over one row, so the scan has no shuffle. Positions are code points and
come from the pieces between matches. The entropy of a window is log2(w) - S / w with S the sum of
c * log2(c) over its characters' counts; stepping on by one character changes two counts and S.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns. A run of hex digits or of an access key's letters is matched whole or not at all, so their
#: least lengths can stand in the pattern; the assigned value's length is tested afterwards.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
#: Candidates that are never reported for their entropy: UUIDs, plain runs of digits or letters, samples.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"(?i)example|placeholder|0123456789|abcdefghij",
)
#: Matches of one text whose lengths are summed up at a time.
BLOCK = 64
#: Class of characters -> bits that a window must reach.
CLASSES = {"^[0-9a-f]+$": 3.0, "^[0-9A-F]+$": 3.0, "": 3.9}


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'" if "'" not in pattern else 'r"""' + pattern + '"""'


def _matches(df: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Add column ``kind``: array of (start, end, word) of all matches of a pattern in ``text``."""
    df = df.withColumn("m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn("p", F.when(F.size("m") > 0, F.split("text", pattern)))
    # Where match i begins: running sums over blocks of BLOCK matches, then inside a block. A column that a lambda
    # reads is used twice, so that it is worked out once a row.
    df = df.withColumn("step", F.expr("if(size(m) > 0, transform(m, (x, i) -> length(p[i]) + length(x)), null)"))
    df = df.withColumn("sums", F.expr(f"if(step is null, null, transform(sequence(0, size(step) div {BLOCK}), b -> aggregate(slice(step, b * {BLOCK} + 1, {BLOCK}), 0, (a, x) -> a + x)))"))
    df = df.withColumn("before", F.expr("if(sums is null, null, transform(sums, (x, b) -> aggregate(slice(sums, 1, b), 0, (a, y) -> a + y)))"))
    at = f"before[i div {BLOCK}] + aggregate(slice(step, i div {BLOCK} * {BLOCK} + 1, i % {BLOCK}), 0, (a, y) -> a + y)"
    spans = f"if(before is not null, transform(m, (x, i) -> struct({at} + length(p[i]) as start, {at} + step[i] as end, x as word)), null)"
    none = F.expr("cast(array() as array<struct<start: int, end: int, word: string>>)")
    return df.withColumn(kind, F.coalesce(F.expr(spans), none)).drop("m", "p", "step", "sums", "before")


def _entropy(window: int) -> str:
    """SQL over candidate ``c``: (first start, last end) of its windows that reach the class's bits, or null."""
    table = "array(" + ", ".join(f"{c * log2(c) if c else 0.0}D" for c in range(window + 2)) + ")"
    place = lambda i: f"instr('{ALPHABET}', substr(c.word, {i}, 1)) - 1"
    bits = "case " + " ".join(f"when c.word rlike '{k}' then {v}D" for k, v in CLASSES.items() if k) + f" else {CLASSES['']}D end"
    return f"""aggregate(
        transform(sequence(1, length(c.word)), i -> struct(i as i, {place('i')} as enter, if(i > {window}, {place(f'i - {window}')}, -1) as leave)),
        struct(array_repeat(0, {len(ALPHABET)}) as n, 0.0D as s, {bits} as bits, cast(null as int) as lo, cast(null as int) as hi),
        (a, x) -> transform(array(struct(
            transform(a.n, (v, k) -> v + if(k = x.enter, 1, 0) - if(k = x.leave, 1, 0)) as n,
            a.s + if(x.enter = x.leave, 0.0D, g[a.n[x.enter] + 1] - g[a.n[x.enter]]
                + if(x.leave < 0, 0.0D, g[a.n[greatest(x.leave, 0)] - 1] - g[a.n[greatest(x.leave, 0)]])) as s)),
            y -> struct(y.n as n, y.s as s, a.bits as bits,
                if(x.i >= {window} and {log2(window)}D - y.s / {window} >= a.bits, coalesce(a.lo, x.i - {window}), a.lo) as lo,
                if(x.i >= {window} and {log2(window)}D - y.s / {window} >= a.bits, x.i, a.hi) as hi))[0],
        a -> if(a.lo is null, null, struct(c.start + a.lo as start, c.start + a.hi as end)))""".replace("g[", f"{table}[")


def find_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(doc_id, found) for every row: ``found`` is array<struct<start, rank, kind, end>>, sorted by start, then kind.

    Kinds, in this order: assign, access, hex (the patterns, leftmost without overlap) and entropy: the
    range of a candidate string's windows whose entropy reaches the bits of its character class, unless
    an ``allowed`` pattern matches the candidate. Positions are code points, ends exclusive.
    Null or empty texts: nothing found. Null and repeated ids stay row by row. Empty table: empty result.
    Spans that start together go by kind; overlapping ones of different kinds are all given. Whole texts are searched; of a
    very long one the positions of its matches are summed up in blocks.
    """
    df = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    df = _matches(df, "assign", ASSIGN)
    df = df.withColumn("assign", F.filter("assign", lambda c: F.length(F.regexp_extract(c["word"], ASSIGN, 2)) >= 6))
    df = _matches(_matches(_matches(df, "access", ACCESS), "hex", HEX), "candidate", CANDIDATE)

    def suspicious(c):
        keep = F.lit(True)
        for pattern in allowed:
            keep = keep & ~c["word"].rlike(pattern)
        return keep

    df = df.withColumn("candidate", F.filter("candidate", suspicious))
    df = df.withColumn("entropy", F.expr(f"filter(transform(candidate, c -> {_entropy(window)}), x -> x is not null)"))
    kinds = [
        F.expr(f"transform({kind}, c -> struct(c.start as start, {rank} as rank, '{kind}' as kind, c.end as end))")
        for rank, kind in enumerate(("assign", "access", "hex", "entropy"))
    ]
    return df.select("doc_id", F.sort_array(F.concat(*kinds)).alias("found"))
