"""The prefix trie, exact top-k search and the alignment of two tokenizers, each against a plain version."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinetab.llm import alignment, balltree, queries, shared, tokens, tries

TURNS = "conv_id long, turn long, role string, text string, depth string, m1 int"


def plain_trie(rows):
    """Each node, from all rebuilt conversations as tuples of turns."""
    said, rebuilt = collections.defaultdict(list), {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            said[conv].append((-1 if turn is None else turn, role or "", text or ""))
    for turns in said.values():
        turns.sort(key=lambda t: t[0])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(t[1:] for t in said.get(c - c % 100, [])[:h] + said[c][h:])
        ends[rebuilt[c]].append(c)
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for key in members:
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(members[key]) - 1) * len(key[-1][1]) if key else 0
    sha = lambda key: hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest()
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], sha(k)) for k, m in members.items()), key=str
    )


def conversations():
    rng = random.Random(3)
    say = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "", None, "é" * rng.randrange(5), "long " * 3000]))
    rows = [(c, t, *say()) for c in [*range(40), *range(100, 140), *range(250, 270)] for t in range(rng.randrange(1, 9))]
    rows += [(300 + c, t, "user", f"same {t}") for c in range(60) for t in range(7)]  # many copies
    rows += [(400, t, "user", f"turn {t % 3}") for t in range(300)] + [(401, t, "user", f"turn {t % 3}") for t in range(280)]
    rows += [(5, None, "user", "first"), (None, 1, "user", "nobody's"), (7, 50, None, None), (7, 50, None, None)]
    rng.shuffle(rows)
    return [(*r, "x", 1) for r in rows]


def trie_rows(found):
    return sorted((tuple(r)[:8] for r in found.collect()), key=str)


def test_trie(spark, monkeypatch):
    rows = conversations()
    found = tries.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(3))
    assert trie_rows(found) == plain_trie(rows)
    stored = {(c, i + 1): t for c in {r[0] for r in rows} - {None, 5, 7} for i, t in enumerate(sorted((r[1:4] for r in rows if r[0] == c), key=lambda t: t[0]))}
    for r in found.where("n_convs = 1 and depth > 0").collect():  # the reference leads to the turn that the node ends with
        if r.turn_conv not in (5, 7):
            assert (r.turn_conv, r.turn_place) in stored
    monkeypatch.setattr(tries, "DEPTHS", 7)
    assert trie_rows(tries.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)


def test_trie_of_one_conversation_over_many_tasks(spark):
    """Products are composed across tasks: all rows belong to one conversation and its copy."""
    rows = [(c, t, "user", f"{t * t % 17}", "", 0) for c in (1000, 1001) for t in range(900)]
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        assert trie_rows(tries.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("lanes", ["0", "length(text) % 2"])
def test_trie_with_colliding_fingerprints(spark, monkeypatch, lanes):
    """Fingerprints that mix up turns are found out by the stored turns, and another seed is taken."""
    rows, seeds, stored = conversations()[:150], [], tries.stored_turns

    def mixed(*args):
        seeds.append(args[-1])
        out = stored(*args)
        return out if args[-1] else out.withColumns({"m1": F.expr(f"CAST({lanes} AS LONG)"), "m2": F.expr(f"CAST({lanes} AS LONG)")})

    monkeypatch.setattr(tries, "stored_turns", mixed)
    assert trie_rows(tries.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)
    assert seeds == [0, 1]


def test_trie_empty_and_other_bases(spark):
    assert tries.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    turns = spark.createDataFrame([(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "c"), (2, 1, "u", "d")], "conv_id long, turn long, role string, text string")
    found = tries.prefix_trie(turns, base=F.lit(1), head=F.lit(1), longest_head=1)
    assert {(r.depth, r.n_convs, r.n_children) for r in found.collect()} == {(0, 2, 1), (1, 2, 2), (2, 1, 0)}


VECTORS = "vec_id long, embedding array<float>, row string, dim int"


def plain_top(rows, k=10):
    """For each query the scores and ids of its best rows, by whole numbers; usable rows by their place."""
    usable = [(i, v, [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, v, e in usable:
        if v is not None and v % 100 == 0:
            scores = [(-max(-balltree.LONG, min(balltree.LONG, sum(a * b for a, b in zip(e, f, strict=False)))), w is None, w or 0, j) for j, w, f in usable if j != i]
            out += [(v, n + 1, None if none else w, -s) for n, (s, none, w, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def top_rows(found):
    return sorted(((r.query_id, r["rank"], r.id, r.score) for r in found.collect()), key=str)


def vectors(n, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.integers(-3, 4, dim).astype(float).tolist()) for i in range(n)]  # few values: many ties


def test_top_k(spark, monkeypatch):
    odd = [(1000, None), (1001, [1.0, None]), (1100, [float("nan")] * 12), (1200, [float("inf"), 1.0]), (1300, []), (1400, [2.0, 1.0]), (None, [3.0] * 12), (100, [1.0] * 12)]
    rows = vectors(900) + odd + [(500, [0.5] * 12)] * 40 + [(7, [3.0] * 12)] * 70 + [(200, [0.1] * 40)]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    query = F.col("vec_id") % 100 == 0
    assert top_rows(balltree.top_k(data, query)) == plain_top(rows)
    for name, value in (("SHARD", 50), ("STRIPE", 2), ("GROUP", 6), ("BLOCK", 4), ("LEAF", 5)):
        monkeypatch.setattr(balltree, name, value)
    assert top_rows(balltree.top_k(data, query)) == plain_top(rows)
    assert top_rows(balltree.top_k(data, query, k=3)) == plain_top(rows, 3)


def test_top_k_of_large_and_few_vectors(spark):
    large = [(0, [3e38, -3e38, 1.0]), (1, [3e38, 3e38, 2.0]), (2, [1e9, 5.0, -7.0]), (3, [1e8, 5.25, 1e7]), (100, [1e7, -1e7, 3.0])]
    assert top_rows(balltree.top_k(spark.createDataFrame([(*r, "x", 1) for r in large], VECTORS), F.col("vec_id") % 100 == 0)) == plain_top(large)
    for rows in ([], [(100, [1.0])], [(1, [1.0]), (2, [2.0])]):
        found = balltree.top_k(spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS), F.col("vec_id") % 100 == 0)
        assert top_rows(found) == plain_top(rows) == []


def test_ball_tree_leaves_nodes_out():
    """In clusters, the bound spares most inner products, more so with a score to start from."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 1000
    x = np.floor(centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 16)) * 20)
    q, row = np.floor(centres[:5]), np.arange(2000)
    tree = balltree.BallTree.load(balltree.BallTree.build(x, row, row >= 0, row).dump())
    best = balltree.Best(np.full(5, -1), np.full(5, -balltree.LONG), 10)
    first = balltree.search(tree, q, best)
    again = balltree.Best(np.full(5, -1), best.floor, 10)
    second = balltree.search(tree, q, again)
    assert second <= first < 0.3 * 5 * 2000
    for i in range(5):
        assert best.scores[i].tolist() == sorted((x @ q[i]).astype(int).tolist())[::-1][:10] == again.scores[i].tolist()


class Plain:
    """Both tokenizers, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(queries.TOKENIZER)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}

    def sides(self, text):
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        return a, [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a], b, [piece(i) for i in b]

    def rows(self, docs):
        counts, each = collections.Counter(), []
        for doc, text in docs:
            a, a_bytes, b, b_bytes = self.sides(text) if text else ([], [], [], [])
            if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
                each.append((doc, 0, 0, [], ""))
                continue
            ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
            links, groups, at = [], [], [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                to = [e.index(cut) + 1 for e in ends]
                groups.append("|".join(",".join(map(str, ids[i:j])) for ids, i, j in zip((a, b), at, to, strict=True)))
                links.append((a[to[0] - 1], b[to[1] - 1]))
                at = to
            counts.update(links)
            each.append((doc, len(a), len(b), links, ";".join(groups)))
        most = collections.Counter()
        for (_, b), n in counts.items():
            most[b] = max(most[b], n)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
        return [(d, n, m, len(x), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), sha(g), g) for d, n, m, x, g in each]


def aligned(found):
    return sorted(map(tuple, found.collect()), key=str)


def test_alignment(spark, monkeypatch):
    rng = random.Random(8)
    words = ["the", "ing", "straße", "日本語", "🙂👩‍👩‍👧", "x=1;", "12345", "été", "don't", "\t", "  ", "\n\n", "مرحبا", "\x07", "ﬁ", "①", "Ａ", "é"]
    texts = [None, "", " ", "a", "<|endoftext|> and <s> <unk> </s>", "▁ under ▁▁", "a\x00b", " x", "tail  ", "  head", "<0x41>", "same text", "same text", "y" * 30_000]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, "a"), (3, "a"), (3, "b")]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, pair string, batch int")
    expected = sorted(Plain().rows(rows), key=str)
    assert sum(r[1] > 0 for r in expected) > 60 and sum(r[1] == 0 for r in expected) >= 3
    assert aligned(alignment.align_tokens(data, queries.TOKENIZER, queries.PIECES)) == expected
    monkeypatch.setattr(alignment, "PASS_BYTES", 100)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 500)
    assert aligned(alignment.align_tokens(data, queries.TOKENIZER, queries.PIECES)) == expected


def test_alignment_without_tokens(spark):
    kind = "doc_id long, text string"
    assert alignment.align_tokens(spark.createDataFrame([], kind), queries.TOKENIZER, queries.PIECES).count() == 0
    found = alignment.align_tokens(spark.createDataFrame([(1, None), (2, "")], kind), queries.TOKENIZER, queries.PIECES)
    assert aligned(found) == [(1, 0, 0, 0, 0, 0, 0, "", ""), (2, 0, 0, 0, 0, 0, 0, "", "")]


def test_overlaps():
    """Both directions together: every pair of tokens with a common byte, once."""
    import pandas as pd

    a = pd.DataFrame({"place": [0, 2, 3, 10], "doc": [0, 0, 0, 1], "a": [0, 1, 2, 3], "a_end": [2, 3, 9, 12]})
    b = pd.DataFrame({"place": [0, 1, 5, 10, 11], "doc": [0, 0, 0, 1, 1], "b": [0, 1, 2, 3, 4], "b_end": [1, 5, 9, 11, 12]})
    met = alignment.overlaps(a, b)
    assert sorted(zip(met["a"], met["b"], strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (3, 3), (3, 4)]


def test_tables_of_the_tokenizers():
    assert public_tokenizers.path("piece_bpe_32k.model") == queries.PIECES
    both = alignment.Aligner(queries.TOKENIZER, queries.PIECES)
    plain = Plain()
    for text in ("Hello, wörld 日本 🙂", "  a\n b"):
        a, a_bytes, b, b_bytes = plain.sides(text)
        assert both.a.joined(np.array(a)) == b"".join(a_bytes) and both.b.joined(np.array(b)) == b"".join(b_bytes)


def test_failed_operators_leave_nothing(spark, tmp_path, monkeypatch):
    """Tables of an operator go when it ends, well or not; one that is half written goes too."""
    monkeypatch.setattr(shared, "scratch_folder", lambda spark: str(tmp_path))

    @shared.operator
    def works(df):
        shared.materialize(df, "on-the-way")
        return df.selectExpr("id + 1 AS id")

    @shared.operator
    def fails(df):
        works(shared.materialize(df, "before"))
        return df.selectExpr("raise_error('broken') AS id")

    assert works(spark.range(3)).count() == 3
    kept = sorted(p.name.split("-")[0] for p in tmp_path.iterdir())
    assert kept == ["works"]
    with pytest.raises(Exception, match="broken"):
        fails(spark.range(3))
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == kept


def test_tokens_of_one_id_are_spread(spark, tmp_path):
    """Rows that repeat an id, or id and text, are cut into ranges like others, and read back in one order."""
    rows = [(7, "the same words")] * 900 + [(7, f"other words {i}") for i in range(900)] + [(None, None)] * 300 + [(i, "one") for i in range(20)]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "tokens")
    tokens.write_tokens(data, path, queries.TOKENIZER)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()
    assert len(parts) == 4 and max(r.n for r in parts) < 0.5 * len(rows)
    found = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in found] == sorted(-1 if d is None else d for d, _ in rows)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(found, found[1:], strict=False)) and found[0].start == 0
    encoder = Tokenizer.from_file(queries.TOKENIZER)
    expected = collections.Counter((d, tuple([*encoder.encode(t or "", add_special_tokens=False).ids, 2])) for d, t in rows)
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == expected
