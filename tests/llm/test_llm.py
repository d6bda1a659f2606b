"""Every operator against a plain version, on texts with nulls, blanks, copies, repeats and extra columns."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cinetab.llm import fmindex, minhash, mixing, quality, queries, rans, rules, secrets, sharding, suffixes, tokens, toolcalls

SCHEMA = "doc_id long, text string, source string, label int, id string, set_a string"
WORD = r"[^\x20\x09-\x0D]+"


def texts():
    rng = random.Random(5)
    say = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    base, passage = say(200), say(70)
    words = base.split()
    near = " ".join([*words[:100], "x", *words[101:]])
    out = [base, base, near, "", None, "  \n\t ", "one two", "One  two", say(30) + " " + passage + " " + say(20), passage + say(9), say(3) + " " + passage]
    out += [say(60) + "\n" + say(4) + "\n" + say(4), "a b c d e " * 60, "token = 'abc' password: hunter22 AKIA" + "A1" * 10 + " f" * 3 + "0123456789abcdef0123456789ab", "é" * 30 + " ÀÉ Straße 日本", base]
    out += [say(rng.randrange(1, 120)) for _ in range(40)] + ["long " + say(20_000)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "b", "a", "b", "b"][i % 5], 7, "x", "y") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def components(pairs, ids):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_minhash(docs):
    found = by_id(minhash.near_duplicates(docs))
    sets = {i: shingles(t) for i, t in enumerate(texts())}
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    expected = components(pairs, sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {i: (len(s), expected[i], expected[i] == i) for i, s in sets.items()}


def edited(words, edits):
    """A text of words, with some replaced by position."""
    return " ".join(edits.get(i, w) for i, w in enumerate(words))


def brute_components(texts, percent=85):
    """The component of each text by all pairs, as products of the incidence with the shingles that texts share."""
    sets = [shingles(t) for t in texts]
    count = collections.Counter(x for s in sets for x in s)
    column = {x: k for k, x in enumerate(sorted(x for x, n in count.items() if n > 1))}
    inside = np.zeros((len(sets), len(column)), np.float32)
    for i, s in enumerate(sets):
        inside[i, [column[x] for x in s if x in column]] = 1
    both, sizes = inside @ inside.T, np.array([len(s) for s in sets])
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    found = np.full(len(sets), -1)
    for i in range(len(sets)):
        todo = np.array([i]) if found[i] < 0 else []
        while len(todo):
            found[todo] = i
            todo = np.flatnonzero(linked[todo].any(axis=0) & (found < 0))
    return found.tolist()


def crowd(rng, size, edits=3):
    """A text and near copies of it, with so many words replaced in each."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    return base, [edited(base, {p: f"c{rng.randrange(10**9)}" for p in rng.sample(range(0, 400, 6), edits)}) for _ in range(size)]


def test_minhash_crowd(spark):
    """Rows at 0.80 to thousands of connected rows, and above 0.85 to one of them only."""
    rng = random.Random(3)
    base, rows = crowd(rng, 3000)
    for _ in range(60):
        own = {p: f"r{rng.randrange(10**9)}" for p in rng.sample(range(3, 400, 6), 6)}
        rows += [edited(base, dict(list(own.items())[:2]) | {p: f"p{rng.randrange(10**9)}" for p in rng.sample(range(0, 400, 6), 1)}), edited(base, own)]
    found = by_id(minhash.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")))
    assert [found[i].component_id for i in range(len(rows))] == brute_components(rows)


def test_minhash_past_connected_rows(spark):
    """In every order 60 rows of one part stand between a row of that part and one of another; all pairs are found."""
    values = lambda last: np.array([last if k % 16 >= 12 else 10 for k in range(128)], np.uint16).tobytes()
    rows = [(0, values(10), 0), *((k, values(20), 0) for k in range(1, 61)), (61, values(30), 61)]
    signed = spark.createDataFrame([(i, bytearray(x), part, 0) for i, x, part in rows], "id long, signature binary, part long, home int")
    for block in (2048, 7):
        found = minhash.apart_candidates(signed, 92, block).collect()
        assert sorted(x for r in found for x in r.lefts) == list(range(61)) and {(r.right, r.right_part, r.part, r.home) for r in found} == {(61, 61, 0, 0)}


def test_minhash_blocks(spark):
    """Rows against blocks of sets: each pair of parts with a link is found, others are not."""
    rng = random.Random(8)
    base, rows = crowd(rng, 30, 2)
    rows += [edited(base, {k: f"x{k}" for k in range(0, 60, 3)}), rows[3] + " end", edited(rows[4].split(), {7: "y"})]
    texts = minhash.keyed(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), "doc_id", "text")
    sets = texts.selectExpr("doc_id as id", "doc_id as first_id", "text_key", "if(doc_id < 30, 0, doc_id) as part", "cast(if(doc_id < 30, doc_id % 3, 0) as int) as home")
    tries = [(right, right, 0, home, [k for k in range(30) if k % 3 == home]) for right in (30, 31, 32) for home in range(3)]
    rest = spark.createDataFrame(tries, "right long, right_part long, part long, home int, lefts array<long>")
    assert sorted(set(map(tuple, minhash.confirm_blocks(rest, sets, texts, 85, 5).collect()))) == [(31, 0), (32, 0)]


def test_minhash_forest_depth(spark):
    """Neighbours with the longest common prefix, whatever the batches: a row is in two pairs of a tree at most."""
    rng = random.Random(9)
    values = [[rng.randrange(3) for _ in range(128)] for _ in range(300)]
    signed = spark.createDataFrame([(i, bytearray(np.array(v, np.uint16).tobytes())) for i, v in enumerate(values)], "id long, signature binary").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = {}
        for size in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found[size] = sorted(map(tuple, minhash.forest_candidates(signed, 0, trees=2, min_depth=2).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = set()
    for tree in range(2):
        # A key is compared as bytes; small values make that the order of the lists, too.
        order = sorted((v[8 * tree : 8 * tree + 64], i) for i, v in enumerate(values))
        common = [next((k for k in range(64) if x[k] != y[k]), 64) for (x, _), (y, _) in zip(order, order[1:])]
        depth = [max(([common[k - 1]] if k else []) + common[k : k + 1]) for k in range(len(order))]
        expected |= {tuple(sorted((order[k][1], order[k + 1][1]))) for k, c in enumerate(common) if c >= 2 and c in (depth[k], depth[k + 1])}
    assert found["7"] == found["10000"] == sorted(expected)


def test_minhash_repeated_ids(spark):
    """Two texts of one id: near copies of either belong to that id; the stage keeps one row of each group."""
    rng = random.Random(10)
    one, two = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(100)) for x in "ab")
    rows = [(5, one, 1), (5, two, 2), (7, one + " more", 3), (8, two + " more", 4), (5, one, 5), (9, "", 6), (9, "", 7), (None, one, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone int").withColumn("_draw", F.col("_gone")).withColumn("key", F.lit(1)).withColumn("ID", F.lit(2))
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert found == [(0, 0, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 5, False), (9, 9, True), (9, 9, True)]
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    kept = sorted(r._gone for r in kept.collect())
    assert kept in ([1, 2, 6, 7, 8], [2, 5, 6, 7, 8])
    assert sorted(r._gone for r in mixing.repeat_documents(docs.withColumn("source", F.lit("a")), max_epochs=1.0).collect() if r._gone < 6) == [1, 2, 3, 4, 5]


def test_pipeline_drops_copies_from_80(spark):
    """Near copies between 0.80 and 0.85 go in the pipeline; below 0.80 they stay."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [" ".join(base), *(edited(base, {p: f"x{p}" for p in range(0, 6 * n, 6)}) for n in (8, 12))]
    sets = [shingles(t) for t in rows]
    similar = [len(sets[0] & s) / len(sets[0] | s) for s in sets]
    assert 0.80 <= similar[1] < 0.85 and similar[2] < 0.80
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame([(0, rows[0]), (1, rows[1]), (3, edited(base, {p: f"y{p}" for p in range(3, 150, 6)}))], "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3]


def test_substrings(docs):
    for limit in (8192, 1):  # 1: every shared prefix is crowded
        found = by_id(suffixes.repeated_substrings(docs, group_limit=limit))
        first, all_words = {}, {i: re.findall(WORD, t or "") for i, t in enumerate(texts())}
        for i, w in all_words.items():
            for k in range(len(w) - 49):
                first.setdefault(tuple(w[k : k + 50]), i)
        for i, w in all_words.items():
            gone = set()
            for k in range(len(w) - 49):
                if first[tuple(w[k : k + 50])] < i:
                    gone |= set(range(k, k + 50))
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
            if gone:
                assert found[i].kept_text == kept


def test_decontamination(spark, docs):
    items = [("q1", texts()[0][50:200]), ("q2", "one two"), ("q3", None), ("q4", ""), (None, texts()[20]), ("q6", texts()[0][50:200].upper())]
    bench = spark.createDataFrame(items, "item_id string, text string")
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = norm(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(item or "")
    for block in (2_000_000, 40):
        found = by_id(fmindex.decontaminate(docs, bench, block_words=block))
        for i, t in enumerate(texts()):
            w, hit, seen = norm(t), set(), set()
            for size in {len(x) for x in windows}:
                for k in range(len(w) - size + 1):
                    if tuple(w[k : k + size]) in windows:
                        hit |= set(range(k, k + size))
                        seen |= windows[tuple(w[k : k + size])]
            assert (found[i].n_words, found[i].n_hit, found[i]["items"]) == (len(w), len(hit), sorted(seen)), i
    kept = fmindex.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.n_hit}
    assert fmindex.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontamination_shards(spark, docs, monkeypatch):
    """Where a shard ends makes no difference; occurrences are located from one suffix in SAMPLE."""
    rng = np.random.default_rng(5)
    text = np.concatenate([np.append(rng.integers(1, 4, rng.integers(1, 40)), 0) for _ in range(60)])
    index = fmindex.FMIndex(text)
    assert len(index.sampled) == -(-len(text) // fmindex.SAMPLE)
    for size in (1, 3, 10):
        phrases = np.unique(rng.integers(1, 5, (200, size)), axis=0)
        expected = [(r, p) for r, x in enumerate(phrases) for p in range(len(text) - size + 1) if (text[p : p + size] == x).all()]
        assert sorted(zip(*(x.tolist() for x in index.search(phrases)))) == expected
    words = fmindex.WaveletMatrix(values := rng.integers(0, 700, 3000), 10)
    for symbol, at in ((3, 0), (3, 3000), (699, 2561), (100, 1024)):
        assert words.rank(np.array([symbol]), np.array([at]))[0] == (values[:at] == symbol).sum()
    batch = pa.RecordBatch.from_pydict({"text": [t or "" for t in texts()]})
    phrases = fmindex.Phrases([("q", texts()[0]), ("r", "one two")], 10)
    seen = []
    for limit in (1, 5_000, 10**9):
        monkeypatch.setattr(fmindex, "SHARD_BYTES", limit)
        monkeypatch.setattr("cinetab.llm.shared.PASS_BYTES", 1000)
        seen.append([(n_, h.tolist(), sorted(i)) for _, n, hit, items in fmindex.searched(iter([batch]), 0, phrases) for n_, h, i in zip(n.tolist(), hit, items)])
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == batch.num_rows and any(any(h) for _, h, _ in seen[0])


def test_decontamination_blocks_by_row(spark):
    """Rows that repeat an id or have none are judged by their own text, with one block and with several."""
    rng = random.Random(6)
    say = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    items = [(f"q{k}", say(30)) for k in range(8)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, say(5)), (1, say(90) + " " + items[0][1]), (None, items[1][1] + " " + say(3)), (None, say(40)), (None, None), (2, items[2][1]), (2, items[2][1])]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    seen = lambda block: sorted(map(repr, fmindex.decontaminate(odd, bench, block_words=block).collect()))
    one, several = seen(2_000_000), seen(40)
    assert len(one) == len(rows) and one == several


def test_rules(docs):
    found = by_id(rules.ledger(docs))
    for i, t in enumerate(texts()):
        t = t or ""
        w, lines = re.findall(WORD, t), [x for x in t.split("\n") if re.search(WORD, x)]
        n = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if n[tuple(w[k : k + 5])] > 1 for j in range(5)}
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
        )
        assert bool(r.failed & 1) == (len(w) < 10) and bool(r.failed & 2) == (100 * len(covered) > 20 * len(w))
    table = {r.rule: r for r in rules.ablation(rules.ledger(docs), 1).collect()}
    whole = rules.mask(rules.POLICIES[1])
    failed = [r.failed & whole for r in found.values()]
    for k, rule in enumerate(rules.RULES):
        if whole >> k & 1:
            assert table[rule.name].failing == sum(f >> k & 1 for f in failed)
            assert table[rule.name].only_this == sum(f == 1 << k for f in failed)
            assert table[rule.name].rejected_without == sum(f & ~(1 << k) != 0 for f in failed)


def test_secrets(docs):
    found = by_id(secrets.find_secrets(docs))
    kinds = [x.kind for x in found[13].found]
    assert kinds.count("assign") == 1 and kinds.count("access") == 1 and kinds.count("hex") == 1
    text = texts()[13]
    assert [text[x.start : x.end] for x in found[13].found if x.kind == "assign"] == ["password: hunter22"]
    assert found[4].found == [] and found[3].found == []


def plain_secrets(text):
    """Spans (start, rank, end) as find_secrets means them, with each window's entropy from fresh counts."""
    found = [(m.start(), 0, m.end()) for m in re.finditer("(?a)" + secrets.ASSIGN.replace("(?i)", "", 1), text, re.I) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for m in re.finditer(secrets.CANDIDATE, text):
        if any(re.search(p, m[0]) for p in secrets.ALLOWED):
            continue
        bits = next(v for k, v in secrets.CLASSES.items() if re.search(k, m[0]))
        entropy = [sum(-c / 20 * math.log2(c / 20) for c in collections.Counter(m[0][k : k + 20]).values()) for k in range(len(m[0]) - 19)]
        if hot := [k for k, e in enumerate(entropy) if e >= bits]:
            found.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
    return sorted(found)


def test_secrets_brute_force(spark):
    rng = random.Random(11)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    pieces = [
        lambda: rng.choice(["password", "Api_Key", "APIKEY", "token", "seCret", "passwd"]) + rng.choice(["=", ": ", '" : "', "' ='", " "]) + draw("aZ9+/_.=-", rng.randrange(3, 12)),
        lambda: "AKIA" + draw("ABCXYZ0189", rng.randrange(12, 24)), lambda: draw("0123456789abcdef", rng.randrange(18, 40)), lambda: draw(secrets.ALPHABET, rng.randrange(15, 60)),
        lambda: draw("ab", 30) + draw(secrets.ALPHABET, 25) + draw("ab", 30), lambda: "é日😀" + draw("xyz", 3), lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: draw("ABCDEF0123456789", 28), lambda: "example" + draw(secrets.ALPHABET, 30),
    ]
    made = ["".join(rng.choice(pieces)() + rng.choice([" ", "\n", "", ","]) for _ in range(rng.randrange(0, 14))) for _ in range(150)]
    found = by_id(secrets.find_secrets(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")))
    for i, text in enumerate(made):
        assert [(x.start, x.rank, x.end) for x in found[i].found] == plain_secrets(text), text


def test_secrets_many_in_one_text(spark):
    """Positions after thousands of matches; time grows with the text and not with its square."""
    text = " ".join(f"{k:024x} AKIA{k:016d} token={k:08d}" for k in range(6000))
    found = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().found
    assert [(x.start, x.rank, x.end) for x in found if x.kind != "entropy"] == [x for x in plain_secrets(text) if x[1] < 3]


def plain_shard(key, weights):
    """The shard of the earliest attempt that stands, region by region, layer by layer, attempt by attempt, without any bound."""
    best = (math.inf, None)
    for region in range(-(-len(weights) // 12)):
        for layer in range(8):
            low, high = (2.0 ** (layer - 1) if layer else 0.0), 2.0**layer
            at, attempt = 0.0, 1
            while any(w > low for w in weights[region * 12 : region * 12 + 12]):
                h = hashlib.md5(f"{key}:{region}{f'+{layer}' if layer else ''}:{attempt}".encode()).hexdigest()
                at -= math.log((int(h[:15], 16) + 0.5) / 2**60) / (12 * (high - low))
                leaf = region * 12 + int(h[15:21], 16) * 3 // 2**24 * 4 + int(h[21:27], 16) * 4 // 2**24
                if at >= best[0]:
                    break
                if leaf < len(weights) and int(h[27:], 16) / 2**20 * (high - low) < weights[leaf] - low:
                    best = (at, leaf)
                    break
                attempt += 1
    return best[1]


def test_shards_by_plain_descent(spark):
    keys = spark.range(2000)
    for weights in ((1,) * 24, (1,) * 31, (2, 0, 1, 3, 0, 0, 0, 0, 1.5, 1, 1, 1, 0.5)):
        found = sharding.assign_shard(keys, "id", len(weights), "out", weights=weights).collect()
        assert [r.out for r in found] == [plain_shard(r.id, weights) for r in found]
    odd = spark.createDataFrame([(None, 1, 2), (3, 1, 2)], "id long, draws int, region int")
    assert sharding.assign_shard(odd, "id", 24, "out").columns == ["id", "draws", "region", "out"]
    with pytest.raises(ValueError):
        sharding.assign_shard(keys, "id", 3, "out", weights=(1, 1))


def test_sharding(docs):
    found = sharding.shard(docs, 24, buckets=4).collect()
    slots = collections.defaultdict(list)
    for r in found:
        t = texts()[r.doc_id] or ""
        assert r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode())
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(docs.limit(0), 24).count() == 0


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20_000)
    counts = (1, 2, 3, 5, 6, 12, 13, 24, 25, 26, 35, 36, 37, 59, 60)
    for n in counts:
        df = sharding.assign_shard(df, "id", n, f"n{n}")
    rows = df.collect()
    for a, b in zip(counts, counts[1:]):
        if b == a + 1:
            moved = [r[f"n{b}"] for r in rows if r[f"n{a}"] != r[f"n{b}"]]
            assert set(moved) == {a} and 0.7 < len(moved) * b / len(rows) < 1.3
    share = collections.Counter(r.n24 for r in rows)
    assert len(share) == 24 and all(600 < n < 1100 for n in share.values())


def test_weights_confine_movement(spark):
    """A heavier shard takes rows from all, a lighter one gives rows to all; others exchange none."""
    before, after = [1.0] * 24, [1.0] * 24
    after[7], after[20] = 3.0, 0.25
    df = sharding.assign_shard(sharding.assign_shard(spark.range(20_000), "id", 24, "a", weights=tuple(before)), "id", 24, "b", weights=tuple(after))
    moved = df.where("a <> b").select("a", "b").distinct().collect()
    assert moved and all(r.b == 7 or r.a == 20 for r in moved)


def test_mixing(docs):
    found = mixing.mix(docs, buckets=4).collect()
    size = collections.Counter()
    for r in found:
        assert r.size == len(re.findall(WORD, texts()[r.doc_id] or "")) and r.taken <= 3 * r.size and r.taken == r.times * r.size + r.part
        size[r.source] += r.size
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, capped, total = {s: 1 + k % 3 for k, s in enumerate(order)}, set(), sum(size.values())
    while True:
        level = (total - sum(3 * size[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        more = {s for s in order if s not in capped and level * weight[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    for s in order:
        target = 3 * size[s] if s in capped else level * weight[s]
        mine = [r for r in found if r.source == s]
        assert abs(mine[0].target - target) < 1e-6 and abs(sum(r.taken for r in mine) - target) <= 1
    assert mixing.repeat_documents(docs).columns == docs.columns


def test_rans_parts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 1000, 200_000):
        s = np.minimum(rng.geometric(0.05, n) - 1, 99)
        table = rans.Table(np.bincount(s, minlength=100))
        block = rans.encode(s, table)
        assert (rans.decode(block, table) == s).all()
        assert (np.concatenate([rans.decode(block, table, k) for k in range(rans.parts(block))]) == s).all()
    with pytest.raises(ValueError):
        rans.decode(block[:-1] + bytes([block[-1] ^ 1]), table)


def test_tokens(docs):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for r in sorted(tokens.token_output(docs, queries.TOKENIZER, ids=True).collect(), key=lambda r: r.doc_id):
        ids = np.array([*whole.encode(texts()[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r["ids"])) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += r.n_tokens
    assert tokens.token_output(docs.limit(0), queries.TOKENIZER).count() == 0


def test_token_range(spark, docs, monkeypatch, tmp_path):
    """Any range of ids, decoded from the checkpoints around it alone."""
    tokens.write_tokens(docs, str(tmp_path / "ids"), queries.TOKENIZER)
    whole = b"".join(bytes(r["ids"]) for r in tokens.read_tokens(spark, str(tmp_path / "ids")).orderBy("start").collect())
    n = len(whole) // 4
    for first, count in ((0, 10), (n - 5, 50), (123, 70_000 % n), (n // 2, 1), (n, 5), (0, n)):
        found = sorted((r.start, bytes(r["ids"])) for r in tokens.token_range(spark, str(tmp_path / "ids"), first, count).collect())
        assert b"".join(x for _, x in found) == whole[4 * first : 4 * (first + count)]
        assert not found or found[0][0] == first


def test_tokenizer_pieces():
    coder, whole = tokens.PieceTokenizer(queries.TOKENIZER), Tokenizer.from_file(queries.TOKENIZER)
    assert coder.by_piece
    for t in ("x\x1cy \x85 z", "a\u0301 \U0001f600 b", "I'LL don't 'tis", "1\u00b2 \u2167 3", "x" * 3000, "a  b", "\n x\n\n y", " lead", "tail ", "a\r b", "x <|endoftext|> y", "tab\tz q", "é 日本", "a\xa0 b", "it's we'll  ", " ", "a\n b", "a \nb"):
        assert coder.encode([t])[0] == np.array(whole.encode(t, add_special_tokens=False).ids, coder.kind).tobytes(), t
    other, whole = (make(public_tokenizers.path("word_bpe_49k.json")) for make in (tokens.PieceTokenizer, Tokenizer.from_file))
    assert not other.by_piece and other.encode(["An <|endoftext|> It"])[0] == np.array(whole.encode("An <|endoftext|> It", add_special_tokens=False).ids, other.kind).tobytes()


def test_tokenizer_pieces_of_many_texts():
    """Texts of one call, cut together, have the ids that the library gives each of them alone."""
    coder, whole, rng = tokens.PieceTokenizer(queries.TOKENIZER), Tokenizer.from_file(queries.TOKENIZER), random.Random(6)
    marks = ["'", " ", "  ", "\n", "\t", "\xa0", "s", "S", "t", "d", "m", "r", "v", "e", "l", "1", "\u00b2", "\u0663", ".", "\u2014", "\u00ad", "\u00e9", "\u65e5", "\ud55c", "\U0001f600", "<|endoftext|>"]
    for few in (marks, marks[:-2], marks[:2] + marks[6:15], marks[:6] + ["e"]):
        for _ in range(150):
            group = ["".join(rng.choices(few, k=rng.randrange(12))) for _ in range(rng.randrange(1, 12))]
            assert coder.encode(group) == [np.array(whole.encode(t, add_special_tokens=False).ids, coder.kind).tobytes() for t in group], group
    assert coder.encode([]) == []


def test_tokenizer_looks_distinct_pieces_up():
    """A call looks each distinct piece up once, however often its texts hold it."""
    coder = tokens.PieceTokenizer(queries.TOKENIZER)
    assert coder.by_piece
    looked_up = []

    class Counted(type(coder.pieces)):
        def __getitem__(self, piece):
            looked_up.append(piece)
            return super().__getitem__(piece)

    coder.pieces = Counted(coder.tokenizer.model, coder.pieces.code)
    found = coder.encode([" one two one"] * 500 + ["", " two \u00e9t\u00e9"])
    assert sorted(looked_up) == sorted(x.encode() for x in (" one", " two", " \u00e9t\u00e9"))
    assert found[0] == np.array(coder.tokenizer.encode(" one two one", add_special_tokens=False).ids, coder.kind).tobytes() == found[499] and found[500] == b""


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op2_quality(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in found) / len(found) > 0.98


def test_quality_by_plain_discriminant(spark, docs):
    """Scores from sums over tasks against means and covariances of all rows at once."""
    rng = random.Random(13)
    labels = spark.createDataFrame([(i, rng.randrange(2)) for i in range(0, 50, 1)] + [(3, 1), (3, 0), (4, None), (5, 7), (None, 1)], "doc_id long, quality int")
    described = {r.doc_id: np.array(r.x) for r in quality.describe(docs).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in described}
    marks = sorted({(r.doc_id, r.quality) for r in labels.collect() if r.doc_id in described and r.quality in (0, 1) and not held[r.doc_id]})
    words = {i: math.expm1(x[0]) for i, x in described.items()}
    good = [i for i, q in marks if q == 1]
    ordinary = sum(words[i] * described[i] for i in good) / sum(words[i] for i in good)
    described = {i: np.concatenate([x[:1], (words[i] * x[1:] + 15 * ordinary[1:]) / (words[i] + 15)]) for i, x in described.items()}
    classes = [np.stack([described[i] for i, q in marks if q == k]) for k in (0, 1)]
    pooled = sum((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) for x in classes) / len(marks)
    density = {}
    for k, x in enumerate(classes):
        own = 0.8 * np.cov(x.T, bias=True) + 0.2 * pooled
        own = 0.9 * own + 0.1 * np.diag(np.diag(own)) + 1e-4 * np.eye(len(own))
        for i, y in described.items():
            away = y - x.mean(axis=0)
            density[i, k] = -0.5 * (away @ np.linalg.inv(own) @ away + np.linalg.slogdet(own)[1]) + math.log(len(x) + 1)
    found = by_id(quality.classify(docs, labels))
    assert len(found) == len(described)
    for i, r in found.items():
        score = 1 / (1 + math.exp(-max(-700, min(700, density[i, 1] - density[i, 0]))))
        assert abs(r.score - score) < 1e-6 and r.held_out == held[i] and r.predicted == int(r.score >= 0.3)


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}


def test_tool_calls(spark):
    calls = [(1, "a", "f", '{"x":1}', []), (1, "b", "f", '{"x":"no"}', ["a"]), (1, "c", "f", '{"x":2}', ["b", "a"]), (1, "d", "g", "{}", ["zz"]), (1, "e", "f", "oops", ["e"])]
    calls += [(1, "p", "f", '{"x":1}', ["q"]), (1, "q", "f", '{"x":1}', ["p"]), (2, "a", "f", '{"x":1}', []), (None, "n", "f", "{}", None), (1, "a", "f", '{"x":1}', [])]
    calls = spark.createDataFrame(calls, "conv_id long, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([(1, x, "r" + x) for x in "abcdepq"], "conv_id long, call_id string, result string")
    found = {(r.conv_id, r.call_id): r for r in toolcalls.link_calls(calls, results, {"f": {"required": ["x"], "properties": {"x": {"type": "integer"}}}}).collect()}
    status = {k: r.status for k, r in found.items()}
    assert status == {
        (1, "a"): "ok", (1, "b"): "invalid", (1, "c"): "ok", (1, "d"): "missing_need", (1, "e"): "cyclic", (1, "p"): "cyclic", (1, "q"): "cyclic", (2, "a"): "no_result",
    }
    assert [found[1, x].depth for x in "abce"] == [0, 1, 2, None]
    assert sorted(r.place for k, r in found.items() if k[0] == 1) == list(range(7)) and found[1, "c"].place > found[1, "b"].place > found[1, "a"].place
    assert found[1, "a"].message == '{"arguments":{"x":1},"id":"a","name":"f","result":"ra"}'


def plain_levels(edges):
    """Longest path of needs by recursion with a colour for nodes on the way; None in or above a cycle."""
    needs = collections.defaultdict(set)
    for a, b in edges:
        needs[a].add(b)
        needs[b]
    depth = {}
    while True:
        ready = [n for n in needs if n not in depth and all(b in depth for b in needs[n])]
        if not ready:
            return {n: depth.get(n) for n in needs}
        depth |= {n: max((depth[b] + 1 for b in needs[n]), default=0) for n in ready}


def test_levels_brute_force(spark):
    """Chains, trees, random graphs with and without cycles, and a crowd that needs one root."""
    rng = random.Random(12)
    edges = [(k, k - 1) for k in range(1, 400)] + [(1000 + k, 1000) for k in range(1, 300)] + [(2001, 2002), (2002, 2003), (2003, 2001), (2004, 2001), (2005, 2004), (2005, 2006)]
    edges += [(3000 + a, 3000 + rng.randrange(a)) for a in range(1, 60) for _ in range(rng.randrange(3))]
    edges += [(4000 + rng.randrange(60), 4000 + rng.randrange(60)) for _ in range(70)]
    edges += [(5001, 5002), (5001, 5003), (5002, 5001), (5002, 5003), (5003, 5001), (5003, 5002), (5004, 5001)]
    edges = [(a, b) for a, b in edges if a != b]
    found = toolcalls._levels(spark.createDataFrame(edges, "node long, needs long")).collect()
    assert len(found) == len({r.node for r in found}) and all(r.cyclic == (r.depth is None) for r in found)
    assert {r.node: r.depth for r in found} == plain_levels(edges)


def test_tool_call_arguments(spark):
    """Texts that are not JSON, or that cannot be written back, are named so; long ones and odd columns do no harm."""
    texts_ = ["[" * 100_000, '{"x":"\\ud800"}', '{"x":NaN}', '{"x":1e999}', '{"x":' + "9" * 5000 + "}", None, "", '{"x":1,"x":2}', '{"b":"é","x":1}', '{"x":"' + "w" * 3_000_000 + '"}']
    calls = spark.createDataFrame([(1, f"c{k}", "f", t, None, 0) for k, t in enumerate(texts_)], "conv_id long, call_id string, name string, arguments string, needs array<string>, node int")
    results = spark.createDataFrame([(1, f"c{k}", "r", 1) for k in range(len(texts_))] + [(1, "c7", "q", 2)], "conv_id long, call_id string, result string, node int")
    found = {r.call_id: r for r in toolcalls.link_calls(calls, results, {"f": {"required": ["x"], "properties": {"x": {}, "b": {}}}}).collect()}
    assert [found[f"c{k}"].errors for k in range(7)] == ["not JSON"] * 7 and [found[f"c{k}"].status for k in (0, 7, 8, 9)] == ["invalid", "ok", "ok", "ok"]
    assert found["c7"].message == '{"arguments":{"x":2},"id":"c7","name":"f","result":"q"}' and '"b":"é"' in found["c8"].message
    assert json.loads(found["c0"].message)["arguments"] is None and len(found["c9"].message) > 3_000_000


def test_tool_call_query(spark):
    """The query against a plain version, on its whole table."""
    sf = "/root/testdata/sf0.001"
    found = {(r.conv_id, r.call_id): r for r in queries.op7_toolcalls(spark, sf).collect()}
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{sf}/conversations.parquet").withColumn("number", F.expr("pmod(xxhash64(conv_id, turn), 1000)")).collect()}
    calls = {k: r for k, r in turns.items() if r.role == "assistant"}
    edges, lost = [], set()
    for (conv, turn), r in calls.items():
        needs = {turn - 2} if turn >= 2 else set()
        needs |= {1} if turn > 3 and r.number % 8 == 0 else set()
        needs |= {turn + 2} if r.number == 502 else set()
        if r.number == 501 or any((conv, n) not in calls for n in needs):
            lost.add((conv, turn))
        edges += [((conv, turn), (conv, n)) for n in needs if (conv, n) in calls]
    depth = plain_levels(edges)
    assert set(found) == {(c, f"call-{t}") for c, t in calls}
    for (conv, turn), r in calls.items():
        mine = found[conv, f"call-{turn}"]
        words = re.findall(r"[^ \t\n\x0b\f\r]+", r.text or "")
        answer = turns.get((conv, turn + 1))
        answered = answer is not None and answer.role == "user"
        wrong = len(words) % 7 == 0 and len(words) % 2 == 1 or len(words) % 2 == 0 and turn % 5 == 4
        level = depth.get((conv, turn), 0)
        assert mine.depth == level
        assert mine.status == ("cyclic" if level is None else "missing_need" if (conv, turn) in lost else "no_result" if not answered else "invalid" if wrong else "ok")
        message = json.loads(mine.message)
        assert message["arguments"]["terms"] == words and message["result"] == ((answer.text or "") if answered else None)
    for conv in {c for c, _ in calls}:
        rows = sorted((r.place, float("inf") if r.depth is None else r.depth) for (c, _), r in found.items() if c == conv)
        assert [p for p, _ in rows] == list(range(len(rows))) and [d for _, d in rows] == sorted(d for _, d in rows)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels, bench = spark.createDataFrame([(1, 1)], "doc_id long, quality int"), spark.createDataFrame([("q", "one two")], "item_id string, text string")
    calls = spark.createDataFrame([], "conv_id long, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, result string")
    for out in (
        minhash.near_duplicates(none), minhash.drop_near_duplicates(none), suffixes.repeated_substrings(none), rules.ledger(none), secrets.find_secrets(none), mixing.mix(none),
        mixing.repeat_documents(none), quality.classify(none, labels), quality.keep_good(none, labels), fmindex.decontaminate(none, bench), fmindex.drop_contaminated(none, bench),
        toolcalls.link_calls(calls, results, {}), tokens.token_output(none, queries.TOKENIZER), sharding.shard(none),
    ):
        assert out.count() == 0


PIPE = "doc_id long, text string, lang string, source string, n_chars long, _gone int, draw string"


def plain_pipeline(rows, labels, items, good):
    """The ids that stay after each stage, and the copies of the mix, by brute force; ``good`` are those that the classifier keeps."""
    stay = [r for r in rows if r[0] in good]
    after = [{r[0] for r in stay}]
    sets = {r[0]: shingles(r[1]) for r in stay}
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    group = components(pairs, sets)
    stay = [r for r in stay if group[r[0]] == r[0]]
    after.append({r[0] for r in stay})
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for _, text in items:
        w = norm(text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    stay = [r for r in stay if not hit(norm(r[1]))]
    after.append({r[0] for r in stay})
    return after, stay


def test_pipeline(spark, tmp_path, monkeypatch):
    """The ids after each stage, the mix's copies and the token files' rows, against brute force; nothing is left behind but token files."""
    rng = random.Random(14)
    say = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    base, items = say(120), [("q1", say(30)), ("q2", say(6))]
    rows = [(0, base), (1, base), (2, base + " end"), (3, None), (4, "  "), (5, items[0][1]), (6, say(40) + " " + items[0][1][:90] + " " + say(9)), (7, items[1][1]), (8, "x " * 300)]
    rows += [(9 + k, say(rng.randrange(5, 200))) for k in range(60)]
    rows += [(70 + k, edited(rows[20 + k][1].split(), {1: "changed"})) for k in range(4)]
    rows += [(80 + k, " ".join(rng.choice(["#$%", "***", "9|9", "<<>>", say(1)]) for _ in range(rng.randrange(10, 90)))) for k in range(25)]
    rows = [(i, t, "en", [None, "a", "b", "b"][i % 4], len(t or ""), 1, "z") for i, t in rows]
    labels = [(r[0], int(r[0] < 80)) for r in rows]
    for name, data, schema in (("documents", rows, PIPE), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id string, text string")):
        spark.createDataFrame([(*r, 0) for r in data] if name == "labels" else data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert {0, 1, 2, 5, 6} <= good and 60 < len(good) < 90
    after, stay = plain_pipeline(rows, labels, items, good)
    table = docs
    for (name, stage), ids in zip(corpus_pipeline.STAGES, after):
        table = stage(spark, table, sf)
        assert table.columns == docs.columns and sorted(r.doc_id for r in table.collect()) == sorted(ids), name
    mixed = corpus_pipeline.STAGES[3][1](spark, table, sf)
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    plan = {r.doc_id: r.times + (r.part > 0 and 2 * r.part >= max(r.size, 1)) for r in mixing.mix(table).collect()}
    assert mixed.columns == docs.columns and copies == collections.Counter({i: n for i, n in plan.items() if n})
    whole, text = Tokenizer.from_file(queries.TOKENIZER), {r[0]: r[1] for r in rows}
    expected, start = [], 0
    for i in sorted(copies.elements()):
        ids = np.array([*whole.encode(text[i] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        expected.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    shared = tmp_path / "shared"
    for module in ("shared", "tokens"):
        monkeypatch.setattr(f"cinetab.llm.{module}.scratch_folder", lambda spark: str(shared))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == expected
    assert [p.name.split("-")[0] for p in shared.iterdir()] == ["token"]
    # No rows at all.
    empty = tmp_path / "empty"
    for name, schema in (("documents", PIPE), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id string, text string")):
        spark.createDataFrame([], schema).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_repeated_and_null_ids(spark, docs):
    odd = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, texts()[0], None, 1, "", "")] * 2, SCHEMA))
    n = odd.count()
    labels, bench = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1)], "doc_id long, quality int"), spark.createDataFrame([("q", "one two"), ("q", "one two"), (None, None)], "item_id string, text string")
    for out in (
        minhash.near_duplicates(odd), suffixes.repeated_substrings(odd), rules.ledger(odd), secrets.find_secrets(odd), mixing.mix(odd), sharding.shard(odd), tokens.token_output(odd, queries.TOKENIZER),
        quality.classify(odd, labels), fmindex.decontaminate(odd, bench), fmindex.decontaminate(odd, bench, block_words=1),
    ):
        assert out.count() == n
