"""Substring deduplication by prefix-partitioned suffix trees.

Where a window of words repeats, so does everything in it. So not every suffix needs a place in a tree: of
each window only one starts, at the window's *anchor*, the half-window phrase in it that is smallest by hash.
The suffix's prefix, that phrase, deals the suffixes into groups; those whose prefix one document alone has
are left out. A suffix brings along the words of its windows, so that a group's subtree can be built where
the group is: word ids, ranks of all positions by prefix doubling, windows in the order of their words, the
common-prefix length of neighbours, and from it the internal nodes of ``window`` words or more. All
documents of such a node but the smallest repeat it.

Prefixes have variable length: one with more than ``group_limit`` suffixes is lengthened to whole windows, each
of them a node, and reduced to its smallest document by a partial aggregate, so that no group grows with the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import PLAIN, Words, binaries, materialize, mix64, ngram_hashes, operator, passes

#: Words that a subtree pass indexes at once; a larger group forms a pass of its own.
PASS_WORDS = 400_000


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each window's anchor (the leftmost of equal ones), and the hashes of all phrases, for one text."""
    phrase = window // 2
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = ngram_hashes(words, phrase)

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)

    span = window - phrase + 1
    # Sliding minimum in log steps: the minimum of 2**k neighbours, then of two overlapping blocks.
    least, width = np.arange(len(grams)), 1
    while width * 2 <= span:
        least = better(least[:-width], least[width:])
        width *= 2
    if rest := span - width:
        least = better(least[: len(least) - rest], least[rest:])
    return least, grams


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins and ends."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_key); the key tells rows apart that repeat an id with another text."""
    text = F.col(text_col).cast("string")
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def survey(documents: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(doc_id, text_key, n_words, full_sha256, seq_a, seq_b, anchors) of each row.

    seq_a and seq_b name the word sequence; ``anchors`` are the prefixes of its sampled suffixes, with repeats.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in passes(batch.column(1)):
                words = Words(data, bounds, PLAIN)
                counts = words.counts()
                place = np.arange(len(words.hashes), dtype=np.uint64) - np.repeat(words.first[:-1], counts).astype(np.uint64)
                names = []
                for salt in (21, 22):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(words.hashes + mix64(place + np.uint64(salt << 32))))])
                    names.append((total[words.first[1:]] - total[words.first[:-1]]).view(np.int64))
                raw = data.tobytes()
                shas = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                found = []
                for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                    place, grams = anchors(words.hashes[a:b], window)
                    found.append(grams[place[runs(place)[0]]])
                sizes = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(2).slice(row, end - row), pa.array(counts.astype(np.int64)), pa.array(shas),
                     pa.array(names[0]), pa.array(names[1]), lists],
                    ["doc_id", "text_key", "n_words", "full_sha256", "seq_a", "seq_b", "anchors"],
                )

    return keyed(documents, id_col, text_col).mapInArrow(work, "doc_id long, text_key long, n_words long, full_sha256 string, seq_a long, seq_b long, anchors array<long>")


def suffixes(candidates: DataFrame, window: int) -> DataFrame:
    """(prefix, crowded, doc_id, text_key, at, windows, words, nodes): each text's sampled suffixes under a shared prefix.

    ``candidates``: (doc_id, text, shared array<long>, crowded array<boolean>, text_key). A suffix stands for
    ``windows`` windows from word ``at`` on; it has their words, or their hashes (``nodes``) under a crowded prefix.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shared, crowded, keys = (batch.column(i) for i in (0, 2, 3, 4))
            for row, end, data, bounds in passes(batch.column(1)):
                words, raw = Words(data, bounds, PLAIN), data.tobytes()
                out: list[list] = [[] for _ in _SUFFIX]
                for i in range(row, end):
                    a, b = words.first[i - row], words.first[i - row + 1]
                    place, grams = anchors(words.hashes[a:b], window)
                    wanted = shared[i].values.to_numpy().view(np.uint64)
                    full = crowded[i].values.to_numpy(zero_copy_only=False)
                    order = np.argsort(wanted)
                    wanted, full = wanted[order], full[order]
                    begin, stop = runs(place)
                    prefix = grams[place[begin]] if len(begin) else np.zeros(0, np.uint64)
                    at = np.minimum(np.searchsorted(wanted, prefix), len(wanted) - 1)
                    node = ngram_hashes(words.hashes[a:b], window, seed=2) if full.any() else None
                    for k in np.flatnonzero(wanted[at] == prefix).tolist():
                        x, y, long = int(begin[k]), int(stop[k]), bool(full[at[k]])
                        text = None if long else raw[words.begins[a + x] : words.ends[a + y + window - 2]]
                        values = (int(prefix[k].view(np.int64)), long, ids[i].as_py(), keys[i].as_py(), x, y - x, text, node[x:y].tobytes() if long else None)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _SUFFIX, strict=True)], schema=_SUFFIX)

    return candidates.select("doc_id", "text", "shared", "crowded", "text_key").mapInArrow(
        work, "prefix long, crowded boolean, doc_id long, text_key long, at int, windows int, words binary, nodes binary"
    )


_SUFFIX = pa.schema(
    [("prefix", pa.int64()), ("crowded", pa.bool_()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("windows", pa.int32()),
     ("words", pa.binary()), ("nodes", pa.binary())]
)


class Subtrees:
    """The suffix trees of some groups, cut at ``window`` words: all their windows in order, and common prefixes of neighbours.

    ``texts`` holds each suffix's words and ``group`` the number of its group; windows of different groups share nothing.
    ``windows`` says how many windows start in each text. ``suffix`` and ``start`` name the windows in the order
    of their words, ``common`` counts the words that each shares with the window before it.
    """

    def __init__(self, texts: list[bytes], group: np.ndarray, windows: np.ndarray, window: int):
        split = [x.split() for x in texts]
        sizes = np.array([len(x) for x in split])
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for x in split for w in x], np.int64)
        first = np.cumsum(sizes) - sizes
        # ranks[k]: positions by their next 2**k words, equal ranks for equal words; positions with fewer words left have none.
        left = np.repeat(first + sizes, sizes) - np.arange(len(ids))
        ranks, width = [np.unique(np.repeat(group, sizes) * len(number) + ids, return_inverse=True)[1]], 1
        while width * 2 <= window:
            last, both = ranks[-1], np.flatnonzero(left >= 2 * width)
            rank = np.full(len(ids), -1)
            rank[both] = np.unique(last[both] * len(ids) + last[both + width], return_inverse=True)[1]
            ranks.append(rank)
            width *= 2
        suffix = np.repeat(np.arange(len(texts)), windows)
        start = np.arange(len(suffix)) - np.repeat(np.cumsum(windows) - windows, windows)
        place = first[suffix] + start
        # Two overlapping ranges of 2**k words cover the window.
        order = np.lexsort((ranks[-1][place + window - width], ranks[-1][place]))
        self.suffix, self.start, place = suffix[order], start[order], place[order]
        self.common = np.zeros(len(place), np.int64)
        a, b, common = place[:-1], place[1:], self.common[1:]
        for k in range(len(ranks) - 1, -1, -1):  # a window has fewer than 2 * width words, so each step is taken once at most
            fits = common + (1 << k) <= window
            step = np.where(fits, common, 0)
            common += ((ranks[k][a + step] == ranks[k][b + step]) & fits).astype(np.int64) << k

    def nodes(self, depth: int) -> np.ndarray:
        """The number of the node of ``depth`` words that each window belongs to."""
        return np.cumsum(self.common < depth)


def subtree_repeats(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_key, places) of windows whose node holds a smaller doc_id, from groups of one prefix each."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        prefix, doc, at, windows = (table.column(k).to_numpy() for k in (0, 1, 3, 4))
        tree = Subtrees(table.column(5).to_pylist(), np.cumsum(np.concatenate([[0], prefix[1:] != prefix[:-1]])), windows, window)
        node = tree.nodes(window)
        least = np.full(node.max(initial=0) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc[tree.suffix])
        late = np.flatnonzero(doc[tree.suffix] > least[node])
        row, place = tree.suffix[late], at[tree.suffix[late]] + tree.start[late]
        order = np.argsort(row, kind="stable")
        row, place = row[order], place[order].astype(np.int32)
        begin, stop = runs(row)
        columns = [pa.array(table.column(k).to_numpy()[row[begin]]) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([*columns, binaries([place[a:b] for a, b in zip(begin, stop, strict=True)])], ["doc_id", "text_key", "places"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.column(5).nbytes
            if size >= 7 * PASS_WORDS:
                table = pa.Table.from_batches(held)
                prefix = table.column(0).to_numpy()
                cut = int(np.searchsorted(prefix, prefix[-1]))  # the last group may go on
                if cut:
                    yield solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(x.column(5).nbytes for x in held)
        if held:
            yield solve(pa.Table.from_batches(held))

    rows = rows.select("prefix", "doc_id", "text_key", "at", "windows", "words").repartition("prefix").sortWithinPartitions("prefix")
    return rows.mapInArrow(work, "doc_id long, text_key long, places binary")


def crowded_repeats(rows: DataFrame) -> DataFrame:
    """As subtree_repeats, for prefixes that are lengthened to whole windows; a node is named by prefix and window, 128 bits.

    A batch's windows of one node go in one row, before and after the join, so that a hot node is a few rows a task.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, windows = (batch.column(k).to_numpy() for k in (3, 4))
            prefix, doc, key = (np.repeat(batch.column(k).to_numpy(), windows) for k in (0, 1, 2))
            place = (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(at, windows)).astype(np.int32)
            node = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.int64)
            order = np.lexsort((doc, node, prefix))
            prefix, doc, key, place, node = (x[order] for x in (prefix, doc, key, place, node))
            begin = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (prefix[1:] != prefix[:-1])]))
            stop = np.append(begin[1:], len(node))
            parts = [binaries([x[a:b] for a, b in zip(begin, stop, strict=True)]) for x in (doc, key, place)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x) for x in (prefix[begin], node[begin], doc[begin], doc[stop - 1])], *parts], ["prefix", "node", "lo", "hi", "docs", "keys", "places"]
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [batch.column(k).to_pylist() for k in (1, 2, 3)]
            least = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in raw[0]])
            doc, key, place = (np.frombuffer(b"".join(x), kind) for x, kind in zip(raw, (np.int64, np.int64, np.int32), strict=True))
            late = np.flatnonzero(doc > least)
            late = late[np.lexsort((key[late], doc[late]))]
            doc, key, place = doc[late], key[late], place[late]
            begin = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
            stop = np.append(begin[1:], len(doc)) if len(doc) else begin
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[begin]), pa.array(key[begin]), binaries([place[a:b] for a, b in zip(begin, stop, strict=True)])], ["doc_id", "text_key", "places"]
            )

    single = rows.select("prefix", "doc_id", "text_key", "at", "windows", "nodes")
    single = single.mapInArrow(spread, "prefix long, node long, lo long, hi long, docs binary, keys binary, places binary")
    node = ["prefix", "node"]
    least = materialize(single.groupBy(*node).agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least < most"), "nodes")
    late = single.join(least.select(*node, "least"), node).where("hi > least").select("least", "docs", "keys", "places")
    return late.mapInArrow(pack, "doc_id long, text_key long, places binary")


def cut_repeats(candidates: DataFrame, repeats: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_key, n_removed, kept_sha256, kept_text, spans) of texts with repeats; spans are word ranges, merged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = (text or "").encode().split()
                step = np.zeros(len(words) + 1, np.int32)
                start = np.unique(np.frombuffer(b"".join(places), np.int32))
                np.add.at(step, start, 1)
                np.add.at(step, start + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                out[0].append(int(gone.sum()))
                out[1].append(hashlib.sha256(kept).hexdigest())
                out[2].append(kept.decode())
                out[3].append(edge.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                 pa.array(out[3], pa.list_(pa.int64()))], ["doc_id", "text_key", "n_removed", "kept_sha256", "kept_text", "spans"],
            )

    key = ["doc_id", "text_key"]
    grouped = repeats.groupBy(*key).agg(F.collect_list("places").alias("places"))
    return candidates.select(*key, "text").join(grouped, key).select(*key, "text", "places").mapInArrow(
        work, "doc_id long, text_key long, n_removed long, kept_sha256 string, kept_text string, spans array<long>"
    )


@operator
def repeated_substrings(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, group_limit: int = 8192, texts: bool = True
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans[, kept_text]) for every row of ``documents``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``window`` words over it also
    starts in a document with a smaller id, judged on the input. ``spans`` are the removed word ranges
    (begin, end, begin, end, ...). A text whose whole word sequence a smaller id has loses all its words
    (if it has a window) and takes no part in the search, so copies cost one row each.

    A group of ``group_limit`` suffixes has some 4 MB of words, and its subtree takes some 100 MB in a task.

    ``kept_text`` (with ``texts``) is null where nothing is removed. Null or blank texts: no words, the
    hash of nothing. Null ids: nothing is removed from them or on account of them. Rows that repeat an id
    never remove each other. Empty table: empty result. Other columns are not read.
    """
    seen = materialize(survey(documents, id_col, text_col, window), "survey")
    first = materialize(
        seen.where(f"doc_id is not null and n_words >= {window}").groupBy("seq_a", "seq_b").agg(F.min("doc_id").alias("first_id")), "sequences"
    )
    holders = materialize(
        seen.join(first.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("doc_id", "text_key", F.explode("anchors").alias("prefix")), "anchors"
    )
    shared = materialize(
        holders.groupBy("prefix").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi").select("prefix", (F.col("n") > group_limit).alias("crowded")), "prefixes"
    )
    wanted = materialize(
        holders.join(shared, "prefix").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("prefix", "crowded")).alias("p"))
        .select("doc_id", "text_key", F.col("p.prefix").alias("shared"), F.col("p.crowded").alias("crowded")), "wanted"
    )
    candidates = keyed(documents, id_col, text_col).join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    candidates = materialize(candidates, "candidate-texts")
    found = materialize(suffixes(candidates, window), "suffixes")
    repeats = subtree_repeats(found.where("not crowded"), window).union(crowded_repeats(found.where("crowded")))
    cut = cut_repeats(candidates, repeats, window)
    cut = materialize(cut if texts else cut.drop("kept_text"), "cut")
    out = seen.select("doc_id", "text_key", "n_words", "full_sha256", "seq_a", "seq_b").join(first, ["seq_a", "seq_b"], "left").join(cut, ["doc_id", "text_key"], "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "full_sha256")).alias("kept_sha256"),
        F.when(copy, F.array(F.lit(0).cast("long"), F.col("n_words"))).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans"),
    ]
    if texts:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select(*columns)
