"""Benchmark decontamination with an FM-index over each shard's words.

A shard (about SHARD_BYTES of texts inside one task) is reduced to its runs of benchmark words, as no
occurrence can hold any other word, and indexed: suffix array by rank doubling, Burrows-Wheeler
transform, wavelet matrix for ranks, and the positions of every SAMPLE-th suffix. Of the benchmark's
windows, those whose words all stand in the shard go through one vectorised backward search;
occurrences are located by walking back to a sampled suffix, and their spans are merged. Documents
never move between tasks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ALNUM, Words, materialize, passes

#: Of the suffixes of a shard, one in SAMPLE keeps its position.
SAMPLE = 8
#: A shard ends at so many bytes of texts or so many words in runs, whichever comes first; a longer text forms one of its own.
SHARD_BYTES, SHARD_WORDS = 32_000_000, 2_000_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class WaveletMatrix:
    """Ranks over a sequence of small integers, one bit plane a level: counts before each block of 256 and inside it, a byte a place."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.planes = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            rows = np.zeros((len(bit) // 256 + 1, 256), np.uint8)
            rows.ravel()[: len(bit)] = bit
            inside = np.cumsum(rows, axis=1, dtype=np.uint16)
            total = np.concatenate([[0], np.cumsum(inside[:-1, -1], dtype=np.int64)])
            self.planes.append((total, (inside - rows).astype(np.uint8).ravel()))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(at)
        for k, ((total, inside), zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            up = (symbol >> (self.bits - 1 - k)) & 1 == 1
            for x in (at, start):
                ones = total[x >> 8] + inside[x]
                x[:] = np.where(up, zeros + ones, x - ones)
        return at - start


class FMIndex:
    """An index of runs of positive integers; ``text`` holds them, each followed by a 0."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        stops = text == 0
        # Stops are smaller than all words and differ from each other, so no suffix reaches past its run.
        rank = np.where(stops, np.cumsum(stops) - 1, text + int(stops.sum()))
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        width = 1
        while True:
            after = np.full(n, 0, np.int64)
            after[: n - width] = rank[width:] + 1 if width < n else 0
            both = rank * np.int64(n + 1) + after
            order = np.argsort(both, kind="stable")
            head = np.concatenate([[0], np.cumsum(both[order][1:] != both[order][:-1])]) if n else np.zeros(0, np.int64)
            rank = np.empty(n, np.int64)
            rank[order] = head
            if n == 0 or head[-1] == n - 1:
                break
            width *= 2
        self.bwt = text[order - 1].astype(np.int32)
        top = int(text.max(initial=0))
        self.count = np.bincount(text, minlength=top + 1)
        self.below = np.concatenate([[0], np.cumsum(self.count)])
        self.wavelet = WaveletMatrix(self.bwt, max(1, top.bit_length()))
        self.sampled = order[::SAMPLE].copy()
        # A run's first place is kept too: walking back never crosses a stop.
        self.heads = np.flatnonzero(self.bwt == 0)
        self.head_places = order[self.heads]

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.wavelet.rank(symbol, at.copy())

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase row, text place) of every occurrence of the phrases, rows of equal length."""
        here = np.zeros(max(len(self.count), int(phrases.max(initial=0)) + 1), bool)
        here[: len(self.count)] = self.count > 0
        here[0] = False
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1]):
            live = live[here[phrases[live, j]]]
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(self.bwt), np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, j]
            low, high = self._step(symbol, low), self._step(symbol, high)
            some = low < high
            live, low, high = live[some], low[some], high[some]
        count = high - low
        row = np.repeat(live, count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        place, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
        walked = 0
        while len(open_):
            now = at[open_]
            every, head = now % SAMPLE == 0, self.bwt[now] == 0
            place[open_[every]] = self.sampled[now[every] // SAMPLE] + walked
            head &= ~every
            place[open_[head]] = self.head_places[np.searchsorted(self.heads, now[head])] + walked
            open_ = open_[~(every | head)]
            at[open_] = self._step(self.bwt[at[open_]], at[open_])
            walked += 1
        return row, place


def lowered_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return _WORD.findall((text or "").encode().lower())


class Phrases:
    """A block of benchmark items as windows: their word ids by length, and the items of each window, all in arrays."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        vocabulary: dict[bytes, int] = {}
        self.names = [item for item, _ in items]
        parts: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in lowered_words(text)], np.int32)
            if len(ids):
                size = min(window, len(ids))
                parts[size].append((np.lib.stride_tricks.sliding_window_view(ids, size), k))
        #: Length -> (distinct windows, where each one's items begin in the third, numbers of items).
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, found in parts.items():
            rows, inverse = np.unique(np.concatenate([w for w, _ in found]), axis=0, return_inverse=True)
            owner = np.repeat([k for _, k in found], [len(w) for w, _ in found])
            pairs = np.unique(np.stack([inverse.ravel(), owner], axis=1), axis=0)
            self.windows[size] = rows, np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), pairs[:, 1]
        words = list(vocabulary)
        if words:
            joined = b" ".join(words)
            hashes = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALNUM).hashes
            order = np.argsort(hashes)
            self.hashes, self.ids = hashes[order], order + 1

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], 0)


class Shard:
    """Texts of one task: their runs of benchmark words, with the places that these have among all words of the shard."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.held, self.n_words, self.n_bytes, self.n_run = phrases, [], 0, 0, 0
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, rows: pa.RecordBatch, words: Words) -> None:
        """Take in a pass of whole texts."""
        n = len(words.hashes)
        self.held.append((rows, words.counts()))
        if n and self.phrases.windows:
            ids = self.phrases.ids_of(words.hashes)
            # Runs of benchmark words inside one text, each followed by a stop.
            brk = np.zeros(n + 1, bool)
            brk[words.first] = True
            known = ids > 0
            begin = np.flatnonzero(known & (brk[:n] | ~np.concatenate([[False], known[:-1]])))
            end = np.flatnonzero(known & (brk[1:] | ~np.concatenate([known[1:], [False]]))) + 1
            long = end - begin >= min(self.phrases.windows)
            begin, end = begin[long], end[long]
            size = end - begin + 1
            origin = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
            text = np.where(origin == np.repeat(end, size), 0, ids[np.minimum(origin, n - 1)])
            self.runs.append((text, origin + self.n_words))
            self.n_run += len(text)
        self.n_words += n
        self.n_bytes += len(words.data)

    def full(self) -> bool:
        return self.n_bytes >= SHARD_BYTES or self.n_run >= SHARD_WORDS

    def search(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray], list[set[str]]]]:
        """For each pass: its rows, words of each text, which of these are hit, and the items of each text."""
        step = np.zeros(self.n_words + 1, np.int32)
        counts = np.concatenate([c for _, c in self.held]) if self.held else np.zeros(0, np.int64)
        first = np.cumsum(counts) - counts
        items: dict[int, set[str]] = defaultdict(set)
        if self.n_run:
            text, origin = (np.concatenate(x) for x in zip(*self.runs, strict=True))
            index = FMIndex(text)
            for length, (windows, begin, owners) in self.phrases.windows.items():
                row, place = index.search(windows)
                at = origin[place]
                np.add.at(step, at, 1)
                np.add.at(step, at + length, -1)
                home = np.searchsorted(first, at, "right") - 1
                for t, r in np.unique(np.stack([home, row], axis=1), axis=0).tolist():
                    items[t].update(self.phrases.names[k] for k in owners[begin[r] : begin[r + 1]])
        hit = np.cumsum(step[:-1]) > 0
        k = 0
        for rows, n in self.held:
            each = [hit[first[k + i] : first[k + i] + c] for i, c in enumerate(n)]
            yield rows, n, each, [items.get(k + i, set()) for i in range(len(n))]
            k += len(n)


def searched(
    batches: Iterator[pa.RecordBatch], column: int, phrases: Phrases
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray], list[set[str]]]]:
    """The batches' rows, shard by shard, as ``Shard.search`` gives them; texts stand in ``column``."""
    shard = Shard(phrases)
    for batch in batches:
        for row, end, data, bounds in passes(batch.column(column)):
            shard.add(batch.slice(row, end - row), Words(data, bounds, ALNUM))
            if shard.full():
                yield from shard.search()
                shard = Shard(phrases)
    yield from shard.search()


def _ranges(hit: np.ndarray) -> list[int]:
    """Where words begin and cease to be hit, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def without(text: str | None, ranges: list[int]) -> str | None:
    """The text without the words in ``ranges``, blanks between them included; null if there are none."""
    if not ranges:
        return None
    raw, at, kept = (text or "").encode(), 0, []
    spans = [m.span() for m in _WORD.finditer(raw.lower())]
    for a, b in zip(ranges[::2], ranges[1::2], strict=True):
        kept.append(raw[at : spans[a][0]])
        at = spans[b - 1][1]
    return (b"".join(kept) + raw[at:]).decode()


SCHEMA = "doc_id long, n_words long, hits array<long>, items array<string>, text string"


def scan(documents: DataFrame, phrases: Phrases, texts: bool = True) -> DataFrame:
    """One pass over whole texts: (doc_id, n_words, hits, items, text); ``hits`` are merged word ranges, ``text`` is what is left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n, hit, items in searched(batches, 1, phrases):
            ranges = [_ranges(x) for x in hit]
            clean = [without(rows.column(1)[i].as_py(), r) if texts and r else None for i, r in enumerate(ranges)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n.astype(np.int64)), pa.array(ranges, pa.list_(pa.int64())),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(clean, pa.string())],
                ["doc_id", "n_words", "hits", "items", "text"],
            )

    return documents.mapInArrow(work, SCHEMA)


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_words: int = 1_000_000,
) -> DataFrame:
    """(doc_id, n_words, n_hit, hits, items, clean_text) for every row of ``documents``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A window is ``window`` consecutive
    words of an item, or all of a shorter item; words inside an occurrence are hit. ``items`` are the ids
    (as strings, sorted) of items with occurring windows, ``hits`` merged word ranges, ``clean_text`` the
    text without them (null where nothing is hit).

    The benchmark goes to the tasks in blocks of at most ``block_words`` words (and one item), whose
    size is counted first; each further block is a further pass. Null or blank texts and items have no
    words; null item ids are named "". Null or repeated doc ids are kept and judged row by row: with
    several blocks the rows are numbered and written once, and merged by number. Empty tables give empty results or clean documents.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    if _block_count(items, block_words) == 1:
        found = scan(rows, next(_blocks(items, window, block_words)))
    else:
        # Written, as the numbers would differ from pass to pass otherwise.
        rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
        scans = [scan(rows.select(F.col("row").alias("doc_id"), "text"), phrases, False) for phrases in _blocks(items, window, block_words)]
        found = _merge(reduce(DataFrame.union, scans).drop("text"), rows)
    return found.select(
        "doc_id", "n_words",
        F.expr("aggregate(transform(hits, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)").alias("n_hit"),
        "hits", "items", F.col("text").alias("clean_text"),
    )


def _block_count(items: DataFrame, block_words: int) -> int:
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // (2 * block_words)))  # a word and its separator take two bytes at least


def _blocks(items: DataFrame, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark's ``items(item, text)`` in blocks of bounded size; one block for a small benchmark."""
    blocks = _block_count(items, block_words)
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield Phrases([tuple(r) for r in part.collect()], window)


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, block_words: int = 1_000_000,
) -> DataFrame:
    """The rows of ``documents`` without any occurrence of a window, with all columns; nothing is shuffled."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    at = documents.columns.index(text_col)
    for phrases in _blocks(items, window, block_words):

        def clean(batches: Iterator[pa.RecordBatch], phrases: Phrases = phrases) -> Iterator[pa.RecordBatch]:
            for rows, _, hit, _ in searched(batches, at, phrases):
                yield rows.filter(pa.array([not x.any() for x in hit], pa.bool_()))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents


def _merge(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Join what several blocks found of one row; ``doc_id`` of ``found`` is the ``row`` of ``rows(doc_id, text, row)``."""

    def merge(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        n = batch.column("n_words")[0].as_py()
        step = np.zeros(n + 1, np.int64)
        for r in batch.column("hits").to_pylist():
            np.add.at(step, r[::2], 1)
            np.add.at(step, r[1::2], -1)
        hit = np.cumsum(step[:-1]) > 0
        ranges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()
        items = sorted(set().union(*batch.column("items").to_pylist()))
        return pa.table(
            {"doc_id": pa.array([key[0].as_py()], pa.int64()), "n_words": [n], "hits": pa.array([ranges], pa.list_(pa.int64())),
             "items": pa.array([items], pa.list_(pa.string()))}
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [without(text, ranges) for text, ranges in zip(batch.column(4).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(clean, pa.string())], ["doc_id", "n_words", "hits", "items", "text"])

    merged = found.groupBy("doc_id").applyInArrow(merge, "doc_id long, n_words long, hits array<long>, items array<string>")
    both = merged.withColumnRenamed("doc_id", "row").join(rows.withColumnRenamed("text", "whole"), "row")
    return both.select("doc_id", "n_words", "hits", "items", "whole").mapInArrow(cut, SCHEMA)
