"""Where the tokens of two tokenizers meet in a text, and how often ids are linked in the whole corpus.

Texts are encoded in passes of about PASS_BYTES. As-of joins in pandas, keyed by document, give for each token's start the token of the other side
that covers it; both directions together are all overlaps, of which those with equal ends cut the text into groups. Pairs of ids are numbered
within a batch of passes, so that a document keeps a small number for each link, and only a batch's distinct pairs are shuffled to be
counted; the counts come back to the batch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, operator
from .tokens import PieceTokenizer, byte_letters

#: Bytes of text that are joined at once, and that share the numbers of pairs; a longer text stands alone.
PASS_BYTES = 500_000
BATCH_BYTES = 8_000_000
#: Pieces whose ids a worker keeps at most; beyond that it starts anew.
CACHE = 400_000


class Side:
    """One tokenizer's ids: ``flat[start[i] : start[i] + size[i]]`` are the bytes of id i."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of all ``ids`` one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class Aligner:
    """Both tokenizers of a worker: ``byte_bpe`` a byte-level BPE file, ``pieces`` a sentencepiece model."""

    def __init__(self, byte_bpe: str, pieces: str):
        self.a_coder = PieceTokenizer(byte_bpe, plain=True)
        self.b_coder = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        names = self.a_coder.tokenizer
        byte = lambda name: bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.a = Side([byte(names.id_to_token(i) or "") for i in range(names.get_vocab_size())])
        count = self.b_coder.get_piece_size()
        piece = lambda i: bytes([int(self.b_coder.id_to_piece(i)[3:5], 16)]) if self.b_coder.is_byte(i) else self.b_coder.id_to_piece(i).replace("▁", " ").encode()
        self.b = Side([piece(i) for i in range(count)])
        # Decimal ids by what follows them: "," within a side, "|" after a group's first side, ";" after a group.
        self.said = [f"{i}{mark}" for size, marks in ((len(self.a.size), ",|"), (count, ",;")) for mark in marks for i in range(size)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [np.frombuffer(x, self.a_coder.kind).astype(np.int64) for x in self.a_coder.encode([" " + t for t in texts])]
        return a, [np.array(x, np.int64) for x in self.b_coder.encode(texts, num_threads=1)]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs (a, b) of tokens with a common byte, and their ends, from tables (doc, place, a or b, a_end or b_end) by place.

    A token's start is covered by the last token of the other side that starts there or before; tokens that start together are found
    from both sides and kept once.
    """
    one = pd.merge_asof(a, b, on="place", by="doc")
    other = pd.merge_asof(b, a.assign(a_place=a["place"]), on="place", by="doc")
    columns = ["doc", "a", "b", "a_end", "b_end"]
    return pd.concat([one[columns], other.loc[other["a_place"] < other["place"], columns]], ignore_index=True)


def align(aligner: Aligner, texts: list[str | None]) -> tuple[list[tuple[int, int, int, str]], list[np.ndarray]]:
    """Of each text (n_a, n_b, n_groups, groups), and its links as ``a << 32 | b``, in the order of the text."""
    raw = [(" " + t).encode() if t else b"" for t in texts]
    asked = [i for i, t in enumerate(texts) if t]
    encoded = dict(zip(asked, zip(*aligner.encode([texts[i] for i in asked]), strict=True), strict=True)) if asked else {}
    fine = [i for i in asked if aligner.a.joined(encoded[i][0]) == raw[i] == aligner.b.joined(encoded[i][1])]
    empty = np.zeros(0, np.int64)
    out, links = [(0, 0, 0, "")] * len(texts), [empty] * len(texts)
    if not fine:
        return out, links
    base = np.cumsum([0] + [len(raw[i]) for i in fine])
    ids, ends, counts, frames = [], [], [], []
    for side, (part, name) in enumerate(((aligner.a, "a"), (aligner.b, "b"))):
        each = [encoded[i][side] for i in fine]
        ids.append(np.concatenate(each))
        counts.append(np.array([len(x) for x in each]))
        size = part.size[ids[-1]]
        ends.append(np.cumsum(size))
        frames.append(pd.DataFrame({"place": ends[-1] - size, "doc": np.repeat(np.arange(len(fine)), counts[-1]), name: np.arange(len(size)), f"{name}_end": ends[-1]}))
    met = overlaps(*frames)
    met = met[met["a_end"] == met["b_end"]].sort_values("a_end")
    cut = met["a_end"].to_numpy()
    pairs = ids[0][met["a"].to_numpy()] << 32 | ids[1][met["b"].to_numpy()]
    group = [np.searchsorted(cut, e) for e in ends]
    sizes = [np.bincount(g, minlength=len(cut)) for g in group]
    upto = [np.cumsum(s) for s in sizes]
    spoken = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    n_a, n_b = len(aligner.a.size), len(aligner.b.size)
    spoken[np.arange(len(ids[0])) + (upto[1] - sizes[1])[group[0]]] = ids[0] + n_a * (ends[0] == cut[group[0]])
    spoken[np.arange(len(ids[1])) + upto[0][group[1]]] = ids[1] + 2 * n_a + n_b * (ends[1] == cut[group[1]])
    of_doc = np.searchsorted(cut, base, "right")
    last = np.cumsum([counts[0], counts[1]], axis=1).sum(0)
    at = 0
    for k, i in enumerate(fine):
        words = "".join(map(aligner.said.__getitem__, spoken[at : last[k]].tolist()))
        at = last[k]
        out[i] = (int(counts[0][k]), int(counts[1][k]), int(of_doc[k + 1] - of_doc[k]), words[:-1])
        links[i] = pairs[of_doc[k] : of_doc[k + 1]]
    return out, links


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(*paths: str) -> Aligner:
    """One per Python worker, so that the ids of its pieces last from task to task."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in ascending order, as compressed steps."""
    return zlib.compress(np.diff(np.sort(numbers), prepend=np.uint32(0)).astype("<u4").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u4"), dtype=np.int64)


_BATCHES = pa.schema(
    [("batch", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("groups_sha256", pa.string()), ("groups", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())])))]
)
_BATCHES_SQL = "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, links binary, pairs array<struct<pair:long,n:long>>"


def aligned_batches(documents: DataFrame, byte_bpe: str, pieces: str, id_col: str, text_col: str, groups: bool) -> DataFrame:
    """A row for each document, with its links as sorted numbers of its batch's pairs, and one for each batch, with its pairs in ascending order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, batch_id = _aligner(byte_bpe, pieces), TaskContext.get().partitionId() << 32
        docs: list[tuple] = []
        found: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal batch_id, held
            every = np.concatenate(found)
            pairs, number, n = np.unique(every, return_inverse=True, return_counts=True)
            number, at, rows = number.astype("<u4"), 0, []
            for (doc, (n_a, n_b, n_groups, said)), links in zip(docs, found, strict=True):
                part, at = number[at : at + len(links)], at + len(links)
                rows.append((batch_id, doc, n_a, n_b, n_groups, len(links), hashlib.sha256(said.encode()).hexdigest() if said else "", said if groups else None, packed(part), None))
            rows.append((batch_id, *[None] * 8, pa.StructArray.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])))
            columns = list(zip(*rows, strict=True))
            lists = pa.ListArray.from_arrays(pa.array([None] * (len(rows) - 1) + [0, len(pairs)], pa.int32()), rows[-1][-1])
            batch_id, held = batch_id + 1, 0
            docs.clear()
            found.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, kind.type) for c, kind in zip(columns[:-1], _BATCHES, strict=False)), lists], schema=_BATCHES)

        for batch in batches:
            texts, row = batch.column(1), 0
            total = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())])
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(total, total[row] + PASS_BYTES, "right")) - 1)
                if len(aligner.a_coder.pieces) > CACHE:
                    aligner.a_coder.pieces.clear()
                out, links = align(aligner, texts.slice(row, end - row).to_pylist())
                docs += zip(batch.column(0).slice(row, end - row).to_pylist(), out, strict=True)
                found += links
                held += int(total[end] - total[row])
                row = end
                if held >= BATCH_BYTES:
                    yield flush()
        if docs:
            yield flush()

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, _BATCHES_SQL)


def linked_pairs(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): how often each id pair of ``pairs(pair, n)`` is linked, and whether none of its second id's is linked more often."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


@operator
def align_tokens(documents: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of each document.

    A: the ids of a space and the text by ``byte_bpe``, B: those of the text by ``pieces``, which adds that space; the strings of special tokens are
    plain text. ``groups`` is ``a1,a2|b1;a3|b2,b3``, cut wherever tokens of both sides end; links are the pairs that end together, n_best
    counts those whose id pair is linked as often in the corpus as any of its B id, count_sum sums the pairs' counts.

    Null and empty texts, and texts that either side does not give back byte for byte, have no tokens: zeros, and empty strings. Every row counts
    for itself, whether its id repeats or is null; other columns are not read. A table without rows gives none. A very long text is
    one pass of one task, which holds its tokens, some 100 bytes each.
    """
    staged = materialize(aligned_batches(documents, byte_bpe, pieces, id_col, text_col, groups), "aligned")
    pairs = staged.where("pairs IS NOT NULL").select("batch", F.inline("pairs"))
    judged = pairs.select(F.col("batch").alias("of_batch"), "pair").join(linked_pairs(pairs), "pair").groupBy("of_batch")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * groups]

    def total(rows: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("pair").to_numpy())
        count, best = (known.column(x).to_numpy()[order].astype(np.int64) for x in ("count", "best"))
        links = [unpacked(x) for x in rows.column("links").to_pylist()]
        for name, values in (("n_best", best), ("count_sum", count)):
            rows = rows.append_column(name, pa.array([int(values[x].sum()) for x in links], pa.int64()))
        return rows.select(names)

    kinds = ", ".join(f"{x} {'string' if x.startswith('groups') else 'long'}" for x in names)
    docs = staged.where("pairs IS NULL").drop("pairs").groupBy("batch")
    return docs.cogroup(judged).applyInArrow(total, kinds)
