"""Token-id output: texts to ids, ids to range-coded blocks in ascending document order, and back.

A dataset is a folder with ``table`` (symbol, n: counts of the whole corpus, from which the shared frequencies follow) and ``blocks``: one row a
block with part (range of ids), block, start (ids of the part before it), doc_ids, lengths and payload.
"""

from __future__ import annotations

import codecs
import itertools
import json
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rans
from .shared import delete, passes, scratch_folder

#: Pieces whose ids a worker keeps at most (some 200 bytes each); beyond that it starts anew. Results do not depend on it.
CACHE = 1_500_000
#: Bytes of text that are cut and looked up at once; a longer text stands alone.
PASS_BYTES = 4_000_000
BLOCK_TOKENS = 1 << 18
#: Ranges of characters that have been in one class of letters, digits, blanks or others for long; texts with further ones go whole.
STEADY = (
    (0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0xA0, 0x2FF), (0x391, 0x3A1), (0x3A3, 0x3C9), (0x400, 0x481), (0x2010, 0x2027), (0x3041, 0x3096),
    (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
)
#: Classes of characters.
LETTER, DIGIT, BLANK, OTHER = 1, 2, 3, 4


def _kinds() -> np.ndarray:
    """The class of each character below 65,536; 0 outside STEADY."""
    found = np.zeros(1 << 16, np.uint8)
    for lo, hi in STEADY:
        for c in range(lo, hi + 1):
            category = unicodedata.category(chr(c))[0]
            found[c] = BLANK if chr(c).isspace() else {"L": LETTER, "N": DIGIT}.get(category, OTHER)
    return found


def _begins(chars: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character of joined texts, and True at their end; ``bounds`` are the texts' places.

    The cut of byte-level BPE, ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+`` with L letters and N digits:
    runs of one class, but the last blank before something else stands alone, or goes with it if it is a space.
    """
    n = len(chars)
    first = np.ones(n + 3, bool)
    first[:n] = False
    first[bounds] = True
    begins = first[: n + 1].copy()
    begins[1:n] |= kinds[1:] != kinds[:-1]
    last = np.flatnonzero((kinds[:-1] == BLANK) & (kinds[1:] != BLANK) & ~first[1:n])
    begins[last] = True
    begins[last[chars[last] == ord(" ")] + 1] = False
    # A contraction: an apostrophe that begins a piece, and one or two letters of the same text.
    at = np.flatnonzero(chars == ord("'"))
    at = at[begins[at] & ~first[at + 1]]
    one = chars[at + 1]
    two = np.where(first[at + 2], 0, chars[np.minimum(at + 2, n - 1)])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    begins[at[short | long] + 1] = False
    begins[at[short] + 2] = True
    begins[at[long] + 3] = True
    return begins


#: A text in which the cut into pieces is tried before it is relied on.
PROBE = "It's  we'll\n\n (a) 12b-c,  \u00e9t\u00e9\u65e5\u672c \t x\u00a0y 'd' $5.00\r\n end  "


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


def _buffers(values: pa.BinaryArray) -> tuple[np.ndarray, bytes]:
    """The ends of values, from 0 on, and their bytes one after another: slices of these are much faster than Arrow's own Python values."""
    _, ends, flat = values.buffers()
    return np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1], flat.to_pybytes() if flat else b""


class _Pieces(dict):
    """Piece in UTF-8 -> its ids as bytes; a new piece is encoded by the tokenizer's model once."""

    def __init__(self, model, code: str):
        self.model, self.code = model, code
        self.letters = "".join(letter for _, letter in sorted(byte_letters().items()))

    def __missing__(self, piece: bytes) -> bytes:
        letters = codecs.charmap_decode(piece, "strict", self.letters)[0]
        found = self[piece] = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
        return found


class PieceTokenizer:
    """Encodes whole texts with a tokenizers file, looking the pieces of a byte-level BPE up once per worker.

    Texts are cut into pieces as the file's pre-tokenizer cuts them, and the library's model gives the ids of
    each distinct piece. Arrow numbers the distinct pieces of the texts of one call, so that each is looked up once a
    call. Whole texts go through the library's encode where that might differ: files of another
    kind, texts that hold one of the file's added tokens, and characters outside STEADY. With ``plain``,
    the strings of special tokens are plain text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        file = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in file.get("added_tokens") or []]
        self.kinds = _kinds()
        self.pieces = _Pieces(self.tokenizer.model, np.dtype(self.kind).char)
        cut = file.get("pre_tokenizer") or {}
        plain = not any(file.get(x) for x in ("normalizer", "truncation", "padding"))
        byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.by_piece = bool(plain and byte_level and file["model"]["type"] == "BPE") and self._joined([PROBE]) == [self.whole(PROBE)]

    def whole(self, text: str) -> bytes:
        # The fast form leaves out offsets, which nothing here reads.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def _joined(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text from its pieces; None for a text with a character outside STEADY."""
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        data, bounds = joined.encode(), np.cumsum([0, *map(len, texts)])
        one_byte = len(data) == len(joined)
        chars = np.frombuffer(data, np.uint8) if one_byte else np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = np.empty(len(chars), np.uint8)
        for at in range(0, len(chars), 1 << 20):  # numpy widens the places to eight bytes
            self.kinds.take(chars[at : at + (1 << 20)], mode="clip", out=kinds[at : at + (1 << 20)])
        if not kinds.all():
            odd = set((np.searchsorted(bounds, np.flatnonzero(kinds == 0), "right") - 1).tolist())
            found = iter(self._joined([t for i, t in enumerate(texts) if i not in odd]))
            return [None if i in odd else next(found) for i in range(len(texts))]
        begins = _begins(chars, kinds, bounds)
        first = np.searchsorted(np.flatnonzero(begins), bounds)  # each text's first piece
        if not one_byte:
            heads = np.ones(len(data) + 1, bool)
            heads[:-1] = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
            heads[heads] = begins
            begins = heads
        starts = np.flatnonzero(begins).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        ends, flat = _buffers(pieces.dictionary)
        distinct = [self.pieces[flat[a:b]] for a, b in itertools.pairwise(ends.tolist())]
        ends, flat = _buffers(pa.array(distinct, pa.binary()).take(pieces.indices))
        return [flat[a:b] for a, b in itertools.pairwise(ends[first].tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``kind``."""
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        found = self._joined(texts) if self.by_piece else [None] * len(texts)
        return [self.whole(t) if x is None or any(a in t for a in self.added) else x for t, x in zip(texts, found, strict=True)]


_CODERS: dict[str, PieceTokenizer] = {}


def _coder(path: str) -> PieceTokenizer:
    """One per Python worker, so that its pieces last from task to task."""
    if path not in _CODERS:
        _CODERS[path] = PieceTokenizer(path)
    return _CODERS[path]


def tokenize(documents: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """(doc_id, ids): the ids of each whole text (null: empty), with ``end_id`` appended, as little-endian bytes.

    An id takes 2 bytes where the vocabulary has up to 65,536 ids, else 4.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        end = np.array([end_id], coder.kind).tobytes()
        for batch in batches:
            for row, stop, _, _ in passes(batch.column(1), PASS_BYTES):
                part = batch.slice(row, stop - row)
                texts = [x or "" for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x + end for x in coder.encode(texts)], pa.binary())], ["doc_id", "ids"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, ids binary")


def _symbol_counts(tokens: DataFrame, kind: type, size: int) -> np.ndarray:
    """How often each id occurs in the corpus; ``size`` numbers reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                joined = b"".join(batch.column(0).slice(at, 500).to_pylist())
                total += np.bincount(np.frombuffer(joined, kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["symbol", "n"])

    counts = np.zeros(size, np.int64)
    for symbol, n in tokens.select("ids").mapInArrow(work, "symbol long, n long").groupBy("symbol").agg(F.sum("n")).collect():
        counts[symbol] = n
    return counts


def write_tokens(
    documents: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2
) -> None:
    """Write all ids of ``documents`` to ``path``, in ascending document order (null ids first, repeated ids by a hash of their ids).

    Documents are sorted by range; a task codes its range in blocks of about BLOCK_TOKENS ids, cut
    between documents. An empty table writes a dataset without blocks. Other columns are not read. A null text has the
    end id alone. A text longer than a block is a block of its own, which a task holds whole.
    """
    spark = documents.sparkSession
    coder = _coder(tokenizer)
    kind, size = coder.kind, max(coder.tokenizer.get_vocab_size(), end_id + 1)
    staged = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    tokenize(documents, tokenizer, id_col, text_col, end_id).write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.schema("doc_id long, ids binary").parquet(staged)
    counts = _symbol_counts(tokens, kind, size)
    spark.createDataFrame(pa.table({"symbol": np.arange(size), "n": counts})).coalesce(1).write.parquet(f"{path}/table")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, part = rans.Table(counts), TaskContext.get().partitionId()
        start = block = held = 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            joined = np.concatenate(ids)
            row = {
                "part": [part], "block": [block], "start": [start], "n_tokens": [len(joined)], "doc_ids": [docs],
                "lengths": [[len(x) for x in ids]], "payload": [rans.encode(joined, shared)],
            }
            return pa.RecordBatch.from_pydict(row, schema=_BLOCKS)

        for batch in batches:
            for doc, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(one.as_buffer(), kind)
                if held and held + len(one) > BLOCK_TOKENS:
                    yield flush()
                    start, block, held = start + held, block + 1, 0
                    docs, ids = [], []
                docs.append(doc)
                ids.append(one)
                held += len(one)
        if held:
            yield flush()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows of one id (or none) go on by a hash of their ids and then by place, so that they too are cut into ranges.
    order = ["doc_id", "spread", "row"]
    placed = tokens.withColumns({"spread": F.xxhash64("ids"), "row": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInArrow(code, _BLOCKS_SQL).write.option("compression", "none").parquet(f"{path}/blocks")
    delete(spark, [staged])


_BLOCKS = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
)
_BLOCKS_SQL = "part int, block int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"


def _opened(spark: SparkSession, path: str) -> tuple[np.ndarray, DataFrame, DataFrame]:
    """A dataset's symbol counts (as many as the vocabulary has), its blocks, and (part, base): the ids before each part."""
    rows = spark.read.parquet(f"{path}/table").orderBy("symbol").collect()
    blocks = spark.read.schema(_BLOCKS_SQL).parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each range that was written
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return np.array([r.n for r in rows], np.int64), blocks, sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_range(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """(start, ids): the ids of the dataset from place ``first`` on, ``count`` of them, in pieces that begin at ``start``.

    Of each block only the parts between the checkpoints around the range are decoded, one row a part.
    """
    counts, blocks, bases = _opened(spark, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(counts)
        for batch in batches:
            for at, n, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                size = rans.part_size(payload)
                low, high = max(0, first - at), min(n, first + count - at)
                for k in range(low // size, -(-high // size)):
                    ids = rans.decode(payload, table, k)[max(0, low - k * size) : high - k * size]
                    start = at + max(low, k * size)
                    yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["start", "ids"])

    place = F.col("base") + F.col("start")
    rows = blocks.select("part", "start", "n_tokens", "payload").join(F.broadcast(bases), "part").where((place < first + count) & (place + F.col("n_tokens") > first))
    return rows.select(place.alias("at"), "n_tokens", "payload").mapInArrow(work, "start long, ids binary")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document in a dataset.

    ``start``: ids of all documents before it; ``ids`` are little-endian unsigned 32-bit integers.
    """
    counts, blocks, bases = _opened(spark, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(counts)
        for batch in batches:
            for part, start, docs, lengths, payload in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                symbols = rans.decode(payload, table)
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                out = [symbols[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [
                    pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(start + cuts[:-1]), pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(x) for x in out], pa.int64()),
                ]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array(out, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    found = blocks.select("part", "start", "doc_ids", "lengths", "payload").mapInArrow(work, schema)
    out = found.join(F.broadcast(bases), "part")
    return out.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def token_output(documents: DataFrame, tokenizer: str, path: str | None = None, ids: bool = False, **columns) -> DataFrame:
    """Write ``documents`` as tokens and read the files back; ``path`` is a new folder in the shared one if left out."""
    spark = documents.sparkSession
    path = path or f"{scratch_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(documents, path, tokenizer, **columns)
    return read_tokens(spark, path, ids)
