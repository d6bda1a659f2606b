"""Helpers that several operators use: shared scratch tables and whole-text word hashing."""

from __future__ import annotations

import functools
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass works on; a longer text forms a pass of its own.
PASS_BYTES = 1_000_000

WORD_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def scratch_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or below the warehouse where that is unset.

    On a cluster a warehouse on a local disk is refused: executors would not see each other's files there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    home = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if home.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{home}/scratch"


class _Open(threading.local):
    """Of each operator that is running, innermost last, the folders that it has written and the tables in them."""

    def __init__(self) -> None:
        self.tables: list[list[tuple[str, DataFrame]]] = []


_OPEN = _Open()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; the folder goes when the running operator ends.

    Cuts the lineage: losing executors afterwards costs no work that this table holds.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except BaseException:
        delete(spark, [path])
        raise
    out = spark.read.schema(df.schema).parquet(path)
    if _OPEN.tables:
        _OPEN.tables[-1].append((path, out))
    return out


def _run(f: Callable[..., DataFrame], *args, **kwargs) -> tuple[str, DataFrame]:
    """The folder and table of what ``f`` returns; all else that it wrote is deleted, and everything if it fails."""
    _OPEN.tables.append([])
    try:
        found = f(*args, **kwargs)
        wrote = _OPEN.tables[-1]
        if not wrote or wrote[-1][1] is not found:
            materialize(found, f.__name__)
        result = wrote.pop()
    finally:
        for path, table in _OPEN.tables.pop():
            delete(table.sparkSession, [path])
    return result


def operator(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Write the result of ``f`` and delete the tables that it wrote on the way."""

    @functools.wraps(f)
    def run(*args, **kwargs) -> DataFrame:
        result = _run(f, *args, **kwargs)
        if _OPEN.tables:
            _OPEN.tables[-1].append(result)
        return result[1]

    return run


class Chain:
    """Tables that follow from one another: each is written, and the one before it goes."""

    def __init__(self) -> None:
        self.last: tuple[str, DataFrame] | None = None

    def step(self, f: Callable[..., DataFrame], *args) -> DataFrame:
        before, self.last = self.last, _run(f, *args)
        if before:
            delete(self.last[1].sparkSession, [before[0]])
        return self.last[1]

    def end(self) -> None:
        """Delete the last table."""
        if self.last:
            delete(self.last[1].sparkSession, [self.last[0]])
            self.last = None


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders wherever they are."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """256 values: 0 for separators, else the byte plus one, A-Z as a-z if ``lower``."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Words ``[^\x20\x09-\x0D]+``, unchanged and lower-cased.
SPACES = bytes([32, 9, 10, 11, 12, 13])
PLAIN = byte_table(SPACES, lower=False)
LOWERED = byte_table(SPACES, lower=True)
#: Lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, n of each at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PASS_BYTES * 2)
        inverse = np.uint64(pow(int(WORD_MULTIPLIER), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, m)])) for m in (WORD_MULTIPLIER, inverse)]
    return _POWERS[0], _POWERS[1]


class Words:
    """The words of a run of texts: ``hashes`` of all words, and word k of text i at ``first[i] + k``.

    ``begins`` and ``ends`` are byte positions in ``data``; ``bounds`` those of the texts.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        n = len(data)
        value = table[data]
        inside = value > 0
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        after = np.zeros(n + 1, bool)
        after[:-1] = inside
        before[bounds] = False
        after[bounds] = False
        self.data, self.bounds = data, bounds
        self.begins = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(value * power[:n], out=total[1:])
        self.hashes = mix64((total[self.ends] - total[self.begins]) * inverse[self.begins])
        self.first = np.searchsorted(self.begins, bounds)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def passes(texts: pa.Array, size: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of whole texts (null: empty) into runs of about ``size`` bytes: first row, end row, bytes, bounds."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + size, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def ngram_hashes(words: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """The hash of the ``size`` words from each position on; positions without so many are left out."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    rng = np.random.default_rng(size * 1000 + seed)
    for j, m in enumerate(rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)):
        total += words[j : len(words) - size + 1 + j] * m
    return mix64(total + np.uint64(size))


def binaries(parts: list[np.ndarray]) -> pa.Array:
    """A binary column of the bytes of each array."""
    return pa.array([x.tobytes() for x in parts], pa.binary())


def keep_rows(documents: DataFrame, text_col: str, table: np.ndarray, test: Callable[[Words], np.ndarray]) -> DataFrame:
    """The rows of ``documents``, with all their columns, whose whole texts pass ``test``; nothing is shuffled."""
    at = documents.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in passes(batch.column(at)):
                yield batch.slice(row, end - row).filter(pa.array(test(Words(data, bounds, table)), pa.bool_()))

    return documents.mapInArrow(work, documents.schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case of letters."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name
