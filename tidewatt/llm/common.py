"""What the operators share: reading tables, saving intermediate tables, hashing words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidewatt
from tidewatt.scratch import scratch_dir

# Functions travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(tidewatt)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The frame written to the shared scratch folder and read back, so lineage ends there."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


MAX_BROADCAST_IDS = 1_000_000


def id_set(ids: DataFrame, limit: int = MAX_BROADCAST_IDS) -> DataFrame:
    """A saved table of ids, to be broadcast if it has ``limit`` rows at most, else to be joined by a shuffle.

    Documents meet it in a semi or anti join; below the limit their texts stay where they are.
    """
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def ascii_lower(text):
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % divisor


def one_thread() -> None:
    """Matrix products of this process take one thread, as a task has one core; threads beyond that only wait for each other."""
    for path in Path(np.__file__).parent.with_name("numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


# --- words of an Arrow column, hashed without a Python loop over words -------

CHUNK_BYTES = 1 << 18
SLICE_ROWS = 256
WORD_BYTES = np.ones(256, np.uint8)
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a run of rows: 64-bit hashes, and where each row's words begin and end."""

    hashes: np.ndarray
    row_starts: np.ndarray  # rows + 1 entries


class Powers:
    """Powers of the hash base and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up, self.down


POWERS = Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]] if len(ends) else raw[:0], ends - ends[0] if len(ends) else ends


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of bytes (a polynomial modulo 2^64, mixed with the length)."""
    up, down = POWERS.upto(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + mix(lengths))


def split_words(raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORD_BYTES):
    """Starts and ends of the words (runs of bytes of one kind but 0), and words before each row."""
    kind = kinds[raw]
    change = np.ones(len(raw) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    starts = np.flatnonzero(change[:-1] & (kind > 0))
    return starts, np.flatnonzero(change[1:] & (kind > 0)) + 1, np.searchsorted(starts, offsets)


def hashed_words(column: pa.Array) -> Words:
    """Lower-cased (A-Z) words between white space, as hashes."""
    raw, offsets = text_bytes(column)
    raw = LOWERED[raw]
    starts, ends, rows = split_words(raw, offsets)
    return Words(hash_spans(raw, starts, ends), rows)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, and the row of each; a shorter row is one shingle."""
    counts = np.diff(words.row_starts)
    each = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    row = np.repeat(np.arange(len(counts)), each)
    first = words.row_starts[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    left = counts[row]
    value = np.full(len(row), np.uint64(size), np.uint64)
    hashes = words.hashes
    for k in range(size):
        inside = k < left
        at = np.minimum(first + k, max(len(hashes) - 1, 0))
        value = np.where(inside, mix(value * BASE + hashes[at]), value)
    return value, row


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in runs of few rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    _, offsets = text_bytes(texts)
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end
