"""Reading tables and walking over Arrow batches of texts within bounded memory."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at once in a task, in bytes; a single longer text is handled by itself.
SLICE_BYTES = 4 << 20


#: Arrays above this size go back to the system as soon as they are freed. Without it a worker that waits for its next
#: task keeps what the largest slice took (glibc raises its own limit to 32 MB). Other C libraries go without.
GIVEN_BACK_BYTES = 1 << 20
_M_MMAP_THRESHOLD = -3
if hasattr(_libc := ctypes.CDLL(None), "mallopt"):
    _libc.mallopt(_M_MMAP_THRESHOLD, GIVEN_BACK_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators look at, so that others never clash with theirs."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches with a ``text`` column into pieces of at most ``max_bytes`` of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        length = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(length.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end, and where each begins (one more entry: the end). Null: empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def frame(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in schema],
        schema=schema,
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values in place (a bijection)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Word hashes are polynomials in ``_BASE`` over random values of the bytes, modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ASCII_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


#: Bytes whose powers of the base, and of its inverse, are held; further ones are products of two.
_STEP = 1 << 16


def _powers(base: int) -> np.ndarray:
    steps = np.full(_STEP, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_INVERSE = pow(_BASE, -1, 2**64)
_UP, _DOWN = _powers(_BASE), _powers(_INVERSE)


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Sums, from the first byte on, of the bytes' values times powers of the base; taken block by block."""
    sums = np.zeros(len(data) + 1, np.uint64)
    for at in range(0, len(data), _STEP):
        part = _BYTE_VALUES[data[at : at + _STEP]]
        part *= _UP[: len(part)]
        part *= np.uint64(pow(_BASE, at, 2**64))
        part[:1] += sums[at : at + 1]
        np.cumsum(part, out=sums[at + 1 : at + 1 + len(part)])
    return sums


def inverse_powers(places: np.ndarray) -> np.ndarray:
    blocks = range(0, int(places.max(initial=0)) + 1, _STEP)
    found = _DOWN[places % _STEP]
    found *= np.array([pow(_INVERSE, at, 2**64) for at in blocks], np.uint64)[places // _STEP]
    return found


def scan_words(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Words of texts that lie end to end: starts, ends, 64-bit hashes, and each text's first word.

    Words end at ASCII white space, at the end of a text, and before the places ``cuts``.
    Hashes depend on the bytes of the word alone."""
    body = ~ASCII_BLANK[data]
    first = body.copy()
    first[1:] &= ~body[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = body[begins]
    if cuts is not None:
        first[cuts] = True
    last = body.copy()
    last[:-1] &= ~body[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = byte_sums(data)
    hashes = mixed((sums[ends] - sums[starts]) * inverse_powers(starts))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs of ``pool``, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
