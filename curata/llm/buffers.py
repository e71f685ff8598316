"""Arrow text columns as flat byte buffers, and shared byte-level hashing.

Every Arrow operator here works on slices of a batch that hold at most ``SLICE_BYTES``
of text (a single longer document is a slice of its own), so that the temporaries of a
task stay bounded whatever the size of the batch.
"""

from __future__ import annotations

import contextlib
import functools

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
_ODD, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_powers: dict[int, np.ndarray] = {}


def tune(spark) -> None:
    """Small Arrow batches: memory of a Python worker follows the batch, not the partition.

    The settings stay, as frames run after the function that made them has returned.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1024"), ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))):
        try:
            spark.conf.set(key, value)
        except Exception as error:  # a version without this setting
            if "CANNOT_MODIFY" not in str(error) and "maxBytes" not in key:
                raise


@contextlib.contextmanager
def settings(spark, values: dict[str, str]):
    """Settings of the session for the queries that run within."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, int64 offsets of each); a null counts as empty."""
    array = array.cast(pa.large_string()).fill_null("")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges (i, j) of at most that many bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on each bit of x."""
    x = x ^ (x >> U64(30))
    x = x * U64(_MIX1)
    x = x ^ (x >> U64(27))
    x = x * U64(_MIX2)
    return x ^ (x >> U64(31))


def powers(n: int, base: int = _ODD) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand.

    The span's words of 8 bytes, each mixed with its place, are summed up. (A polynomial modulo 2**64 would
    give some long texts, such as a Thue-Morse word and its complement, one hash.) Spans of one size of up to
    8 bytes never collide; hashes of different seeds are independent.
    """
    size, base = ends - starts, _place(np.zeros(1, np.uint64), seed)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    short = np.minimum(size, 8).astype(np.uint64)
    total = mix((words[starts] & _ends()[short]) ^ base)
    total[size == 0] = 0
    long = np.flatnonzero(size > 8)
    if len(long):  # the words after the first
        more = (size[long] - 1) // 8
        for i, j in slices(np.concatenate([[0], np.cumsum(more)]), 1 << 17):
            count = more[i:j]
            place = expand(np.ones(j - i, np.int64), count)
            at = np.repeat(starts[long[i:j]], count) + 8 * place
            left = np.minimum(np.repeat(ends[long[i:j]], count) - at, 8).astype(np.uint64)
            own = mix((words[at] & _ends()[left]) ^ _place(place.astype(np.uint64), seed))
            total[long[i:j]] += np.add.reduceat(own, np.cumsum(count) - count)
    return mix(total + size.astype(np.uint64) * U64(_MIX1))


def _place(k: np.ndarray, seed: int) -> np.ndarray:
    return mix(k * U64(_ODD) + U64((seed * _MIX2 + _MIX1) & (2**64 - 1)))


@functools.cache
def _ends() -> np.ndarray:
    """Masks that leave the first 0 to 8 bytes of a word."""
    return np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indices first[i] .. first[i] + count[i] - 1 of all i, one after another."""
    total = int(count.sum())
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(first - (np.cumsum(count) - count), count)

