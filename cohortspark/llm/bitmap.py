"""Fixed-size bit filters over 64-bit hashes, built on the executors.

A filter never exceeds ``MAX_BITS`` bits, whatever the data; past its capacity it only lets more
hashes through, so callers must treat a hit as "maybe". Tasks send the touched segments of their own
bits; a segment is merged by folding one partial after another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 128 MB: what one executor holds of a filter at most.
MAX_BITS = 1 << 30
SEGMENT_BYTES = 1 << 16


def size_for(rows: int, bits_per_row: int = 16, most: int = MAX_BITS) -> int:
    """A power of two with ``bits_per_row`` bits a row, within the bound."""
    bits = SEGMENT_BYTES * 8
    while bits < rows * bits_per_row and bits < most:
        bits *= 2
    return bits


def _get(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 != 0


def _set(bits: np.ndarray, slots: np.ndarray) -> None:
    np.bitwise_or.at(bits, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))


def _slots(hashes: pa.Array, size: int) -> np.ndarray:
    return hashes.to_numpy(zero_copy_only=False).astype(np.int64) & np.int64(size - 1)


def _partials(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)
        for batch in batches:
            slots, counts = np.unique(_slots(batch.column(0), size), return_counts=True)
            _set(twice, slots[(counts > 1) | _get(once, slots)])
            _set(once, slots)
        for k in range(0, size // 8, SEGMENT_BYTES):
            part = once[k : k + SEGMENT_BYTES]
            if part.any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([k // SEGMENT_BYTES], pa.int32()),
                    "once": pa.array([part.tobytes()], pa.binary()),
                    "twice": pa.array([twice[k : k + SEGMENT_BYTES].tobytes()], pa.binary()),
                })

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one segment is held at a time."""
    current, once, twice = None, None, None

    def row():
        return pa.RecordBatch.from_pydict({
            "segment": pa.array([current], pa.int32()),
            "once": pa.array([once.tobytes()], pa.binary()), "twice": pa.array([twice.tobytes()], pa.binary()),
        })

    for batch in batches:
        for segment, a, b in zip(*(batch.column(k).to_pylist() for k in ("segment", "once", "twice"))):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if segment != current:
                if current is not None:
                    yield row()
                current, once, twice = segment, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if current is not None:
        yield row()


def build(hashes: DataFrame, size: int, twice: bool = False) -> Broadcast:
    """The filter of the single bigint column of ``hashes``: slots hit, or slots hit by two rows or more."""
    schema = "segment int, once binary, twice binary"
    partials = hashes.mapInArrow(_partials(size), schema)
    merged = partials.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, schema)
    bits = np.zeros(size // 8, np.uint8)
    # The driver sees the filter alone, never more than its fixed size.
    for segment, part in merged.select("segment", "twice" if twice else "once").toLocalIterator():
        bits[segment * SEGMENT_BYTES : (segment + 1) * SEGMENT_BYTES] = np.frombuffer(part, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def hit(filter_bits: Broadcast, size: int, hashes: Column) -> Column:
    """Whether the filter may hold the hash."""

    @F.arrow_udf("boolean")
    def probe(values: pa.Array) -> pa.Array:
        return pa.array(_get(filter_bits.value, _slots(values, size)))

    return probe(hashes)
