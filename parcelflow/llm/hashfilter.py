"""A filter of hashes with a fixed size: what it lets through may be in the set, the rest is not."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of its bits, whatever the number of hashes (8 MB). What is let through is joined exactly.
FILTER_LOG = 26


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_LOG)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = _slots(hashes)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def build_filter(hashes: DataFrame) -> np.ndarray:
    """Bits of the long column `hash`: set per batch, joined bitwise, then a fixed-size array here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.unique(_slots(batch.column("hash").to_numpy().view(np.uint64)))
            if not len(every):
                continue
            byte, value = every >> np.uint64(3), np.uint8(1) << (every & np.uint64(7)).astype(np.uint8)
            first = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(byte[first].astype(np.int32)), pa.array(np.bitwise_or.reduceat(value, first).astype(np.int32))],
                ["byte", "bits"],
            )

    merged = hashes.select("hash").mapInArrow(run, "byte int, bits int").groupBy("byte").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros((1 << FILTER_LOG) // 8, np.uint8)
    found = merged.toArrow()
    bits[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    return bits
