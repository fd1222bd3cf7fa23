"""Bloom filters of 64-bit hashes: filled by partition, merged block by block, with a fixed number of bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Hash functions of a filter, the bytes of one block (the unit in which filters are merged), and the most tasks that fill one.
PROBES = 4
BLOCK_BYTES = 1 << 12
FILL_TASKS = 1024


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's byte and bit of each probe of each hash (double hashing), one column a probe."""
    h = h.astype(np.uint64)
    step = ((h >> np.uint64(33)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    at = np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)], axis=1)
    return (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7), dtype=np.uint64).astype(np.uint8)


def holds(packed: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter."""
    bits = 8 * len(packed)
    first = h.astype(np.uint64) & np.uint64(bits - 1)  # most hashes fail at the first probe already
    found = (packed[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8)) & 1 == 1
    if found.any():
        at, bit = positions(h[found], bits)
        found[found] = ((packed[at] & bit) != 0).all(axis=1)
    return found


def merged_filters(hashes: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, repeated): merged Bloom filters, as packed bits, of the hashes that occur at all and of those that occur more than once.

    ``hashes`` has one bigint column. Partitions are merged by ``repeated = repeated_a | repeated_b | (once_a & once_b)`` and
    ``once = once_a | once_b``; nulls take no part. What the driver gets is 2 x ``bits``.
    """
    name = hashes.columns[0]

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            values, counts = np.unique(batch[name].dropna().to_numpy(np.int64), return_counts=True)
            at, bit = positions(values, bits)
            twice = ((once[at] & bit) != 0).all(axis=1) | (counts > 1)
            np.bitwise_or.at(again, at[twice].ravel(), bit[twice].ravel())
            np.bitwise_or.at(once, at.ravel(), bit.ravel())
        used = np.flatnonzero(once.reshape(-1, BLOCK_BYTES).any(axis=1))
        cut = lambda a, b: a[b * BLOCK_BYTES:(b + 1) * BLOCK_BYTES].tobytes()
        for some in np.array_split(used, max(1, len(used) // 256)):
            yield pd.DataFrame({"block": some.astype(np.int32), "once": [cut(once, b) for b in some], "again": [cut(again, b) for b in some]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[np.ndarray]] = {}  # of this task's blocks only
        for batch in batches:
            for block, o, a in zip(batch["block"], batch["once"], batch["again"]):
                o, a = np.frombuffer(o, np.uint8), np.frombuffer(a, np.uint8)
                if block in held:
                    once, again = held[block]
                    again |= a | (once & o)
                    once |= o
                else:
                    held[block] = [o.copy(), a.copy()]
        yield pd.DataFrame({"block": np.array(list(held), np.int32), "once": [x[0].tobytes() for x in held.values()], "again": [x[1].tobytes() for x in held.values()]})

    partial = hashes.coalesce(FILL_TASKS).mapInPandas(fill, "block int, once binary, again binary")
    merged = partial.repartition("block").mapInPandas(merge, "block int, once binary, again binary")
    once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for block, o, a in merged.toLocalIterator():  # together 2 * bits / 8 bytes
        once[block * BLOCK_BYTES:(block + 1) * BLOCK_BYTES] = np.frombuffer(o, np.uint8)
        again[block * BLOCK_BYTES:(block + 1) * BLOCK_BYTES] = np.frombuffer(a, np.uint8)
    return once, again
