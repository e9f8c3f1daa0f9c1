"""A bitmap of hashed keys: rows whose key is surely not in a table can be left
out before they are moved.  Its size is bounded, so it may be broadcast;
false positives are dropped by the join that follows."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from citegrid.llm.textbatch import mix64
from citegrid.session import ship_package

#: Largest bitmap (16 MB), and bits per key below that.
MOST_BITS, BITS_PER_KEY = 1 << 27, 16
#: Bits in one row while the bitmap is put together.
_BLOCK = 1 << 19


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(keys.astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _deal(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy(), bits))
            yield pa.record_batch([pa.array(at // _BLOCK, pa.int64()), pa.array(at % _BLOCK, pa.int64())], ["block", "bit"])
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        block, bit = batch.column("block").to_numpy(), batch.column("bit").to_numpy()
        for b in np.unique(block).tolist():
            blocks.setdefault(b, np.zeros(_BLOCK, bool))[bit[block == b]] = True
    yield pa.record_batch([pa.array(list(blocks), pa.int64()), pa.array([np.packbits(x).tobytes() for x in blocks.values()], pa.binary())],
                          ["block", "packed"])


def build(keys: DataFrame, count: int) -> np.ndarray:
    """Packed bitmap of the one long column of ``keys``, without nulls."""
    ship_package(keys.sparkSession)
    bits = _BLOCK
    while bits < min(MOST_BITS, BITS_PER_KEY * count):
        bits *= 2
    dealt = keys.mapInArrow(_deal(bits), "block long, bit long").repartition(bits // _BLOCK, "block")
    out = np.zeros(bits, bool)
    for r in dealt.mapInArrow(_gather, "block long, packed binary").collect():      # the bitmap itself: 16 MB at most
        out[r["block"] * _BLOCK:(r["block"] + 1) * _BLOCK] = np.unpackbits(np.frombuffer(bytes(r["packed"]), np.uint8)).astype(bool)
    return np.packbits(out)


def has(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the table."""
    at = places(keys, len(packed) * 8)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
