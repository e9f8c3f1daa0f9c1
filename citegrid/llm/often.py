"""Which hashed keys occur several times: the first pass of a count by hash cells.

Tasks send 32 bits of every key, packed into one binary value per range of keys;
the task that gathers a range counts them.  Keys that share a cell are counted
together, so no frequent key is missed, and one that is not frequent may pass: a
later exact count drops it.  What is moved is some 4 bytes a key and task, in
proportion to the keys however often they meet, and a task holds one range.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm import bitmap

PACKED = "range long, cells binary, counts binary"
#: Keys of a range, or so.
RANGE = 1 << 18

_U = np.uint64


def range_bits(keys: int) -> int:
    """Bits of a key that name its range, where there are that many keys."""
    return min(31, max(0, (max(0, keys - 1) // RANGE).bit_length()))


def cells(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) >> _U(32 - bits)).view(np.int64)


def _width(least: int) -> type:
    return np.uint8 if least < 256 else np.int64


def pack(keys: np.ndarray, counts: np.ndarray, bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their counts as rows of PACKED; counts beyond ``least`` are sent as ``least``."""
    if not len(keys):
        return
    cell = cells(keys, bits)
    where = cell >> 32
    at = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    low, counts = (cell & 0xFFFFFFFF).astype(np.uint32), np.minimum(counts, least).astype(_width(least))
    cut = list(zip(at.tolist(), [*at[1:].tolist(), len(cell)]))
    yield pa.record_batch([pa.array(where[at], pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (low, counts))],
                          ["range", "cells", "counts"])


def _count(least: int) -> Callable:
    """Rows sorted by range to the cells with ``least`` keys or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for where, low, counts in zip(*(batch.column(c).to_pylist() for c in ("range", "cells", "counts"))):
                if where != now:
                    yield from counted(now, held)
                    now, held = where, []
                held.append((low, counts))
        yield from counted(now, held)

    def counted(where: int | None, held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        low = np.frombuffer(b"".join(x for x, _ in held), np.uint32)
        counts = np.frombuffer(b"".join(x for _, x in held), _width(least))
        order = np.argsort(low)
        low = low[order]
        at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        good = low[at[np.add.reduceat(counts[order].astype(np.int64), at) >= least]]
        yield pa.record_batch([pa.array(good.astype(np.int64) | (where << 32), pa.int64())], ["cell"])
    return run


def cells_with(packed: DataFrame, least: int) -> DataFrame:
    """The cells (one column, cell) of ``packed`` that have ``least`` keys or more."""
    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(_count(least), "cell long")


def filter_of(table: DataFrame, bits: int) -> tuple:
    """Broadcast bitmap of the cells of a written table, for ``may``."""
    return table.sparkSession.sparkContext.broadcast(bitmap.build(table.select(F.col("cell")), table.count())), bits


def may(known: tuple, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be that frequent."""
    packed, bits = known
    return bitmap.has(packed.value, cells(keys, bits))
