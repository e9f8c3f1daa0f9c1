"""Tiles of queries against blocks of documents.

Queries beyond one tile never pass through the driver: strips of queries meet
blocks of documents in a group each, whose two sides are bounded by the numbers
they hold.  Rows are copied to the groups of their strip or block by number, so
the exchange carries documents x strips + queries x blocks rows, against
documents x queries products of arithmetic.  Strips and blocks are therefore as
large as a task can hold and no more than the cores need; a group goes through
its strip tile by tile.  With many strips and many blocks the exchange would grow
with the product of the two sides; then strips take turns, and what a turn moved
goes before the next one begins, so the disk holds one turn.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.session import materialize

#: Documents scored at a time inside a group.
BLOCK_ROWS = 8192
#: Numbers (components, postings) on each side of a group, and groups per core at least.
SIDE_NUMBERS, GROUPS_PER_CORE = 3_000_000, 4
#: Numbers copied to the groups in a turn, as far as that allows one strip.
TURN_NUMBERS = 500_000_000


def numbered(df: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """``df`` with the number of its strip or block of ``n`` (by hash of ``key``)."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)))


def grid(asked: int, docs: int, groups: int) -> tuple[int, int]:
    """Strips and blocks for two sides that hold so many numbers: no side of a
    group beyond SIDE_NUMBERS, ``groups`` groups or more, the least exchange."""
    least, blocks = max(1, -(-asked // SIDE_NUMBERS)), max(1, -(-docs // SIDE_NUMBERS))
    ways = ((s, max(blocks, -(-groups // s))) for s in range(least, max(least, groups) + 1))
    return min(ways, key=lambda w: w[0] * docs + w[1] * asked)


def turns(asked: int, docs: int, n_strips: int, n_blocks: int) -> list[range]:
    """The strips of each turn."""
    each = docs + n_blocks * asked // n_strips
    n = max(1, min(n_strips, TURN_NUMBERS // max(each, 1)))
    return [range(first, min(first + n, n_strips)) for first in range(0, n_strips, n)]


def meet(asked: DataFrame, asked_numbers: int, qid: str, docs: DataFrame, doc_numbers: int, did: str,
         score: Callable[[pa.Table, pa.Table], pa.Table], schema, fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``score(strip, block)`` of every strip of ``asked`` and every block of
    ``docs``; the sides hold so many numbers in all.  Beyond one turn the scores
    of each are written as far as ``fold`` keeps them (rows of a ``qid`` are in one turn)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    n_strips, n_blocks = grid(asked_numbers, doc_numbers, GROUPS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism)

    def each(places: range, name: str):
        return F.explode(F.sequence(F.lit(places[0]).cast("long"), F.lit(places[-1]).cast("long"))).alias(name)

    def run(strip: pa.Table, block: pa.Table) -> pa.Table:
        if not strip.num_rows or not block.num_rows:
            return arrow.empty_table()
        return score(strip.combine_chunks(), block.combine_chunks()).cast(arrow)

    strips = numbered(asked, qid, n_strips, "strip").select("*", each(range(n_blocks), "block"))
    blocks = numbered(docs, did, n_blocks, "block")

    def turn(now: range) -> DataFrame:
        own = strips.where(F.col("strip").between(now[0], now[-1])).groupBy("strip", "block")
        return own.cogroup(blocks.select("*", each(now, "strip")).groupBy("strip", "block")).applyInArrow(run, schema)

    first, *more = turns(asked_numbers, doc_numbers, n_strips, n_blocks)
    if not more:
        return turn(first)
    return reduce(DataFrame.unionByName, [materialize(fold(turn(now)), "tiles-turn", free=True) for now in (first, *more)])
