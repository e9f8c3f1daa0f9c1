"""Connected components of a link table, without collecting links anywhere.

Each round first contracts links inside bounded tasks (union-find over one
task's rows, which leaves at most one row per node), then, if more than one
task was needed, one large-star and one small-star step over the cluster.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.session import materialize, remove_tables, ship_package

#: Links that one task contracts in memory.
LINKS_PER_TASK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([parent[x] for x in nodes], pa.int64())], ["a", "b"])


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour (large: each larger one; small: each smaller one
    and the node itself) to the node's smallest neighbour."""
    both = _both_ways(links) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    out = joined.where(F.col("b") > F.col("a")) if large else joined.where(F.col("b") != F.col("m"))
    out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame, links_per_task: int = LINKS_PER_TASK, paths: list[str] | None = None) -> DataFrame:
    """(node long, root long) for every node with a link; root is the smallest
    node reachable, and roots themselves are not listed.

    ``links`` has long columns a and b.  Empty input gives no rows; self links
    and repeated links change nothing; rows with a null end are ignored.
    ``paths`` receives the written table that the result reads.
    """
    spark = links.sparkSession
    ship_package(spark)
    scratch: list[str] = []
    now = materialize(links.select("a", "b").where("a != b"), "links", scratch)
    n = now.count()
    while True:
        tasks = max(1, -(-n // links_per_task))
        dealt = now.repartition(tasks, F.least("a", "b")) if tasks > 1 else now.coalesce(1)
        now = materialize(dealt.mapInArrow(_contract, "a long, b long"), "forest", scratch)
        if tasks > 1:
            spread = materialize(_star(now, large=True), "large-star", scratch)
            after = materialize(_star(spread, large=False), "small-star", scratch)
            same = after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty()
            now, n = after, after.count()
            if not same:
                continue
        remove_tables(spark, scratch[:-1])
        if paths is not None:
            paths.append(scratch[-1])
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
