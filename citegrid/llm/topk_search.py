"""Exact top-k inner product search with dual cover trees.

Vectors are dealt by nearest pivot into blocks of bounded size, and every block
becomes a cover tree; queries are dealt and indexed the same way.  Each query
block first searches the candidate block that promises most, which gives every
query a kth score to beat.  Then the pairs of blocks whose radii still allow a
better score are searched; candidate trees stay where they are and query trees
are sent to them.  The k best of every visited pair of blocks meet in one
top-k per query.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citegrid.llm import cover_tree as ct
from citegrid.session import materialize, ship_package

SCALE = 256
K = 5
#: Vectors per candidate block and per query block.
BLOCK, QUERY_BLOCK = 4096, 512
#: Pivots at most; they come from a sample and only decide which rows share a block.
PIVOTS = 128
_TREE = "dim int, cell int, salt long, n long, radius double, centre array<double>, ids array<long>, tree binary"


def usable(column: str) -> Column:
    """Vectors with a component and without null or non-finite ones."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 1e305)
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, fine)


def _matrix(column: pa.Array) -> np.ndarray:
    """Quantised vectors of equal length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).reshape(len(column), -1)


def _cells(pivots) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                if (p := pivots.value.get(dim)) is not None:
                    x = _matrix(batch.column("vector").take(pa.array(rows)))
                    cell[rows] = ((p ** 2).sum(1)[None] - 2 * (x @ p.T)).argmin(axis=1)
            yield pa.record_batch([batch.column("vec_id"), batch.column("dim"), pa.array(cell), batch.column("vector")],
                                  ["vec_id", "dim", "cell", "vector"])
    return run


def _grow(key: tuple, table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    tree = ct.build(_matrix(table.column("vector").combine_chunks())[order], ids[order])
    dim, cell, salt = (x.as_py() for x in key)
    return pa.table([pa.array([dim], pa.int32()), pa.array([cell], pa.int32()), pa.array([salt], pa.int64()), pa.array([len(ids)], pa.int64()),
                     pa.array([float(tree.radius[0])]), pa.array([tree.points[tree.centre[0]].tolist()], pa.list_(pa.float64())),
                     pa.array([ids.tolist()], pa.list_(pa.int64())), pa.array([tree.pack()], pa.binary())],
                    ["dim", "cell", "salt", "n", "radius", "centre", "ids", "tree"])


def _trees(rows: DataFrame, block: int, name: str) -> DataFrame:
    """One tree per block; cells with more rows than a block are dealt by hash of the id."""
    sizes = materialize(rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks")), f"{name}-cells")
    dealt = rows.join(sizes, ["dim", "cell"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    trees = dealt.groupBy("dim", "cell", "salt").applyInArrow(_grow, _TREE)
    return materialize(trees.withColumn("block", F.concat_ws("-", "dim", "cell", "salt")), name)


def _search(k: int) -> Callable:
    """Rows sorted by (to, kind): a candidate tree (kind 0), then the query trees sent to it (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for to, kind, raw, ids, least in zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "tree", "ids", "least"))):
                if kind == 0:
                    held, tree = to, ct.Tree.unpack(raw)
                    continue
                assert held == to, "query tree without its candidate tree"
                queries = ct.Tree.unpack(raw)
                best, known = ct.Best.new(len(queries.ids), k), np.full(len(queries.ids), ct.NONE)
                if ids:
                    order = np.argsort(queries.ids, kind="stable")
                    at = order[np.searchsorted(queries.ids, ids, sorter=order)]
                    known[at] = least
                ct.search(queries, tree, best, known)
                q, rank = np.nonzero(best.who != -1) if len(best.who) else (np.zeros(0, int),) * 2
                real = best.score[q, rank] > ct.NONE
                q, rank = q[real], rank[real]
                yield pa.record_batch([pa.array(queries.ids[q], pa.int64()), pa.array(best.who[q, rank], pa.int64()),
                                       pa.array(best.score[q, rank], pa.int64())], ["query_id", "vec_id", "score"])
    return run


def _visit(pairs: DataFrame, queries: DataFrame, data: DataFrame, known: DataFrame | None, k: int, tasks: int) -> DataFrame:
    """Searches the pairs (q, c) of blocks."""
    sent = pairs.join(queries.select(F.col("block").alias("q"), "tree"), "q")
    if known is None:
        sent = sent.withColumns({"ids": F.lit(None).cast("array<long>"), "least": F.lit(None).cast("array<long>")})
    else:
        sent = sent.join(known, "q", "left")
    sent = sent.select(F.col("c").alias("to"), F.lit(1).alias("kind"), "tree", "ids", "least")
    stay = data.join(pairs.select(F.col("c").alias("block")).distinct(), "block").select(
        F.col("block").alias("to"), F.lit(0).alias("kind"), "tree",
        F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("least"))
    return (stay.unionByName(sent).repartition(tasks, "to").sortWithinPartitions("to", "kind")
            .mapInArrow(_search(k), "query_id long, vec_id long, score long"))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The k best candidates (every other vec_id) of each query, among vectors
    of its length: query_id, rank, vec_id, score; ties go to the smaller id.

    ``vectors`` has vec_id and embedding.  Rows with a null id, or a vector that
    is null, empty or holds null or non-finite components, take no part.  If an
    id repeats, its least vector (in array order) counts.  An empty table, or
    one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
            .where(F.col("vec_id").isNotNull() & usable("vector")))
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = rows.withColumn("dim", F.size("vector"))
    dims = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().orderBy(F.desc("count")).limit(PIVOTS).collect()}
    total = sum(dims.values())
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    share = F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(1_000_000)) < min(1_000_000, 1 + 4_000_000 * PIVOTS // total)
    sample = rows.where(share).select("dim", "vector").limit(PIVOTS).collect()
    pivots = {d: np.floor(SCALE * np.array([r["vector"] for r in sample if r["dim"] == d], np.float64))[:max(1, 2 * n // BLOCK)]
              for d, n in dims.items() if any(r["dim"] == d for r in sample)}
    celled = materialize(rows.mapInArrow(_cells(spark.sparkContext.broadcast(pivots)),
                                         f"vec_id long, dim int, cell int, vector {rows.schema['vector'].dataType.simpleString()}"), "search-cells")
    data = _trees(celled, BLOCK, "search-trees")
    queries = _trees(celled.where(is_query), QUERY_BLOCK, "search-queries")
    side = lambda t, x: t.select("dim", F.col("block").alias(x), F.col("centre").alias(f"{x}_centre"), F.col("radius").alias(f"{x}_radius"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(dot(a, a))
    q_n, c_n = norm("q_centre") + F.col("q_radius"), norm("c_centre") + F.col("c_radius")
    most = (dot("q_centre", "c_centre") + norm("q_centre") * F.col("c_radius") + norm("c_centre") * F.col("q_radius")
            + F.col("q_radius") * F.col("c_radius") + (q_n * c_n + 1) * 1e-9)
    # summaries of blocks (a centre and a radius), never rows
    pairs = materialize(side(queries, "q").join(side(data, "c"), "dim").select("q", "c", most.alias("most")), "search-pairs")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = pairs.groupBy("q").agg(F.max_by("c", F.struct("most", "c")).alias("c"))
    started = materialize(_visit(first, queries, data, None, k, tasks), "search-started")
    kth = _top(started, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    # per query block: the kth scores to beat; a query that has fewer than k so far bars nothing
    members = queries.select(F.col("block").alias("q"), "n", F.explode("ids").alias("query_id"))
    known = materialize(members.join(kth, "query_id").groupBy("q").agg(
        F.collect_list("query_id").alias("ids"), F.collect_list("least").alias("least"),
        F.when(F.count(F.lit(1)) == F.max("n"), F.min("least")).alias("worst")), "search-known")
    left = (pairs.join(first, ["q", "c"], "left_anti").join(known.select("q", "worst"), "q", "left")
            .where(F.col("worst").isNull() | (F.col("most") >= F.col("worst"))).select("q", "c"))
    found = started.unionByName(_visit(left, queries, data, known.drop("worst"), k, tasks))
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
