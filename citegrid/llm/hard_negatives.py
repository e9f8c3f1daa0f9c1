"""Hard negatives by threshold joins over partial inverted indexes (L2AP style).

Vectors lie in blocks.  Inside a block, dimensions are ordered by weight, and a
vector is indexed in its leading dimensions only, until the norm of the rest
times the largest norm of the anchors can't reach the threshold: a vector that
an anchor meets in none of its indexed dimensions scores less.  Scores are
accumulated over the lists dimension by dimension; a vector goes as soon as its
partial score plus the product of the remaining norms is below the threshold of
every anchor.  What is left is completed from the dimensions that were omitted.

Thresholds start high and are lowered, round by round, for the anchors whose
windows are not full yet; the last round goes down to the window's lower end.
Blocks that an anchor tile can't reach by norm are not visited.
"""
from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citegrid.llm.topk_search import usable
from citegrid.session import materialize, remove_tables, ship_package

SCALE = 256
#: Vectors of a block, anchors of a tile.
BLOCK, TILE = 4096, 128
#: Dimensions whose lists are read at a time.
STEP = 8
#: Thresholds of the first rounds: of the product of the norms (positives), and of the window from its upper end (negatives).
NORM_SHARES, WINDOW_SHARES = (0.6, 0.35), (0.15, 0.5)
#: Components below this bound give scores that float64 holds exactly.
EXACT = float(1 << 53)
_BLOCK = "block long, norm double, packed binary"
_HIT = "anchor long, slot int, row long, id long, score long"


def _pack(**parts: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **parts)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return {k: z[k] for k in z.files}


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _bundle(key: tuple, table: pa.Table) -> pa.Table:
    """One block or tile: vectors with their row numbers, ids and labels, in order of the row number."""
    order = np.argsort(table.column("row").to_numpy(), kind="stable")
    x = _matrix(table.column("q"), key[0].as_py())[order]
    norms = np.sqrt((x ** 2).sum(axis=1))
    more = {c: table.column(c).to_numpy()[order] for c in ("row", "vec_id", "label")}
    return pa.table([pa.array([key[1].as_py()], pa.int64()), pa.array([float(norms.max())]),
                     pa.array([_pack(x=x, norms=norms, **more)], pa.binary())], ["block", "norm", "packed"])


# ------------------------------------------------------------ one tile against one block

class Index:
    """Partial inverted index of a block for anchors of norms up to ``longest``
    and thresholds from ``least`` on.  Vectors are sorted by the number of
    indexed dimensions, so that the list of a dimension is a run of rows."""

    def __init__(self, x: np.ndarray, least: float, longest: float):
        self.order = np.argsort(-(x ** 2).sum(axis=0), kind="stable")
        x = x[:, self.order]
        rest = np.sqrt(np.concatenate([np.cumsum((x ** 2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))], axis=1))
        # dimensions from the first with rest * longest < least on are omitted
        indexed = (rest[:, :-1] * longest * (1 + 1e-9) >= least).sum(axis=1)
        self.rows = np.argsort(-indexed, kind="stable")
        self.x, self.rest, self.indexed = x[self.rows], rest[self.rows], indexed[self.rows]


def scores_above(anchors: np.ndarray, index: Index, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row of the block, score) of all pairs with score >= the anchor's ``least``."""
    q = anchors[:, index.order]
    q_rest = np.sqrt(np.concatenate([np.cumsum((q ** 2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))], axis=1))
    dim = q.shape[1]
    alive = np.flatnonzero(index.indexed > 0)
    part = np.zeros((len(q), len(alive)))
    done = np.zeros(len(alive), np.int64)          # dimensions whose products are in ``part``
    for lo in range(0, dim, STEP):
        hi = min(dim, lo + STEP)
        n = int(np.searchsorted(-index.indexed[alive], -lo, "left"))      # rows of the lists: indexed > lo
        if not n:
            break
        part[:, :n] += q[:, lo:hi] @ index.x[alive[:n], lo:hi].T
        done[:n] = hi
        bound = part + q_rest[:, done] * index.rest[alive, done][None]
        slack = 1e-9 * (q_rest[:, :1] * index.rest[alive, 0][None] + 1)
        keep = (bound + slack >= least[:, None]).any(axis=0)
        if not keep.all():
            alive, done, part = alive[keep], done[keep], part[:, keep]
    bound = part + q_rest[:, done] * index.rest[alive, done][None] + 1e-9 * (q_rest[:, :1] * index.rest[alive, 0][None] + 1)
    who, at = np.nonzero(bound >= least[:, None])
    score = np.empty(len(who), np.int64)
    for lo in range(0, len(who), 1 << 16):
        a, b = who[lo:lo + (1 << 16)], alive[at[lo:lo + (1 << 16)]]
        score[lo:lo + len(a)] = _exact(q[a], index.x[b])
    fits = score >= least[who]
    return who[fits], index.rows[alive[at[fits]]], score[fits]


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows, held at the ends of a long."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    top = np.iinfo(np.int64).max
    return np.array([max(-top, min(top, sum(int(u) * int(v) for u, v in zip(x, y)))) for x, y in zip(a, b)], np.int64)


def _first(anchor: np.ndarray, slot: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The k best of every (anchor, slot): score first, then the smaller id."""
    order = np.lexsort((ids, -score, slot, anchor))
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), bool),
                                          (anchor[order][1:] != anchor[order][:-1]) | (slot[order][1:] != slot[order][:-1])]))
    rank = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
    return order[rank < k]


def _join(k: int, same_label: bool) -> Callable:
    """Rows sorted by (to, kind): a block (kind 0), then the tiles sent to it
    (kind 1) with their open windows (anchor, slot, low, high, least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block = None
        for batch in batches:
            for to, kind, raw, wanted in zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "packed", "wanted"))):
                if kind == 0:
                    held, block = to, _unpack(raw)
                    continue
                assert held == to, "tile without its block"
                yield from visit(_unpack(raw), block, wanted)

    def visit(tile: dict, block: dict, wanted: list) -> Iterator[pa.RecordBatch]:
        row, slot, low, high, least = (np.array([w[c] for w in wanted]) for c in ("anchor", "slot", "low", "high", "least"))
        at = np.searchsorted(tile["row"], row)
        open_ = np.unique(at)
        lowest = np.full(len(tile["row"]), np.inf)
        np.minimum.at(lowest, at, least)
        longest = tile["norms"][open_].max()
        if np.abs(tile["x"]).max() * np.abs(block["x"]).max() * tile["x"].shape[1] < EXACT:
            who, there, score = scores_above(tile["x"][open_], Index(block["x"], lowest[open_].min(), longest), lowest[open_])
        else:                                     # norms of such components may not be numbers: nothing is left out
            who, there = (x.ravel() for x in np.indices((len(open_), len(block["x"]))))
            score = _exact(tile["x"][open_][who], block["x"][there])
        who = open_[who]
        fits = ((tile["label"][who] == block["label"][there]) == same_label) & (tile["row"][who] != block["row"][there])
        who, there, score = who[fits], there[fits], score[fits]
        by_anchor = np.argsort(who, kind="stable")
        first, last = (np.searchsorted(who[by_anchor], at, s) for s in ("left", "right"))
        which = np.repeat(np.arange(len(at)), last - first)             # one entry a window and pair
        pair = by_anchor[np.repeat(first, last - first) + np.arange(len(which)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)]
        fits = (score[pair] >= low[which]) & (score[pair] >= least[which]) & (score[pair] <= high[which])
        which, pair = which[fits], pair[fits]
        best = _first(row[which], slot[which], block["vec_id"][there[pair]], score[pair], k)
        which, pair = which[best], pair[best]
        yield pa.record_batch([pa.array(row[which], pa.int64()), pa.array(slot[which], pa.int32()), pa.array(block["row"][there[pair]], pa.int64()),
                               pa.array(block["vec_id"][there[pair]], pa.int64()), pa.array(score[pair], pa.int64())],
                              ["anchor", "slot", "row", "id", "score"])
    return run


# ------------------------------------------------------------ rounds

def fill(windows: DataFrame, tiles: DataFrame, blocks: DataFrame, k: int, same_label: bool, shares: tuple, name: str, paths: list[str]) -> DataFrame:
    """(anchor, slot, rank, row, id, score): the k best pairs in every window.

    ``windows`` has anchor, slot, tile, top (from where thresholds fall), low and
    high; null low: no lower end.  Thresholds are lowered as ``shares`` say, for
    windows that have less than k pairs, then to the lower end."""
    spark = windows.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "row")
    last = blocks.agg(F.max("block")).head()[0]
    now, out = windows, None
    low, high = F.coalesce("low", F.lit(-(2 ** 63) + 1)), F.coalesce("high", F.lit(2 ** 63 - 1))
    for step, share in enumerate((*shares, None)):
        if share is None:
            least = F.col("low") - 1 - F.abs(F.col("low").cast("double")) * 1e-12      # a double may lie above its long
        else:
            least = F.col("top") - (F.col("top") - F.coalesce("low", F.lit(0))) * share if not same_label else F.col("top") * share
        least = F.coalesce(least, F.lit(float("-inf")))
        sent = (now.withColumn("least", least).groupBy("tile").agg(                                # a tile's own windows
            F.collect_list(F.struct("anchor", "slot", low.alias("low"), high.alias("high"), "least")).alias("wanted"), F.min("least").alias("lowest"))
            .join(tiles.select(F.col("block").alias("tile"), F.col("norm").alias("t_norm"), "packed"), "tile"))
        to = sent.select("tile", "lowest", "t_norm", F.explode(F.expr(f"sequence(0L, {last}L)")).alias("to"))
        reach = F.col("lowest") <= F.col("t_norm") * F.col("norm") * (1 + 1e-9)
        pairs = to.join(blocks.select(F.col("block").alias("to"), "norm"), "to").where(reach).select("tile", "to")
        calls = pairs.join(sent.select("tile", "wanted", "packed"), "tile").select("to", F.lit(1).alias("kind"), "packed", "wanted")
        stay = blocks.select(F.col("block").alias("to"), F.lit(0).alias("kind"), "packed", F.lit(None).cast(calls.schema["wanted"].dataType).alias("wanted"))
        hits = (stay.unionByName(calls).repartition(tasks, "to").sortWithinPartitions("to", "kind")
                .mapInArrow(_join(k, same_label), _HIT))
        ranked = materialize(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), f"{name}-{step}", paths)
        if share is None:
            done, now = ranked, None
        else:
            full = ranked.where(F.col("rank") == k).select("anchor", "slot")
            done = ranked.join(full, ["anchor", "slot"], "left_semi")
            now = materialize(now.join(full, ["anchor", "slot"], "left_anti"), f"{name}-open-{step}", paths)
        out = done if out is None else out.unionByName(done)
        if now is None or now.isEmpty():
            break
    return out


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor and each of its ``positives`` best rows of the same label,
    the ``negatives`` best rows of other labels with
    low * positive score <= 100 * score <= high * positive score.

    ``vectors`` has vec_id, label and embedding; scores are inner products of
    floor(256 x), held at the ends of a long; ties go to the smaller id.  Rows
    with a null id or label, or a vector that is null, empty or holds null or
    non-finite components take no part; vectors of different lengths don't
    meet.  Repeated ids are rows of their own; repeats of a row come in any
    order among themselves.  An empty table, or one without anchors, gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    paths: list[str] = []
    q = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))
    rows = (vectors.where(usable("embedding") & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), q.alias("q"))
            .groupBy("vec_id", "label", "q").count().withColumn("copy", F.explode(F.expr("sequence(1L, count)")))
            .select("vec_id", "label", "q", F.size("q").alias("dim"), F.xxhash64("vec_id", "label", "q", "copy").alias("row")))
    rows = materialize(rows, "negatives-rows", paths)
    out = None
    # a length is a table of its own; a third of all vectors may have one, few have many
    for dim in [r["dim"] for r in rows.select("dim").distinct().orderBy("dim").toLocalIterator()]:
        here = _mine_one(rows.where(F.col("dim") == dim), dim, is_anchor, positives, negatives, low, high, paths)
        if here is not None:
            out = here if out is None else out.unionByName(here)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = materialize(out, "negatives")
    remove_tables(spark, paths)
    return out


def _bundles(rows: DataFrame, size: int, name: str, paths: list[str]) -> DataFrame:
    n = -(-rows.count() // size)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit(name)), F.lit(max(1, n))))
    return materialize(dealt.groupBy("dim", "block").applyInArrow(_bundle, _BLOCK), name, paths)


def _mine_one(rows: DataFrame, dim: int, is_anchor: Column, positives: int, negatives: int, low: int, high: int, paths: list[str]) -> DataFrame | None:
    anchors = rows.where(is_anchor)
    if anchors.isEmpty():
        return None
    blocks = _bundles(rows, BLOCK, f"negatives-blocks-{dim}", paths)
    tiles = _bundles(anchors, TILE, f"negatives-tiles-{dim}", paths)
    n = -(-anchors.count() // TILE)
    tile = F.pmod(F.xxhash64("row", F.lit(f"negatives-tiles-{dim}")), F.lit(max(1, n)))
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x))
    windows = anchors.select(F.col("row").alias("anchor"), F.lit(0).alias("slot"), tile.alias("tile"), (norm * norm).alias("top"),
                             F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"))
    found = materialize(fill(windows, tiles, blocks, positives, True, NORM_SHARES, f"negatives-positives-{dim}", paths), f"negatives-found-{dim}", paths)
    chosen = found.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    exact = lambda x: F.lit(x).cast("decimal(10,0)") * F.col("positive_score").cast("decimal(20,0)") / 100
    windows = chosen.join(anchors.select(F.col("row").alias("anchor"), "vec_id", tile.alias("tile")), "anchor").withColumns(
        {"low": F.ceil(exact(low)).cast("long"), "high": F.floor(exact(high)).cast("long")}).where("low <= high")
    windows = materialize(windows.withColumn("top", F.col("high").cast("double")), f"negatives-windows-{dim}", paths)
    hits = fill(windows.select("anchor", "slot", "tile", "top", "low", "high"), tiles, blocks, negatives, False, WINDOW_SHARES,
                f"negatives-hits-{dim}", paths)
    return (hits.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
            .join(windows.select("anchor", "slot", "vec_id", "positive_id", "positive_score"), ["anchor", "slot"])
            .select(F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))

