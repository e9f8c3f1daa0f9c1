"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words and dealt to
shards of bounded size by a hash of what they are, so that the bins are the
same however the table is cut into files and tasks; each shard packs its
pieces, largest first.  Open bins
are held by residual; each carries a bitmap of the sources and one of the
duplicate clusters it holds.  A piece goes to the bin with the smallest
residual that fits: the successor search starts at the piece's size and
continues upwards until a bin has neither its source nor its cluster.
"""
from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.llm.columns import n_words
from citegrid.session import materialize, ship_package

CAPACITY = 2048
#: Pieces that one task packs; bounds its memory and its search.
SHARD_PIECES = 4096
#: Copies of one row that are written out at a time.
COPIES = 4096


def cluster_of_text() -> Column:
    """Duplicate cluster: equal texts but for case of A-Z and white space.
    Null for text without words, which is no duplicate of anything."""
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain != "", F.xxhash64(plain))


class Bins:
    """Open bins of one shard, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.occupied = 0                   # bit r: some bin has residual r
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def successor(self, residual: int) -> int:
        """Smallest residual of an open bin that is no less, or -1."""
        above = self.occupied >> residual
        return residual + (above & -above).bit_length() - 1 if above else -1

    def place(self, size: int, source: int, cluster: int) -> int:
        """Number of the tightest compatible bin, after putting the piece in."""
        r, found = self.successor(size), -1
        while r >= 0 and found < 0:
            for b in self.at[r]:
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    found = b
                    break
            else:
                r = self.successor(r + 1)
        if found < 0:
            found, r = len(self.sources), self.capacity
            self.sources.append(0)
            self.clusters.append(0)
        else:
            self.at[r].remove(found)
            if not self.at[r]:
                self.occupied &= ~(1 << r)
        self.sources[found] |= source
        self.clusters[found] |= cluster
        self.at[r - size].append(found)
        self.occupied |= 1 << (r - size)
        return found


def _bits(codes: np.ndarray) -> list[int]:
    return [0 if c < 0 else 1 << c for c in codes.tolist()]


def _pack_shard(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        by = ["words", "doc_id", "source", "cluster", "size", "copy", "piece"]
        pdf = pdf.sort_values(by, ascending=[c != "words" for c in by]).reset_index(drop=True)
        sources = _bits(pd.factorize(pdf["source"].fillna("\0null"))[0])
        clusters = pdf["cluster"].where(pdf["cluster"].duplicated(keep=False))   # a cluster seen once can't conflict
        bits = _bits(pd.factorize(clusters)[0])
        bins = Bins(capacity)
        placed = [bins.place(*x) for x in zip(pdf["words"].tolist(), sources, bits)]
        pdf["bin_id"] = pdf["shard"] * (1 << 20) + np.asarray(placed, np.int64)
        return pdf[["doc_id", "source", "piece", "start", "words", "bin_id"]]
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: doc_id, source, piece (from 0), start (first word),
    words, bin_id.

    A bin holds at most ``capacity`` words, no two pieces of one source and no
    two of one duplicate cluster; null sources count as one source.  Documents
    without words are one piece of 0 words; repeated rows are documents of
    their own.  An empty table gives an empty result.  The bins depend on the
    rows alone, not on their order or layout.
    """
    spark = docs.sparkSession
    ship_package(spark)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       cluster_of_text().alias("cluster"), n_words("text").alias("size"))
    # rows alike in all that is packed are counted; the number of a copy tells them apart
    alike = ["doc_id", "source", "cluster", "size"]
    rows = materialize(rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("copies")), "pack-rows")
    n = rows.agg(F.coalesce(F.sum(pieces * F.col("copies")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-n // shard_pieces))
    last = F.col("copies") - 1
    first = F.col("block") * COPIES
    each = (rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES))))
            .withColumn("copy", F.explode(F.sequence(first, F.least(last, first + (COPIES - 1))))))
    cut = (each.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
           .withColumn("start", F.col("piece").cast("long") * capacity)
           .withColumn("words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")))
           .withColumn("shard", F.pmod(F.xxhash64(*alike, "copy", "piece"), F.lit(shards)).cast("long")))
    return (cut.select(*alike, "copy", "piece", "start", "words", "shard").groupBy("shard")
            .applyInPandas(_pack_shard(capacity),
                           "doc_id long, source string, piece int, start long, words long, bin_id long"))
