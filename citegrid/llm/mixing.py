"""Mixing sources to target weights by hash-threshold histograms.

Every row has a 60-bit hash.  Sizes are summed by source and leading hash
bits; the running sums of one source show in which bucket its budget ends, and
only the rows of that bucket are summed again by the next bits, until one hash
value is left.  A row then belongs to the mix if its hash is below its
source's threshold: a filter, nothing is sorted, and a smaller budget always
picks a subset of a larger one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citegrid.llm.columns import fresh, n_words
from citegrid.session import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times the source's size.
MOST_COPIES = 3
#: Hash bits of each refinement; their sum is the width of the hash.
LEVELS = (12, 16, 16, 16)
#: Up to so many sources the table of thresholds (some 60 bytes a source) is broadcast.
BROADCAST_SOURCES = 50_000
#: Beyond that, rows of one source are dealt to so many join keys.
SALTS = 64


def row_hash() -> Column:
    """60 bits from the id (from the text where that is null)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _with_source(rows: DataFrame, table: DataFrame, n_sources: int) -> DataFrame:
    """Joins per-source columns to ``rows`` (source, h, ...) without moving all
    rows of a source to one task."""
    table = table.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(table), same).drop("of")
    salted = table.withColumn("salt_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.col("h"), F.lit(SALTS)).cast("int")
    return rows.join(salted, same & (salt == F.col("salt_t"))).drop("of", "salt_t")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source (source, source_size): target, so that targets sum to the
    total size, follow the weights, and none is above ``most`` times its source.

    Sharing the excess by weight until nothing is above its limit ends at
    target = least(limit, level * weight) with one level for all; sources are
    held at their limit in order of limit / weight.  The windows run over one
    row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    i = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), i + 1).cast("double"))
    s = s.withColumn("limit", F.col("source_size") * most)
    s = s.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("held", F.col("limit") / F.col("w") <= (F.col("total") - before) / left)
    whole = Window.partitionBy()
    held = F.coalesce(F.sum(F.when(F.col("held"), F.col("limit"))).over(whole), F.lit(0))
    free = F.sum(F.when(~F.col("held"), F.col("w"))).over(whole)
    s = s.withColumn("level", (F.col("total") - held) / free)
    return s.select("source", "source_size", F.when(F.col("held"), F.col("limit").cast("double"))
                    .otherwise(F.col("level") * F.col("w")).alias("target"))


def _budgets(target: DataFrame) -> DataFrame:
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = target.withColumn("whole", whole.cast("long"))
    return t.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))


def thresholds(rows: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> tuple[DataFrame, int]:
    """Per source: source_size, target, whole (copies of every row) and below
    (rows with a smaller hash are taken once more); and the number of sources.
    ``rows`` is a written table of (source, size, h)."""
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    n = sizes.count()
    state = materialize(_budgets(targets(sizes, weights, most))
                        .withColumns({"path": F.lit(0).cast("long"), "before": F.lit(0).cast("long")}), "mix-targets")
    shift = sum(LEVELS)
    for bits in LEVELS:
        inside = (_with_source(rows, state.select("source", "path"), n)
                  .where(F.shiftright("h", shift) == F.col("path")) if shift < sum(LEVELS) else rows)
        shift -= bits
        histogram = inside.groupBy("source", F.shiftright("h", shift).alias("next")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("next")
        histogram = (histogram.withColumn("upto", F.sum("words").over(run))
                     .withColumnRenamed("source", "of")
                     .join(F.broadcast(state) if n <= BROADCAST_SOURCES else state,
                           F.col("of").eqNullSafe(F.col("source"))))
        ends = F.col("before") + F.col("upto") > F.col("rest")
        first = histogram.where(ends).groupBy("source").agg(
            F.min("next").alias("next"), F.min("upto").alias("upto"), F.min_by("words", "next").alias("words"))
        state = materialize(
            state.withColumnRenamed("source", "of").join(first, F.col("of").eqNullSafe(F.col("source")), "left")
            .select(F.col("of").alias("source"), "source_size", "target", "whole", "rest", F.col("next").alias("path"),
                    (F.col("before") + F.col("upto") - F.col("words")).alias("before"), F.col("words").alias("last")),
            "mix-boundary")
        state = state if shift == 0 else state.drop("last")
    nearer = F.col("before") + F.col("last") - F.col("rest") <= F.col("rest") - F.col("before")
    below = F.coalesce(F.col("path") + nearer.cast("long"), F.lit(0).cast("long"))
    return materialize(state.select("source", "source_size", "target", "whole", below.alias("below")), "mix-thresholds"), n


def decide(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per row: doc_id, source, size (words), source_size, target (its source's),
    copies and taken (copies times size).

    Null text has size 0; null sources are one source, last in order; rows
    with the same id (or, without id, the same text) have the same hash and
    are taken together.  Sources of size 0 have target 0.  An empty table
    gives an empty result.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                   n_words("text").alias("size"), row_hash().alias("h")), "mix-rows")
    table, n = thresholds(rows, weights, most)
    copies = F.least(F.lit(most).cast("long"), F.col("whole") + (F.col("h") < F.col("below")).cast("long"))     # rows of size 0 may be below 0 words
    return (_with_source(rows, table, n).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``docs`` as mixed: each row as often as the mix takes it, same columns."""
    rows = materialize(docs.select(F.col("source").cast("string").alias("source"), n_words("text").alias("size"),
                                   row_hash().alias("h")), "mix-rows")
    table, n = thresholds(rows, weights, most)
    names = {c: fresh(docs, c) for c in ("mix_h", "mix_of", "mix_whole", "mix_below", "mix_salt", "mix_copy")}
    table = table.select(F.col("source").alias(names["mix_of"]), F.col("whole").alias(names["mix_whole"]),
                         F.col("below").alias(names["mix_below"]))
    hashed = docs.withColumn(names["mix_h"], row_hash())
    same = F.col("source").cast("string").eqNullSafe(F.col(names["mix_of"]))
    if n <= BROADCAST_SOURCES:
        joined = hashed.join(F.broadcast(table), same)
    else:
        salted = table.withColumn(names["mix_salt"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = hashed.join(salted, same & (F.pmod(F.col(names["mix_h"]), F.lit(SALTS)) == F.col(names["mix_salt"])))
    copies = F.least(F.lit(most).cast("long"), F.col(names["mix_whole"]) + (F.col(names["mix_h"]) < F.col(names["mix_below"])).cast("long"))
    repeated = joined.withColumn(names["mix_copy"], copies).where(F.col(names["mix_copy"]) > 0)
    return repeated.withColumn(names["mix_copy"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["mix_copy"])))).select(docs.columns)
