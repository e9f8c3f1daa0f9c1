"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of a text; at every byte it depends on
the 32 bytes before.  A chunk ends where the hash passes a mask: a strict one
before the normal chunk size, a loose one after it (normalised chunking),
between a least and a most size.  Boundaries move with the content, so a
change alters only the chunks it touches.  The fingerprint is the set of chunk
digests with their lengths; likeness is the length-weighted containment of the
smaller set in the larger.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm.textbatch import mix64, slices
from citegrid.session import ship_package

#: Chunk sizes in bytes.
LEAST, NORMAL, MOST = 12, 32, 128
#: Hash bits that must be zero before and after the normal size.
STRICT_BITS, LOOSE_BITS = 6, 4
#: Bytes that the gear hash depends on.
REACH = 32
#: Rows a range holds on average when documents are dealt by id.
ROWS_PER_RANGE = 8192

_GEAR = np.append((mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)), 0).astype(np.uint32)
_STRICT = np.uint32(((1 << STRICT_BITS) - 1) << (32 - STRICT_BITS))
_LOOSE = np.uint32(((1 << LOOSE_BITS) - 1) << (32 - LOOSE_BITS))


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: h = (h << 1) + G[byte], which after 32 bytes has
    forgotten what came before, built by doubling the span five times."""
    h = _GEAR[data]
    for span in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h = longer
    return h


def _cuts(loose: list[int], strict: list[bool], size: int) -> list[int]:
    """Ends of the chunks of one text, from the positions (after the byte) that
    pass the loose mask and whether they pass the strict one too."""
    ends, start, i, n = [], 0, 0, len(loose)
    while size - start > LEAST:
        while i < n and loose[i] < start + LEAST:
            i += 1
        j = i
        while j < n and loose[j] < start + NORMAL and not strict[j]:
            j += 1
        end = min(loose[j] if j < n else size, start + MOST, size)
        ends.append(end)
        start, i = end, j
    if start < size:
        ends.append(size)
    return ends


def chunk_sets(texts: list[bytes]) -> list[dict[str, int]]:
    """Per text: chunk digest (8 hex digits of length and content) to length."""
    if not texts:
        return []
    gap = np.full(REACH, 256, np.uint16)              # forgets the text before
    parts = [x for t in texts for x in (np.frombuffer(t, np.uint8).astype(np.uint16), gap)]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + REACH for t in texts], out=at[1:])
    h = gear(np.concatenate(parts))
    loose = np.flatnonzero((h & _LOOSE) == 0)
    strict = (h[loose] & _STRICT) == 0
    first = np.searchsorted(loose, at, "left")
    out = []
    for i, text in enumerate(texts):
        a, b = first[i], first[i + 1]
        chunks, start = {}, 0
        for end in _cuts((loose[a:b] - at[i] + 1).tolist(), strict[a:b].tolist(), len(text)):
            chunks[xxhash.xxh3_64_hexdigest(text[start:end])[:10]] = end - start
            start = end
        out.append(chunks)
    return out


def as_string(chunks: dict[str, int]) -> str:
    """The set as text: digest and length in hex, in order of the digest."""
    return " ".join(f"{d}{n:x}" for d, n in sorted(chunks.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Length of the shared chunks by the length of the smaller set; two empty sets are alike."""
    least = min(sum(a.values()), sum(b.values()))
    if not least:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    return sum(n for d, n in a.items() if d in b) / least


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the next document."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with a column fingerprint of the text added (replacing one of that name); null text is empty."""
    ship_package(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != "fingerprint"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                sets = chunk_sets([t.encode() for t in pc.fill_null(rows.column("text"), "").to_pylist()])
                yield pa.record_batch([rows.column(f.name) for f in kept] + [pa.array(map(as_string, sets), pa.string())],
                                      [f.name for f in kept] + ["fingerprint"])
    return docs.select([F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


# ------------------------------------------------------------ edited texts

def _edited() -> Callable:
    """Rows sorted by (range, descending id), each range closed by its guard:
    a copy of the document after the range's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None           # the row whose next has not come yet
        for batch in batches:
            for rows in slices(batch):
                part = rows if held is None else pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
                if part.num_rows > 1:
                    yield compare(part)
                held = part.slice(part.num_rows - 1)

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(rows.column("text"), "").to_pylist()
        raw = [t.encode() for t in texts]
        ranges, guard = rows.column("range").to_pylist(), rows.column("guard").to_pylist()
        own = [i for i in range(len(texts) - 1) if not guard[i]]
        assert all(ranges[i] == ranges[i + 1] for i in own), "a range is not closed by its guard"
        edited = [edit(texts[i], texts[i + 1]).encode() for i in own]
        sets, later = chunk_sets(raw), chunk_sets(edited)
        columns = [
            rows.column("doc_id").take(pa.array(own, pa.int64())),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([as_string(sets[i]) for i in own], pa.string()),
            pa.array([as_string(s) for s in later], pa.string()),
            pa.array([likeness(sets[i], s) for i, s in zip(own, later)], pa.float64()),
            pa.array([likeness(sets[i], sets[i + 1]) for i in own], pa.float64())]
        return pa.record_batch(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                         "near_edited", "near_next"])
    return run


def edited_likeness(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is that with the next smaller id, after the last the
    first.  Ids that repeat follow each other in order of their texts' hashes;
    null ids come last, in the same order.  Null text is empty.  One document
    alone is its own next.  An empty table gives an empty result.

    Documents are dealt into ranges of descending id; the boundaries come from
    a quantile sketch of the ids, and null ids are dealt by hash range.  Each
    range gets a copy of the first document of the range after it, so every
    neighbour is found where the rows lie and texts move once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    count = rows.agg(F.count("doc_id").alias("ids"), F.count(F.lit(1)).alias("n")).first()
    n = max(1, -(-count["ids"] // rows_per_range))
    nulls = max(1, -(-(count["n"] - count["ids"]) // rows_per_range))
    at = docs.select(F.col("doc_id").cast("long").alias("doc_id")).approxQuantile(
        "doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 and count["ids"] else []
    bounds = sorted(set(at)) or [0.0]
    cuts = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="id_d", outputCol="bucket", handleInvalid="keep")
    by_hash = F.floor((F.col("th").cast("double") / float(1 << 64) + 0.5) * nulls)
    place = F.when(F.col("doc_id").isNotNull(), F.lit(len(bounds)) - F.col("bucket")).otherwise(
        F.lit(len(bounds) + 1) + F.least(by_hash, F.lit(nulls - 1))).cast("int")
    dealt = (cuts.transform(rows.withColumn("id_d", F.coalesce(F.col("doc_id"), F.lit(0)).cast("double")))
             .withColumn("range", place).drop("id_d", "bucket"))
    order = [F.col("doc_id").isNull(), F.col("doc_id").desc(), F.col("th")]
    # first document of each range: one small row a range
    heads = (dealt.groupBy("range").agg(F.max("doc_id").alias("top"))
             .select(F.col("range").alias("of"), "top").collect())
    full = sorted((r["of"], r["top"]) for r in heads)
    if not full:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    before = {full[(i + 1) % len(full)][0]: full[i][0] for i in range(len(full))}
    firsts = spark.createDataFrame([(r, t, before[r]) for r, t in full], "of int, top long, closes int")
    first = (dealt.join(F.broadcast(firsts), (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy("closes").agg(F.min_by("text", "th").alias("text"), F.min("th").alias("th"), F.first("doc_id").alias("doc_id")))
    guards = first.select("doc_id", "text", "th", F.col("closes").alias("range"), F.lit(True).alias("guard"))
    both = dealt.withColumn("guard", F.lit(False)).unionByName(guards)
    parts = max(1, min(len(full), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    group = F.floor(F.col("range") * parts / (max(r for r, _ in full) + 1)).cast("int")
    return (both.repartitionById(parts, group).sortWithinPartitions("range", "guard", *order)
            .mapInArrow(_edited(), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double"))
