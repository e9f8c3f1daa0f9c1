"""Dense text encoder trained on the corpus itself.

Documents and questions become short dense vectors: their TF-IDF vectors,
folded into a fixed number of hashed features, times the leading right singular
vectors of the corpus matrix.  The singular vectors come from randomized
subspace iteration: a random basis is multiplied by the matrix and its
transpose, made orthonormal, and again; every step is one pass over the written
document vectors.  A task holds the basis and its own part of the product, both
``features`` x (rank + OVERSAMPLE) numbers whatever the corpus.  There is one
part per core, not per file, so that what is exchanged does not grow with the
corpus; parts are summed by blocks of features, and the sum, of the same bounded
size, is all that the driver receives.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.session import ship_package

#: Hashed features and dimensions of the encoder (parameters of the model).
FEATURES, RANK = 1 << 16, 64
#: Extra dimensions while the basis is found, and passes over the corpus.
OVERSAMPLE, STEPS = 8, 4
#: Features in one row of a product, and postings and rows multiplied at a time.
BLOCK, CHUNK, ROWS = 1024, 1 << 13, 256


@dataclass
class Encoder:
    """basis: features x rank, orthonormal columns by falling singular value."""
    basis: np.ndarray
    singular: np.ndarray

    @property
    def rank(self) -> int:
        return self.basis.shape[1]


def features_of(terms: pa.Array, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and sign of each term: hashes of its bytes."""
    coded = terms.dictionary_encode()
    h = np.array([zlib.crc32(t.encode()) for t in coded.dictionary.to_pylist()], np.int64)
    h = h[coded.indices.to_numpy(zero_copy_only=False)] if len(h) else np.zeros(0, np.int64)
    return (h >> 1) % features, np.where(h & 1, 1.0, -1.0)


def _sparse(batch: pa.RecordBatch, features: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row, feature, weight) of some rows at a time; null lists are empty."""
    terms, ws = batch.column("terms"), batch.column("ws")
    sizes = terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    feature, sign = features_of(terms.flatten(), features)
    weight = sign * np.nan_to_num(ws.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    lo = 0
    while lo < batch.num_rows:
        hi = min(lo + ROWS, max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK, "right")) - 1))
        part = slice(at[lo], at[hi])
        yield lo, hi - lo, np.repeat(np.arange(hi - lo), sizes[lo:hi]), feature[part], weight[part]
        lo = hi


def _block(n: int, row: np.ndarray, feature: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of some rows, and the rows as a dense matrix over them."""
    names, place = np.unique(feature, return_inverse=True)
    return names, np.bincount(row * len(names) + place, weights=weight, minlength=n * len(names)).reshape(n, len(names))


def _rows_of(product: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in range(0, len(product), BLOCK):
        part = product[block:block + BLOCK]
        if part.any():
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "packed"])


def _multiply(basis) -> Callable:
    """A part's rows A to A'(A basis)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = basis.value
        out = np.zeros(b.shape)
        for batch in batches:
            for _, n, row, feature, weight in _sparse(batch, len(b)):
                names, rows = _block(n, row, feature, weight)
                out[names] += rows.T @ (rows @ b[names])
        yield from _rows_of(out)
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist()):
            x = np.frombuffer(raw, np.float64)
            total[block] = total[block] + x if block in total else x
    for block, x in total.items():
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["block", "packed"])


def _product(docvecs: DataFrame, basis: np.ndarray) -> np.ndarray:
    spark = docvecs.sparkSession
    shared = spark.sparkContext.broadcast(basis)
    parts = docvecs.select("terms", "ws").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(_multiply(shared), "block int, packed binary")
    blocks = -(-len(basis) // BLOCK)
    out = np.zeros(basis.shape)
    for r in parts.repartition(blocks, "block").mapInArrow(_add, "block int, packed binary").collect():     # features x rank
        part = out[r["block"]:r["block"] + BLOCK]
        part[:] = np.frombuffer(bytes(r["packed"]), np.float64).reshape(part.shape)
    shared.unpersist()
    return out


def train(docvecs: DataFrame, rank: int = RANK, features: int = FEATURES, steps: int = STEPS, seed: int = 13) -> Encoder:
    """Leading right singular vectors of the rows of ``docvecs`` (pmid, terms, ws).

    A corpus of lower rank than asked gets singular values of 0 at the end;
    an empty corpus has only those.  Rows without terms change nothing."""
    ship_package(docvecs.sparkSession)
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(features, min(features, rank + OVERSAMPLE))))
    for _ in range(steps - 1):
        basis, _ = np.linalg.qr(_product(docvecs, basis))
    product = _product(docvecs, basis)
    inner = basis.T @ product
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values)[:rank]
    return Encoder(basis @ turn[:, order], np.sqrt(np.maximum(values[order], 0)))


def encode(vectors: DataFrame, encoder: Encoder, key: str = "pmid") -> DataFrame:
    """(key, vector): unit vectors of rows (key, terms, ws); a row without
    terms, or with terms outside the corpus's space only, has a null vector."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = vectors.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(encoder.basis)
    rows = vectors.select(key, "terms", "ws")
    schema = rows.select(key, F.lit(None).cast("array<float>").alias("vector")).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            for lo, n, row, feature, weight in _sparse(batch, len(b)):
                names, rows = _block(n, row, feature, weight)
                z = rows @ b[names]
                norm = np.sqrt((z ** 2).sum(axis=1))
                unit = (z / np.maximum(norm, 1e-300)[:, None]).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * b.shape[1], pa.int32()), pa.array(unit.ravel()),
                                                 mask=pa.array(norm <= 1e-12))
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(lo, n), lists.cast(arrow.field(1).type)], schema=arrow)
    return rows.mapInArrow(run, schema)


def encode_questions(questions: DataFrame, vocab: DataFrame, encoder: Encoder, qid: str = "qid") -> DataFrame:
    """Questions in the space of the documents (terms that the corpus lacks drop out)."""
    from citegrid.operators.lexical import query_vectors

    grouped = query_vectors(questions, vocab, qid).groupBy(qid).agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("p"))
    return encode(grouped.select(qid, F.col("p.term").alias("terms"), F.col("p.w").alias("ws")), encoder, qid)


def write(encoder: Encoder, spark: SparkSession, path: str) -> None:
    rows = [(i, float(encoder.singular[i]), encoder.basis[:, i].astype(np.float64).tobytes()) for i in range(encoder.rank)]
    spark.createDataFrame(rows, "dimension int, singular double, direction binary").coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> Encoder:
    rows = spark.read.parquet(path).orderBy("dimension").collect()          # rank x features numbers
    return Encoder(np.stack([np.frombuffer(bytes(r["direction"]), np.float64) for r in rows], axis=1),
                   np.array([r["singular"] for r in rows]))
