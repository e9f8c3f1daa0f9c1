"""L2 — build the retrieval index once, write it, and reuse it.

The index of a corpus is a written table (``postings``, ``vocab``) in the
shared checkpoint folder, keyed by the identity of the source files (path,
size, modification time), so every later job that asks for the same
corpus reads it instead of rebuilding it — the same split as building an
index once and loading it for every question.  The written form is one
row per document (``pmid, terms[], ws[]``), which the block scorer streams.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.operators import encoder, lexical
from citegrid.session import ensure_checkpoint_dir, materialize, remove_tables, shuffles_go


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# Bumped whenever the index format or weighting changes, so an index written
# by another version is never reused.
INDEX_VERSION = "5"


def source_key(spark: SparkSession, paths: list[str]) -> str:
    """Identity of the input files (path, length, modification time) and of
    the index format."""
    h = hashlib.sha1(INDEX_VERSION.encode())
    for path in paths:
        p, fs = _fs(spark, path)
        for st in fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]:
            h.update(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()};".encode())
    return h.hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path + "/_SUCCESS")
    return fs.exists(p)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def write_lexical_index(docvecs: DataFrame, vocab: DataFrame, path: str) -> None:
    """Writes ``vocab`` and the doc vectors (one row per document; the
    postings form is a narrow explode of it)."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    docvecs.write.mode("overwrite").parquet(f"{path}/docvecs")


def read_lexical_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(doc vectors, vocab)``."""
    return spark.read.parquet(f"{path}/docvecs"), spark.read.parquet(f"{path}/vocab")


def lexical_index(spark: SparkSession, articles: Callable[[], DataFrame], source_paths: list[str],
                  name: str = "lexical", rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read the written index of these sources, building it first if absent.

    A build writes into a private folder and is then published by renaming
    it to the shared name, so concurrent jobs never read a half-written
    index and never overwrite one another.  ``rebuild`` always builds (into
    its own folder) and leaves a published index in place."""
    # the shared folder itself (not the per-application sub-folder), so that
    # later jobs over the same sources find the index
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    final = f"{base}/index/{name}-{source_key(spark, source_paths)}"
    if not rebuild and _exists(spark, f"{final}/docvecs") and _exists(spark, f"{final}/vocab"):
        return read_lexical_index(spark, final)
    private = f"{final}.build-{uuid.uuid4().hex[:12]}"
    scratch: list[str] = []
    docvecs, vocab = lexical.build_doc_vectors(articles(), keep=lambda df, part: materialize(df, part, scratch, free=True))
    with shuffles_go(spark):
        write_lexical_index(docvecs, vocab, private)
    remove_tables(spark, scratch)
    if not _exists(spark, f"{final}/docvecs"):
        src, fs = _fs(spark, private)
        dst, _ = _fs(spark, final)
        if not fs.exists(dst) and fs.rename(src, dst):
            return read_lexical_index(spark, final)
    return read_lexical_index(spark, private)


def text_encoder(spark: SparkSession, articles: Callable[[], DataFrame], source_paths: list[str], name: str = "encoder",
                 **parameters) -> encoder.Encoder:
    """The encoder (P2) trained on these sources; trained from their lexical index if absent."""
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    told = "-".join(f"{k}{v}" for k, v in sorted(parameters.items()))
    final = f"{base}/index/{name}{told and '-'}{told}-{source_key(spark, source_paths)}"
    if _exists(spark, final):
        return encoder.read(spark, final)
    docvecs, _ = lexical_index(spark, articles, source_paths)
    model = encoder.train(docvecs, **parameters)
    private = f"{final}.build-{uuid.uuid4().hex[:12]}"
    encoder.write(model, spark, private)
    src, fs = _fs(spark, private)
    dst, _ = _fs(spark, final)
    if fs.exists(dst) or not fs.rename(src, dst):
        return encoder.read(spark, private)
    return encoder.read(spark, final)


# Documents of one bucket of the doc store on average, and buckets at most.
BUCKET_ROWS, MOST_BUCKETS = 512, 4096


def bucket_of(pmid, n: int):
    return F.pmod(F.xxhash64(pmid), F.lit(n)).cast("int")


def doc_store(spark: SparkSession, articles: Callable[[], DataFrame], source_paths: list[str], name: str = "docs") -> DataFrame:
    """The written doc store (S15) of these sources, built if absent: articles
    in folders by hash of the id, so that a lookup reads the folders of its ids only."""
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    final = f"{base}/index/{name}-{source_key(spark, source_paths)}"
    if not _exists(spark, final):
        arts = articles().select("pmid", "title", "abstract")
        n = max(1, min(MOST_BUCKETS, arts.count() // BUCKET_ROWS))
        private = f"{final}.build-{uuid.uuid4().hex[:12]}"
        with shuffles_go(spark):
            (arts.withColumn("buckets", F.lit(n)).withColumn("bucket", bucket_of("pmid", n)).repartition("bucket")
             .sortWithinPartitions("bucket", "pmid").write.partitionBy("buckets", "bucket").parquet(private))
        src, fs = _fs(spark, private)
        dst, _ = _fs(spark, final)
        if fs.exists(dst) or not fs.rename(src, dst):
            return spark.read.parquet(private)
    return spark.read.parquet(final)


def lookup(store: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of the store that may have one of the ids (``pmid``): the
    folders of their buckets.  What the driver sees is bucket numbers, at most
    MOST_BUCKETS of them, however many ids there are."""
    first = store.select("buckets").first()
    if first is None:
        return store
    n = int(first["buckets"])
    wanted = [r["b"] for r in ids.select(bucket_of("pmid", n).alias("b")).distinct().collect()]
    return store.where(F.col("bucket").isin(wanted))


def write_dense_index(docs: DataFrame, path: str, id_col: str = "pmid", vec_col: str = "vector") -> DataFrame:
    """The dense index is the table of unit vectors keyed by id
    (normalised once at write time so cosine = inner product)."""
    from citegrid.functions.vectors import as_float_vector, l2_normalize
    out = docs.select(id_col, as_float_vector(l2_normalize(vec_col)).alias(vec_col))
    out.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)
