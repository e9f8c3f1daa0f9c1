"""Article and question tables: scans with explicit schemas, and their sinks
(S11, S13–S16, S19)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid import schemas
from citegrid.functions.text import split_title


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """CPU-heavy text work needs at least one task per core.  A scan splits
    by file/row group, so a small table stored as one row group arrives as one
    partition; only then is it redistributed (round-robin).  A large scan
    already has many splits and is left untouched (no shuffle)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """D1 from free text: ``pmid`` = the document id as a string, title = first
    sentence, abstract = the rest.  A narrow projection (no shuffle)."""
    title, abstract = split_title("text")
    return documents.select(F.col("doc_id").cast("string").alias("pmid"),
                            title.alias("title"), abstract.alias("abstract"))


def read_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """Corpus CSV (quoted multi-line fields), nulls -> ''."""
    df = (spark.read.schema(schemas.ARTICLES).option("header", True)
          .option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))
    return df.na.fill("")


def read_questions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Question file, every column a string, nulls -> ''."""
    df = (spark.read.schema(schemas.QUESTIONS_CSV).option("header", True)
          .option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))
    return df.na.fill("")


def write_articles_csv(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Corpus sink (header, quoted)."""
    (articles.select("pmid", "title", "abstract").write.mode(mode)
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))


def write_doc_store(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The three-column doc store, each file sorted by ``pmid`` so that an
    id lookup (``pmid IN (…)``) skips row groups by their min/max statistics
    (sorting within partitions: no shuffle)."""
    articles.select("pmid", "title", "abstract").sortWithinPartitions("pmid").write.mode(mode).parquet(path)


def index_meta(articles: DataFrame, embedding_model: str) -> DataFrame:
    """One-row ``{embedding_model, n_docs}``."""
    return articles.agg(F.count(F.lit(1)).alias("n_docs")).select(
        F.lit(embedding_model).alias("embedding_model"), "n_docs")


def fetch_meta(saved: DataFrame, query_used: str, requested: int) -> DataFrame:
    """One-row ``{query_used, requested_n_docs, saved_n_docs}``."""
    return saved.agg(F.count(F.lit(1)).alias("saved_n_docs")).select(
        F.lit(query_used).alias("query_used"), F.lit(requested).alias("requested_n_docs"),
        "saved_n_docs")


def write_json_single(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Small one-row results (metadata, metrics) as one JSON file."""
    df.coalesce(1).write.mode(mode).json(path)


def write_if_missing(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Build-if-missing: ``mode('ignore')`` leaves an existing table alone."""
    w = df.write.mode("ignore")
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)
