"""Markup ingestion.

Records are flattened to ``(pmid, title, abstract)`` with the text nodes in
document order, each stripped, joined by one space (``get_text(" ", strip=True)``).

* Article-set XML (``<PubmedArticle>`` records): the file is split on the
  record end tag by the text reader (so records stream, no whole-file read),
  each record is checked by ``from_xml`` with a corrupt-record column, and
  only well-formed records reach ``xpath`` — ``xpath`` raises on malformed
  input and would otherwise fail the whole job.  Bad records go to a rejects
  table instead.
* Web pages (not well-formed XML: unclosed ``<br>``/``<p>``): regex-based
  extraction of ``<title>`` and the ``<article>`` body after dropping
  script/style/comment blocks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.functions.text import markup_text, nz, strip

RECORD_TAG = "PubmedArticle"


# Place of a record in its input: file, split of the file, record in the split.
POSITION = ["_file", "_block", "_record"]


def read_article_sets(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<PubmedArticle>`` record (``xml`` column) from XML files,
    with its place in the input (``POSITION``).  Rows of a task keep their order
    in the file, so the running number of a task orders the records of a split."""
    raw = spark.read.option("lineSep", f"</{RECORD_TAG}>").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_record"))
    rec = F.regexp_extract("value", rf"(?s)<{RECORD_TAG}[\s>].*", 0)
    return (raw.select(rec.alias("body"), *POSITION).where(F.col("body") != "")
            .select(F.concat("body", F.lit(f"</{RECORD_TAG}>")).alias("xml"), *POSITION))


def _nodes_text(nodes: Column) -> Column:
    return F.array_join(F.filter(F.transform(nodes, strip), lambda s: s != ""), " ")


def flatten_article_xml(records: DataFrame, xml: str = "xml") -> DataFrame:
    """``(pmid, title, abstract, malformed)``; ``pmid`` is the first
    ``PMID`` in document order (later ones, e.g. in reference lists, are
    ignored), the abstract joins every ``AbstractText`` of the first
    ``Abstract`` (labels/attributes ignored, inline tags flattened)."""
    probe = F.from_xml(F.col(xml), "x string, _corrupt_record string",
                       {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE",
                        "rowTag": RECORD_TAG})
    kept = [c for c in records.columns if c in POSITION]
    d = records.withColumn("_probe", probe)
    good = F.col("_probe._corrupt_record").isNull() & F.col(xml).isNotNull()
    safe = F.when(good, F.col(xml))
    pmid = F.get(F.xpath(safe, F.lit("(//PMID)[1]//text()")), 0)
    title = _nodes_text(F.xpath(safe, F.lit("(//ArticleTitle)[1]//text()")))
    abstract = _nodes_text(F.xpath(safe, F.lit("(//Abstract)[1]//AbstractText//text()")))
    pid = strip(nz(pmid))
    return d.select(F.when(good & (pid != ""), pid).alias("pmid"),
                    F.coalesce(title, F.lit("")).alias("title"),
                    F.coalesce(abstract, F.lit("")).alias("abstract"),
                    (~good).alias("malformed"), F.col(xml), *kept)


# Blocks whose content is never page text.
_NOISE = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"


def page_key(url: Column | str) -> Column:
    """Article key of a page URL: ``<lang>/<number>`` (hosts, query strings,
    fragments and suffixes vary between copies of the same article)."""
    u = F.col(url) if isinstance(url, str) else url
    k = F.regexp_extract(u, r"/([a-z]{2}/[0-9]+)", 1)
    return F.when(k != "", k)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """S4 on web pages: ``(page_id, pmid, title, abstract)``."""
    clean = F.regexp_replace(nz("html"), _NOISE, " ")
    title = markup_text(F.regexp_extract(clean, r"(?is)<title[^>]*>(.*?)</title>", 1))
    body = F.regexp_extract(clean, r"(?is)<article[^>]*>(.*?)</article>", 1)
    body = F.regexp_replace(body, r"(?is)<h1[^>]*>.*?</h1>", " ")
    return pages.select("page_id", page_key("url").alias("pmid"), title.alias("title"),
                        markup_text(body).alias("abstract"))


def keep_nonempty(articles: DataFrame) -> DataFrame:
    """A pmid and some text (title or abstract)."""
    return articles.where(F.col("pmid").isNotNull() & ((nz("title") != "") | (nz("abstract") != "")))


def rejects(flat: DataFrame) -> DataFrame:
    """Records that were dropped: malformed, no pmid, or no text."""
    return flat.where(F.col("malformed") | F.col("pmid").isNull()
                      | ((nz("title") == "") & (nz("abstract") == "")))


def dedup_keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``, the first by ``order`` (deterministic).

    Only the key and the order columns are aggregated (one row per key and
    map task, so a key holding a third of all rows stays small), and the rows
    that win are fetched by joining back.  Rows equal in key and order are
    one row of the result, chosen arbitrarily."""
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_best")
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(best)
    won = F.struct(*[F.col(c) for c in order]).eqNullSafe(F.col("_best"))
    return df.join(first, key).where(won).drop("_best").dropDuplicates([key])


def semi_fetch(articles: DataFrame, ids: DataFrame, key: str = "pmid") -> DataFrame:
    """The records of an id list (left-semi join; ids are deduplicated by
    the join itself, so repeated ids never duplicate records)."""
    return articles.join(ids.select(key), key, "left_semi")
