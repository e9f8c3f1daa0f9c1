"""Plan properties the design relies on (checked on executed, adaptive plans)."""
import re

import __spark_entry__ as entry
from conftest import SF001


def _plan(spark, name):
    df = entry.queries()[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cascade_is_one_pruned_scan(spark):
    plan = _plan(spark, "ingest_query_cascade")
    scans = [re.sub(r"#\d+L?", "", s) for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    assert scans == ["text"]                      # all levels in one scan, only the text column read


def test_dense_broadcast_path_does_not_shuffle_the_corpus(spark):
    plan = _plan(spark, "knn_dense")
    assert "MapInArrow" in plan
    assert "hashpartitioning(neighbor" not in plan and "SortMergeJoin" not in plan
    assert "WindowGroupLimit" in plan


def test_lexical_retrieval_has_no_pair_shuffle(spark):
    plan = _plan(spark, "knn_lexical")
    assert "SortMergeJoin" not in plan


def test_search_moves_k_rows_per_question_and_task(spark):
    from citegrid.operators import lexical
    from citegrid.plans import retrieval
    docvecs, vocab = retrieval.lexical_index(spark, SF001)
    found = lexical.block_candidates(lexical.query_vectors(retrieval.silver_questions(spark, SF001), vocab).toPandas(), docvecs, 5)
    assert found.count() <= 5 * 140 * max(1, found.rdd.getNumPartitions())


def test_dedup_aggregates_keys_before_shuffle(spark):
    plan = _plan(spark, "ingest_dedup_keep_first")
    assert "partial_min" in plan and "partial_min_by" not in plan


def test_article_xml_is_parsed_once(spark):
    plan = _plan(spark, "ingest_xml_files")
    assert "xpath" not in plan and "from_xml" not in plan          # the join reads the written records
