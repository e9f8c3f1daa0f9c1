"""Property tests over generated answers (one Spark job for all examples)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citegrid.functions import rules as R

HEADERS = ["Answer:", "answer :", " ANSWER:", "Biomarkers:", "biomarkers mentioned in evidence :",
           "Biomarkers mentioned in Evidence:", "Takeaways:", "takeaways:", "References:"]
PIECES = st.sampled_from(HEADERS + ["", "- BRCA1 [1]", "- x [#]", "Foo [2].", "Bar.[1] Baz.", "e.g. TP53 [3]",
                                    "- c [99999999999999999999]", "not relevant", "  ", "MYC is up [1]."])
ANSWERS = st.lists(st.lists(PIECES, min_size=0, max_size=12).map("\n".join), min_size=300, max_size=300)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(ANSWERS)
def test_normalize_idempotent_and_validation_total(spark, answers):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string")
    df = df.withColumn("n", R.normalize("a")).withColumn("evidence", F.lit("BRCA1 and TP53 in tumours"))
    df = R.with_validation(df.withColumn("answer", F.col("n")), k=3, markers=None)
    rows = df.select("n", R.normalize("n").alias("nn"), "validation").collect()
    assert len(rows) == len(answers)
    for r in rows:
        assert r["nn"] == r["n"]
        v = r["validation"]
        assert v["ok"] == (len(v["issues"]) == 0)
        assert ("MYC" in v["leaked_tokens"]) == ("MYC" in r["n"])
