"""Search text: expression, predicate, places of errors, relevance by hand."""
import math

import pytest

from citegrid.sources import cascade, querytext
from citegrid.sources.querytext import Both, Phrase, QueryError, read

T, A = ("title",), ("abstract",)


@pytest.mark.parametrize("text,want", [
    ("cancer[Title/Abstract]", Phrase(("cancer",))),
    ("Breast  Cancer", Phrase(("breast", "cancer"))),
    ('"gene-expression"[TI]', Phrase(("gene", "expression"), T)),
    ("a AND b OR c", Both("OR", Both("AND", Phrase(("a",)), Phrase(("b",))), Phrase(("c",)))),
    ("a AND (b OR c[Abstract])", Both("AND", Phrase(("a",)), Both("OR", Phrase(("b",)), Phrase(("c",), A)))),
    ('"a b" "c" NOT and', Both("NOT", Both("AND", Phrase(("a", "b")), Phrase(("c",))), Phrase(("and",)))),
    ("(((x)))", Phrase(("x",))),
])
def test_read(text, want):
    assert read(text) == want


@pytest.mark.parametrize("text,place", [
    ("", 0), ("  ", 0), ("a AND", 5), ("AND a", 0), ("a OR AND b", 5), ("(a OR b", 0), ("a) b", 1), ("()", 1), ('"a', 0), ('x [Title', 2),
    ("a[Journal]", 2), ("[Title]", 1), ("(a)[Title]", 4), ('"--"', 1), ("NOT a", 0), ("(" * 200 + "a" + ")" * 200, 100),
])
def test_errors_say_where(text, place):
    with pytest.raises(QueryError) as e:
        read(text)
    assert e.value.place == place and str(place) in str(e.value)


def test_reference_texts_are_the_hand_made_predicates(spark):
    t = cascade.tiab
    rows = [("1", "Breast cancer", "a biomarker"), ("2", "gene", "expression of breast cancer"), ("3", "x", "gene expression, breast cancer"),
            ("4", "cancer", "transcriptomic"), ("5", "breast cancer", "transcriptomic"), ("6", "cancers", "biomarker"), ("7", None, "biomarker gene expression")]
    arts = cascade.with_haystack(spark.createDataFrame(rows, "pmid string, title string, abstract string"))
    hand = [t("breast cancer") & (t("biomarker") | t("gene expression") | t("transcriptomic")), t("breast cancer") & (t("biomarker") | t("gene expression")),
            t("cancer") & (t("biomarker") | t("gene expression")), t("biomarker") & t("gene expression"), t("cancer")]
    levels = cascade.reference_levels()
    assert len(levels) == len(hand)
    for lv, p in zip(levels, hand):
        assert sorted(arts.where(lv.predicate).collect()) == sorted(arts.where(p).collect())
    assert [lv.name for lv in cascade.reference_levels("cancer[Title/Abstract]")][0] == "cancer[Title/Abstract]"


def test_relevance_by_hand(spark):
    rows = [("1", "gene gene", "other words here"), ("2", "other", "gene in many many more words than that"), ("2", "other", "gene"),
            ("3", "none", "none"), ("4", "gene", "mouse"), ("5", "", ""), ("6", None, None), ("7", "a a a", "a a")]
    arts = cascade.with_haystack(spark.createDataFrame(rows, "pmid string, title string, abstract string"))
    got = {r["pmid"]: r["score"] for r in querytext.relevance(arts, read("gene NOT mouse"), cascade.HAYSTACK).collect()}
    assert set(got) == {"1", "2"}
    size = [len(h.replace("|", "").split()) for h in (r[cascade.HAYSTACK] for r in arts.collect())]
    hay = [r[cascade.HAYSTACK] for r in arts.collect()]
    length = [h.count(" ") - 2 for h in hay]
    mean, n = sum(length) / len(length), 4
    idf = math.log(1 + (len(rows) - n + .5) / (n + .5))

    def score(tf, i):
        return round(idf * tf * 2.2 / (tf + 1.2 * (.25 + .75 * length[i] / mean)), 6)
    assert got["1"] == pytest.approx(score(4, 0)) and got["2"] == pytest.approx(max(score(1, 1), score(1, 2))) and size[0] == 5
    twice = arts.where("pmid = '7'").select(querytext.occurrences(Phrase(("a", "a")), cascade.HAYSTACK).alias("n")).first()["n"]
    assert twice == 2 * 1 + 1                       # occurrences don't overlap


def test_search_goes_by_relevance(spark):
    rows = [("1", "x", "gene and much much more"), ("2", "gene", "gene"), ("3", "y", "gene")]
    arts = spark.createDataFrame(rows, "pmid string, title string, abstract string")
    ids, used = cascade.search(arts, [cascade.level("zzz"), cascade.level("gene")], 2)
    assert [r["pmid"] for r in ids.collect()] == ["2", "3"] and used == "gene"
    assert [r["pmid"] for r in cascade.search(arts, [cascade.level("gene")], 2, order=["pmid"])[0].collect()] == ["1", "2"]
