import random

import numpy as np
import pytest

from citegrid.llm import repeats
from tests.llm.conftest import COLUMNS


def plain(texts, window):
    """Per text: words, and whether each goes; by a dictionary of all windows."""
    words = [(t or "").encode().split() for t in texts]
    starts = {}
    for i, w in enumerate(words):
        for s in range(len(w) - window + 1):
            starts.setdefault(tuple(w[s:s + window]), []).append((i, s))
    gone = [[False] * len(w) for w in words]
    for places in starts.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s:s + window] = [True] * window
    return words, gone


def expected(rows, window):
    words, gone = plain([t for _, t in rows], window)
    return sorted(((d, len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode()) for (d, _), w, g in zip(rows, words, gone)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def passages(seed, words=40, docs=60):
    """Texts of few words with planted passages, overlapping copies, periodic runs and copies that end early."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    out = []
    for i in range(docs):
        text = []
        for _ in range(rng.randrange(0, 6)):
            text += [rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            text += p[a:] if rng.random() < .5 else p[:a]
        if i % 9 == 0:
            text += ["ab", "cd"] * 30
        out.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    return out + [(90, None), (91, ""), (92, " \n"), (None, out[3][1]), (None, out[4][1]), (5, out[5][1]), (93, "one"), (94, "A a Ä ä " * 20)]


@pytest.mark.parametrize("window,most", [(35, 4096), (12, 4096), (12, 1), (3, 2), (1, 4096)])
def test_equals_brute_force(spark, window, most, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_MOST", most)
    monkeypatch.setattr(repeats, "TREE_WORDS", 500)
    rows = passages(window)
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, g string, t1 int, marks int").repartition(3)
    got = found(repeats.remove(df, window))
    assert got == expected(rows, window) and any(r[2] for r in got)


def test_documents_with_odd_rows(spark, docs, rows):
    assert found(repeats.remove(docs)) == expected([(r[0], r[1]) for r in rows], 35)


def test_spans_are_the_removed_words(spark):
    rows = passages(4)
    for r in repeats.remove(spark.createDataFrame(rows, "doc_id long, text string"), 12).where("n_removed > 0").collect():
        assert sum(s.end - s.first for s in r.spans) == r.n_removed
        assert all(a.end < b.first for a, b in zip(r.spans, r.spans[1:]))


def test_names_are_equal_for_equal_words_only():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    for depth in (1, 2, 3, 5, 8, 13):
        names = repeats.names_at(words, depth)
        by_name = {}
        for i, n in enumerate(names.tolist()):
            by_name.setdefault(n, set()).add(tuple(words[i:i + depth].tolist()))
        assert all(len(s) == 1 for s in by_name.values()) and len(set().union(*by_name.values())) == len(by_name)


def test_empty(spark, empty):
    assert repeats.remove(empty).count() == 0
    assert repeats.remove(spark.createDataFrame([(None, None), (1, "a b")], "doc_id long, text string")).count() == 2
    assert COLUMNS
