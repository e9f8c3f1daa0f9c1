import random
import re
from collections import Counter

import pytest

from citegrid.llm import phrases

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=4, report=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    covered = {(lang, p[i:i + m]) for (lang, p), b in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
               if 100 * b >= 80 * often[lang, p[i:i + m]]}
    out = []
    for lang in n:
        found = []
        for (x, p), a in often.items():
            if x != lang or (x, p) in covered:
                continue
            cuts = [(2000000 * a // (f[x, p[:k]] + f[x, p[k:]]), k, f[x, p[:k]], f[x, p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            found.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:report])]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in df.dtypes} == {"string", "bigint"}
    return sorted(tuple(r) for r in df.collect())


def table(seed):
    rng = random.Random(seed)
    idioms = ["In The end", "new  york\tcity hall", "Ähm ja nun", "a b", "x y z w v"]
    rows = []
    for i in range(240):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            parts.append(rng.choice(idioms) if rng.random() < .4 else f"w{int(rng.expovariate(.2))}")
            parts.append(rng.choice([" ", " ", " ", ". ", ",", "\n", " \t", "!?"]))
        rows.append(("".join(parts), ["en", "de", None, "und"][i % 7 % 4]))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("one", "fr"), (rows[0][0], rows[0][1])]


@pytest.mark.parametrize("least,shard,report", [(30, 1 << 20, 2000), (5, 200, 2000), (1, 30, 7)])
def test_equals_brute_force(spark, least, shard, report, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "SLICE", 100)
    monkeypatch.setattr(phrases, "CHUNK", 7)
    monkeypatch.setattr(phrases, "ROWS", 5)
    rows = table(least)
    df = spark.createDataFrame([(t, x, "c", 1, 2) for t, x in rows], "text string, lang string, key string, c int, total int").repartition(3)
    want = plain(rows, least, report=report)
    assert got(phrases.collocations(df, least, report=report)) == want and want


def test_documents_with_odd_rows(spark, docs, rows):
    assert got(phrases.collocations(docs, 3)) == plain([(r[1], r[2]) for r in rows], 3)


def test_long_phrases(spark):
    rows = [("a b c d e f g", "en")] * 4 + [("b c d e", "en")] * 9
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(phrases.collocations(df, 2, longest=6)) == plain(rows, 2, longest=6)
    assert got(phrases.collocations(df, 2, longest=2)) == plain(rows, 2, longest=2)


def test_empty(spark, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b", None)], "text string, lang string")).count() == 0


def test_bound_over_shards(spark, monkeypatch):
    """Phrases spread evenly, in one shard alone, and just below the support, in shards of unequal sizes."""
    monkeypatch.setattr(phrases, "SHARD", 90)
    rows = [("common pair and more", "en")] * 40 + [(f"f{i} g{i} h{i} i{i}", "en") for i in range(60)]
    rows += [("only here", "en")] * 30 + [("never enough", "en")] * 29 + [("two tongues", x) for x in ("en", "de") for _ in range(29)]
    spread = rows[::2] + rows[1::2]
    for some in (rows, spread, sorted(rows)):
        assert got(phrases.collocations(spark.createDataFrame(some, "text string, lang string").repartition(5), 30)) == plain(some, 30)


def test_phrases_that_their_task_does_not_find(spark, monkeypatch):
    """Tasks numbered otherwise in the last scan: the phrases are spelled all the same."""
    spell = phrases._spell

    def elsewhere(longest, words, often, among, owned):
        run = spell(longest, words, often, among, owned)
        return (lambda batches: iter(())) if owned else run
    monkeypatch.setattr(phrases, "_spell", elsewhere)
    rows = table(7)
    assert got(phrases.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), 5)) == plain(rows, 5)


def test_shards_report_no_chance_meetings(spark, monkeypatch):
    """Phrases that meet twice in a shard but are rare in all of them do not become rows."""
    rng = random.Random(5)
    rows = [(" ".join(f"w{rng.randrange(150)}" for _ in range(60)) + " common pair", "en") for _ in range(400)]
    reported = {}

    def counting(df, name, paths=None, real=phrases.materialize):
        written = real(df, name, paths)
        if name.startswith("phrases-local"):
            reported[name] = written.where("key is not null").count()
        return written
    monkeypatch.setattr(phrases, "materialize", counting)
    found = got(phrases.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(16), 30))
    assert found == plain(rows, 30) and found
    assert 0 < reported["phrases-local-1"] <= len(found) + 3


def test_cells_of_frequent_keys(spark, monkeypatch):
    """Ranges, repeats over many tasks and counts beyond the width of a byte."""
    import numpy as np

    from citegrid.llm import often
    from citegrid.llm.textbatch import mix64
    monkeypatch.setattr(often, "RANGE", 50)
    keys = mix64(np.random.default_rng(3).integers(0, 400, 4000).astype(np.uint64)).view(np.int64)
    names, counts = np.unique(keys, return_counts=True)
    bits = often.range_bits(len(names))
    assert bits == 3
    for least in (1, 10, 300):
        rows = [r for part in np.array_split(keys, 7) for b in often.pack(*np.unique(part, return_counts=True), bits, least) for r in b.to_pylist()]
        rows += [r for b in often.pack(names[:1], np.array([500]), bits, least) for r in b.to_pylist()]
        df = spark.createDataFrame([tuple(r.values()) for r in rows], often.PACKED)
        total = counts + 500 * (np.arange(len(names)) == 0)
        assert sorted(r.cell for r in often.cells_with(df, least).collect()) == sorted(often.cells(names[total >= least], bits).tolist())
    assert often.range_bits(0) == 0 and not list(often.pack(keys[:0], counts[:0], 0, 3))
