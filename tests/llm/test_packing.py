import re

from citegrid.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_bins(docs, rows):
    got = packing.pack(docs, capacity=200, shard_pieces=40).collect()
    words = {}
    for d, t, *_ in rows:
        words.setdefault(d, []).append(len(WORD.findall(t or "")))
    pieces = {}
    for r in got:
        assert 0 <= r.words <= 200 and r.start == r.piece * 200
        pieces.setdefault(r.doc_id, []).append(r.words)
    assert {d: sum(p) for d, p in pieces.items()} == {d: sum(n) for d, n in words.items()}
    assert len(got) == sum(max(1, -(-n // 200)) for ns in words.values() for n in ns)
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    text = {r[0]: " ".join(WORD.findall((r[1] or "").lower())) for r in rows if r[0] is not None}
    for members in bins.values():
        assert sum(r.words for r in members) <= 200
        assert len({r.source for r in members}) == len(members)
        clusters = [text[r.doc_id] for r in members if text.get(r.doc_id)]
        assert len(set(clusters)) == len(clusters)


def test_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert bins.place(7, 1, 0) == 0          # residual 3
    assert bins.place(6, 2, 0) == 1          # residual 4
    assert bins.place(3, 4, 0) == 0          # the tighter one
    assert bins.place(4, 2, 0) == 2          # bin 1 has its source
    assert bins.place(4, 4, 0) == 1
    assert bins.place(1, 8, 1) == 2 and bins.place(1, 16, 1) == 3


def brute(sizes, sources, clusters, capacity):
    """Every bin is looked at: the tightest one without a conflict; of equal ones the one that has been so tight longest."""
    bins, out = [], []
    for step, (n, s, c) in enumerate(zip(sizes, sources, clusters)):
        fits = [(b[0], b[3], i) for i, b in enumerate(bins) if b[0] >= n and not b[1] & s and not b[2] & c]
        i = min(fits)[2] if fits else len(bins)
        if not fits:
            bins.append([capacity, 0, 0, 0])
        bins[i] = [bins[i][0] - n, bins[i][1] | s, bins[i][2] | c, step]
        out.append(i)
    return out


def test_best_fit_equals_brute_force():
    import random
    rng = random.Random(4)
    for _ in range(60):
        n = 120
        sizes = sorted((rng.randrange(0, 40) for _ in range(n)), reverse=True)
        sources = [1 << rng.randrange(6) for _ in range(n)]
        clusters = [rng.choice([0, 0, 0, 1 << rng.randrange(5)]) for _ in range(n)]
        bins = packing.Bins(40)
        got = [bins.place(*x) for x in zip(sizes, sources, clusters)]
        assert got == brute(sizes, sources, clusters, 40)


def test_layout_does_not_matter(docs):
    got = [sorted(map(tuple, packing.pack(d, capacity=200, shard_pieces=40).collect()), key=repr)
           for d in (docs.coalesce(1), docs.repartition(5), docs.orderBy(docs.n_chars.desc()).coalesce(2))]
    assert got[0] == got[1] == got[2]


def test_many_copies_of_a_row(spark):
    n = 2 * packing.COPIES + 5
    got = packing.pack(spark.range(n).selectExpr("7L doc_id", "'a b c' text", "'s' source"), capacity=10, shard_pieces=1000).collect()
    assert len(got) == n and len({r.bin_id for r in got}) == n and {r.words for r in got} == {3}


def test_empty(empty):
    assert packing.pack(empty).count() == 0
