import random
import re

import numpy as np
import pytest

from citegrid.llm import bitmap, components, ngram_join, textbatch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def sets(rows, k):
    out = []
    for d, t, *_ in rows:
        w = WORD.findall((t or "").translate(FOLD))
        out.append((d, {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()))
    return out


def brute(rows, rule):
    """Component (as a set of row numbers) of every row, by comparing all pairs."""
    s = sets(rows, rule.k)
    root = list(range(len(s)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            a, b = s[i][1], s[j][1]
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(s)):
        groups.setdefault(find(i), []).append(i)
    return s, groups


def check(df, rows, rule):
    s, groups = brute(rows, rule)
    want = []
    for members in groups.values():
        low = min((s[i][0] for i in members if s[i][0] is not None), default=None)
        want += [(str(s[i][0]), len(s[i][1]), str(low)) for i in members]
    got = [(str(r.doc_id), r.n, str(r.component_id)) for r in ngram_join.component_ids(ngram_join.join(df, rule)).collect()]
    assert sorted(got) == sorted(want)
    return s, groups


@pytest.mark.parametrize("rule", [ngram_join.Rule(5, 80, 100), ngram_join.Rule(3, 90, 100)])
def test_equals_all_pairs(docs, rows, rule):
    check(docs, rows, rule)


def near_copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        out.append((i, " ".join(w)))
    return out


def test_large_group_of_near_copies(spark, monkeypatch):
    """Blocks and tiles of hot groups lose no link."""
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 16)
    rows = near_copies(150, 120, 6, 3) + [(1000 + i, t) for i, t in near_copies(30, 80, 2, 4)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, ngram_join.Rule(3, 90, 100))


def test_join_without_bitmap(spark, monkeypatch):
    monkeypatch.setattr(bitmap, "MOST_BITS", 1)
    rows = near_copies(40, 60, 4, 5)
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, ngram_join.Rule(5, 80, 100))


def test_keep_one(docs, rows):
    rule = ngram_join.Rule(5, 80, 100)
    s, groups = brute(rows, rule)
    kept = ngram_join.keep_one(docs, rule)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    for members in groups.values():
        if not s[members[0]][1]:
            continue
        ids = [s[i][0] for i in members]
        if None not in ids:
            assert [d for d in got if d in ids] == [min(ids)]
    assert len(got) == sum(1 if s[m[0]][1] else len(m) for m in groups.values())


def test_empty(empty):
    assert ngram_join.component_ids(ngram_join.join(empty)).count() == 0
    assert ngram_join.keep_one(empty).count() == 0


def test_components_of_many_tasks(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(60)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = sorted((x, find(x)) for x in root if find(x) != x)
    df = spark.createDataFrame(links, "a long, b long")
    for per_task in (7, 1000):
        got = [(r.node, r.root) for r in components.components(df.where("a is not null"), per_task).collect()]
        assert sorted(got) == want


def test_bounds_lose_nothing():
    """Parities never differ in more places than the sets do; prefixes of linked sets meet."""
    rng = np.random.default_rng(1)
    rule = ngram_join.Rule(3, 90, 100)
    cells = rng.integers(0, 50, ngram_join.CELLS)
    for _ in range(200):
        n = int(rng.integers(5, 300))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.05], rng.integers(0, 2 ** 63, rng.integers(0, 6)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both * 190 < (len(a) + len(b)) * 90:
            continue
        first = [set(x[np.argsort(ngram_join.order_key(x, cells), kind="stable")[:rule.prefix(len(x))]].tolist()) for x in (a, b)]
        assert first[0] & first[1]
        apart = ngram_join.parities_apart([ngram_join.parity_of(a)], [ngram_join.parity_of(b)])[0]
        assert apart <= len(a) + len(b) - 2 * both <= len(a) + len(b) - 2 * rule.least_overlap(len(a) + len(b))


def test_pivots_cut_equal_weights():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2 ** 63, 200_000).astype(np.uint64) * np.uint64(2)
    h = textbatch.mix64(h)
    cells = np.bincount((h & np.uint64(ngram_join.CELLS - 1)).astype(int), minlength=ngram_join.CELLS)
    piece = np.searchsorted(ngram_join.pivots(cells), ngram_join.order_key(h, cells), "right")
    share = np.bincount(piece, minlength=ngram_join.FRAGMENTS) / len(h)
    assert share.min() > 0.06 and share.max() < 0.2


def test_words_longer_than_the_window(monkeypatch):
    import pyarrow as pa
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + ["x" * 200, "", None, "y" * 40 + " z"]
    column = pa.array(texts)
    whole = textbatch.word_hashes(*textbatch.flat(column))
    monkeypatch.setattr(textbatch, "WINDOW", 16)
    parts = textbatch.word_hashes(*textbatch.flat(column))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert np.diff(whole[1]).tolist() == [len(WORD.findall(t or "")) for t in texts]
    got = {}
    for i, t in enumerate(texts):
        for w, h in zip(WORD.findall(t or ""), whole[0][whole[1][i]:whole[1][i + 1]].tolist()):
            assert got.setdefault(w, h) == h
    assert len(set(got.values())) == len(got)


def test_size_bands_keep_linkable_sizes_together():
    for rule in (ngram_join.Rule(3, 90, 100), ngram_join.Rule(5, 80, 100)):
        bands = ngram_join.size_bands(rule, 10_000)
        for n in range(1, 2000):
            m = n * rule.den // rule.num
            assert np.searchsorted(bands, m, "right") - np.searchsorted(bands, n, "right") in (0, 1)


def test_rows_stay_small_in_long_texts(spark, monkeypatch):
    """A set's rows name a bounded number of groups, however long its text is; no pair is lost by that."""
    monkeypatch.setattr(ngram_join, "NAMED", 1)
    rows = near_copies(24, 400, 70, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _, groups = check(df, rows, ngram_join.Rule(5, 80, 100))
    assert len(groups) > 1
    x = np.array([3, 5, 9])
    zero = np.zeros(3, int)
    assert not ngram_join._met_before(3, x, zero, x, zero) and ngram_join._met_before(5, x, zero, x, zero)
    assert not ngram_join._met_before(5, x, zero + 1, x, zero + 1)


def test_scratch_tables_are_removed(spark, docs):
    from citegrid.session import ensure_checkpoint_dir

    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/tables")
    store = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def tables():
        return {str(x.getPath().getName()).rsplit("-", 1)[0] for x in store.listStatus(fs)} if store.exists(fs) else set()

    before = {str(x.getPath().getName()) for x in store.listStatus(fs)} if store.exists(fs) else set()
    kept = ngram_join.keep_one(docs)
    kept.count()
    after = {str(x.getPath().getName()) for x in store.listStatus(fs)} - before
    assert {x.rsplit("-", 1)[0] for x in after} == {"keep-gone", "keep-repeated"} and tables()


@pytest.mark.parametrize("rule", [ngram_join.Rule(3, 90, 100), ngram_join.Rule(5, 80, 100)])
def test_linked_sets_share_a_token(rule):
    """In the space of the larger set, where one of the two is in its own; sets with single n-grams in common share none."""
    rng = np.random.default_rng(2)
    cells = rng.integers(1, 60, ngram_join.CELLS)
    low, _ = ngram_join.spaces(rule)
    linked = 0
    for i in range(600):
        a = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(1, 30 if i % 2 else 400))).astype(np.uint64) * np.uint64(2))
        more = rng.integers(0, 2 ** 63, rng.integers(0, 2 + len(a) // 6)).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * .2], more]))
        both = len(np.intersect1d(a, b))
        if not both * (rule.num + rule.den) >= (len(a) + len(b)) * rule.num:
            continue
        linked += 1
        (x, own_x), (y, own_y) = (ngram_join.tokens(rule, s, cells) for s in (a, b))
        assert set(x[:own_x].tolist()) & set(y.tolist()) or set(y[:own_y].tolist()) & set(x.tolist())
        assert len(x) <= 2 * (rule.spoiled(len(a) + len(a) * rule.den // rule.num) + 1 + rule.prefix(len(a)))
    assert linked > 100 and (np.diff(low) > 0).all()
    a, b = (np.unique(np.concatenate([np.arange(1, 41, dtype=np.uint64) << np.uint64(57), rng.integers(0, 2 ** 63, 300).astype(np.uint64)])) for _ in (0, 1))
    assert not set(ngram_join.tokens(rule, a, cells)[0].tolist()) & set(ngram_join.tokens(rule, b, cells)[0].tolist())


def test_a_tile_emits_forests_of_its_components():
    """Rows of pairs grow with the members of a group, not with their square; what is held back is told."""
    import pyarrow as pa

    m = 40
    cls = np.arange(1, m + 1)
    lists = lambda x: pa.array([[x]] * m, pa.list_(pa.int64()))
    tile = pa.record_batch([pa.array(x) for x in (np.full(m, 7), np.zeros(m, int), cls, np.full(m, 100), np.zeros(m, int), cls, np.full(m, 2))]
                           + [pa.array([bytes(32)] * m, pa.binary()), lists(7), lists(0)],
                           ["sh", "tile", "cls", "n", "up", "comp", "side", "parity", "keys", "ups"])
    rows = lambda most: [r for b in ngram_join._compare(ngram_join.Rule(), most)(iter([tile])) for r in b.to_pylist()]
    for most in (1, 2):
        got = rows(most)
        assert got[-1] == {"a": None, "b": None} and m <= len(got) <= most * (m - 1) + 1
        root = {r["b"]: r["a"] for r in got[:-1]}
        assert set(root) | {1} == set(cls.tolist())
    assert len(rows(m)) == m * (m - 1) // 2 and all(r["a"] < r["b"] for r in rows(m))


def test_rounds_lose_nothing(spark, monkeypatch):
    """Pairs held back in one round are looked at in the next."""
    monkeypatch.setattr(ngram_join, "FORESTS", 1)
    monkeypatch.setattr(ngram_join, "MORE", 2)
    rows = near_copies(70, 90, 14, 9)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, ngram_join.Rule(3, 80, 100))


def test_groups_that_hold_pairs_back_are_named(spark):
    """The next round looks at these alone, not at all groups that have several components."""
    alike, apart = range(1, 21), range(101, 106)
    many = spark.createDataFrame([(sh, c, 100, 0) for sh, members in ((7, alike), (8, apart)) for c in members], "sh long, cls long, n long, up int")
    parity = lambda c: bytes(32) if c in alike else bytes(255 if i // 6 == c - 101 else 0 for i in range(32))
    sets = spark.createDataFrame([(c, 100, parity(c)) for c in (*alike, *apart)], "cls long, n long, parity binary")
    known = spark.createDataFrame([], "node long, root long")
    near, compared = ngram_join._near(many, known, sets, ngram_join.Rule(), 2, [])
    rows = near.collect()
    assert {r.sh for r in rows if r.a is None} == {7} and {r.sh for r in rows if r.a is not None} == {None}
    assert {a for r in rows if r.a is not None for a in (r.a, r.b)} == set(alike)
    assert compared.count() == 25
    again, compared = ngram_join._near(compared.join(near.where("a is null").select("sh"), "sh", "left_semi"), known, sets, ngram_join.Rule(), 32, [])
    assert compared.count() == 20 and again.where("a is null").isEmpty() and again.count() == 190


def test_one_of_the_groups_with_the_same_members(spark):
    """Groups of three, and of one component, have no pair left to look at."""
    groups = {1: "abcd", 2: "abcd", 3: "abce", 4: "abc", 5: "abcde", 6: "aaaa"}
    rows = [(sh, ord(c) * 10 + (i if sh == 6 else 0), 9, 0, ord(c)) for sh, members in groups.items() for i, c in enumerate(members)]
    rows += [(7, ord(c) * 10, 9, int(c == "d"), ord(c)) for c in "abcd"]          # d is there from another space
    got = ngram_join._split(spark.createDataFrame(rows, "sh long, cls long, n long, up int, comp long")).collect()
    assert sorted((r.sh, r.size) for r in got) == [(1, 4), (3, 4), (5, 5), (7, 4)]


def test_documents_that_surely_stay_are_not_moved(spark, docs):
    """However many documents go, the texts of the others pass no exchange."""
    plan = ngram_join.keep_one(docs)._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    first = plan.children().head().toString()
    assert "MapInArrow" in first and "Join" not in first


@pytest.mark.parametrize("inside", [False, True])
def test_sift_keeps_every_row_on_one_side(spark, inside):
    keys = spark.range(0, 400, 4).select("id")
    known = spark.sparkContext.broadcast(bitmap.build(keys, 100))
    got = {r.id for r in spark.range(400).mapInArrow(ngram_join._sift(known, "id", inside), "id long").collect()}
    other = {r.id for r in spark.range(400).mapInArrow(ngram_join._sift(known, "id", not inside), "id long").collect()}
    assert got | other == set(range(400)) and not got & other
    assert set(range(0, 400, 4)) <= (got if inside else other)
