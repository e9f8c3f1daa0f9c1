import hashlib
import re

import pytest

from citegrid.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by literal resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        target = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if target[s] >= most * sizes[s]]
        if not over:
            return {**held, **target}
        held |= {s: most * sizes[s] for s in over}


def test_decide(docs, rows):
    got = mixing.decide(docs).collect()
    sizes = {}
    for d, t, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = shares(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        largest = max(len(WORD.findall(x[1] or "")) for x in rows if x[3] == s)
        assert abs(taken[s] - t) <= 2 * largest, s
    assert sorted((r.doc_id or -1, r.taken) for r in got) == sorted((r.doc_id or -1, r.taken) for r in mixing.decide(docs).collect())


def test_threshold_is_nested(docs):
    """A source with a smaller budget takes a subset of the rows that a larger one takes."""
    few = {r.doc_id: r.copies for r in mixing.decide(docs, weights=(1, 4, 4, 4)).collect() if r.source == "s0" and r.doc_id is not None}
    many = {r.doc_id: r.copies for r in mixing.decide(docs, weights=(4, 1, 1, 1)).collect() if r.source == "s0" and r.doc_id is not None}
    assert all(few[d] <= many[d] for d in few)


def test_hash_is_of_the_id(docs):
    want = int(hashlib.md5(b"3").hexdigest()[:15], 16)
    assert docs.where("doc_id = 3").select(mixing.row_hash().alias("v")).first().v == want


def test_salted_join_agrees(docs, monkeypatch):
    plain = sorted((r.doc_id or -1, r.taken) for r in mixing.decide(docs).collect())
    mixed = sorted(str(r) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert plain == sorted((r.doc_id or -1, r.taken) for r in mixing.decide(docs).collect())
    assert mixed == sorted(str(r) for r in mixing.mix(docs).collect())


def test_mix_repeats_rows(docs):
    want = {}
    for r in mixing.decide(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {}
    for r in mixing.mix(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert mixing.mix(docs).columns == docs.columns
    assert got == {d: n for d, n in want.items() if n}


def test_empty(empty):
    assert mixing.decide(empty).count() == 0 and mixing.mix(empty).columns == empty.columns
