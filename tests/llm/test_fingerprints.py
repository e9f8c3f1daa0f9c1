import hashlib
import random

from citegrid.llm import fingerprints as fp


def gear_plain(data):
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(fp._GEAR[b])) % (1 << 32)
        out.append(h)
    return out


def chunks_plain(data):
    h, start, out = gear_plain(data), 0, []
    while len(data) - start > fp.LEAST:
        end = min(len(data), start + fp.MOST)
        for i in range(start + fp.LEAST, end + 1):
            mask = fp._STRICT if i < start + fp.NORMAL else fp._LOOSE
            if not h[i - 1] & int(mask):
                end = i
                break
        out.append(data[start:end])
        start = end
    return out + ([data[start:]] if start < len(data) else [])


def test_chunks_equal_plain_gear_hash():
    rng = random.Random(5)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 24, 25, 300, 5000)] + [b"aaaa" * 600]
    for t, got in zip(texts, fp.chunk_sets(texts)):
        parts = chunks_plain(t)
        assert b"".join(parts) == t and all(len(p) <= fp.MOST for p in parts)
        assert got == fp.chunk_sets([t])[0]
        assert sum(got.values()) == sum({p: len(p) for p in parts}.values())


def test_shift_changes_few_chunks():
    rng = random.Random(6)
    text = " ".join(f"word{rng.randrange(3000)}" for _ in range(800)).encode()
    a, b = fp.chunk_sets([text, b"inserted " + text])
    assert fp.likeness(a, b) > 0.9


def test_likeness():
    assert fp.likeness({}, {}) == 1 and fp.likeness({}, {"a": 3}) == 0
    assert fp.likeness({"a": 3, "b": 1}, {"a": 3, "c": 10}) == 0.75


def test_edited_equals_plain(docs, rows):
    got = fp.edited_likeness(docs, rows_per_range=7).collect()
    named = sorted([r for r in rows if r[0] is not None], key=lambda r: -r[0])
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], r[1] or "")
    by = {r.doc_id: r for r in got}
    for i, r in enumerate(named[:-1]):
        if r[0] == named[i + 1][0]:
            continue                          # the repeated row is its own neighbour
        following = texts[named[i + 1][0]]
        edited = fp.edit(r[1] or "", following).encode()
        a, b, c = fp.chunk_sets([(r[1] or "").encode(), edited, following.encode()])
        x = by[r[0]]
        assert x.n_chars == len(r[1] or "") and x.fingerprint == fp.as_string(a) and x.near_next == fp.likeness(a, c)
        if r[0] != 7:
            assert x.edited_sha256 == hashlib.sha256(edited).hexdigest() and x.near_edited == fp.likeness(a, b)
    # after the smallest id come the null ids, in order of their texts' hashes, and after them the first
    last = [r for r in got if r.doc_id is None]
    assert len(last) == 3
    first = named[0][1]
    ends = {hashlib.sha256(fp.edit(t, n).encode()).hexdigest() for t in ("", "text without id one two three")
            for n in ("", "text without id one two three", first)}
    assert all(r.edited_sha256 in ends for r in last)


def test_ranges_do_not_matter(docs):
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.edited_sha256, r.near_next)
    assert sorted(map(key, fp.edited_likeness(docs, 5).collect())) == sorted(map(key, fp.edited_likeness(docs, 10_000).collect()))


def test_single_and_empty(spark, empty):
    one = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    r = fp.edited_likeness(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1
    assert fp.edited_likeness(empty).count() == 0
    assert fp.fingerprints(empty).columns == empty.columns + ["fingerprint"]


def test_equal_texts_have_equal_fingerprints(docs):
    seen = {}
    for r in fp.fingerprints(docs.select("doc_id", "text", "cls")).collect():
        assert seen.setdefault(r.text or "", r.fingerprint) == r.fingerprint
