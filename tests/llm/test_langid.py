import random
import zlib

import numpy as np

from citegrid.llm import langid

SYLLABLES = {"en": ["the", "ing", "ow", "sh"], "de": ["sch", "ung", "ei", "ch"], "fr": ["eau", "oi", "que", "é"]}


def corpus(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        out.append((i, " ".join(words), lang, "s"))
    return out


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    rows = corpus(400)
    odd = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 !!", "en", "s"), (None, rows[0][1], None, None), (1003, "é" * 50_000, None, "s"),
           (5, rows[5][1], rows[5][2], "s")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string")
    got = langid.predict(df).collect()
    assert len(got) == len(rows) + len(odd)
    lang = {r[0]: r[2] for r in rows}
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    test = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out and r.doc_id < 400]
    assert len(test) > 80 and np.mean(test) > 0.95
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[1003].lang_pred in SYLLABLES and by[None].lang_pred == rows[0][2]


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, t, "xx" if held(i) else lang, s) for i, t, lang, s in corpus(60)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert "xx" not in {r.lang_pred for r in got}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.new(["a", "b", "c"])
    for k in ("embed", "filters", "bias", "out", "out_bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    x = rng.integers(0, 257, (6, langid.WINDOW)).astype(np.int16)
    y, w = np.array([0, 1, 2, 0, 1, 2]), np.ones(6)

    def loss():
        return float(-np.log(net.forward(x)[3][np.arange(6), y]).mean())

    grad = langid._gradients(net, x, y, w)
    for name in ("filters", "bias", "out", "out_bias", "embed"):
        p = getattr(net, name)
        for at in [tuple(i) for i in np.argwhere(np.abs(grad[name]) > 1e-4)[:5]]:
            p[at] += 1e-5
            up = loss()
            p[at] -= 2e-5
            down = loss()
            p[at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-4, name


def test_windows_cover_whole_texts():
    texts = [b"", b"abc", b"x" * 128, b"y" * 300]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    windows, row, length = langid.cut(data, offsets)
    for i, t in enumerate(texts):
        assert b"".join(windows[j][windows[j] < 256].astype(np.uint8).tobytes() for j in np.flatnonzero(row == i)) == t
    assert length.sum() == len(data)


def test_no_labels_and_empty(spark, empty):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.predict(df).collect()] == [("und", 0.0)]
    assert langid.predict(empty).count() == 0
