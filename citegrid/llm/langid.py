"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes.  A window goes through
a byte embedding, filters of several widths, a maximum over all places, and a
softmax over the learned languages; a text's prediction is the mean over all
its windows, weighted by their bytes.  The network is trained with numpy on
windows of a bounded sample of labelled texts.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm.textbatch import flat, slices
from citegrid.session import ship_package

WINDOW = 128
EMBEDDING = 4
#: Filter width in bytes to number of filters.
FILTERS = {2: 6, 3: 8, 4: 10}
WIDEST = max(FILTERS)
#: Labelled texts of each language, and windows of each text, that are trained on at most (the bound of the fitted sample).
TEXTS, WINDOWS_OF_TEXT = 400, 6
EPOCHS, BATCH, RATE = 10, 128, 0.01
UNDETERMINED = "und"
#: Windows that go through the network at a time.
CHUNK = 256


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray                      # (257, EMBEDDING); 256 is padding and stays zero
    filters: np.ndarray                    # (WIDEST * EMBEDDING, n); zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray                        # (n, languages)
    out_bias: np.ndarray
    mask: np.ndarray = field(repr=False)   # where a filter has weights

    @classmethod
    def new(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        n = sum(FILTERS.values())
        embed = rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32)
        embed[256] = 0
        mask = np.concatenate([np.repeat(np.arange(WIDEST) < w, EMBEDDING)[:, None].repeat(c, 1)
                               for w, c in FILTERS.items()], axis=1).astype(np.float32)
        filters = (rng.normal(0, 0.35, (WIDEST * EMBEDDING, n)) * mask).astype(np.float32)
        out = rng.normal(0, 0.2, (n, max(1, len(languages)))).astype(np.float32)
        return cls(languages, embed, filters, np.zeros(n, np.float32), out, np.zeros(max(1, len(languages)), np.float32), mask)

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(window, place, WIDEST * EMBEDDING) views of the embedded bytes."""
        padded = np.full((len(windows), WINDOW + WIDEST - 1), 256, np.int16)
        padded[:, :WINDOW] = windows
        e = np.ascontiguousarray(self.embed[padded]).reshape(len(windows), -1)
        return np.lib.stride_tricks.as_strided(
            e, (len(windows), WINDOW, WIDEST * EMBEDDING), (e.strides[0], EMBEDDING * e.itemsize, e.itemsize), writeable=False)

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """columns, pooled activations, place of each maximum, probabilities."""
        cols = self.columns(windows)
        act = cols @ self.filters
        place = act.argmax(axis=1)
        top = np.take_along_axis(act, place[:, None, :], 1)[:, 0, :]
        pooled = np.maximum(top + self.bias, 0)
        return cols, pooled, place, softmax(pooled @ self.out + self.out_bias)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        parts = []
        for i in range(0, len(windows), CHUNK):
            act = np.matmul(self.columns(windows[i:i + CHUNK]), self.filters).max(axis=1)
            parts.append(softmax(np.maximum(act + self.bias, 0) @ self.out + self.out_bias))
        return np.concatenate(parts) if parts else np.zeros((0, self.out.shape[1]), np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the cross entropy; languages weigh alike however many windows they have."""
    net = Network.new(languages, seed)
    if not len(windows) or len(languages) < 2:
        return net
    rng = np.random.default_rng(seed)
    weight = 1 / np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    weight = (weight * len(labels) / len(languages))[labels].astype(np.float32)
    names = ("embed", "filters", "bias", "out", "out_bias")
    m, v, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        rate = RATE * (1 - epoch / epochs)
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            grad = _gradients(net, windows[pick], labels[pick], weight[pick])
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                getattr(net, k).__isub__(rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8))
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    cols, pooled, place, p = net.forward(x)
    d = p.copy()
    d[np.arange(len(y)), y] -= 1
    d *= weight[:, None] / len(y)
    back = (d @ net.out.T) * (pooled > 0)                                   # (window, filter), at the place of its maximum
    row = np.arange(len(x))[:, None]
    seen = cols[row, place]                                                  # (window, filter, WIDEST * EMBEDDING)
    filters = np.einsum("nf,nfw->wf", back, seen) * net.mask
    into = back[:, :, None] * net.filters.T[None]                            # gradient of the embedded bytes
    padded = np.full((len(x), WINDOW + WIDEST - 1), 256, np.int64)
    padded[:, :WINDOW] = x
    symbols = padded[row[:, :, None], place[:, :, None] + np.arange(WIDEST)]
    embed = np.zeros_like(net.embed)
    np.add.at(embed, symbols.reshape(-1), into.reshape(-1, EMBEDDING))
    embed[256] = 0
    return {"embed": embed, "filters": filters, "bias": back.sum(0), "out": pooled.T @ d, "out_bias": d.sum(0)}


# ------------------------------------------------------------ texts to windows

def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows (symbols, padded with 256), the row of each and its bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row] + nth * WINDOW
    length = np.minimum(WINDOW, offsets[1:][row] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    windows = np.full((len(row), WINDOW), 256, np.int16)
    if len(row):
        windows[inside] = data[np.minimum(at, len(data) - 1)[inside]]
    return windows, row, length


def learnable():
    """Rows that languages may be learned from; the others are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)), F.lit(0)) != 1


def _sampled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            windows, row, _ = cut(*flat(rows.column("text")))
            first = np.searchsorted(row, np.arange(rows.num_rows + 1))
            lang, out = rows.column("lang").to_pylist(), []
            for i, (a, b) in enumerate(zip(first, first[1:])):
                out += [(lang[i], windows[j].tobytes()) for j in np.unique(np.linspace(a, b - 1, WINDOWS_OF_TEXT).astype(int))] if b > a else []
            yield pa.record_batch([pa.array([x for x, _ in out], pa.string()), pa.array([w for _, w in out], pa.binary())], ["lang", "window"])


def learn(docs: DataFrame, texts: int = TEXTS) -> Network:
    """Trains on at most some ``texts`` texts of each language, taken by hash of
    the id among the rows that may be learned from."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & learnable() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}        # one row a language
    place, keep = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("window")), F.lit(1_000_000)), F.lit(False)
    for lang, n in counts.items():
        keep = keep | ((F.col("lang") == lang) & (place < min(1_000_000, 1 + 1_000_000 * texts // n)))
    got = (rows.where(keep).limit(2 * texts * max(1, len(counts))).select("lang", "text")
           .mapInArrow(_sampled_windows, "lang string, window binary").toPandas())
    got = got.sort_values(["lang", "window"]).reset_index(drop=True)
    languages = sorted(counts)
    windows = np.stack([np.frombuffer(w, np.int16) for w in got.window]) if len(got) else np.zeros((0, WINDOW), np.int16)
    return fit(windows, np.searchsorted(languages, got.lang.to_numpy(dtype=str)) if len(got) else np.zeros(0, np.int64), languages)


# ------------------------------------------------------------ prediction

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _has_letter(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ASCII_LETTER[data], out=seen[1:])
    has = np.diff(seen[offsets]) > 0
    for i in np.flatnonzero(~has & (np.diff(offsets) > 0)).tolist():
        has[i] = any(c.isalpha() for c in rows.column("text")[i].as_py() or "")
    return has


def _predict(broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = broadcast.value
        for batch in batches:
            for rows in slices(batch, max_bytes=1 << 20):
                data, offsets = flat(rows.column("text"))
                lang, score = [UNDETERMINED] * rows.num_rows, np.zeros(rows.num_rows)
                if net.languages and len(data):
                    windows, row, length = cut(data, offsets)
                    total = np.zeros((rows.num_rows, len(net.languages)))
                    np.add.at(total, row, net.predict(windows) * length[:, None])
                    mean = total / np.maximum(np.diff(offsets), 1)[:, None]
                    best = mean.argmax(axis=1)
                    for i in np.flatnonzero(_has_letter(rows, data, offsets)).tolist():
                        lang[i], score[i] = net.languages[best[i]], min(1.0, float(mean[i, best[i]]))
                yield pa.record_batch([rows.column("doc_id"), rows.column("held_out"), pa.array(lang), pa.array(score)],
                                      ["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, texts: int = TEXTS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    Null text and text without a letter: ``und`` with score 0, and so is every
    row where no language could be learned.  Null ids are not held out;
    repeated rows are predicted alike.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    net = spark.sparkContext.broadcast(learn(docs, texts))                   # a few KB
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~learnable()).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(net), "doc_id long, held_out boolean, lang_pred string, score double")
