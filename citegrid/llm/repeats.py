"""Removal of repeated word sequences, by prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one text; the suffix that starts
where a window starts matters down to that depth.  Suffixes are split into
groups by a prefix of variable length: from the suffix's first word up to the
end of its anchor, the run of GRAM words with the least hash inside the window.
Equal windows have equal anchors at equal distances, so they meet in one group.
Consecutive suffixes with the same anchor share their words and travel as one
segment of text.

Groups of one segment hold no repeat and are left out before texts move.  Equal
segments are one row with a count.  A task builds the suffix trees of its
groups, the nodes named level by level (depths 1, 2, 4, ... and the window
length); nodes at the window length with several leaves are maximal repeats'
starts.  Groups of more than GROUP_MOST segments get a longer prefix, the whole
window: their suffixes are dealt one by one and counted.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm import bitmap
from citegrid.llm.textbatch import NON_SPACE, flat, mix64, powers, shingle_hashes, slices, word_hashes, word_spans
from citegrid.session import materialize, remove_tables, ship_package

WINDOW = 35
#: Words of an anchor (less where the window is shorter).
GRAM = 8
#: Segments of a group whose tree one task builds; larger groups get longer prefixes.
GROUP_MOST = 4096
#: Words in the trees that are built at a time.
TREE_WORDS = 1 << 20
#: Bytes of text that a task turns into words at a time.
SLICE = 2 << 20

_U = np.uint64
_SPOT = "g long, sh long, t1 long, t2 long, at int, n int, segment string"


# ------------------------------------------------------------ anchors and segments

def anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of all rows: anchor hash, anchor place, place of the first
    window and number of windows (places count over the words of all rows)."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none.view(np.uint64), none, none, none
    k = min(GRAM, window)
    grams, _ = shingle_hashes(words, np.array([0, len(words)]), k)
    per = sliding_window_view(grams, window - k + 1)
    least = np.concatenate([per[i:i + (1 << 17)].argmin(axis=1) for i in range(0, len(per), 1 << 17)])
    place = least + np.arange(len(per))
    last = np.repeat(first[1:], np.diff(first))[:len(per)]       # end of each window's row
    start = np.flatnonzero(np.arange(len(per)) + window <= last)
    if not len(start):
        return none.view(np.uint64), none, none, none
    place = place[start]
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    count = np.diff(np.append(head, len(start)))
    return grams[place[head]], place[head], start[head], count


def _sequence_hashes(words: np.ndarray, at: np.ndarray, length: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hash of each run of words, with a salt."""
    up, down = powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix64(words) * up[:len(words)], out=total[1:])
    return mix64((total[at + length] - total[at]) * down[at] + (length.astype(np.uint64) << _U(32)) + salt.astype(np.uint64))


def _fresh_rows(batch: pa.RecordBatch, seen: set) -> pa.RecordBatch:
    """Rows whose text this task hasn't had yet."""
    keep = []
    for key in zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist()):
        keep.append(key not in seen)
        seen.add(key)
    return batch.filter(pa.array(keep, pa.bool_()))


def _count_anchors(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(_fresh_rows(batch, seen), max_bytes=SLICE):
                g, *_ = anchors(*word_hashes(*flat(part.column("text")), lower=False), window)
                names, counts = np.unique(g, return_counts=True)
                yield pa.record_batch([pa.array(names.view(np.int64)), pa.array(counts, pa.int64())], ["g", "c"])
    return run


def _word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = [], []
    for at, _, s, e in word_spans(data, offsets, NON_SPACE):
        starts.append(s + at)
        ends.append(e + at)
    return np.concatenate(starts), np.concatenate(ends)


def _spots(window: int, shared) -> Callable:
    """Segments whose anchor may occur elsewhere; the words go along once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        sent: set = set()
        for batch in batches:
            for part in slices(_fresh_rows(batch, seen), max_bytes=SLICE):
                data, offsets = flat(part.column("text"))
                words, first = word_hashes(data, offsets, lower=False)
                g, place, start, count = anchors(words, first, window)
                keep = bitmap.has(shared.value, g.view(np.int64)) if len(g) else np.zeros(0, bool)
                g, place, start, count = g[keep], place[keep], start[keep], count[keep]
                if not len(g):
                    continue
                sh = _sequence_hashes(words, start, count + window - 1, place - start).view(np.int64)
                row = np.searchsorted(first, start, "right") - 1
                begin, end = _word_bounds(data, offsets)
                texts = []
                for name, a, b in zip(zip(g.tolist(), sh.tolist()), begin[start].tolist(), end[start + count + window - 2].tolist()):
                    texts.append(None if name in sent else data[a:b].tobytes().decode())
                    sent.add(name)
                at = pa.array(row)
                yield pa.record_batch(
                    [pa.array(g.view(np.int64)), pa.array(sh), part.column("t1").take(at), part.column("t2").take(at),
                     pa.array(start - first[row], pa.int32()), pa.array(count, pa.int32()), pa.array(texts, pa.string())],
                    ["g", "sh", "t1", "t2", "at", "n", "segment"])
    return run


# ------------------------------------------------------------ suffix trees

def names_at(words: np.ndarray, depth: int) -> np.ndarray:
    """For each place, the name of the tree node that its suffix passes at
    ``depth`` words: equal names stand for equal words.  Places nearer to the
    end than that have none (the result is shorter)."""
    names = np.unique(words, return_inverse=True)[1].astype(np.int64)
    height = 1
    while height < depth:
        step = min(height, depth - height)
        m = len(names) - step
        if m <= 0:
            return np.zeros(0, np.int64)
        pairs = names[:m] * (int(names.max()) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        height += step
    return names


def _grow(window: int) -> Callable:
    """Rows (g, sh, segment) sorted by g, sh: whole groups are put into trees,
    and each segment returns the windows that lie under a node with several leaves."""
    def trees(names: list[tuple], texts: list[str]) -> Iterator[pa.RecordBatch]:
        words, first = word_hashes(*flat(pa.array(texts, pa.large_string())), lower=False)
        node = names_at(words, window)
        count = np.diff(first) - window + 1
        at = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=at[1:])
        d = np.arange(at[-1]) - np.repeat(at[:-1], count)
        node = node[np.repeat(first[:-1], count) + d]
        deep = np.bincount(node)[node] > 1
        kept = np.add.reduceat(deep, at[:-1].astype(np.int64)) if len(at) > 1 else np.zeros(0, np.int64)
        ends = np.zeros(len(count) + 1, np.int64)
        np.cumsum(kept, out=ends[1:])
        starts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(d[deep], pa.int32()))
        some = pa.array(kept > 0)
        g, sh = (pa.array([n[i] for n in names], pa.int64()) for i in (0, 1))
        yield pa.record_batch([g, sh, starts], ["g", "sh", "starts"]).filter(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, texts, size = [], [], 0
        for batch in batches:
            for g, sh, text in zip(*(batch.column(c).to_pylist() for c in ("g", "sh", "segment"))):
                if names and names[-1] == (g, sh):
                    continue
                if size >= TREE_WORDS and names[-1][0] != g:
                    yield from trees(names, texts)
                    names, texts, size = [], [], 0
                names.append((g, sh))
                texts.append(text)
                size += 2 * window
        if names:
            yield from trees(names, texts)
    return run


def _deal_windows(window: int) -> Callable:
    """Suffixes of the segments of large groups, named by their whole window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "segment", SLICE):
                words, first = word_hashes(*flat(part.column("segment")), lower=False)
                count = np.diff(first) - window + 1
                row = np.repeat(np.arange(len(count)), count)
                d = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = first[row] + d
                same = np.full(len(at), window)
                w1, w2 = (_sequence_hashes(w, at, same, np.zeros(len(at), np.int64)).view(np.int64)
                          for w in (words, mix64(words + _U(1))))
                rows = pa.array(row)
                yield pa.record_batch([pa.array(w1), pa.array(w2), part.column("g").take(rows), part.column("sh").take(rows),
                                       pa.array(d, pa.int32())], ["w1", "w2", "g", "sh", "d"])
    return run


# ------------------------------------------------------------ marks and cuts

def _texts(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*more, text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2"))


def marks(docs: DataFrame, window: int, paths: list[str]) -> DataFrame:
    """(t1, t2, marks) for texts with repeated windows: from which word on which
    windows are repeated (``starts`` null: all n; ``at`` -1: the text itself occurs again)."""
    spark = docs.sparkSession
    rows = _texts(docs).where(F.length("text") >= 2 * window - 1)
    copies = rows.groupBy("t1", "t2").count().where("count > 1").select("t1", "t2")
    counted = rows.mapInArrow(_count_anchors(window), "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    shared = materialize(counted.where("c > 1").select("g"), "repeats-anchors", paths)
    filter_ = spark.sparkContext.broadcast(bitmap.build(shared, shared.count()))
    spots = materialize(rows.mapInArrow(_spots(window, filter_), _SPOT), "repeats-spots", paths)

    counts = materialize(spots.groupBy("g", "sh").agg(F.count(F.lit(1)).alias("c")), "repeats-segments", paths)
    groups = counts.groupBy("g").agg(F.count(F.lit(1)).alias("segments"), F.min("c").alias("least")).where("segments > 1 and least = 1")
    wanted = (spots.where("segment is not null").select("g", "sh", "segment")
              .join(groups.select("g", "segments"), "g"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grown = (wanted.where(F.col("segments") <= GROUP_MOST).select("g", "sh", "segment")
             .repartition(tasks, "g").sortWithinPartitions("g", "sh")
             .mapInArrow(_grow(window), "g long, sh long, starts array<int>"))
    large = wanted.where(F.col("segments") > GROUP_MOST).dropDuplicates(["g", "sh"]).select("g", "sh", "segment")
    dealt = large.mapInArrow(_deal_windows(window), "w1 long, w2 long, g long, sh long, d int")
    often = dealt.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    counted_out = dealt.join(often, ["w1", "w2"]).groupBy("g", "sh").agg(F.collect_list("d").alias("starts"))   # at most a window a word
    single = counts.where("c = 1").select("g", "sh")
    found = grown.unionByName(counted_out).join(single, ["g", "sh"], "left_semi")
    whole = counts.where("c > 1").select("g", "sh", F.lit(None).cast("array<int>").alias("starts"))
    marked = spots.select("g", "sh", "t1", "t2", "at", "n").join(found.unionByName(whole), ["g", "sh"]).select("t1", "t2", "at", "n", "starts")
    again = copies.select("t1", "t2", F.lit(-1).alias("at"), F.lit(0).alias("n"), F.lit(None).cast("array<int>").alias("starts"))
    return marked.unionByName(again).groupBy("t1", "t2").agg(F.collect_list(F.struct("at", "n", "starts")).alias("marks"))   # a text's own


def _cover(marked: pa.Array, lengths: np.ndarray, window: int) -> np.ndarray:
    """Whether each word (of all rows, back to back) is covered by a repeated window."""
    base = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=base[1:])
    edge = np.zeros(base[-1] + 1, np.int64)
    per = marked.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), per)
    flat_marks = marked.flatten()
    if len(flat_marks):
        at, n = (flat_marks.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
        starts = flat_marks.field("starts")
        every = starts.is_null().to_numpy(zero_copy_only=False)
        some = np.where(every, 0, starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        again = np.flatnonzero((at < 0) & (lengths[row] >= window))
        np.add.at(edge, base[row[again]], 1)
        np.add.at(edge, base[row[again] + 1], -1)
        runs = np.flatnonzero(every & (at >= 0))
        first = base[row[runs]] + at[runs]
        np.add.at(edge, first, 1)
        np.add.at(edge, first + n[runs] + window - 1, -1)
        one = np.repeat(base[row] + at, some) + starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        np.add.at(edge, one, 1)
        np.add.at(edge, one + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = [t.encode().split() for t in part.column("text").to_pylist()]     # splits at \x20 and \x09 to \x0D
                lengths = np.array([len(w) for w in words], np.int64)
                covered = _cover(part.column("marks"), lengths, window)
                kept, removed, spans, at = [], [], [], 0
                for w in words:
                    gone = covered[at:at + len(w)]
                    at += len(w)
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans.append([{"first": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                    removed.append(int(gone.sum()))
                    kept.append((b" ".join(w) if not removed[-1] else b" ".join([x for x, g in zip(w, gone.tolist()) if not g])).decode())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(lengths), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"])
    return run


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored, so names
    can't clash): doc_id, n_words, n_removed, spans (removed word ranges, end
    exclusive), kept (words joined by a space).

    Words are runs of anything but \\x20 and \\x09 to \\x0D, unchanged.  A word
    goes if a window over it also starts anywhere else, in this or another row.
    Null text is empty: no words, kept is empty.  Texts shorter than a window
    lose nothing.  Rows are documents of their own: null or repeated ids stay,
    and a row that is there twice loses all its words if it has ``window`` of
    them.  An empty table gives an empty result.  Words are compared by 64-bit
    hashes, texts by 128 bits.
    """
    ship_package(docs.sparkSession)
    paths: list[str] = []
    marked = materialize(marks(docs, window, paths), "repeats-marks")
    remove_tables(docs.sparkSession, paths)
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = _texts(docs, doc_id)
    # texts that hold no window need no partner, and must not meet under one key
    short = F.length("text") < 2 * window - 1
    rows = rows.withColumns({"t1": F.when(short, F.xxhash64("doc_id", F.lit("short"))).otherwise(F.col("t1")),
                             "t2": F.when(short, F.lit(0)).otherwise(F.col("t2"))})
    joined = rows.join(marked, ["t1", "t2"], "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, "
                                           "spans array<struct<first:int,end:int>>, kept string")
