"""Collocations: frequent phrases mined by SON partitioning, scored and thinned.

A shard is a run of rows of one task, SHARD words at most.  First the shards send
all their phrases as hash cells, some bytes each; a phrase whose cell is less
frequent than the support in all shards together is not.  Of the others each
shard is mined completely at its share of the global support (a phrase with support ``least``
reaches ``least`` * shard words / all words of its language in some shard,
rounded up).  A shard that doesn't report a phrase has it at most support - 1
times, so the counts that were reported and what the other shards may hide give
a bound on the phrase's count; the phrases whose bound reaches ``least`` are the
candidates, and one more scan counts every one of them exactly.  That is done
twice: for phrases of two words, and then for longer ones, which are only looked
at where all their pairs of neighbours are frequent as a whole.  There are SHARDS
shards or more; where a shard's share of the support is one, it hides nothing and
the bound is the count itself.

Phrases are 64-bit hashes (language included) until the frequent ones are
known; one last scan brings their words, each phrase's from one task.  Membership of a phrase in the frequent
or candidate ones is looked up in a bitmap of bounded size; what it lets through
wrongly is counted and dropped.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citegrid.llm import bitmap, often as by_cell
from citegrid.llm.textbatch import flat, mix64, slices, word_hashes, word_spans
from citegrid.session import materialize, remove_tables, ship_package

LEAST, LONGEST, REPORT = 30, 4, 2000
#: Words of a shard at most, of a task on average where there are more than SHARDS of them, and shards
#: of smaller tables, so that the lowered support of a small table is that of a larger one.
SHARD, TASK, SHARDS = 10_000_000, 7_500_000, 16
#: Bytes of text that are turned into words at a time, places looked up at a time, and rows in a batch.
SLICE, CHUNK, ROWS = 2 << 20, 1 << 18, 1 << 16

#: Bytes that end a piece, bytes between words.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[list(ENDS + GAPS)] = False
_END_BYTE = np.zeros(256, bool)
_END_BYTE[list(ENDS)] = True
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_U = np.uint64
_FACTOR = _U(0x9FB21C651E98DF25)


@dataclass
class Words:
    """Words of some rows, languages one after the other: hashes; whether a
    word continues the piece of the word before; byte places; first word of each language."""
    hashes: np.ndarray
    joined: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray
    langs: list[str]
    range: np.ndarray


def words_of(rows: pa.RecordBatch) -> Words:
    langs = pc.dictionary_encode(rows.column("lang"))
    code = langs.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    data, offsets = flat(rows.column("text").take(pa.array(order)))
    hashes, first = word_hashes(data, offsets, _WORD_BYTE)
    begin, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for place, _, s, e in word_spans(data, offsets, _WORD_BYTE):
        begin.append(s + place)
        end.append(e + place)
    begin = np.concatenate(begin)
    ends = np.zeros(len(data) + 1, np.int32)          # piece ends before each byte
    np.cumsum(_END_BYTE[data], out=ends[1:])
    joined = np.zeros(len(hashes), bool)
    joined[1:] = ends[begin[1:]] == ends[begin[:-1]]
    heads = first[:-1]
    joined[heads[heads < len(hashes)]] = False
    return Words(hashes, joined, begin, np.concatenate(end), data, langs.dictionary.to_pylist(),
                 first[np.searchsorted(code[order], np.arange(len(langs.dictionary) + 1))])


def salt_of(lang: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def keys(hashes: np.ndarray, length: int, salt: np.uint64) -> np.ndarray:
    """Key of the phrase of that length at each word; there are length - 1 less than words."""
    h = hashes
    for j in range(1, length):
        h = mix64(h[:-1] * _FACTOR + hashes[j:])
    return mix64(h ^ salt).view(np.int64)


def runs(hashes: np.ndarray, joined: np.ndarray, length: int, salt: np.uint64, part: int = 0, often=None,
         among=None, likely_cells=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and keys, some at a time, of the phrases in one piece whose parts of ``part`` words
    may all be in the bitmap ``often``, and that may be in the bitmap ``among`` themselves,
    and their cells in ``likely_cells``."""
    n = len(hashes) - length + 1
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        some = hashes[lo:hi + length - 1]
        fits = np.ones(hi - lo, bool)
        for j in range(1, length):
            fits &= joined[lo + j:hi + j]
        if often is not None:
            likely = bitmap.has(often.value, keys(some, part, salt))
            for j in range(length - part + 1):
                fits &= likely[j:j + hi - lo]
        here = np.flatnonzero(fits)
        key = keys(some, length, salt)[here]
        if among is not None and len(key):
            good = bitmap.has(among.value, key)
            here, key = here[good], key[good]
        if likely_cells is not None and len(key):
            good = by_cell.may(likely_cells, key)
            here, key = here[good], key[good]
        yield here + lo, key


def counts_of(hashes: np.ndarray, *how) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and their counts, ROWS or so at a time, of the phrases that runs(hashes, *how) has."""
    found, n = np.empty(len(hashes), np.int64), 0
    for _, key in runs(hashes, *how):
        found[n:n + len(key)] = key
        n += len(key)
    found = found[:n]
    found.sort()
    lo = 0
    while lo < n:
        hi = n if lo + ROWS >= n else int(np.searchsorted(found, found[lo + ROWS], "right"))
        yield np.unique(found[lo:hi], return_counts=True)
        lo = hi


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """Shards of a task, ``most`` words or so, a language at a time: language, its words in all shards, hashes, joined."""
    held: dict[str, tuple] = {}
    size = 0

    def shard() -> Iterator[tuple]:
        pa.default_memory_pool().release_unused()                         # what the batches took, before the words are worked on
        for lang in sorted(held):
            total, *parts = held.pop(lang)
            while len(parts) > 1 and isinstance(parts[0], list):          # the pieces go before the whole is worked on
                parts = [*parts[1:], np.concatenate(parts[0])]
            yield lang, total, *parts

    for batch in batches:
        for rows in slices(batch, max_bytes=SLICE):
            total = dict(zip(rows.column("lang").to_pylist(), rows.column("total").to_pylist()))
            w = words_of(rows)
            for lang, a, b in zip(w.langs, w.range.tolist(), w.range[1:].tolist()):
                _, hashes, joined = held.setdefault(lang, (total[lang], [], []))
                hashes.append(w.hashes[a:b])
                joined.append(w.joined[a:b])
            size += len(w.hashes)
            if size >= most:
                yield from shard()
                size = 0
    yield from shard()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, _, hashes, joined in shards(batches, SHARD // 8):
        for names, counts in counts_of(hashes, joined, 1, salt_of(lang)):
            yield pa.record_batch([pa.array([lang] * len(names), pa.string()), pa.array(names), pa.array(counts, pa.int64())], ["lang", "key", "c"])


def _send_cells(lengths: range, part: int, often, least: int, most: int, bits: int) -> Callable:
    """All phrases of a shard whose parts may be frequent, packed as hash cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, hashes, joined in shards(batches, most):
            for length in lengths:
                for names, counts in counts_of(hashes, joined, length, salt_of(lang), part, often):
                    yield from by_cell.pack(names, counts, bits, least)
    return run


def _mine(lengths: range, part: int, often, likely_cells, least: int, most: int) -> Callable:
    """Phrases in likely cells that are frequent in a shard, at its lowered support: key, and count beyond what
    a shard may hide. A row with the language, without a key, has what this shard may hide."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, total, hashes, joined in shards(batches, most):
            hidden = max(1, -(-least * len(hashes) // max(1, total))) - 1
            yield pa.record_batch([pa.array([lang], pa.string()), pa.nulls(1, pa.int64()), pa.array([hidden], pa.int64())], ["lang", "key", "c"])
            for length in lengths:
                for names, counts in counts_of(hashes, joined, length, salt_of(lang), part, often, None, likely_cells):
                    good = counts > hidden
                    yield pa.record_batch([pa.nulls(int(good.sum()), pa.string()), pa.array(names[good]),
                                           pa.array(counts[good] - hidden, pa.int64())], ["lang", "key", "c"])
    return run


def _count(lengths: range, part: int, often, candidates) -> Callable:
    """Candidates of the task: key, count, and the task's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for lang, _, hashes, joined in shards(batches, SHARD // 8):
            for length in lengths:
                for names, counts in counts_of(hashes, joined, length, salt_of(lang), part, often, candidates):
                    yield pa.record_batch([pa.array(names), pa.array(counts, pa.int64()), pa.array(np.full(len(names), task))], ["key", "c", "task"])
    return run


def _spell(longest: int, words, often, among, owned: bool) -> Callable:
    """Words of the phrases in the bitmap ``among``; once a task. Where ``owned``, the bitmap holds
    each phrase with the number of the one task that is to spell it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set = set()
        task = np.int64(TaskContext.get().partitionId() if owned else 0)
        for batch in batches:
            for rows in slices(batch, max_bytes=SLICE):
                w = words_of(rows)
                for lang, a, b in zip(w.langs, w.range.tolist(), w.range[1:].tolist()):
                    yield from spell(w, lang, a, b, sent, task)

    def spell(w: Words, lang: str, a: int, b: int, sent: set, task: np.int64) -> Iterator[pa.RecordBatch]:
        salt, hashes = salt_of(lang), w.hashes[a:b]
        for length in range(2, longest + 1):
            at, key = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x, y in runs(hashes, w.joined[a:b], length, salt, 1 if length == 2 else 2, words if length == 2 else often):
                good = bitmap.has(among.value, y ^ task)
                at.append(x[good])
                key.append(y[good])
            names, first = np.unique(np.concatenate(key), return_index=True)
            new = np.array([n not in sent for n in names.tolist()], bool)
            names, at = names[new], np.concatenate(at)[first[new]]
            sent.update(names.tolist())
            if not len(at):
                continue
            spans = a + at[:, None] + np.arange(length)
            text = [b" ".join([w.data[s:e].tobytes() for s, e in zip(x, y)]).translate(_LOWER).decode()
                    for x, y in zip(w.begin[spans].tolist(), w.end[spans].tolist())]
            yield pa.record_batch([pa.array(names), pa.array([lang] * len(at), pa.string()), pa.array(text, pa.string())], ["key", "lang", "phrase"])
    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of words and the keys of all shorter parts, by length, then by first word."""
    for batch in batches:
        data, offsets = flat(batch.column("phrase"))
        hashes, first = word_hashes(data, offsets, _WORD_BYTE)
        parts = []
        for lang, a, b in zip(batch.column("lang").to_pylist(), first.tolist(), first[1:].tolist()):
            salt = salt_of(lang)
            parts.append(np.concatenate([keys(hashes[a:b], n, salt) for n in range(1, b - a)]))
        yield pa.record_batch([*(batch.column(c) for c in ("key", "lang", "phrase", "a")), pa.array(np.diff(first), pa.int32()),
                               pa.array(parts, pa.list_(pa.int64()))], ["key", "lang", "phrase", "a", "length", "parts"])


def _at(length: Column, part: Column, first: Column) -> Column:
    """Place in ``parts`` (from 1) of the part with that many words from word ``first`` (from 0) on."""
    # parts of n words come after those of 1 .. n-1 words, of which there are (length - m + 1) for m words
    before = (part - 1) * (length + 1) - (part * (part - 1) / 2).cast("int")
    return (before + first + 1).cast("int")


def frequent(docs: DataFrame, least: int, longest: int, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(phrases, counts): (key, lang, length, phrase, parts, a, n) of the phrases of 2 to
    ``longest`` words with a >= least; (key, c) of all phrases and words that often."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = materialize(rows.withColumn("total", F.lit(0).cast("long")).mapInArrow(_count_words, "lang string, key long, c long")
                        .groupBy("lang", "key").agg(F.sum("c").alias("c")), "phrases-words", paths)
    totals = materialize(words.groupBy("lang").agg(F.sum("c").alias("n")), "phrases-totals", paths)
    size = totals.agg(F.sum("n")).head()[0] or 0
    # a row per language: Spark broadcasts the table where its size allows it
    dealt = rows.join(totals.select("lang", F.col("n").alias("total")), "lang").coalesce(max(SHARDS, -(-size // TASK)))
    most = max(1, min(SHARD, -(-size // SHARDS)))

    def filter_of(table: DataFrame):
        return spark.sparkContext.broadcast(bitmap.build(table.select("key"), table.count()))

    counts = [words.where(F.col("c") >= least).select("key", "c")]
    known = [filter_of(counts[0])]
    for part, lengths in ((1, range(2, min(longest, 2) + 1)), (2, range(3, longest + 1))):
        if not lengths:
            continue
        bits = by_cell.range_bits(size * len(lengths))
        sent = dealt.mapInArrow(_send_cells(lengths, part, known[-1], least, most, bits), by_cell.PACKED)
        likely = by_cell.filter_of(materialize(by_cell.cells_with(sent, least), f"phrases-cells-{part}", paths), bits)
        mined = dealt.mapInArrow(_mine(lengths, part, known[-1], likely, least, most), "lang string, key long, c long")
        mined = materialize(mined.groupBy("lang", "key").agg(F.sum("c").alias("c")), f"phrases-local-{part}", paths)
        hidden = mined.where("key is null").agg(F.max("c")).head()[0] or 0          # in all shards of a language, less than ``least``
        candidates = mined.where(F.col("key").isNotNull() & (F.col("c") + hidden >= least))
        counted = (dealt.mapInArrow(_count(lengths, part, known[-1], filter_of(candidates)), "key long, c long, task long")
                   .groupBy("key").agg(F.sum("c").alias("c"), F.min("task").alias("task")).where(F.col("c") >= least))
        counts.append(materialize(counted, f"phrases-count-{part}", paths))
        known.append(filter_of(counts[-1] if part == 1 else counts[-2].unionByName(counts[-1])))
    often = counts[1] if len(counts) == 2 else counts[1].unionByName(counts[2])

    def spell(which: DataFrame, among, owned: bool) -> DataFrame:
        spelled = dealt.mapInArrow(_spell(longest, known[0], known[-1], among, owned), "key long, lang string, phrase string")
        spelled = spelled.join(which.select("key", F.col("c").alias("a")), "key")
        found = (spelled.groupBy("key").agg(*(F.first(c).alias(c) for c in ("lang", "phrase", "a")))
                 .mapInArrow(_parts, "key long, lang string, phrase string, a long, length int, parts array<long>"))
        return materialize(found.join(totals, "lang"), "phrases-spelled", paths)

    # a phrase is spelled by the first task that counted it; any that isn't found there, by all
    phrases = spell(often, filter_of(often.select(F.col("key").bitwiseXOR(F.col("task")).alias("key"))), True)
    missing = often.join(phrases, "key", "left_anti")
    if not missing.isEmpty():
        phrases = phrases.unionByName(spell(missing, filter_of(missing), False))
    return phrases, materialize(counts[0].unionByName(often.select("key", "c")), "phrases-often", paths)


def score(phrases: DataFrame, often: DataFrame, longest: int) -> DataFrame:
    """The lowest-scoring cut of each phrase: k, l, r, score."""
    cuts = phrases.select("key", "length", "parts", "a", F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    cuts = cuts.select("key", "a", "k", F.get("parts", _at(F.col("length"), F.col("k"), F.lit(0)) - 1).alias("left"),
                       F.get("parts", _at(F.col("length"), F.col("length") - F.col("k"), F.col("k")) - 1).alias("right"))
    side = lambda name, c: often.select(F.col("key").alias(name), F.col("c").alias(c))
    cuts = cuts.join(side("left", "l"), "left").join(side("right", "r"), "right")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumns({"wide": wide("a") * F.lit(2000000).cast("decimal(7,0)"), "both": wide("l") + wide("r")})
    cuts = cuts.withColumn("score", F.expr("cast(wide div both as bigint)"))
    return cuts.groupBy("key").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("key", "cut.score", "cut.k", "cut.l", "cut.r")


def inside_longer(phrases: DataFrame) -> DataFrame:
    """Keys of the phrases with 80 % or more of their count inside one longer phrase."""
    # parts of one word come first; those of two words and more are phrases themselves
    inner = phrases.where("length > 2").select(F.explode(F.slice("parts", F.col("length") + 1, F.size("parts"))).alias("key"), F.col("a").alias("longer"))
    most = inner.groupBy("key").agg(F.max("longer").alias("longer"))
    wide = lambda c, x: F.col(c).cast("decimal(20,0)") * F.lit(x).cast("decimal(3,0)")
    return most.join(phrases.select("key", "a"), "key").where(wide("longer", 100) >= wide("a", 80)).select("key")


def first_of_each(found: DataFrame, report: int) -> DataFrame:
    """The first ``report`` rows of each language, ranked; a part of a language's rows is ranked first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= report).drop("rank")
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= report))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, report: int = REPORT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``report`` phrases of each language.

    ``docs`` has text and lang; other columns are ignored, so names can't clash.
    Words are runs of anything but space and tab, A-Z lower-cased, inside pieces
    between the characters ``.,;:!?`` and \\x0A to \\x0D.  Null text has no words,
    null lang is the language ``und``, ids are not read, and a row that is there
    twice counts twice.  Ties go to the higher count, then to the smaller phrase
    in UTF-8 order.  An empty table, or one without frequent phrases, gives an
    empty result.  Counts are sums of longs, scores exact integers.
    """
    ship_package(docs.sparkSession)
    paths: list[str] = []
    phrases, often = frequent(docs, least, longest, paths)
    kept = phrases.join(inside_longer(phrases), "key", "left_anti").join(score(phrases, often, longest), "key")
    out = materialize(first_of_each(kept, report).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    remove_tables(docs.sparkSession, paths)
    return out
