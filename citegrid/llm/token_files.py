"""Token ids as Parquet list columns.

One row per document in ascending doc_id: doc_id, part (number of the range),
first (ids before the document in its part), n_tokens, tokens.  Ids are
dictionary encoded, the counting columns delta encoded (format version 2);
row groups and pages are small and carry page indexes, so a reader that wants
some columns or some documents reads little else.
"""
from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citegrid.llm.textbatch import mix64, powers, slices
from citegrid.session import ship_package

#: Parquet settings of the token files.
FORMAT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#tokens.list.element": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
#: Slots of the table of pieces that a Python worker remembers; half may be filled (some 35 MB).
SLOTS = 1 << 21
#: Code points below this are classed by a table; texts beyond go whole to the tokenizer.
TABLED = 0x250

#: Bytes of text that a task encodes at a time.
SLICE = 1 << 20

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
_CLASS = np.zeros(TABLED, np.uint8)
for _c in range(TABLED):
    _kind = unicodedata.category(chr(_c))[0]
    _CLASS[_c] = {"L": _LETTER, "N": _NUMBER}.get(_kind, _OTHER)
_CLASS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]] = _SPACE

_STATE: dict = {}


def piece_starts(cp: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """Starts of the pieces that the byte-level pattern cuts
    ('s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|space+(?!non-space)|space+)
    in code points below TABLED; no piece spans a row start."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = _CLASS[cp]
    opens = np.zeros(n, bool)
    opens[1:] = kind[1:] != kind[:-1]
    row = np.zeros(n + 1, bool)
    row[row_starts] = True
    opens |= row[:n]
    opens[0] = True
    run = np.flatnonzero(opens)
    end = np.append(run[1:], n)
    starts = opens.copy()
    # the last space of a run goes with what follows in the row, if it is U+0020; else it stands alone
    space = (kind[run] == _SPACE) & (end < n) & ~row[end]
    starts[end[space] - 1] = True
    glued = np.zeros(n + 1, bool)
    glued[end[space & (cp[np.maximum(end - 1, 0)] == 0x20)]] = True
    starts &= ~glued[:n]
    # a lone apostrophe, not glued to a space, takes its contraction's letters
    lone = run[(end - run == 1) & (cp[run] == 0x27) & ~glued[run]]
    lone = lone[lone + 1 < n]
    lone = lone[(kind[lone + 1] == _LETTER) & ~row[lone + 1]]
    if len(lone):
        a = cp[lone + 1]
        inner = lone + 2 < n
        after = np.where(inner, lone + 2, lone + 1)
        b = np.where(inner & (kind[after] == _LETTER) & ~row[after], cp[after], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ~one & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for got, width in ((lone[one], 2), (lone[two], 3)):
            starts[got + 1] = False
            rest = got + width
            rest = rest[rest < n]
            starts[rest] = True
    return np.flatnonzero(starts)


class Pieces:
    """Ids of the pieces met so far: an open-addressing table from a piece's
    128-bit hash to its run of ids, looked up for whole arrays of pieces."""

    def __init__(self, slots: int = SLOTS):
        self.slots = np.full(slots, -1, np.int32)
        self.key = np.zeros((slots // 2, 2), np.uint64)
        self.first = np.zeros(slots // 2 + 1, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.n = 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 for those not in the table."""
        out = np.full(len(key), -1, np.int64)
        todo, at = np.arange(len(key)), (key[:, 0] & np.uint64(len(self.slots) - 1)).astype(np.int64)
        while len(todo):
            entry = self.slots[at]
            used = entry >= 0
            todo, at, entry = todo[used], at[used], entry[used]
            same = (self.key[entry] == key[todo]).all(axis=1)
            out[todo[same]] = entry[same]
            todo, at = todo[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return out

    def add(self, key: np.ndarray, ids: list[list[int]]) -> None:
        """New, distinct keys and their ids; the caller leaves room (see full)."""
        count = np.array([len(x) for x in ids], np.int64)
        start, end = int(self.first[self.n]), int(self.first[self.n] + count.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(end, len(self.ids)), np.uint32)])
        self.ids[start:end] = np.fromiter(chain.from_iterable(ids), np.uint32, end - start)
        self.key[self.n:self.n + len(key)] = key
        self.first[self.n + 1:self.n + len(key) + 1] = start + np.cumsum(count)
        for entry, slot in enumerate((key[:, 0] & np.uint64(len(self.slots) - 1)).tolist(), self.n):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & (len(self.slots) - 1)
            self.slots[slot] = entry
        self.n += len(key)

    def full(self, more: int) -> bool:
        return self.n + more > len(self.key)


_CODES = [mix64(np.arange(1, TABLED + 1, dtype=np.uint64) * np.uint64(c)) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)]


def piece_keys(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit hash of each piece of code points below TABLED."""
    up, down = powers(len(cp) + 1)
    out = np.zeros((len(start), 2), np.uint64)
    for i, code in enumerate(_CODES):
        total = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum(code[cp] * up[:len(cp)], out=total[1:])
        out[:, i] = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return out


class Encoder:
    """Ids of texts.  Pieces are cut with piece_starts, each distinct piece is
    encoded by the tokenizers library and remembered; a text with other code
    points goes to the library whole.  With ``added`` so does a text that holds
    the string of an added token, which the library's plain call makes that
    token; without, special tokens' strings are ordinary text."""

    def __init__(self, tokenizer_json: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if added and t.content]
        self.known = Pieces()

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        cps = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        plain = [i for i, c in enumerate(cps) if (not len(c) or c.max() < TABLED) and not any(a in texts[i] for a in self.added)]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i in set(range(len(texts))) - set(plain):
            out[i] = np.asarray(self.library([texts[i]])[0], np.uint32)
        at = np.zeros(len(plain) + 1, np.int64)
        np.cumsum([len(cps[i]) for i in plain], out=at[1:])
        if at[-1] == 0:
            return out
        cp = np.concatenate([cps[i] for i in plain])
        start = piece_starts(cp, at[:-1])
        entry = self._entries(cp, start, np.append(start[1:], at[-1]), "".join([texts[i] for i in plain]))
        first = self.known.first
        count = first[entry + 1] - first[entry]
        before = np.zeros(len(entry) + 1, np.int64)
        np.cumsum(count, out=before[1:])
        ids = self.known.ids[np.arange(before[-1]) + np.repeat(first[entry] - before[:-1], count)]
        cut = before[np.searchsorted(start, at, "left")]
        for k, i in enumerate(plain):
            out[i] = ids[cut[k]:cut[k + 1]]
        return out

    def _entries(self, cp: np.ndarray, start: np.ndarray, end: np.ndarray, joined: str) -> np.ndarray:
        key = piece_keys(cp, start, end)
        entry = self.known.find(key)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            _, one = np.unique(key[missing, 0], return_index=True)
            new = missing[one]
            if self.known.full(len(new)):
                self.known = Pieces(max(SLOTS, 1 << (4 * len(start)).bit_length()))
                return self._entries(cp, start, end, joined)
            self.known.add(key[new], self.library([joined[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())]))
            entry[missing] = self.known.find(key[missing])
            if (entry < 0).any():                       # equal in one half of the hash only: on to the next
                return self._entries(cp, start, end, joined)
        return entry


def _encoder(broadcast) -> Encoder:
    """One per Python worker and tokenizer, kept between tasks."""
    if _STATE.get("json") != hash(broadcast.value):
        _STATE.update(json=hash(broadcast.value), encoder=Encoder(broadcast.value, added=True))
    return _STATE["encoder"]


def _tokenize(broadcast, end_id: int) -> Callable:
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, encoder = TaskContext.get().partitionId(), 0, _encoder(broadcast)
        for batch in batches:
            for rows in slices(batch, max_bytes=SLICE):
                ids = encoder.encode(pc.fill_null(rows.column("text"), "").to_pylist())
                n = np.array([len(x) + 1 for x in ids], np.int64)
                whole = np.concatenate([x for i in ids for x in (i, end)])
                offsets = np.zeros(len(n) + 1, np.int32)
                np.cumsum(n, out=offsets[1:])
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(
                    pa.int32(), int(offsets[-1]), [None, pa.py_buffer(whole.tobytes())]))
                yield pa.record_batch(
                    [rows.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(first + offsets[:-1].astype(np.int64)),
                     pa.array(n), tokens], ["doc_id", "part", "first", "n_tokens", "tokens"])
                first += int(offsets[-1])
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, partitions: int | None = None) -> int:
    """Encodes every whole text of ``docs`` (doc_id, text) and writes the files;
    returns the number of parts.

    Null text is empty, so its document is the end id alone.  Null ids come
    first; rows with one id are in the order of their texts' hashes, so
    repeated rows stay and runs agree.  An empty table gives files without rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        broadcast = spark.sparkContext.broadcast(f.read())      # a vocabulary: a few MB
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    (rows.repartitionByRange(n, "doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text")
     .mapInArrow(_tokenize(broadcast, end_id), "doc_id long, part int, first long, n_tokens long, tokens array<int>")
     .write.options(**FORMAT).parquet(path))
    return n


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, tokens."""
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per part
    base = sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return (files.join(F.broadcast(base), "part")
            .select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "tokens"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        ids, at = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), tokens.offsets.to_numpy()
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
        yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"),
                               pa.array(crc, pa.int64()), pa.array(np.diff(at).astype(np.int64))],
                              ["doc_id", "start", "n_tokens", "ids_crc32", "n_read"])


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers) and n_read (ids in the list itself)."""
    ship_package(tokens.sparkSession)
    return tokens.mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long, n_read long")
