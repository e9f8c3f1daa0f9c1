"""N-gram Jaccard join by vertical partitioning.

The n-grams of all documents have one global order: rising frequency, then
hash.  Frequencies come from a counting sketch of fixed size summed over all
documents.  The order is used three times:

* every set is cut into vertical fragments by hash, more non-empty ones than a
  link may spoil, so two documents that link have some fragment in common whole.
  The fragments of a set have one order, too (rarest n-gram, then most n-grams);
  the first of them, one more than a link may spoil, are its tokens, and groups
  by token hold all candidates.  Sets with too few fragments add their first
  n-grams (their prefix), which meet in the same way;
* every set is cut into small fragments by hash, of which only the parity of
  the number of n-grams is kept; differing parities are a lower bound of the
  number of n-grams that only one of two documents has, and candidates above
  the bound that a link allows go, without loss;
* for the candidates left the order is cut into FRAGMENTS wide fragments at
  pivots of equal weight; partial overlaps are counted per fragment in
  separate rows and summed per pair.

Copies (equal sets) are one class and never expanded.  Groups first test every
member against two members of the group; components of those links are
known before the other pairs are looked at, and pairs inside a component are
not tested again.  Hot groups are cut into blocks and tested block by block.
Pairs are compared where the rows lie.  Of those that pass the bound some spanning
forests of a block's components become rows; what they link is one component in the
next round, which takes more forests and looks at the groups that held pairs back alone,
until no pair between two components is held back.  Of groups with the same members one is
looked at, and groups of three have no pair without one of the two that all were tested with.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegrid.llm import bitmap, often
from citegrid.llm.columns import fresh
from citegrid.llm.components import components
from citegrid.llm.textbatch import flat, mix64, shingle_hashes, slices, word_hashes
from citegrid.session import materialize, remove_tables, ship_package

#: Cells of the frequency sketch (its size is fixed: 4 MB when broadcast as int64).
CELLS = 1 << 19
#: Cells per row of the sketch while it is summed.
BLOCK = 1 << 15
#: Wide fragments of the global order.
FRAGMENTS = 8
#: Rows of a candidate group that one task compares with each other.
GROUP_BLOCK = 2048
#: Bytes of text that a task turns into n-grams at a time.
SLICE = 2 << 20
#: Sizes in a space differ by this factor or so; non-empty fragments of the largest set, times those needed.
SPACE, SPARE = 2, 1.35
#: Spanning forests of a tile that become pairs in the first round, and how many times more in the next.
FORESTS, MORE = 2, 16
#: Smallest groups of a set that its rows name, so that a pair is rarely emitted by a second group.
NAMED = 16
#: Parity bits per n-gram of a set (rounded up to a power of two), and at least.
PARITY_RATE, LEAST_PARITY = 2, 256
ENTRY = "sh long, cls long, n long, up int"
SEGMENT = "cls long, fragment int, n long, segment binary"

_U = np.uint64


@dataclass(frozen=True)
class Rule:
    """Two documents link when den * intersection >= num * union of their k-word shingle sets."""
    k: int = 5
    num: int = 80
    den: int = 100

    def least_overlap(self, total):
        """Smallest intersection of two linked sets whose sizes sum to ``total``."""
        return -(-self.num * total // (self.num + self.den))

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def spoiled(self, total: int) -> int:
        """Most n-grams that only one of two linked sets has whose sizes sum to ``total`` or less."""
        return total * (self.den - self.num) // (self.num + self.den)


def _fits(rule: Rule, x, y) -> Column:
    """Whether sets of these sizes can link."""
    return F.least(x, y) * rule.den >= F.greatest(x, y) * rule.num


def doc_key() -> Column:
    """Identity of a row: its doc_id, or a hash of the text where that is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _batch_shingles(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(batch.column("text"))
    return shingle_hashes(*word_hashes(data, offsets), k)


# ------------------------------------------------------------ frequency sketch

def _count_cells(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, max_bytes=SLICE):
                h, _ = _batch_shingles(part, k)
                cells += np.bincount((h & _U(CELLS - 1)).astype(np.int64), minlength=CELLS)
        yield from _sketch_rows(cells)
    return run


def _sketch_rows(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    blocks = [i for i in range(CELLS // BLOCK) if cells[i * BLOCK:(i + 1) * BLOCK].any()]
    packed = []
    for i in blocks:
        part = cells[i * BLOCK:(i + 1) * BLOCK]
        used = np.flatnonzero(part)
        wide = part.max() >= 1 << 31
        packed.append(used.astype(np.uint16).tobytes() + part[used].astype(np.int64 if wide else np.int32).tobytes())
    wides = [bool(cells[i * BLOCK:(i + 1) * BLOCK].max() >= 1 << 31) for i in blocks]
    yield pa.record_batch([pa.array(blocks, pa.int32()), pa.array(wides, pa.bool_()), pa.array(packed, pa.binary())],
                          ["block", "wide", "packed"])


def _add_rows(cells: np.ndarray, blocks: list, wides: list, packed: list) -> None:
    for i, wide, raw in zip(blocks, wides, packed):
        n = len(raw) // (10 if wide else 6)
        used = np.frombuffer(raw, np.uint16, n).astype(np.int64)
        cells[i * BLOCK + used] += np.frombuffer(raw[2 * n:], np.int64 if wide else np.int32, n)


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(CELLS, np.int64)
    for batch in batches:
        _add_rows(cells, *(batch.column(c).to_pylist() for c in ("block", "wide", "packed")))
    yield from _sketch_rows(cells)


def frequency_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counts of all k-word shingles of all documents by hash cell; what the
    driver receives is at most two copies of the fixed-size table per block."""
    rows = docs.select("text").mapInArrow(_count_cells(k), "block int, wide boolean, packed binary")
    blocks = CELLS // BLOCK
    summed = rows.repartition(blocks, "block").mapInArrow(_sum_cells, "block int, wide boolean, packed binary")
    cells = np.zeros(CELLS, np.int64)
    got = summed.collect()
    _add_rows(cells, [r.block for r in got], [r.wide for r in got], [bytes(r.packed) for r in got])
    return cells


def pivots(cells: np.ndarray, fragments: int = FRAGMENTS) -> np.ndarray:
    """Order keys that cut the global order into ranges of equal weight."""
    level, per_level = np.unique(np.minimum(cells[cells > 0], (1 << 23) - 1), return_counts=True)
    weight = level * per_level
    if not len(level):
        return np.zeros(0, np.uint64)
    edge = np.cumsum(weight)
    out = []
    for f in range(1, fragments):
        target = edge[-1] * f / fragments
        i = int(np.searchsorted(edge, target, "left"))
        part = (target - (edge[i] - weight[i])) / weight[i]
        out.append((int(level[i]) << 40) + int(part * (1 << 40)))
    return np.array(out, np.uint64)


def order_key(h: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Place in the global order: frequency of the cell, then hash."""
    count = np.minimum(cells[(h & _U(CELLS - 1)).astype(np.int64)], (1 << 23) - 1).astype(np.uint64)
    return (count << _U(40)) | (h >> _U(24))


# ------------------------------------------------------------ documents to sets

def _describe(rule: Rule, sketch) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sketch.value
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, max_bytes=SLICE):
                h, at = _batch_shingles(part, rule.k)
                cls, size, prefixes, parity, own = [], [], [], [], []
                for i in range(part.num_rows):
                    s = np.unique(h[at[i]:at[i + 1]])
                    n = len(s)
                    size.append(n)
                    if not n:
                        cls.append(None), prefixes.append(None), parity.append(None), own.append(None)
                        continue
                    name = _class_of(s)
                    cls.append(name)
                    if name in seen:      # a copy: its class is described already
                        prefixes.append(None), parity.append(None), own.append(None)
                        continue
                    seen.add(name)
                    found, n_own = tokens(rule, s, cells)
                    prefixes.append(found)
                    own.append(n_own)
                    parity.append(parity_of(s))
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("k"), part.column("th"), pa.array(cls, pa.int64()), pa.array(size, pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64())), pa.array(parity, pa.binary()), pa.array(own, pa.int32())],
                    ["doc_id", "k", "th", "cls", "n", "prefix", "parity", "own"])
    return run


@lru_cache
def spaces(rule: Rule) -> tuple[np.ndarray, list[int]]:
    """Lower ends of the size spaces, and into how many fragments the sets of each are cut."""
    step = max(1, round(np.log(SPACE) / np.log(rule.den / rule.num)))
    low = size_bands(rule)[::step]
    counts = []
    for most in (low[1:] - 1).tolist():
        need, f = SPARE * (rule.spoiled(2 * most) + 1), 1
        while f < 4 * most and f * -np.expm1(-most / f) < need:
            f += 1 + f // 20
        counts.append(f)
    return low, counts


def tokens(rule: Rule, s: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens of a set (its hashes, sorted), and how many of them are of its own
    space; the others are of the next, where it may have links with larger sets.

    Each n-gram that only one of two sets has spoils one fragment, so of the
    fragments of linked sets all but ``spoiled`` are in both; as both sets have
    them in one order, the first that is in both is no later than that."""
    low, counts = spaces(rule)
    n = len(s)
    own, most = int(np.searchsorted(low, n, "right")) - 1, n * rule.den // rule.num
    count = cells[(s & _U(CELLS - 1)).astype(np.int64)]
    level, mixed = np.frexp(count.astype(np.float64))[1], mix64(s)
    out, ends = [], []
    for space, other in ((own, min(most, int(low[own + 1]) - 1)), (own + 1, most)):
        if other >= low[space]:
            place = ((s >> _U(32)) * _U(counts[space])) >> _U(32)       # rising, as s is sorted
            at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            name = mix64(np.array([space], np.uint64) + _U(1))
            key = mix64(np.add.reduceat(mixed, at) ^ mix64(place[at] + name))
            need = rule.spoiled(n + other) + 1
            size = np.diff(np.append(at, n))
            out.append(key[np.lexsort((key, -size, np.minimum.reduceat(level, at)))[:need]])
            if len(at) < need:
                first = s[np.argsort(order_key(s, cells), kind="stable")[:rule.prefix(n)]]
                out.append(mix64(first ^ mix64(~name)))
        ends.append(sum(map(len, out)))
    return np.concatenate(out).view(np.int64), ends[0]


def parity_of(s: np.ndarray) -> bytes:
    """Parities of the number of n-grams per small fragment; both halves of a
    vector together (exclusive or) are the vector of half the length."""
    bits = max(LEAST_PARITY, 1 << (PARITY_RATE * len(s) - 1).bit_length())
    odd = np.bincount(((s >> _U(24)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parities_apart(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Number of differing parities of each pair, at the shorter length."""
    size = np.array([(len(a), len(b)) for a, b in zip(x, y)], np.int64).reshape(-1, 2)
    out = np.zeros(len(size), np.int64)
    for a, b in np.unique(size, axis=0):
        at = np.flatnonzero((size == (a, b)).all(axis=1))
        u, v = (_folded([side[i] for i in at], min(a, b)) for side in (x, y))
        out[at] = np.bitwise_count(u ^ v).sum(axis=1)
    return out


def _folded(vectors: list[bytes], size: int) -> np.ndarray:
    """Vectors of one length as rows of 64-bit words, folded to ``size`` bytes."""
    m = np.frombuffer(b"".join(vectors), np.uint64).reshape(len(vectors), -1)
    while m.shape[1] * 8 > size:
        half = m.shape[1] // 2
        m = m[:, :half] ^ m[:, half:]
    return m


def _class_of(s: np.ndarray) -> int:
    """Name of a set: 64 bits of two sums over all its hashes."""
    a = int(mix64(s).sum(dtype=np.uint64))
    b = int(mix64(s ^ _U(0xA0761D6478BD642F)).sum(dtype=np.uint64))
    return int(mix64(np.array([a ^ (b * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)) ^ len(s)], np.uint64)).view(np.int64)[0])


def _segments(rule: Rule, sketch, cuts: np.ndarray, wanted=None) -> Callable:
    """Rows (k, text) to segments; rows whose key is not in the bitmap ``wanted`` are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sketch.value
        seen: set[int] = set()
        for batch in batches:
            if wanted is not None:
                batch = batch.filter(pa.array(bitmap.has(wanted.value, batch.column("k").to_numpy())))
            for part in slices(batch, max_bytes=SLICE):
                h, at = _batch_shingles(part, rule.k)
                rows: list[tuple] = []
                for i in range(part.num_rows):
                    s = np.unique(h[at[i]:at[i + 1]])
                    if not len(s) or (name := _class_of(s)) in seen:
                        continue
                    seen.add(name)
                    piece = np.searchsorted(cuts, order_key(s, cells), "right")
                    rows += [(name, f, len(s), s[piece == f].tobytes()) for f in np.unique(piece).tolist()]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int32(), pa.int64(), pa.binary()))], ["cls", "fragment", "n", "segment"])
    return run


def _partial_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
               for x, y in zip(batch.column("seg_a").to_pylist(), batch.column("seg_b").to_pylist())]
        yield pa.record_batch([batch.column(c) for c in ("a", "b", "n_a", "n_b")] + [pa.array(got, pa.int64())],
                              ["a", "b", "n_a", "n_b", "overlap"])


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule, sketch, cuts, paths: list[str]) -> DataFrame:
    """The pairs (a, b) of classes that link, by partial overlaps per fragment
    summed per pair.  Reads the texts of one row of each class named in ``pairs``."""
    spark = docs.sparkSession
    named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    rows = classes.join(named, "cls").groupBy("cls").agg(F.min("k").alias("k"))
    wanted = materialize(rows.select("k").distinct(), "join-wanted", paths)
    texts, n = docs.select(doc_key().alias("k"), "text"), wanted.count()
    few = n * 4 <= bitmap.MOST_BITS
    if few:                                # else the bitmap would let most rows pass, and a join moves less
        texts = texts.mapInArrow(_segments(rule, sketch, cuts, spark.sparkContext.broadcast(bitmap.build(wanted, n))), SEGMENT)
    else:
        texts = texts.join(wanted, "k", "left_semi").mapInArrow(_segments(rule, sketch, cuts), SEGMENT)
    segments = materialize(texts.join(named, "cls", "left_semi").dropDuplicates(["cls", "fragment"]), "join-segments", paths)
    side = lambda x: segments.select(
        F.col("cls").alias(x), "fragment", F.col("n").alias(f"n_{x}"), F.col("segment").alias(f"seg_{x}"))
    partial = (pairs.select("a", "b").join(side("a"), "a").join(side("b"), ["b", "fragment"])
               .select("a", "b", "n_a", "n_b", "seg_a", "seg_b")
               .mapInArrow(_partial_overlaps, "a long, b long, n_a long, n_b long, overlap long"))
    total = partial.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.max(F.col("n_a") + F.col("n_b")).alias("n"))
    return total.where(F.col("overlap") * (rule.num + rule.den) >= F.col("n") * rule.num).select("a", "b")


# ------------------------------------------------------------ candidates

def size_bands(rule: Rule, most: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size bands: sets that can link are in one band or in neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * rule.den // rule.num + 1)
    return np.array(out)


def _token_cells(bits: int) -> Callable:
    """Token lists, packed as hash cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from often.pack(*np.unique(batch.column("prefix").flatten().to_numpy(), return_counts=True), bits, 2)
    return run


def _entries(meeting: tuple) -> Callable:
    """Token lists to rows (sh, cls, n, up), without the tokens that only one row
    has.  sh names a fragment's n-grams and a size space; up is 0 in the set's own
    space and 1 in the next, so only sets of like sizes meet; two sets of one
    space meet in their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            at, sh = prefix.offsets.to_numpy(), prefix.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            up = (np.arange(len(sh)) - (at[:-1] - at[0])[row] >= batch.column("own").to_numpy()[row]).astype(np.int32)
            keep = often.may(meeting, sh)
            row = pa.array(row[keep])
            yield pa.record_batch([pa.array(sh[keep]), batch.column("cls").take(row), batch.column("n").take(row), pa.array(up[keep])],
                                  ["sh", "cls", "n", "up"])
    return run


def _rows(lists: pa.Array) -> list[np.ndarray]:
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]


def _met_before(sh: int, x: np.ndarray, up_x: np.ndarray, y: np.ndarray, up_y: np.ndarray) -> bool:
    """Whether the named groups show one before ``sh`` in which two sets are
    compared: both are in it, one of them at least in its own band.  In the
    first of their groups there is none, so every pair is emitted at least once."""
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return bool(((both < sh) & ((up_x[i] == 0) | (up_y[j] == 0))).any())


def forests(comps: np.ndarray, others: np.ndarray, most: int) -> np.ndarray:
    """Which of the edges between components, in their order, are in the first ``most``
    spanning forests: each takes the edges that join two of its trees."""
    trees: list[dict[int, int]] = [{} for _ in range(most)]

    def root(tree: dict[int, int], x: int) -> int:
        while (y := tree.get(x, x)) != x:
            tree[x] = tree.get(y, y)
            x = y
        return x

    def fits(tree: dict[int, int], x: int, y: int) -> bool:
        x, y = root(tree, x), root(tree, y)
        if x != y:
            tree[x] = y
        return x != y

    return np.array([any(fits(tree, x, y) for tree in trees) for x, y in zip(comps.tolist(), others.tolist())], bool)


def _compare(rule: Rule, most: int, groups: bool = False) -> Callable:
    """Rows sorted by (sh, tile); of the pairs of a tile that lie in two components
    and that size and parity bounds allow emits those in the first ``most`` spanning
    forests, likest first, and a row of nulls if others are held back; a pair that the
    named groups show to have met before is left to that group.  With ``groups`` there is
    such a row for each group that holds pairs back, and a third column, sh, names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = np.stack([held.column(c).to_numpy() for c in ("sh", "tile")])
            last = int((key == key[:, -1:]).all(axis=0).argmax())  # rows are sorted: first row of the last tile
            if last:
                yield from emit(held.slice(0, last))
                held = held.slice(last).combine_chunks()
        if held is not None:
            yield from emit(held)

    def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        sh, tile, cls, n, comp, side, up = (t.column(c).to_numpy() for c in ("sh", "tile", "cls", "n", "comp", "side", "up"))
        keys, ups = (_rows(t.column(c).combine_chunks()) for c in ("keys", "ups"))
        raw = t.column("parity").to_pylist()
        size = np.array([len(x) for x in raw])
        folded = {}
        for short in np.unique(size).tolist():            # rows at least that long, folded to that length
            rows = np.flatnonzero(size >= short)
            m = np.zeros((len(sh), short // 8), np.uint64)
            for long in np.unique(size[rows]).tolist():
                own = rows[size[rows] == long]
                m[own] = _folded([raw[i] for i in own.tolist()], short)
            folded[short] = m
        d, found = 1, []
        at = np.arange(len(sh) - 1)
        while True:
            at = at[at + d < len(sh)]
            at = at[(sh[at] == sh[at + d]) & (tile[at] == tile[at + d])]
            if not len(at):
                break
            for lo in range(0, len(at), 200_000):
                i = at[lo:lo + 200_000]
                j = i + d
                keep = (comp[i] != comp[j]) & ((side[i] == 2) | (side[i] != side[j])) & ~((up[i] == 1) & (up[j] == 1))
                keep &= np.minimum(n[i], n[j]) * rule.den >= np.maximum(n[i], n[j]) * rule.num
                i, j = i[keep], j[keep]
                if len(i):
                    total = n[i] + n[j]
                    apart = np.zeros(len(i), np.int64)
                    short = np.minimum(size[i], size[j])
                    for x, m in folded.items():
                        at_x = np.flatnonzero(short == x)
                        apart[at_x] = np.bitwise_count(m[i[at_x]] ^ m[j[at_x]]).sum(axis=1)
                    bound = total - 2 * rule.least_overlap(total)
                    near = apart <= bound
                    i, j, room = i[near], j[near], (bound - apart)[near]
                    first = [not _met_before(sh[x], keys[x], ups[x], keys[y], ups[y]) for x, y in zip(i.tolist(), j.tolist())]
                    i, j, room = i[first], j[first], room[first]
                    found.append(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j]), sh[i], tile[i], comp[i], comp[j], room]))
            d += 1
        if found and (pairs := np.concatenate(found, axis=1)).shape[1]:
            a, b, *_, room = pairs
            pairs = pairs[:, np.lexsort((b, a, -room, pairs[3], pairs[2]))]
            cut = np.flatnonzero((pairs[2:4, 1:] != pairs[2:4, :-1]).any(axis=0)) + 1
            good = np.concatenate([forests(p[4], p[5], most) for p in np.split(pairs, cut, axis=1)])
            found_in, pairs = pairs[2], np.unique(pairs[:2, good], axis=1)
            held = pa.array(np.unique(found_in[~good]) if groups else found_in[~good][:1])
            out = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(len(held), pa.int64())]) for x in pairs]
            if groups:
                out.append(pa.concat_arrays([pa.nulls(pairs.shape[1], pa.int64()), held]))
            yield pa.record_batch(out, ["a", "b", "sh"][:len(out)])
    return run


def _within_bound(rule: Rule) -> Callable:
    """The pairs whose differing parities a link allows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = parities_apart(batch.column("p_a").to_pylist(), batch.column("p_b").to_pylist())
            near = apart <= n - 2 * rule.least_overlap(n)
            yield batch.select(["a", "b"]).filter(pa.array(near))
    return run


def _tiles(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of a group of more than GROUP_BLOCK members go to tiles of two
    blocks each (side 0 and 1), or of one block with itself (side 2)."""
    m = members.join(sizes, "sh").withColumn("blocks", F.ceil(F.col("size") / GROUP_BLOCK).cast("long"))
    m = m.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    m = m.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return m.select("sh", (low * F.col("blocks") + high).alias("tile"), "cls", "n", "up", "comp", "parity", "keys", "ups",
                    F.when(low == high, 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))


def _split(named: DataFrame) -> DataFrame:
    """The groups (sh, size) that have pairs to look at: members of several components, and some
    pair without the least and the greatest member.  Of groups with the same members, told by
    128 bits, one stays: each pair of the others is in it too."""
    split = (named.groupBy("sh").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("cls", "up")).alias("name"), F.bit_xor(F.xxhash64("cls", "up", F.lit(1))).alias("more"))
        .where("lo != hi and size > 3"))
    return split.groupBy("name", "more", "size").agg(F.min("sh").alias("sh")).select("sh", "size")


def _near(many: DataFrame, known: DataFrame, known_sets: DataFrame, rule: Rule, most: int, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) between the components ``known``, as _compare emits them, with a row of nulls
    and the group (sh) for each that holds pairs back; and the rows of ``many`` in the groups compared."""
    named = materialize(many.join(known.withColumnRenamed("node", "cls"), "cls", "left")
                        .withColumn("comp", F.coalesce("root", "cls")).select("sh", "cls", "n", "up", "comp"), "join-named", paths)
    split = materialize(_split(named), "join-split", paths)
    compared = materialize(named.join(split.select("sh"), "sh", "left_semi"), "join-compared", paths)
    own = compared.groupBy("cls").agg(F.slice(F.array_sort(F.collect_list(F.struct("sh", "up"))), 1, NAMED).alias("k")).select(
        "cls", F.col("k.sh").alias("keys"), F.col("k.up").alias("ups")).join(known_sets.select("cls", "parity"), "cls")
    rest = _tiles(compared.join(own, "cls"), split)
    tasks = max(1, int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = (rest.repartition(tasks, "sh", "tile").sortWithinPartitions("sh", "tile", "cls")
            .mapInArrow(_compare(rule, most, groups=True), "a long, b long, sh long").distinct())
    return materialize(near, "join-near", paths), compared.select("sh", "cls", "n", "up")


@dataclass
class Joined:
    """documents: (doc_id, k, th, cls, n) per row; links: (a, b) between classes
    that differ, enough to connect every component; labels: (node, root) of components();
    paths: the written tables behind them, for ``remove_tables``."""
    documents: DataFrame
    links: DataFrame
    labels: DataFrame
    paths: list[str]


def join(docs: DataFrame, rule: Rule = Rule()) -> Joined:
    """Links and components of all rows of ``docs`` (doc_id, text; any other
    columns are ignored, so their names can't clash).

    Null text and text without words: an empty set, linked with nothing.  Null
    or repeated doc_id: every row is a document of its own.  An empty table
    gives empty results.  Sets are compared by 64-bit hashes of their n-grams,
    and classes by a 64-bit hash of the set.
    """
    spark = docs.sparkSession
    ship_package(spark)
    paths: list[str] = []
    kept: list[str] = []
    cells = frequency_sketch(docs, rule.k)
    sketch, cuts = spark.sparkContext.broadcast(cells), pivots(cells)
    described = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("k"),
                    F.xxhash64("text").alias("th"), "text")
        .mapInArrow(_describe(rule, sketch),
                    "doc_id long, k long, th long, cls long, n long, prefix array<long>, parity binary, own int"),
        "join-described", paths)
    classes = described.where("parity is not null")

    keyed = described.where("prefix is not null").select("cls", "n", "prefix", "own")
    bits = often.range_bits(keyed.agg(F.sum(F.size("prefix"))).head()[0] or 0)
    met = often.cells_with(keyed.select("prefix").mapInArrow(_token_cells(bits), often.PACKED), 2)
    meeting = often.filter_of(materialize(met, "join-met", paths), bits)
    prefix = keyed.mapInArrow(_entries(meeting), ENTRY)
    # two members of a group, the same in most groups of a family of copies: the least and the greatest
    leads = [(F.min, F.min_by), (F.max, F.max_by)]
    groups = (prefix.groupBy("sh").agg(
        F.min("up").alias("up"), F.count(F.lit(1)).alias("rows"), *(first("cls").alias(f"lead_{i}") for i, (first, _) in enumerate(leads)),
        *(best("n", "cls").alias(f"n_{i}") for i, (_, best) in enumerate(leads))).where("lead_0 != lead_1 and up = 0")
        .select("sh", "rows", F.array_distinct(F.array(*(F.struct(F.col(f"lead_{i}").alias("lead"), F.col(f"n_{i}").alias("lead_n"))
                                                         for i in range(len(leads))))).alias("leads")))
    fitting = F.filter("leads", lambda x: (x["lead"] != F.col("cls")) & _fits(rule, F.col("n"), x["lead_n"]))
    members = materialize(prefix.join(groups, "sh").withColumn("leads", fitting).where("size(leads) > 0 or rows > 2"), "join-members", paths)
    star = members.select("cls", F.explode("leads.lead").alias("lead"))
    star = materialize(star.select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct(), "join-star", paths)
    many = members.where("rows > 2").select("sh", "cls", "n", "up").distinct()
    looked_at = (star.select(F.col("a").alias("cls")).unionByName(star.select(F.col("b").alias("cls")))
                 .unionByName(many.select("cls")).distinct())
    known_sets = materialize(classes.join(looked_at, "cls").groupBy("cls").agg(
        F.max("n").alias("n"), F.first("parity").alias("parity")), "join-parities", paths)
    side = lambda x: known_sets.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"p_{x}"))
    star = (star.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "p_a", "p_b")
            .mapInArrow(_within_bound(rule), "a long, b long"))
    links = materialize(_linked(materialize(star, "join-star-near", paths), docs, classes, rule, sketch, cuts, paths), "join-links", paths)
    known, tested, most = components(links, paths=paths), None, FORESTS
    while True:
        near, many = _near(many, known, known_sets, rule, most, paths)
        pairs = near.where("a is not null").select("a", "b")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        if not pairs.isEmpty():
            pairs = materialize(pairs, "join-tested", paths)
            found = materialize(_linked(pairs, docs, classes, rule, sketch, cuts, paths), "join-links", paths)
            links, tested = links.unionByName(found), pairs if tested is None else tested.unionByName(pairs)
        held = near.where("a is null").select("sh")
        if held.isEmpty():
            break
        many = many.join(held, "sh", "left_semi")
        known, most = components(links, paths=paths), most * MORE
    links = materialize(links, "join-all-links", kept)
    labels = components(links, paths=kept)
    documents = materialize(described.select("doc_id", "k", "th", "cls", "n"), "join-documents", kept)
    remove_tables(spark, paths)
    return Joined(documents, links, labels, kept)


def component_ids(joined: Joined) -> DataFrame:
    """Per row: doc_id, k, th, n, comp (null for an empty set) and component_id,
    the smallest doc_id of the row's component (null ids count only where a
    component has no other; a row with an empty set has its own doc_id)."""
    d = joined.documents
    least = d.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low"))
    rooted = (least.join(joined.labels.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("comp", F.coalesce("root", "cls")))
    lows = rooted.groupBy("comp").agg(F.min("low").alias("component_id"))
    per_class = rooted.join(lows, "comp").select("cls", "comp", "component_id")
    return (d.join(per_class, "cls", "left").withColumn(
        "component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "k", "th", "n", "comp", "component_id"))


def _sift(known, key: str, inside: bool) -> Callable:
    """The rows whose ``key`` may be in the bitmap ``known``, or those whose key surely is not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmap.has(known.value, batch.column(key).to_numpy()) == inside))
    return run


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id
    (a hash of the text stands in for a null id); documents without words all
    stay.  Of rows that repeat the document that stays, one stays.  Only rows
    that may be among those that go or repeat are moved, the others stay where they lie."""
    joined, paths = join(docs, rule), []
    ids = materialize(component_ids(joined).where("comp is not null"), "keep-ids", paths)
    remove_tables(docs.sparkSession, joined.paths)
    low = ids.groupBy("comp").agg(F.min(F.struct("k", "th")).alias("low"))
    marked = ids.join(low, "comp").withColumn("stays", F.struct("k", "th") == F.col("low"))
    gone = materialize(marked.where("not stays").select("k", "th").distinct(), "keep-gone")
    repeated = materialize(marked.where("stays").groupBy("k", "th").count().where("count > 1").select("k", "th"),
                           "keep-repeated")
    remove_tables(docs.sparkSession, paths)
    named = gone.unionByName(repeated).select(F.xxhash64("k", "th").alias("key"))
    known = docs.sparkSession.sparkContext.broadcast(bitmap.build(named, named.count()))
    k, th, key = fresh(docs, "k"), fresh(docs, "th"), fresh(docs, "key")
    keyed = docs.withColumns({k: doc_key(), th: F.xxhash64("text"), key: F.xxhash64(doc_key(), F.xxhash64("text"))})
    stay, may_go = (keyed.mapInArrow(_sift(known, key, inside), keyed.schema) for inside in (False, True))
    same = lambda t: t.select(F.col("k").alias(k), F.col("th").alias(th))
    kept = may_go.join(same(gone), [k, th], "left_anti")
    if not repeated.isEmpty():
        kept = (kept.join(same(repeated), [k, th], "left_anti")
                .unionByName(kept.join(same(repeated), [k, th], "left_semi").dropDuplicates([k, th])))
    return stay.select(docs.columns).unionByName(kept.select(docs.columns))

