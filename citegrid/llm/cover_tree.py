"""Cover trees over blocks of integer vectors, and the dual-tree search of one
tree of queries against one tree of candidates (numpy, no Spark).

A node has a centre (one of its points) and a covering radius, the largest
distance from the centre to a point below it.  The centres of a node's
children are a cover of its points: farthest-first choice stops when every
point lies within the node's radius / SHRINK of a centre, so centres are more than
that apart.  The inner product of a query below node Q and a candidate below
node C is at most cq.cc + |cq| rc + |cc| rq + rq rc; a pair of nodes is left
out when that is less than the worst kth score of the queries below Q.
"""
from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

SHRINK = 1.5
#: Nodes of at most so many points are leaves.
LEAF = 48
#: A node whose cover would need more than this share of its points is a leaf:
#: its points are about equally far from each other, and no ball holds several.
LARGEST_COVER = 0.55
#: Components below this bound give scores that float64 holds exactly.
EXACT = float(1 << 53)
#: Stands for "no score yet"; its negative is a long too.
NONE = np.iinfo(np.int64).min + 1


@dataclass
class Tree:
    """points, ids in tree order; per node: centre (place), radius, first and
    last place of its points, first child and number of children (0: leaf)."""
    points: np.ndarray
    ids: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    children: np.ndarray

    def pack(self) -> bytes:
        kind = next((t for t in (np.int16, np.int32) if len(self.points) and np.abs(self.points).max() < np.iinfo(t).max), np.float64)
        out = io.BytesIO()
        np.savez(out, **{**self.__dict__, "points": self.points.astype(kind)})
        return out.getvalue()

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as z:
            parts = {k: z[k] for k in z.files}
        parts["points"] = parts["points"].astype(np.float64)
        return cls(**parts)


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(axis=1))


def _cover(points: np.ndarray, d: np.ndarray, bound: float) -> tuple[list[int], np.ndarray] | None:
    """Farthest-first centres (the first is place 0 of ``points``) until all
    points are within ``bound``, and the centre of each point."""
    centres, near, owner = [0], d.copy(), np.zeros(len(points), np.int64)
    most = max(2, int(LARGEST_COVER * len(points)))
    while True:
        far = int(near.argmax())
        if near[far] <= bound:
            return centres, owner
        if len(centres) >= most:
            return None
        new = _distances(points, points[far])
        closer = new < near
        near[closer], owner[closer] = new[closer], len(centres)
        centres.append(far)


def build(points: np.ndarray, ids: np.ndarray) -> Tree:
    """The tree of one block of points (at least one)."""
    mean = points.mean(axis=0)
    root = int(_distances(points, mean).argmin())
    order = np.arange(len(points))
    order[[0, root]] = order[[root, 0]]
    nodes: list[list] = [[0, 0.0, 0, len(points), 0, 0]]
    todo = [0]
    while todo:
        i = todo.pop()
        _, _, a, b, _, _ = nodes[i]
        here = points[order[a:b]]                  # the centre comes first
        d = _distances(here, here[0])
        nodes[i][1] = radius = float(d.max())
        if b - a <= LEAF or radius == 0 or (cover := _cover(here, d, radius / SHRINK)) is None:
            continue
        centres, owner = cover
        groups, parts = [], order[a:b].copy()
        for c, centre in enumerate(centres):
            own = np.flatnonzero(owner == c)
            own = np.concatenate([[centre], own[own != centre]])
            groups.append(parts[own])
        nodes[i][4], nodes[i][5] = len(nodes), len(groups)
        at = a
        for g in groups:
            order[at:at + len(g)] = g
            todo.append(len(nodes))
            nodes.append([at, 0.0, at, at + len(g), 0, 0])
            at += len(g)
    n = np.array(nodes, dtype=float)
    whole = n.astype(np.int64)
    return Tree(points[order], ids[order], whole[:, 0], n[:, 1], whole[:, 2], whole[:, 3], whole[:, 4], whole[:, 5])


def bounds(qc: np.ndarray, qr: np.ndarray, cc: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products between balls (queries by candidates)."""
    qn, cn = np.sqrt((qc ** 2).sum(1))[:, None], np.sqrt((cc ** 2).sum(1))[None]
    most = qc @ cc.T + qn * cr[None] + cn * qr[:, None] + qr[:, None] * cr[None]
    return most + 1e-9 * (1 + (qn + qr[:, None]) * (cn + cr[None]))            # rounding


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products as integers, held at the ends of the range of a long."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object)
    got = whole(q) @ whole(c).T
    return np.array([[min(max(v, NONE + 1), -NONE) for v in row] for row in got], dtype=np.int64).reshape(len(q), len(c))


@dataclass
class Best:
    """The k best candidates of each query so far: scores falling, ties by rising id."""
    score: np.ndarray
    who: np.ndarray
    k: int

    @classmethod
    def new(cls, n: int, k: int) -> Best:
        return cls(np.full((n, k), NONE), np.full((n, k), -1), k)

    def add(self, rows: np.ndarray, got: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """Scores of the queries ``rows`` for the candidates ``ids``; a query's own id doesn't count."""
        got = np.where(own[:, None] == ids[None], NONE, got)
        floor = self.score[rows, -1]
        if got.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(got, got.shape[1] - self.k, axis=1)[:, got.shape[1] - self.k])
        q, c = np.nonzero((got >= floor[:, None]) & (got > NONE))
        if not len(q):
            return
        touched = np.unique(q)
        place = np.repeat(touched, self.k)
        score = np.concatenate([self.score[rows[touched]].ravel(), got[q, c]])
        who = np.concatenate([self.who[rows[touched]].ravel(), ids[c]])
        of = np.concatenate([place, q])
        order = np.lexsort((who, -score, of))
        score, who, of = score[order], who[order], of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of, "left")
        keep = rank < self.k
        self.score[rows[of[keep]], rank[keep]] = score[keep]
        self.who[rows[of[keep]], rank[keep]] = who[keep]


def search(queries: Tree, candidates: Tree, best: Best, least: np.ndarray) -> int:
    """Dual-tree search; ``least`` has a score per query that its kth best is
    known to reach.  Returns the number of products taken."""
    taken = 0
    todo = [(0, 0)]
    while todo:
        q, c = todo.pop()
        a, b = queries.first[q], queries.last[q]
        floor = np.maximum(best.score[a:b, -1], least[a:b]).min()              # worst kth score of the group
        most = bounds(queries.points[[queries.centre[q]]], queries.radius[[q]],
                      candidates.points[[candidates.centre[c]]], candidates.radius[[c]])[0, 0]
        if most < floor:
            continue
        q_leaf, c_leaf = not queries.children[q], not candidates.children[c]
        if q_leaf and c_leaf:
            x, y = candidates.first[c], candidates.last[c]
            rows = np.arange(a, b)
            best.add(rows, products(queries.points[a:b], candidates.points[x:y]), candidates.ids[x:y], queries.ids[a:b])
            taken += (b - a) * (y - x)
            continue
        qs = [q] if q_leaf or (not c_leaf and queries.radius[q] < candidates.radius[c]) else list(
            range(queries.child[q], queries.child[q] + queries.children[q]))
        cs = [c] if qs != [q] else list(range(candidates.child[c], candidates.child[c] + candidates.children[c]))
        most = bounds(queries.points[queries.centre[qs]], queries.radius[qs],
                      candidates.points[candidates.centre[cs]], candidates.radius[cs])
        pairs = sorted((most[i, j], i, j) for i in range(len(qs)) for j in range(len(cs)))
        todo += [(qs[i], cs[j]) for _, i, j in pairs]                          # the most promising comes off first
    return taken
