"""A hierarchical navigable small-world graph in numpy, built and searched for many vectors at once.

All vectors have length one; similarity is their inner product, in single precision for the walk. A
search moves all its queries in step: each takes its best candidate that is still closed, and looks at that
one's neighbours.
"""

from __future__ import annotations

import numpy as np

LINKS = 16
BUILD_BEAM = 48
AT_ONCE = 256
NONE = -1


class Graph:
    """``layers[0]`` holds all vectors; each further one about a ``LINKS``-th of the one below."""

    def __init__(self, x: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM):
        self.x, self.links = np.ascontiguousarray(x, np.float32), links
        n = len(x)
        # A vector's level follows from its place alone, so a task that runs again builds the same graph.
        mixed = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        share = np.maximum((mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53), 1e-12)
        self.level = np.minimum((-np.log(share) / np.log(links)).astype(int), 8)
        top = int(self.level.max(initial=0))
        self.layers = [np.full((n, links * (2 if k == 0 else 1)), NONE, np.int32) for k in range(top + 1)]
        order = np.argsort(-self.level, kind="stable")
        self.entry = int(order[0]) if n else NONE
        done = 0
        while done < n:
            size = min(n - done, max(1, min(AT_ONCE, done)))
            self._insert(order[done:done + size], order[:done], beam)
            done += size
        self.lost = self._lost() if n else np.zeros(0, np.int64)

    def _lost(self, beam: int = 8) -> np.ndarray:
        """Vectors that a narrow search for themselves misses, as too few links lead to them.

        Where a beam is full of vectors that are all but the same, another of them was found.
        """
        ids, score = self.search(self.x, beam)
        met = (ids == np.arange(len(self.x))[:, None]).any(axis=1)
        return np.flatnonzero(~met & (score[:, -1] < 1 - 1e-5))

    def _insert(self, new: np.ndarray, old: np.ndarray, beam: int) -> None:
        """Vectors of one batch meet one another by all their products, older ones by a search."""
        starts = np.full((len(new), 1), self.entry if len(old) else NONE, np.int64)
        for k in range(len(self.layers) - 1, -1, -1):
            if len(old):
                found, score = self._walk(self.x[new], starts, k, beam)
                starts = found[:, :1]
            else:
                found, score = np.full((len(new), 1), NONE, np.int64), np.full((len(new), 1), -np.inf, np.float32)
            here = self.level[new] >= k
            if not here.any():
                continue
            rows = new[here]
            among = self.x[rows] @ self.x[rows].T
            np.fill_diagonal(among, -np.inf)
            ids = np.concatenate([found[here], np.broadcast_to(rows, (len(rows), len(rows)))], axis=1)
            scores = np.concatenate([score[here], among], axis=1)
            ids = np.where(np.isfinite(scores), ids, NONE)
            chosen = self._spread(rows, ids, scores, self.links)
            self.layers[k][rows, :chosen.shape[1]] = chosen
            self._link_back(k, rows, chosen)

    def _spread(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates the best that are nearer to it than to one chosen before, then the best."""
        width = min(ids.shape[1], 3 * most)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :width]
        ids, scores = np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1)
        vectors = self.x[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        taken = np.zeros(ids.shape, bool)
        count = np.zeros(len(rows), int)
        for c in range(ids.shape[1]):
            covered = (taken & (between[:, :, c] > scores[:, c:c + 1])).any(axis=1)
            take = (ids[:, c] >= 0) & ~covered & (count < most)
            taken[:, c] = take
            count += take
        # Chosen ones first, then the best of the others up to the number of links.
        rank = np.where(ids < 0, 2 * width, np.where(taken, 0, width)) + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :most]
        return np.take_along_axis(ids, order, 1).astype(np.int32)

    def _link_back(self, k: int, rows: np.ndarray, chosen: np.ndarray) -> None:
        layer = self.layers[k]
        source = np.repeat(rows, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        uniq, first, size = np.unique(target, return_index=True, return_counts=True)
        width = layer.shape[1] + int(size.max(initial=0))
        ids = np.full((len(uniq), width), NONE, np.int64)
        ids[:, :layer.shape[1]] = layer[uniq]
        ids[np.repeat(np.arange(len(uniq)), size), layer.shape[1] + np.arange(len(source)) - np.repeat(first, size)] = source
        # A link may be there already.
        ids = -np.sort(-ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = NONE
        full = (ids >= 0).sum(axis=1) > layer.shape[1]
        kept = -np.sort(-ids, axis=1)[:, :layer.shape[1]]
        layer[uniq[~full]] = kept[~full]
        for a in range(0, int(full.sum()), AT_ONCE):
            some = np.flatnonzero(full)[a:a + AT_ONCE]
            at = uniq[some]
            scores = np.einsum("nd,nkd->nk", self.x[at], self.x[np.maximum(ids[some], 0)])
            scores[ids[some] < 0] = -np.inf
            layer[at] = self._spread(at, ids[some], scores, layer.shape[1])

    def _walk(self, q: np.ndarray, starts: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best found in layer ``k`` for each query, best first, and their similarities."""
        m, layer = len(q), self.layers[k]
        rows = np.arange(m)
        ids = np.full((m, beam), NONE, np.int64)
        score = np.full((m, beam), -np.inf, np.float32)
        open_ = np.zeros((m, beam), bool)
        seen = np.zeros((m, len(self.x) + 1), bool)  # the last column takes what is no vector
        w = starts.shape[1]
        ids[:, :w] = starts
        score[:, :w] = np.where(starts >= 0, np.einsum("nd,nkd->nk", q, self.x[np.maximum(starts, 0)]), -np.inf)
        open_[:, :w] = starts >= 0
        seen[rows[:, None], starts] = True
        while True:
            live = np.flatnonzero(open_.any(axis=1))
            if not len(live):
                break
            pick = np.where(open_[live], score[live], -np.inf).argmax(axis=1)
            at = ids[live, pick]
            open_[live, pick] = False
            near = layer[at].astype(np.int64)
            fresh = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            got = np.einsum("nd,nkd->nk", q[live], self.x[np.maximum(near, 0)])
            got[~fresh] = -np.inf
            all_score = np.concatenate([score[live], got], axis=1)
            all_ids = np.concatenate([ids[live], np.where(fresh, near, NONE)], axis=1)
            all_open = np.concatenate([open_[live], fresh], axis=1)
            best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            score[live] = np.take_along_axis(all_score, best, 1)
            ids[live] = np.take_along_axis(all_ids, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1) & np.isfinite(score[live])
        order = np.argsort(-score, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``_walk``, from the top layer down."""
        beam = min(beam, len(self.x))
        ids, scores = [], []
        for a in range(0, len(q), AT_ONCE):
            part = np.ascontiguousarray(q[a:a + AT_ONCE], np.float32)
            starts = np.full((len(part), 1), self.entry, np.int64)
            for k in range(len(self.layers) - 1, 0, -1):
                starts = self._walk(part, starts, k, 1)[0]
            i, s = self._walk(part, starts, 0, beam)
            ids.append(i)
            scores.append(s)
        return np.concatenate(ids), np.concatenate(scores)
