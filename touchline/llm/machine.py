"""A factorisation machine: linear weights and low-rank pairwise interactions of sparse features.

The score of a row is the logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. The last
sum costs one pass over the features, as ``((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2`` per factor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows: those of row r are ``ids[starts[r]:starts[r + 1]]``, with their values."""

    starts: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    @staticmethod
    def of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(ids) for ids, _ in parts]
        return Rows(
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            np.concatenate([ids for ids, _ in parts] or [np.zeros(0, np.int64)]),
            np.concatenate([x for _, x in parts] or [np.zeros(0)]).astype(np.float32),
        )

    def pick(self, rows) -> Rows:
        return Rows.of([
            (self.ids[self.starts[r]:self.starts[r + 1]], self.values[self.starts[r]:self.starts[r + 1]])
            for r in rows
        ])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each row's values; zero for a row without any."""
    total = np.zeros((len(starts) - 1, *values.shape[1:]), values.dtype)
    full = starts[1:] > starts[:-1]
    if full.any():
        total[full] = np.add.reduceat(values, starts[:-1][full], axis=0)
    return total


class Machine:
    """``place`` maps a feature id to its row in ``w`` and ``v``; unknown ids share the last, zero row."""

    def __init__(self, place: np.ndarray, scale: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.place, self.scale, self.w0, self.w, self.v = place, scale, w0, w, v

    def known(self) -> np.ndarray:
        """For each feature id, whether it counts at all."""
        return self.place < len(self.w) - 1

    def logit(self, rows: Rows) -> np.ndarray:
        at = self.place[rows.ids]
        known = at < len(self.w) - 1
        at = at[known]
        x = rows.values[known] * self.scale[at]
        starts = np.concatenate([[0], np.cumsum(known)])[rows.starts]
        vx = self.v[at] * x[:, None]
        pairs = (_sums(vx, starts) ** 2 - _sums(vx * vx, starts)).sum(axis=1) / 2
        return self.w0 + _sums(self.w[at] * x, starts) + pairs

    def score(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows).astype(np.float64), -35, 35)))


def fit(
    rows: Rows, labels: np.ndarray, size: int, rank: int = 8, epochs: int = 10, rate: float = 0.1,
    shrink: float = 1e-4, least: int = 3, keep: int = 1 << 16, batch: int = 256, seed: int = 7,
) -> Machine:
    """Fit by AdaGrad on the logistic loss. Features of fewer than ``least`` rows stay at zero, as do
    all but the ``keep`` whose presence tells most about the label (by chi-squared).

    Without rows, or with one label only, the machine scores every row by the share of label 1, with
    one row added for each label.
    """
    seen = np.bincount(rows.ids, minlength=size)
    chosen = np.flatnonzero(seen >= least)
    if len(chosen) > keep:
        n, ones = len(rows), labels.sum()
        with_one = np.bincount(rows.ids, labels[np.repeat(np.arange(n), np.diff(rows.starts))], minlength=size)
        a, b = with_one[chosen], seen[chosen].astype(float)
        tells = (a * n - b * ones) ** 2 / np.maximum(1, b * (n - b))
        chosen = np.sort(chosen[np.argsort(-tells, kind="stable")[:keep]])
    # Rare features weigh more, so that common ones don't drown them.
    scale = np.zeros(len(chosen) + 1, np.float32)
    scale[:-1] = np.log((len(rows) + 1) / seen[chosen]) + 0.1
    place = np.full(size, len(chosen), np.int32)
    place[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(seed)
    w = np.zeros(len(chosen) + 1, np.float32)
    v = rng.normal(0, 0.02, (len(chosen) + 1, rank)).astype(np.float32)
    v[-1] = 0
    share = (labels.sum() + 1) / (len(labels) + 2)
    w0 = float(np.log(share / (1 - share)))
    model = Machine(place, scale, w0, w, v)
    if len(set(labels.tolist())) < 2:
        return model
    g0, gw, gv = 1e-6, np.full_like(w, 1e-6), np.full_like(v, 1e-6)
    used = place[rows.ids] < len(chosen)
    rows = Rows(np.concatenate([[0], np.cumsum(used)])[rows.starts], rows.ids[used], rows.values[used])
    order = rng.permutation(len(rows))
    parts = []
    for a in range(0, len(order), batch):
        part = rows.pick(order[a:a + batch])
        at = place[part.ids]
        used, where = np.unique(at, return_inverse=True)
        of_row = np.repeat(np.arange(len(part)), np.diff(part.starts))
        parts.append((part, at, used, where, of_row, labels[order[a:a + batch]]))
    for _ in range(epochs):
        for p in rng.permutation(len(parts)):
            part, at, used, where, of_row, y = parts[p]
            x = part.values * scale[at]
            vx = v[at] * x[:, None]
            s = _sums(vx, part.starts)
            z = model.w0 + _sums(w[at] * x, part.starts) + ((s * s).sum(1) - _sums((vx * vx).sum(1), part.starts)) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y).astype(np.float32) / len(y)
            e = error[of_row] * x
            dw = np.bincount(where, e, len(used)).astype(np.float32) + shrink * w[used]
            dv = e[:, None] * (s[of_row] - vx)
            dv = np.stack([np.bincount(where, dv[:, f], len(used)) for f in range(rank)], axis=1).astype(np.float32)
            dv += shrink * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
            w[-1], v[-1] = 0, 0
            d0 = float(error.sum())
            g0 += d0 * d0
            model.w0 -= rate * d0 / g0 ** 0.5
    return model
