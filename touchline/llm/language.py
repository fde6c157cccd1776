"""Language of whole texts by a byte convolutional network in numpy.

A text's UTF-8 bytes, folded to 128 classes, are cut into windows of fixed length that overlap by a
filter's reach. Filters of several widths slide over each window, their largest responses feed a
softmax, and a text's languages are the mean over its windows, weighted by their letters.

The input of a filter is one of 128 classes per byte, so the response of a pair of bytes is one lookup:
filters of width 2, 3 and 4 cost one, two and two lookups a position.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.batches import add_columns

WIDTHS = (2, 3, 4)
FILTERS = 12
CLASSES = 128
WINDOW = 256
STEP = WINDOW - max(WIDTHS) + 1
TRAIN_ROWS = 3000
TRAIN_WINDOWS = 4
AT_ONCE = 16
UNKNOWN = "und"

# Blanks 0, a to z in either case 1 to 26, digits 27, other ASCII 28; continuation bytes 32 to 95 and
# leading bytes 96 to 127 by their low bits.
_CLASS = np.full(256, 28, np.uint8)
_CLASS[list(b" \t\n\v\f\r")] = 0
_CLASS[48:58] = 27
for _i in range(26):
    _CLASS[[65 + _i, 97 + _i]] = 1 + _i
_CLASS[128:192] = 32 + np.arange(64)
_CLASS[192:256] = 96 + np.arange(64) % 32


def windows(text: str) -> np.ndarray:
    """Byte classes of a text in rows of ``WINDOW``, the last filled up with blanks."""
    classes = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    n = max(1, -(-(len(classes) - WINDOW) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + WINDOW, np.uint8)
    padded[:len(classes)] = classes
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


@dataclass
class Network:
    langs: list[str]
    filters: dict[int, np.ndarray]  # width -> (width, CLASSES, FILTERS)
    shift: np.ndarray
    dense: np.ndarray
    base: np.ndarray

    def tables(self) -> dict[int, list[tuple[int, bool, np.ndarray]]]:
        """For each width its lookups: position, whether by pair of bytes, and the table."""
        def pair(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(-1, a.shape[1]).astype(np.float32)

        out = {}
        for width, w in self.filters.items():
            out[width] = [(j, True, pair(w[j], w[j + 1])) for j in range(0, width - 1, 2)]
            if width % 2:
                out[width].append((width - 1, False, w[width - 1].astype(np.float32)))
        return out

    def responses(self, rows: np.ndarray, tables) -> list[np.ndarray]:
        """For each width (window, position, filter)."""
        one = rows.astype(np.int32)
        two = one[:, :-1] * CLASSES + one[:, 1:]
        out = []
        for width, lookups in tables.items():
            n = WINDOW - width + 1
            total = None
            for j, is_pair, values in lookups:
                got = values.take((two if is_pair else one)[:, j:j + n], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            out.append(total)
        return out

    def predict(self, rows: np.ndarray, tables) -> np.ndarray:
        """Softmax of each window."""
        pooled = np.concatenate([_most(r) for r in self.responses(rows, tables)], axis=1)
        return _softmax(np.maximum(pooled + self.shift, 0) @ self.dense + self.base)


def _most(x: np.ndarray) -> np.ndarray:
    """Largest over the middle axis, by halves."""
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        rest = x[:, 2 * half:]
        x = np.maximum(x[:, :half], x[:, half:2 * half])
        if rest.shape[1]:
            x[:, :1] = np.maximum(x[:, :1], rest)
    return x[:, 0]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(rows: np.ndarray, langs: np.ndarray, steps: int = 400, batch: int = 96, rate: float = 0.01, seed: int = 5) -> Network:
    """Train on windows and their languages with Adam and cross entropy."""
    names = sorted(set(langs.tolist()))
    y = np.searchsorted(names, langs)
    rng = np.random.default_rng(seed)
    filters = {w: rng.normal(0, 0.3 / w, (w, CLASSES, FILTERS)) for w in WIDTHS}
    net = Network(
        names, filters, np.zeros(FILTERS * len(WIDTHS)),
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(names))), np.zeros(len(names)),
    )
    params = [*filters.values(), net.shift, net.dense, net.base]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        pick = rng.integers(0, len(rows), batch)
        x, target = rows[pick], y[pick]
        responses = net.responses(x, net.tables())
        where = [r.argmax(axis=1) for r in responses]
        pooled = np.concatenate([_most(r) for r in responses], axis=1) + net.shift
        hidden = np.maximum(pooled, 0)
        p = _softmax(hidden @ net.dense + net.base)
        p[np.arange(batch), target] -= 1
        p /= batch
        back = (p @ net.dense.T) * (pooled > 0)
        grads = []
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            d = np.zeros_like(filters[width])
            for j in range(width):
                seen = x[np.arange(batch)[:, None], where[k] + j].astype(np.int64)
                np.add.at(d[j], (seen, np.arange(FILTERS)[None, :]), g)
            grads.append(d)
        grads += [back.sum(0), hidden.T @ p, p.sum(0)]
        for q, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return net


def train(
    docs: DataFrame, learn: Column | None = None, rows: int = TRAIN_ROWS, text: str = "text", lang: str = "lang"
) -> Network | None:
    """A network fitted on the driver on windows of at most ``rows`` labelled documents.

    They are those of the smallest hashes of ``doc_id``, of the ids for which ``learn`` holds; up to
    ``TRAIN_WINDOWS`` windows spread over each whole text teach. Rows without id, language or text
    teach nothing. None if there is nothing to learn from.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())
    if learn is not None:
        known = known.where(learn)
    ids = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).distinct()
    # Broadcast: it holds `rows` ids at most.
    examples = known.join(F.broadcast(ids), "doc_id").select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(text, lang).alias("place")
    )

    def spread(texts):
        found = []
        for t in texts:
            w = windows(t)
            at = np.linspace(0, len(w) - 1, min(len(w), TRAIN_WINDOWS)).astype(int)
            found.append(w[at].tobytes())
        return [pa.array(found, pa.binary())]

    cut = add_columns(examples, "text", {"cut": "binary"}, lambda: spread)
    table = cut.select("cut", "lang", "place").orderBy("place").limit(rows).toArrow()
    parts = [np.frombuffer(c, np.uint8).reshape(-1, WINDOW) for c in table["cut"].to_pylist()]
    if not parts:
        return None
    langs = np.repeat(np.array(table["lang"].to_pylist()), [len(p) for p in parts])
    return fit(np.concatenate(parts), langs)


def with_language(
    docs: DataFrame, net: Network | None, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the predicted language of each whole text and its share of the softmax.

    A text that is null or has no letter gets ``und`` and 0, as does every text without a network.
    Columns of these names in ``docs`` give way. Repeated rows get the same, each in its own row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def begin():
        model = sent.value
        tables = model.tables() if model else None

        def compute(texts):
            shares = np.zeros((len(texts), len(model.langs) if model else 1))
            queue, owner = [], []

            def flush():
                rows, who = np.concatenate(queue), np.concatenate(owner)
                for a in range(0, len(rows), AT_ONCE):
                    part = rows[a:a + AT_ONCE]
                    letters = ((part > 0) & (part != 27) & (part != 28)).sum(axis=1)
                    np.add.at(shares, who[a:a + AT_ONCE], model.predict(part, tables) * letters[:, None])
                queue.clear()
                owner.clear()

            waiting = 0
            for i, t in enumerate(texts if model else ()):
                if t and any(map(str.isalpha, t)):
                    queue.append(windows(t))
                    owner.append(np.full(len(queue[-1]), i))
                    waiting += len(queue[-1])
                    if waiting >= 4 * AT_ONCE:
                        flush()
                        waiting = 0
            if queue:
                flush()
            total = shares.sum(axis=1)
            best = shares.argmax(axis=1)
            langs = [model.langs[b] if s > 0 else UNKNOWN for b, s in zip(best, total)]
            top = shares[np.arange(len(texts)), best] / np.where(total > 0, total, 1)
            return [pa.array(langs, pa.string()), pa.array(np.clip(top, 0, 1), pa.float64())]

        return compute

    return add_columns(docs, text, {lang: "string", score: "double"}, begin)
