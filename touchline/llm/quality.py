"""Quality of whole texts by a factorisation machine over hashed words and structure.

No metadata is used: ``lang`` and ``source`` are barred, and ``n_chars`` says what the size of the text does.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame

from touchline.llm import labelled
from touchline.llm.machine import Machine, Rows
from touchline.llm.words import NOT_BLANK, Words, mix, words

WORDS = 1 << 16
BINS = 1 << 12
SIZE = WORDS + BINS
TRAIN_ROWS = 4000

# Byte classes: 0 other, 1 upper, 2 lower, 3 digit, 4 blank, 5 line end, 6 sentence mark, 7 symbol, 8 not ASCII
_CLASS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate([b"", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz",
                                b"0123456789", b" \t", b"\r\n", b".,;:?'\"()-", b"!#$%&*+/<=>@[\\]^_`{|}~"]):
    _CLASS[list(_bytes)] = _kind
_CLASS[128:] = 8


_EDGES = np.array([0, .002, .005, .01, .02, .04, .07, .1, .15, .2, .3, .4, .5, .6, .7, .8, .9, .95, .98, .995])


def _share(x) -> np.ndarray:
    """Bins of shares in 0 to 1, finer near both ends."""
    return np.searchsorted(_EDGES, x)


def _log(x) -> np.ndarray:
    """0 for 0, else the number of binary digits."""
    return np.frexp(np.asarray(x, np.float64))[1]


def structure(texts: list[str], found: Words, counts: np.ndarray, distinct: np.ndarray, most: np.ndarray) -> dict:
    """Named bins of what each text is made of, an array each."""
    raw, bounds = _CLASS[found.raw], found.bytes_of
    kinds = np.stack([np.bincount(raw[a:b - 1], minlength=9) for a, b in zip(bounds, bounds[1:])]).astype(np.float64)
    total, words = np.maximum(1, kinds.sum(1)), np.maximum(1, counts)
    letters = np.maximum(1, kinds[:, 1] + kinds[:, 2] + kinds[:, 8])
    full = [[line for line in t.split("\n") if line and not line.isspace()] for t in texts]
    lines = np.array([len(x) for x in full])
    once = np.array([len(set(x)) for x in full])
    return {
        "size": _log(kinds.sum(1)), "words": _log(counts), "lines": _log(lines),
        "upper": _share(kinds[:, 1] / letters), "digits": _share(kinds[:, 3] / total),
        "blanks": _share((kinds[:, 4] + kinds[:, 5]) / total), "marks": _share(kinds[:, 6] / total),
        "symbols": _share(kinds[:, 7] / total), "foreign": _share(kinds[:, 8] / total),
        "other": _share(kinds[:, 0] / total), "distinct": _share(distinct / words),
        "commonest": _share(most / words), "repeated lines": _share(1 - once / np.maximum(1, lines)),
        "word length": np.minimum(40, np.round((kinds.sum(1) - kinds[:, 4] - kinds[:, 5]) / words)),
    }


def features(model: Machine | None = None):
    """A function from texts to sparse rows, to be made once per task."""
    return rows_of


def rows_of(given: list[str | None]) -> Rows:
    texts = [t or "" for t in given]
    n = len(texts)
    found = words([t.encode("utf-8", "replace") for t in texts], NOT_BLANK)
    bounds = found.bounds(n)
    # Words by their hash, each once per text; the hash is cut to 40 bits behind the text's number.
    key = (found.text.astype(np.uint64) << np.uint64(40)) | (found.hashes() >> np.uint64(24))
    key, times = np.unique(key, return_counts=True)
    text = (key >> np.uint64(40)).astype(np.int64)
    most, distinct = np.zeros(n, np.int64), np.bincount(text, minlength=n)
    np.maximum.at(most, text, times)
    x = np.sqrt(times)
    norm = np.sqrt(np.bincount(text, times, minlength=n))
    bins = structure(texts, found, np.diff(bounds), distinct, most)
    names = np.array([zlib.crc32(name.encode()) for name in bins], np.uint64)
    value = np.stack(list(bins.values()), axis=1).astype(np.uint64)
    named = WORDS + (mix(names[None, :] * np.uint64(64) + value) % np.uint64(BINS)).astype(np.int64)
    ids = np.concatenate([(key % np.uint64(WORDS)).astype(np.int64), named.ravel()])
    row = np.concatenate([text, np.repeat(np.arange(n), len(bins))])
    x = np.concatenate([x / norm[text], np.full(named.size, 0.5)])
    order = np.argsort(row, kind="stable")
    return Rows(np.searchsorted(row[order], np.arange(n + 1)), ids[order], x[order].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, learn=None, rows: int = TRAIN_ROWS, text: str = "text") -> Machine:
    """Fit on at most ``rows`` labelled documents; ``learn`` limits the ids that teach.

    Null texts count as empty. Without labels the score is 0.5 everywhere.
    """
    examples = labelled.sample(docs.select("doc_id", text), labels, "quality", rows, learn)
    return labelled.learn(examples, text, features, SIZE, rows)


def with_quality(docs: DataFrame, machine: Machine, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with ``column``: how likely label 1 is, 0 to 1. Null texts score as empty ones.

    A column of that name in ``docs`` gives way. Repeated rows score alike, each in its own row.
    """
    return labelled.scored(docs, text, machine, features, column)
