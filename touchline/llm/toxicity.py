"""Toxicity of whole texts by a factorisation machine over hashed terms.

Terms are words and their beginnings, so that an inflected insult is known by its stem. A term counts
once however often it occurs; pairs of terms, such as an insult with a group, weigh through the
machine's factors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from touchline.llm import labelled
from touchline.llm.machine import Machine, Rows
from touchline.llm.words import LETTERS, Words, mix, words

SIZE = 1 << 18
TERMS = 1 << 11
"""Buckets that the machine keeps."""
STEMS = (3, 4, 5)
"""Bytes of a word's beginnings."""
TRAIN_ROWS = 6000


def features(model: Machine | None = None):
    """A function from texts to sparse rows, to be made once per task; of a model's own features only."""
    known = np.ones(SIZE, bool) if model is None else model.known()
    return lambda texts: rows_of(texts, known)


def rows_of(texts: list[str | None], known: np.ndarray) -> Rows:
    n = len(texts)
    found = words([(t or "").lower().encode("utf-8", "replace") for t in texts], LETTERS)
    keys = []
    for salt, length in enumerate((None, *STEMS)):
        long = slice(None) if length is None else found.at_least(length)
        cut = Words(found.raw, found.bytes_of, found.text[long], found.start[long], found.end[long], found.sums)
        bucket = (mix(cut.hashes(length) + np.uint64(salt)) % np.uint64(SIZE)).astype(np.int64)
        counts = known[bucket]
        keys.append(cut.text[counts] * SIZE + bucket[counts])
    key = np.unique(np.concatenate(keys))
    return Rows(np.searchsorted(key, np.arange(n + 1) * SIZE), key % SIZE, np.ones(len(key), np.float32))


def train(docs: DataFrame, labels: DataFrame, learn=None, rows: int = TRAIN_ROWS, text: str = "text") -> Machine:
    """Fit on at most ``rows`` labelled documents; ``learn`` limits the ids that teach.

    Null texts count as empty. Without labels the score is 0.5 everywhere.
    """
    examples = labelled.sample(docs.select("doc_id", text), labels, "toxic", rows, learn)
    return labelled.learn(examples, text, features, SIZE, rows, keep=TERMS)


def with_toxicity(docs: DataFrame, machine: Machine, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with ``column``: how likely the toxic label is, 0 to 1. Null texts score as empty ones.

    A column of that name in ``docs`` gives way. Repeated rows score alike, each in its own row.
    """
    return labelled.scored(docs, text, machine, features, column)
