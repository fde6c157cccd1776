"""Words of many texts at once as 64-bit hashes, worked out on their UTF-8 bytes by numpy.

A word's hash is a polynomial of its bytes. With running sums ``C`` of ``byte * P^i`` it is
``(C[end] - C[start]) * P^-start`` modulo 2^64, so whole words and their beginnings cost one lookup each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)

BLANKS = b" \t\n\v\f\r"
"""What parts words when punctuation belongs to them."""


def table(of: bytes, otherwise: bool) -> np.ndarray:
    """A yes or no per byte value: ``not otherwise`` for those of ``of``."""
    found = np.full(256, otherwise)
    found[list(of)] = not otherwise
    return found


NOT_BLANK = table(BLANKS, True)
LETTERS = table(bytes(i for i in range(128) if not chr(i).isalnum() and chr(i) != "_"), True)
"""Letters, digits, the low line and all bytes of characters that are not ASCII."""


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, 1 << 20)
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _P, np.uint64)]), dtype=np.uint64)
                cls.down = np.cumprod(
                    np.concatenate([[np.uint64(1)], np.full(n - 1, _P_INVERSE, np.uint64)]), dtype=np.uint64
                )


def mix(x: np.ndarray) -> np.ndarray:
    """Spread over all 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """``text`` numbers the text of each word in order; ``bytes_of`` are the bounds of texts in ``raw``."""

    raw: np.ndarray
    bytes_of: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sums: np.ndarray

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Of whole words, or of their first ``length`` bytes (of words that have as many, see ``at_least``)."""
        end = self.end if length is None else self.start + length
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[self.start]) * _Powers.down[self.start])

    def at_least(self, length: int) -> np.ndarray:
        return self.end - self.start >= length

    def bounds(self, n: int) -> np.ndarray:
        """Where the words of each of ``n`` texts begin and end."""
        return np.searchsorted(self.text, np.arange(n + 1))


def words(texts: list[bytes], inside: np.ndarray) -> Words:
    """All words of the texts: longest runs of bytes for which ``inside`` holds."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bytes_of = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    _Powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _Powers.up[:len(raw)], dtype=np.uint64, out=sums[1:])
    within = inside[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], within, [False]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    return Words(raw, bytes_of, np.searchsorted(bytes_of, start, "right") - 1, start, end, sums)
