"""SentencePiece encoding and decoding by a streaming Viterbi over the vocabulary's pieces.

The lattice has a boundary before every character and an edge for every piece. A vocabulary of merges
allows an edge after another only if the merges, run on the two pieces alone, leave both as they are;
exactly one path then survives to each boundary, and it gives the ids that the merges give. Only the
boundaries of one piece's length back are kept. When the paths to all of them share a boundary, the ids
before it are final and leave the window.

No piece lies across two characters that never stand side by side inside a piece, so all paths
share such a boundary. Line ends and the mark before a word are of that kind, which cuts a text into words
whose ids a task may remember.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field
from operator import concat

import numpy as np
import pyarrow as pa
from ahocorasick import STORE_ANY, Automaton
from pyspark.sql import DataFrame

from touchline.llm.batches import add_columns

BLANK = "▁"
KNOWN_BYTES = 32 << 20
"""Memory of half the remembered words, with the mark before them or without."""
ENTRY = 200
"""Bytes that a dictionary takes for a word beyond its letters and ids, about."""
KNOWN_PAIRS = 1 << 18
BEGINNING = 5
"""Characters of a stretch whose paths are remembered."""
KNOWN_BEGINNINGS = 1 << 15
LONG_WORD = 64
"""Characters beyond which a word's ids are not remembered."""


@dataclass
class Vocabulary:
    """Pieces with their ids and scores; ``bytes_`` are the ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: list[int]
    unknown: int
    size: int
    dummy: bool
    inner: set[str] = field(default_factory=set)

    def __post_init__(self):
        """The pairs of characters inside a piece."""
        for piece in self.ids:
            self.inner.update(piece[i - 2:i] for i in range(2, len(piece) + 1))
        self.reach = max(map(len, self.ids), default=1)
        # A mark inside a word, or a line end in a piece, would join what is taken apart here.
        self.words = not any((p[1] == BLANK and p[0] != BLANK) or "\n" in p for p in self.inner)


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file of merges; a text is taken as it is, but for blanks."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    with open(path, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    spec, trainer = proto.normalizer_spec, proto.trainer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("the model changes characters before it encodes; only blanks are handled")
    if trainer.model_type != trainer.BPE or trainer.treat_whitespace_as_suffix:
        raise ValueError("the model is not one of merges with a mark before each word")
    model = SentencePieceProcessor(model_file=path)
    ids, scores, single = {}, {}, [model.unk_id()] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            single[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[piece], scores[piece] = i, model.get_score(i)
    return Vocabulary(ids, scores, single, model.unk_id(), model.get_piece_size(), spec.add_dummy_prefix)


class Encoder:
    """Pieces are known by their ids, and a character that is none by ``size`` and its code point.

    An automaton over the longer pieces gives at each character those that end there, the longest first.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._automaton = Automaton(STORE_ANY)
        self._names: dict[int, str] = {-1: ""}
        self._pairs = 0
        self._begun: dict[str, tuple[list[int], list[int]]] = {}
        for piece, i in vocabulary.ids.items():
            self._names[i] = piece
            if len(piece) > 1:
                # With each piece, those met before it and whether it may follow.
                self._automaton.add_word(piece, (i, len(piece), {}))
        if len(self._automaton):
            self._automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """A short text by its merges: the best-scored pair first, of equals the leftmost."""
        parts, scores = list(text), self.v.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def name(self, number: int) -> str:
        return chr(number - self.v.size) if number >= self.v.size else self._names[number]

    def allowed(self, left: int, right: int) -> bool:
        """Whether the merges of both together leave ``left`` and ``right``; a ``left`` of -1 is empty."""
        before, after = self.name(left), self.name(right)
        return self.merged(before + after) == ([before, after] if before else [after])

    def _forget(self) -> None:
        for _, _, pairs in self._automaton.values():
            pairs.clear()
        self._pairs = 0

    def pieces(self, text: str) -> list[int]:
        """The pieces of a stretch that has its marks already.

        The paths to the first boundaries depend on the first characters alone, so stretches that begin alike share them.
        """
        size, single, window = self.v.size, self.v.ids, 4 * self.v.reach
        out: list[int] = []
        # For each boundary from ``done`` to ``at``: how the one path to it ends, and where that piece begins.
        done, at, last, begin = 0, 0, [-1], [0]
        shares = len(text) > BEGINNING
        if shares and (begun := self._begun.get(text[:BEGINNING])) is not None:
            at, last, begin, shares = BEGINNING, begun[0].copy(), begun[1].copy(), False
        for i, (piece, length, pairs) in self._automaton.iter(text) if len(self._automaton) else ():
            if i < at:
                continue  # a longer piece ends the path to this boundary
            # If no longer piece ends the paths to the boundaries before, their characters do.
            while at < i:
                last.append(single.get(text[at], size + ord(text[at])))
                begin.append(at)
                at += 1
            if shares and at >= BEGINNING:
                self._begin(text, last, begin)
                shares = False
            start = i + 1 - length
            if start < done:
                continue
            left = last[start - done]
            kept = pairs.get(left)
            if kept is None:
                if self._pairs >= KNOWN_PAIRS:
                    self._forget()
                self._pairs += 1
                kept = pairs[left] = self.allowed(left, piece)
            if kept:
                last.append(piece)
                begin.append(start)
                at = i + 1
                if at - done > window:
                    shared = self._shared(begin, done, at, self.v.reach)
                    out += self._path(last, begin, done, shared)
                    last, begin, done = last[shared - done:], begin[shared - done:], shared
        for i in range(at, len(text)):
            last.append(single.get(text[i], size + ord(text[i])))
            begin.append(i)
        if shares and not out:
            self._begin(text, last, begin)
        return out + self._path(last, begin, done, len(text))

    def _begin(self, text: str, last: list[int], begin: list[int]) -> None:
        if len(self._begun) >= KNOWN_BEGINNINGS:
            self._begun.clear()
        self._begun[text[:BEGINNING]] = last[:BEGINNING + 1], begin[:BEGINNING + 1]

    @staticmethod
    def _shared(begin: list[int], done: int, end: int, reach: int) -> int:
        """The last boundary on the paths to all those that a coming piece can start from."""
        ends = set(range(max(done, end - reach), end + 1))
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(begin[latest - done])
        return ends.pop()

    @staticmethod
    def _path(last: list[int], begin: list[int], done: int, end: int) -> list[int]:
        pieces = []
        while end > done:
            pieces.append(last[end - done])
            end = begin[end - done]
        pieces.reverse()
        return pieces

    def ids(self, text: str) -> list[int]:
        """Ids of a stretch that has its marks already; a character without a piece becomes its bytes."""
        found, size, single = self.pieces(text), self.v.size, self.v.bytes_
        if found and max(found) < size:
            return found
        out = []
        for piece in found:
            if piece < size:
                out.append(piece)
            else:
                out.extend(single[b] for b in chr(piece - size).encode("utf-8", "replace"))
        return out

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers."""
        return array("i", self.ids(text)).tobytes()


class _Words(dict):
    """A word's ids as packed 32-bit numbers, with or without the mark before it.

    Words seen lately are remembered: when they take ``KNOWN_BYTES``, they become the older half and those of
    the half before go, but for words that are met again.
    """

    def __init__(self, encoder: Encoder, mark: str, bare: _Words | None = None):
        self.encoder, self.mark, self.older, self.bytes = encoder, mark, {}, 0
        self.bare = self if bare is None else bare

    def __missing__(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self._encode(word)
        if len(word) <= LONG_WORD:
            if self.bytes >= KNOWN_BYTES:
                self.older, self.bytes = dict(self), 0
                self.clear()
            self.bytes += len(word) + len(packed) + ENTRY
            self[word] = packed
        return packed

    def _encode(self, word: str) -> bytes:
        # All paths share the boundary between two characters that no piece holds side by side, so what
        # lies between such boundaries are words of their own.
        inner = self.encoder.v.inner
        if inner.issuperset(map(concat, word, word[1:])):
            return self.encoder.packed(self.mark + word)
        cuts = [i for i, pair in enumerate(map(concat, word, word[1:]), 1) if pair not in inner]
        parts = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
        return self[parts[0]] + b"".join(map(self.bare.__getitem__, parts[1:]))


class Codec:
    """Encodes and decodes whole texts, remembering words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.encoder = Encoder(vocabulary)
        self.bare = _Words(self.encoder, "")
        self.marked = _Words(self.encoder, BLANK, self.bare)
        self.line_end = self.encoder.packed("\n")
        self.raw = [b""] * vocabulary.size
        for piece, i in vocabulary.ids.items():
            self.raw[i] = piece.replace(BLANK, " ").encode()
        for b, i in enumerate(vocabulary.bytes_):
            if i != vocabulary.unknown:
                self.raw[i] = bytes([b])
        self.raw[vocabulary.unknown] = " ⁇ ".encode()

    def encode(self, text: str) -> bytes:
        """Packed 32-bit ids; none for an empty text."""
        if not text:
            return b""
        if BLANK in text or not self.v.words:
            whole = (BLANK if self.v.dummy else "") + text.replace(" ", BLANK)
            return self.encoder.packed(whole)
        lines = []
        for n, line in enumerate(text.split("\n")):
            words = line.split(" ")
            first = BLANK if n == 0 and self.v.dummy else ""
            if "" in words:
                # Runs of blanks belong to the word behind them.
                lines.append(self.encoder.packed(first + line.replace(" ", BLANK)))
            else:
                start = (self.marked if first else self.bare)[words[0]]
                lines.append(start + b"".join(map(self.marked.__getitem__, words[1:])))
        return self.line_end.join(lines)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(packed, np.int32).tolist())).decode("utf-8", "replace")
        return text[1:] if self.v.dummy and text[:1] == " " else text


_codecs: dict[int, tuple[Vocabulary, Codec]] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """One per vocabulary in a worker process, so that its tasks share the words they have met."""
    held, codec = _codecs.get(id(vocabulary), (None, None))
    if held is not vocabulary:
        codec = Codec(vocabulary)
        _codecs.clear()
        _codecs[id(vocabulary)] = (vocabulary, codec)
    return codec


def _lists(packed: list[bytes | None]) -> pa.Array:
    sizes = [len(p) // 4 if p is not None else 0 for p in packed]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p for p in packed if p), np.int32))
    nulls = pa.array([p is None for p in packed])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=nulls)


def with_ids(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", count: str = "n_ids",
    round_trip: str = "round_trip",
) -> DataFrame:
    """``docs`` with the ids of each whole text, their number, and whether decoding them gives the text back.

    A null text has null ids, 0 of them and a null round trip; an empty one has no ids. The mark itself
    in a text reads as a blank, as it does in any decoding. Columns of these names in ``docs`` give way;
    repeated rows get the same ids, each in its own row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of the model's size

    def begin():
        codec = _codec(sent.value)

        def compute(texts):
            packed = [None if t is None else codec.encode(t) for t in texts]
            back = [None if p is None else codec.decode(p) == t.replace(BLANK, " ") for p, t in zip(packed, texts)]
            sizes = [len(p) // 4 if p is not None else 0 for p in packed]
            return [_lists(packed), pa.array(sizes, pa.int32()), pa.array(back, pa.bool_())]

        return compute

    return add_columns(docs, text, {ids: "array<int>", count: "int", round_trip: "boolean"}, begin)


def with_text(tokens: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text") -> DataFrame:
    """``tokens`` with the text of the ids; null for null ids. An id outside the vocabulary fails."""
    sent = tokens.sparkSession.sparkContext.broadcast(vocabulary)

    def begin():
        codec = _codec(sent.value)

        def compute(lists):
            return [pa.array([
                None if x is None else codec.decode(np.array(x, np.int32).tobytes()) for x in lists
            ], pa.string())]

        return compute

    return add_columns(tokens, ids, {text: "string"}, begin)
