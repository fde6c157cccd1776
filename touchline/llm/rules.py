"""Quality rules by weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

Each rule looks at one property of a whole text and votes good, bad, or not at all. What votes occur together,
and how often, is counted over all documents that the base rules leave open: at most three to the power of the number of rules, however many
documents there are. On these counts expectation-maximisation estimates, for good and for bad texts, how often a
rule that votes is right, and the share of good texts. The posterior of a document's votes is its quality, so one
unlucky vote of a rule that is often wrong drops nothing, and two weak ones may.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.batches import add_columns, without
from touchline.session import pin

WINDOW = 8
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_BLANK = list(_BLANKS.encode())
_SYMBOL = list(SYMBOLS.encode())

COUNTS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
}
"""What the base rules count, exactly."""
SHARES = {
    "n_lines": "long", "n_distinct": "long", "n_commonest": "long", "n_letters": "long", "n_upper": "long",
    "n_digits": "long", "n_shouts": "long", "n_ends": "long", "n_stutters": "long",
}
"""What further rules look at: lines with a word, distinct words and how often the commonest one stands, letters
(A-Z, a-z and all characters beyond ASCII), of these A-Z, digits, exclamation marks, lines that end a sentence, and words equal
to the one before."""


def repeated(words: list[list], window: int = WINDOW) -> np.ndarray:
    """Per text, the words inside windows that occur twice or more in it, first occurrences included.

    Windows are told apart by numbers and never by hashes: a word gets a number, then pairs of neighbours, pairs
    of these and so on, each round a sort of whole numbers.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for text in words for w in text), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(words)), sizes)
    left = np.cumsum(sizes)[text] - np.arange(len(ids))
    held = np.flatnonzero(left >= window)
    if not len(held):
        return np.zeros(len(words), np.int64)
    span = 1
    while span < window:
        # What starts at a place and is ``2 * span`` words long; ids behind the end are never asked for.
        step = min(span, window - span)
        later = np.concatenate([ids[step:], np.zeros(step, np.int64)])
        ids = np.unique(ids * (int(ids.max()) + 1 + int(later.max())) + later, return_inverse=True)[1]
        span += step
    _, group, count = np.unique(text[held] * (int(ids.max()) + 1) + ids[held], return_inverse=True, return_counts=True)
    again = held[count[group] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=len(words))


def _about(text: str, raw: bytes, words: list[bytes]) -> tuple[int, ...]:
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    seen = Counter(words)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    # Bytes that begin a character: all but those of 0x80 to 0xBF.
    beyond = int(of[0xC0:].sum())
    characters = int(of[:0x80].sum()) + beyond
    upper, lower = int(of[65:91].sum()), int(of[97:123].sum())
    return (
        len(words), characters - int(of[_BLANK].sum()), int(of[_SYMBOL].sum()), len(lines) - len(set(lines)),
        len(lines), len(seen), max(seen.values(), default=0), upper + lower + beyond, upper,
        int(of[48:58].sum()), int(of[ord("!")]), sum(line.rstrip(_BLANKS)[-1] in ".!?…" for line in lines),
        sum(map(eq, words, words[1:])),
    )


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS`` and ``SHARES`` of each whole text; a null text counts as empty.

    Columns of ``docs`` with these names, in any case, give way; all others stay.
    """
    names = [*COUNTS, *SHARES]
    order = ["n_words", "word_chars", "n_symbols", "n_dup_lines", *SHARES]

    def start():
        def compute(texts):
            whole = [t or "" for t in texts]
            raw = [t.encode("utf-8", "replace") for t in whole]
            words = [b.split() for b in raw]
            found = dict(zip(order, zip(*map(_about, whole, raw, words)), strict=True))
            found["n_repeat_words"] = repeated(words)
            return [pa.array(found[n], pa.int64()) for n in names]

        return compute

    return add_columns(docs, text, {**COUNTS, **SHARES}, start)


@dataclass(frozen=True)
class Rule:
    """Votes good if ``share`` is at most ``good``, bad if it is above ``bad``, else abstains; so it does where
    ``share`` is null."""

    name: str
    share: Column
    good: float
    bad: float

    def vote(self) -> Column:
        return F.when(self.share <= self.good, "+").when(self.share > self.bad, "-").otherwise("0")


def _of(a: str, b: str) -> Column:
    """``a`` over ``b``; null where ``b`` is 0."""
    return F.col(a) / F.when(F.col(b) > 0, F.col(b))


def rules() -> list[Rule]:
    """Every share is one of badness: the lower the better."""
    lines = F.when(F.col("n_lines") >= 3, F.col("n_dup_lines") / F.col("n_lines"))
    mean = _of("word_chars", "n_words")
    return [
        Rule("few words", 1 / F.when(F.col("n_words") > 0, F.col("n_words")), 1 / 50, 1 / 20),
        Rule("word length", F.abs(mean - 6.5), 3.5, 5.5),
        Rule("symbols", _of("n_symbols", "n_words"), 0.03, 0.1),
        Rule("repeated lines", lines, 0.1, 0.3),
        Rule("repeated windows", _of("n_repeat_words", "n_words"), 0.1, 0.25),
        Rule("one word", F.when(F.col("n_words") >= 20, _of("n_commonest", "n_words")), 0.15, 0.3),
        Rule("few distinct", F.when(F.col("n_words").between(20, 400), 1 - _of("n_distinct", "n_words")), 0.6, 0.75),
        Rule("few letters", 1 - _of("n_letters", "word_chars"), 0.15, 0.3),
        Rule("upper case", _of("n_upper", "n_letters"), 0.15, 0.4),
        Rule("digits", _of("n_digits", "word_chars"), 0.05, 0.2),
        Rule("shouting", _of("n_shouts", "n_words"), 0.03, 0.15),
        Rule("open lines", F.when(F.col("n_lines") > 0, 1 - F.col("n_ends") / F.col("n_lines")), 0.5, 0.9),
        Rule("stutter", _of("n_stutters", "n_words"), 0.1, 0.3),
    ]


START = 0.95, 0.6
"""Chances of the vote good, for good texts and for bad ones, that the estimates start from."""


@dataclass
class Weights:
    """Of each rule that votes, the chance of the vote good: for good texts, and for bad ones."""

    prior: float
    of_good: np.ndarray
    of_bad: np.ndarray
    rounds: int

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good per row of votes of 1, -1 and 0."""
        odds = np.log(self.prior / (1 - self.prior)) + (votes == 1) @ np.log(self.of_good / self.of_bad) + (
            votes == -1) @ np.log((1 - self.of_good) / (1 - self.of_bad))
        return 1 / (1 + np.exp(-odds))


def weigh(votes: np.ndarray, count: np.ndarray, most: int = 500, close: float = 1e-10) -> Weights:
    """Expectation-maximisation on distinct rows of ``votes``, each there ``count`` times.

    It starts from rules that are right for 95 of 100 good texts and 40 of 100 bad ones. Each rule is taken to have
    voted twice more, once either way, for each kind of text, which keeps rules that seldom vote from certainty; the
    chance of the vote good is never higher for bad texts than for good ones, so good and bad can't change places.
    """
    width = votes.shape[1]
    now = Weights(0.8, np.full(width, START[0]), np.full(width, START[1]), 0)
    up, down = (votes == 1).astype(float), (votes == -1).astype(float)
    while now.rounds < most:
        good = now.posterior(votes) * count
        bad = count - good
        of_good = (good @ up + 1) / (good @ (up + down) + 2)
        of_bad = (bad @ up + 1) / (bad @ (up + down) + 2)
        of_good, of_bad = np.where(of_good < of_bad, (of_good + of_bad) / 2, of_good), np.minimum(of_bad, (of_good + of_bad) / 2)
        new = Weights(float((good.sum() + 1) / (count.sum() + 2)), of_good, of_bad, now.rounds + 1)
        moved = max(abs(new.prior - now.prior), np.abs(of_good - now.of_good).max(), np.abs(of_bad - now.of_bad).max())
        now = new
        if moved < close:
            break
    return now


def votes(about: DataFrame, by: list[Rule]) -> DataFrame:
    """``about`` with ``votes``, a sign per rule."""
    return without(about, ["votes"]).withColumn("votes", F.concat(*[r.vote() for r in by]))


_SIGN = {"+": 1, "-": -1, "0": 0}


def base_failed() -> Column:
    """Texts of under 20 words, or of which over 30 in 100 words are in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def fit(voted: DataFrame, width: int) -> Weights:
    """Weights from the votes of all documents that the base rules leave open; those of the start without any.

    What the base rules have settled needs no votes, and would pass for the one kind of bad text if it were counted.
    The driver gets a row per distinct row of votes.
    """
    open_ = voted.where(~base_failed()).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r.votes, r.n) for r in open_.collect())
    if not counts:
        return Weights(0.8, np.full(width, START[0]), np.full(width, START[1]), 0)
    return weigh(np.array([[_SIGN[s] for s in v] for v, _ in counts]), np.array([n for _, n in counts], float))


def with_verdict(voted: DataFrame, weights: Weights, threshold: float = 0.5) -> DataFrame:
    """``voted`` with ``base_failed``, ``quality`` (the posterior), and ``kept``."""
    odds = [F.lit(float(np.log(weights.prior / (1 - weights.prior))))]
    for i, (a, b) in enumerate(zip(weights.of_good.tolist(), weights.of_bad.tolist())):
        sign = F.substring("votes", i + 1, 1)
        odds.append(F.when(sign == "+", float(np.log(a / b))).when(sign == "-", float(np.log((1 - a) / (1 - b)))).otherwise(0.0))
    quality = 1 / (1 + F.exp(-reduce(Column.__add__, odds)))
    return (
        without(voted, ["base_failed", "quality", "kept"])
        .withColumn("base_failed", base_failed())
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def judge(docs: DataFrame, text: str = "text", by: list[Rule] | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with what the rules looked at, their ``votes``, ``base_failed``, ``quality`` and ``kept``.

    A null or empty text has counts of 0, fails the base rules (under 20 words) and is not kept; rules without
    anything to look at abstain. Texts of any length are read whole. Repeated rows count as often as they are
    there and are judged alike. Columns with names of the new ones give way; all others stay. An empty table gives
    no rows. The rows are written once to the shared folder, since votes are counted before they are weighed.
    """
    voted = pin(votes(described(docs, text), by or rules()))
    return with_verdict(voted, fit(voted, len(by or rules())), threshold)
