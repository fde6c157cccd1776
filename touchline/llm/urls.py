"""URL filters by Bloom filter cascades, on DataFrame functions alone.

A cascade tells exactly whether a key is listed, for all keys of a corpus. Its first level holds the
listed keys, the second those keys of the corpus that the first wrongly passes, the third those listed
keys that the second wrongly passes, and so on until a level passes none wrongly. The first level that
lacks a key decides: an even number of levels passed means not listed. The corpus meets no join, only
bits in literals whose size follows the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.session import pin

BITS = 12
"""Bits per key of a level, at least; the number of levels falls as it grows."""
HASHES = 6
LEVELS = 40
_BYTE = 8


def _positions(key: Column, size: int, level: int) -> list[Column]:
    """Bits of a key in a level of ``size`` bits; each level hashes with a salt of its own."""
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(size)) for i in range(HASHES)]


def _bits(keys: DataFrame, level: int) -> bytes | None:
    """A level that holds all ``keys``; None for no keys. It has ``BITS`` to ``2 * BITS`` bits a key."""
    count = keys.count()
    if not count:
        return None
    size = _BYTE << max(0, (count * BITS - 1) // _BYTE).bit_length()
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), size, level))).alias("at"))
    one = F.expr("shiftleft(1, int(at % 8))")
    set_bits = at.groupBy(F.expr("at div 8").alias("id")).agg(F.bit_or(one).alias("byte"))
    every = keys.sparkSession.range(size // _BYTE).join(set_bits, "id", "left")
    digits = F.lpad(F.hex(F.coalesce("byte", F.lit(0))), 2, "0")
    sorted_bytes = F.sort_array(F.collect_list(F.struct("id", digits.alias("digits"))))
    whole = every.agg(F.unhex(F.array_join(F.transform(sorted_bytes, lambda x: x["digits"]), "")).alias("bits"))
    return bytes(whole.first()["bits"])  # as large as the listed keys need


def _passes(key: Column, bits: bytes, level: int) -> Column:
    held = F.lit(bytearray(bits))
    out = F.lit(True)
    for at in _positions(key, len(bits) * _BYTE, level):
        byte = F.conv(F.hex(F.substring(held, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        out &= F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1
    return out


class Cascade:
    """The levels, as the bits of each. Build it with ``build``."""

    def __init__(self, levels: list[bytes]):
        self.levels = levels

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed; false for a null."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(_passes(key, self.levels[i], i), out).otherwise(F.lit(i % 2 == 1))
        return F.when(key.isNull(), F.lit(False)).otherwise(out)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade for the keys of ``listed``, exact for those of ``universe``; both have one column ``key``.

    Nulls and repeated keys count for nothing. ``universe`` is read once; from it only the keys that
    the first level wrongly passes are kept, in a table of the shared folder.
    """
    inside = pin(listed.where("key IS NOT NULL").distinct())
    levels: list[bytes] = []
    first = _bits(inside, 0)
    if first is None:
        return Cascade([])
    levels.append(first)
    wrong = universe.where(_passes(F.col("key"), first, 0)).distinct().join(inside, "key", "left_anti")
    now, before = pin(wrong), inside
    while (bits := _bits(now, len(levels))) is not None:
        if len(levels) > LEVELS:
            raise RuntimeError("the levels do not shrink; raise BITS")
        level = len(levels)
        levels.append(bits)
        now, before = pin(before.where(_passes(F.col("key"), bits, level))), now
    return Cascade(levels)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without ``://``."""
    part = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(part, upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host_: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host_, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _candidates(host_: Column, path_: Column, lengths: list[int]) -> Column:
    """Every rule that could fit, longest first: each suffix of the host at a dot, each beginning of the path."""
    starts = F.array_compact(F.array(*[
        F.when(F.length(path_) >= n, F.substring(path_, 1, n)) for n in lengths
    ])) if lengths else F.array().cast("array<string>")
    both = F.flatten(F.transform(_suffixes(host_), lambda s: F.transform(starts, lambda p: F.struct(
        (-F.length(s) - F.length(p)).alias("a"), (-F.length(s)).alias("b"), F.concat(s, p).alias("key"),
    ))))
    return F.transform(F.array_sort(both), lambda x: x["key"])


def judge(
    pages: DataFrame, rules: DataFrame, hosts: DataFrame | None = None, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each row's url.

    ``rules`` has ``host``, ``path`` and ``verdict``, ``allow`` or ``block``; a rule is written as host
    and path together. It fits its host and all subdomains where the url's path starts with its own; the
    longest that fits decides, of equally long ones that of the longer host, and of a rule listed under
    both verdicts ``block``. Where the cascades say that no rule fits, ``rule`` is null and the verdict is
    ``block`` if the url's host or a domain above it is one of ``hosts`` (column ``host``), by a cascade
    too, else ``default``. A null url, or one without ``://``, has an empty host and path and
    fits no rule with a host. Columns of these names in ``pages`` give way; repeated rows stay.
    """
    named = ("host", "path", "rule", "verdict")
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    # One number per length of a rule's path.
    lengths = sorted(r[0] for r in known.select(F.length("path")).distinct().collect())
    keys = _candidates(host(F.col(url)), path(F.col(url)), lengths)
    universe = pages.select(F.explode(keys).alias("key"))
    listed = {
        v: build(known.where(F.col("verdict") == v).select(F.concat("host", "path").alias("key")), universe)
        for v in ("block", "allow")
    }
    above = build(
        hosts.select(F.col("host").alias("key")),
        pages.select(F.explode(_suffixes(host(F.col(url)))).alias("key")),
    ) if hosts is not None else Cascade([])
    kept = pages.select(*[pages[f"`{c}`"] for c in pages.columns if c.lower() not in named])
    found = kept.withColumn("host", host(F.col(f"`{url}`"))).withColumn("path", path(F.col(f"`{url}`")))
    fits = F.filter(
        _candidates(F.col("host"), F.col("path"), lengths),
        lambda k: listed["block"].has(k) | listed["allow"].has(k),
    )
    found = found.withColumn("rule", F.get(fits, F.lit(0)))
    verdict = F.when(listed["block"].has(F.col("rule")), "block").when(listed["allow"].has(F.col("rule")), "allow")
    method = F.when(F.exists(_suffixes(F.col("host")), above.has), "block").otherwise(default)
    return found.withColumn("verdict", F.coalesce(verdict, method))
