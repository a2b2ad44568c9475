"""Secret scans: patterns, and Shannon entropy in a sliding window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs that are long enough are the same matches as all runs cut down to the long ones.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_VALUE = 6
BLOCK = 256  # matches folded at a time

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Limits of the window's entropy: random strings of WINDOW characters reach them in 99 of 100 cases.
HEX_CLASS, HEX_BITS = "^[0-9A-Fa-f]+$", 2.8
ONE_CASE_CLASS, ONE_CASE_BITS = "^[a-z0-9+/_=-]+$|^[A-Z0-9+/_=-]+$", 3.3
MIXED_BITS = 3.6
# A word, also of camel case and with a short number, a short number, or up to three characters.
# Everything is possessive, so that no string of many segments is tried in many ways.
SHORT = "As|At|By|Db|Do|Id|If|In|Io|Ip|Is|It|My|No|Of|On|Or|To|Ui|Up"
PLACEHOLDER = r"(?i:[a-z0-9]*?(?:example|sample|dummy|placeholder|changeme|xxxx)[a-z0-9]*+)"
SEGMENT = rf"(?>(?:(?:(?:{SHORT})(?![a-z])|[A-Z]*+[a-z]{{2,}}+)*+[A-Z]*+|[A-Za-z])\d{{0,4}}+(?![A-Za-z0-9])|\d{{1,8}}+(?![A-Za-z0-9])|[A-Za-z0-9]{{1,3}}+(?![A-Za-z0-9])|{PLACEHOLDER})"
# Strings that are no secrets: numbers, UUIDs, and identifiers and paths, all of whose segments are
# words, short or placeholders. One segment that is none of these makes the whole a candidate.
ALLOWED = (
    r"^[0-9_/=+-]+$|^(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
    rf"|^[_/=+-]*+{SEGMENT}(?:[_/=+-]++{SEGMENT})*+[_/=+-]*+$"
)


def _spans(text: Column, pattern: str, kind: int, passes) -> Column:
    """``start, kind, end`` of the pattern's matches that pass, by their place among the pieces
    that the matches cut the text into."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("n"), passes(m).alias("ok")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    start = lambda acc, x: acc["at"] + x["gap"]
    span = lambda acc, x: F.array(F.struct(start(acc, x).alias("start"), F.lit(kind).alias("kind"), (start(acc, x) + x["n"]).alias("end")))
    walk = lambda acc, x: F.struct(
        (start(acc, x) + x["n"]).alias("at"), F.when(x["ok"], F.concat(acc["spans"], span(acc, x))).otherwise(acc["spans"]).alias("spans")
    )
    # A fold copies its array at every step, so it runs over blocks: first over each block's length,
    # then from each block's start.
    blocks = lambda all_: F.transform(F.sequence(F.lit(0), F.ceil(F.size(all_) / BLOCK).cast("int") - 1), lambda b: F.slice(all_, b * BLOCK + 1, BLOCK))
    length = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["n"])
    ends = lambda cut: F.aggregate(cut, F.array(F.lit(0)), lambda acc, block: F.concat(acc, F.array(F.element_at(acc, -1) + length(block))))
    spans_of = lambda at, block: F.aggregate(block, F.struct(at.alias("at"), none.alias("spans")), walk, lambda acc: acc["spans"])
    whole = lambda cut: F.flatten(F.zip_with(F.slice(ends(cut), F.lit(1), F.size(cut)), cut, spans_of))
    # Within a transform over one element each value is computed once and not wherever it is named.
    once = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))
    return F.when(text.rlike(pattern), once(steps, lambda all_: once(blocks(all_), whole))).otherwise(none)


def _highest_entropy(candidate: Column) -> Column:
    """The highest Shannon entropy of a window of the candidate, in bits per character.

    The fold keeps a count per character and the sum of ``c * log2(c)``; a step adds the character
    that enters the window, takes off the one that leaves it, and corrects the sum by these two.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch))
    zeros = F.array_repeat(F.lit(0), len(ALPHABET) + 1)
    state = F.struct(zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        counts = F.transform(acc["counts"], lambda c, k: c + (k == x["new"]).cast("int") - (k == x["old"]).cast("int"))
        n_new = F.get(acc["counts"], x["new"])
        n_old = F.get(acc["counts"], x["old"]) + (x["new"] == x["old"]).cast("int")
        gone = F.when(x["old"] < 0, 0.0).otherwise(F.get(weight, n_old - 1) - F.get(weight, n_old))
        total = acc["sum"] + F.get(weight, n_new + 1) - F.get(weight, n_new) + gone
        entropy = F.when(x["full"], math.log2(WINDOW) - total / WINDOW).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(acc["best"], entropy).alias("best"))

    old = lambda all_, i: F.when(i >= WINDOW, F.get(all_, i - WINDOW)).otherwise(-1)
    moves = lambda all_: F.transform(all_, lambda c, i: F.struct(c.alias("new"), old(all_, i).alias("old"), (i >= WINDOW - 1).alias("full")))
    best = lambda all_: F.aggregate(moves(all_), state, step, lambda acc: acc["best"])
    return F.get(F.transform(F.array(codes), best), F.lit(0))


def _is_secret(candidate: Column) -> Column:
    least = F.when(candidate.rlike(HEX_CLASS), HEX_BITS).when(candidate.rlike(ONE_CASE_CLASS), ONE_CASE_BITS).otherwise(MIXED_BITS)
    # A sum of many steps may be off in its last digits.
    return F.when(candidate.rlike(ALLOWED), F.lit(False)).otherwise(F.round(_highest_entropy(candidate), 9) >= least)


def find_secrets(docs: DataFrame) -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of ``start, kind, end`` in code points (end
    exclusive, kind as a place in ``KINDS``), by start, then kind.

    ``base`` are the matches of the three patterns. ``spans`` holds them and all further strings of
    ``WINDOW`` or more characters of the alphabet with a window whose entropy reaches the limit of
    their character class, unless the allow-list suppresses them or a base span overlaps them.
    A null text is empty and holds nothing. Columns of these names are replaced. One narrow stage.
    """
    text = F.coalesce("text", F.lit(""))
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_VALUE
    always = lambda m: F.lit(True)
    base = F.sort_array(F.concat(_spans(text, ASSIGN, 0, value), _spans(text, ACCESS, 1, always), _spans(text, HEX, 2, always)))
    docs = docs.withColumn("base", base)
    more = _spans(text, CANDIDATE, 3, _is_secret)
    apart = F.filter(more, lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return docs.withColumn("spans", F.sort_array(F.concat("base", apart)))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
