"""Phrases whose words occur together more often than apart, from weighted automata of n-grams."""

from __future__ import annotations

import re
import struct
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import stored
from corpusloom.operators.ranking import top_per_group

LONGEST = 5  # words of a phrase
BLOCK_WORDS = 1 << 20  # words a task turns into automata at a time
SLICE_BYTES = 1 << 20  # text cut into words at a time
RANGE_BYTES = 8 << 20  # text per prefix range, about
MOST_RANGES = 1 << 16
SAMPLE_ROWS, SAMPLE_CHARS = 4096, 512  # the sample that places the ranges; it has no part in any count
SALTS = 64
GAP = re.compile(rb"[ \n]")
BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(10 if b in BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and breaks of a text, about ``SLICE_BYTES`` of it at a time."""
    text, at = text.translate(FOLD), 0
    while at < len(text):
        to = min(len(text), at + SLICE_BYTES)
        if to < len(text):
            gap = GAP.search(text, to)
            to = gap.start() if gap else len(text)
        yield [t for t in text[at:to].replace(b"\n", b" \n ").split(b" ") if t]
        at = to


def _order(columns: list[np.ndarray], n_words: int) -> np.ndarray:
    """Positions that sort windows, several labels to a key."""
    bits = max(1, int(n_words).bit_length())
    per, keys = max(1, 63 // bits), []
    for i in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), np.int64)
        for column in columns[i : i + per]:
            key <<= bits
            key |= column
        keys.append(key)
    return np.lexsort(keys[::-1])


def _changes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Per depth, the rows of sorted windows where a state of that depth begins."""
    out, new = [], np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new = new.copy()
        new[1:] |= column[1:] != column[:-1]
        out.append(new)
    return out


class Automaton:
    """A weighted acyclic automaton of windows of ``LONGEST`` words, kept level by level.

    ``words`` are the labels in byte order, from 1; label 0 ends a path early. A state is known by
    its place in its level; the weight of a path is the number of windows that follow it, so the
    weight of a state at depth d is how often its first d words occur.
    """

    def __init__(self, words: list[bytes], columns: list[np.ndarray], weights: np.ndarray):
        self.words, self.columns, self.weights = words, columns, weights

    @classmethod
    def build(cls, words: list[bytes], columns: list[np.ndarray], weights: np.ndarray) -> Automaton:
        """From windows in any order: sorted, and equal ones added up as they meet."""
        order = _order(columns, len(words))
        columns, weights = [c[order] for c in columns], weights[order]
        first = np.flatnonzero(_changes(columns)[-1])
        return cls(words, [c[first] for c in columns], np.add.reduceat(weights, first) if len(first) else weights)

    def part(self, a: int, b: int) -> Automaton:
        """The paths from ``a`` to ``b``, with their own words only."""
        columns = [c[a:b] for c in self.columns]
        used = np.unique(np.concatenate([[0], *columns]))
        return Automaton([self.words[i - 1] for i in used[1:]], [np.searchsorted(used, c).astype(np.int32) for c in columns], self.weights[a:b])

    def place(self, window: tuple[bytes, ...]) -> int:
        """How many paths come before the window."""
        a, b = 0, len(self.weights)
        for column, word in zip(self.columns, window):
            at = bisect_left(self.words, word)
            known = at < len(self.words) and self.words[at] == word
            low = a + int(np.searchsorted(column[a:b], at + 1, "left"))
            if not known:
                return low
            a, b = low, a + int(np.searchsorted(column[a:b], at + 1, "right"))
        return a

    def states(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the states of a depth begin, and their weights."""
        first = np.flatnonzero(_changes(self.columns[:depth])[-1])
        return first, np.add.reduceat(self.weights, first)

    def pack(self) -> bytes:
        """Labels of every state, which of them are first children, weights of the paths."""
        small = lambda a: a.astype(np.min_scalar_type(int(a.max(initial=0))))
        parts, above = [b" ".join(self.words)], None
        for column, new in zip(self.columns, _changes(self.columns)):
            label = small(column[new])
            opens = np.packbits(above[new]) if above is not None else np.zeros(0, np.uint8)
            parts += [struct.pack("<QB", len(label), label.itemsize), label.tobytes(), opens.tobytes()]
            above = new
        weights = small(self.weights)
        parts += [struct.pack("<QB", len(weights), weights.itemsize), weights.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join([struct.pack("<Q", len(p)) + p for p in parts]))

    @classmethod
    def unpack(cls, data: bytes) -> Automaton:
        data, parts, at = zstandard.ZstdDecompressor().decompress(data), [], 0
        while at < len(data):
            (n,) = struct.unpack_from("<Q", data, at)
            parts.append(data[at + 8 : at + 8 + n])
            at += 8 + n
        array = lambda head, body: np.frombuffer(body, f"<u{struct.unpack('<QB', head)[1]}")
        labels = [array(parts[i], parts[i + 1]).astype(np.int32) for i in range(1, 1 + 3 * LONGEST, 3)]
        opens = [np.unpackbits(np.frombuffer(parts[i + 2], np.uint8), count=len(labels[k])) for k, i in enumerate(range(1, 1 + 3 * LONGEST, 3)) if k]
        columns, state = [labels[-1]], np.arange(len(labels[-1]))
        for depth in range(LONGEST - 2, -1, -1):
            state = (np.cumsum(opens[depth], dtype=np.int64) - 1)[state]
            columns.insert(0, labels[depth][state])
        return cls(parts[0].split(b" ") if parts[0] else [], columns, array(parts[-2], parts[-1]).astype(np.int64))


class _Shard:
    """Words of one language as they come in, and their windows."""

    def __init__(self, carried: list[bytes] = ()):
        self.ids, self.size = [], 0
        self.vocabulary = defaultdict(count(1).__next__, {b"\n": 0})
        self.add(list(carried))

    def add(self, tokens: list[bytes]) -> None:
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def windows(self, last: bool) -> tuple[Automaton, list[bytes]]:
        """The automaton of all windows, and the words that the next one begins with: windows that
        may reach beyond what is here are left to it, unless this is the last."""
        ids = np.concatenate(self.ids)
        names = list(self.vocabulary)
        words = sorted(names[1:])
        rank = np.zeros(len(names), np.int32)
        places = {w: i + 1 for i, w in enumerate(words)}
        rank[1:] = np.fromiter((places[w] for w in names[1:]), np.int32, len(words))
        starts = len(ids) if last else max(0, len(ids) - LONGEST + 1)
        labels = np.concatenate([rank[ids], np.zeros(LONGEST, np.int32)])
        at = np.flatnonzero(labels[:starts])
        columns = [labels[at]]
        for k in range(1, LONGEST):
            columns.append(np.where(columns[-1] > 0, labels[at + k], 0))
        return Automaton.build(words, columns, np.ones(len(at), np.int64)), [names[i] for i in ids[starts:]]


def _range_starts(docs: DataFrame, n_rows: int, n_ranges: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Windows that cut the sorted windows of all languages into ranges of like size."""
    if n_ranges < 2:
        return []
    long = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))
    piece = F.substr("text", (F.pmod(F.xxhash64("text"), long) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    # About SAMPLE_ROWS rows, whatever the number of tasks.
    rows = docs.where(F.rand(0) < SAMPLE_ROWS / n_rows).select("lang", piece.alias("text")).collect()
    found = []
    for row in rows:
        tokens = [t for part in _tokens(row.text.encode("utf-8", "replace")) for t in part]
        for i in range(len(tokens)):
            window = tokens[i : i + LONGEST]
            window = window[: window.index(b"\n")] if b"\n" in window else window
            if window:
                found.append((row.lang, tuple(window)))
    found.sort()
    return sorted({found[len(found) * i // n_ranges] for i in range(1, n_ranges)}) if found else []


def shard_automata(docs: DataFrame, starts: list, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``lang, range, automaton``: the n-grams of every shard, cut at the prefix ranges.

    A shard is what a task reads, ``block_words`` at a time; the last words of one block begin the
    next, so every window is counted once and a text may be of any length.
    """
    names = ["lang", "range", "automaton"]
    numbers = {}
    for i, (lang, window) in enumerate(starts):
        numbers.setdefault(lang, []).append((i + 1, window))
    langs = sorted(numbers)
    before = lambda lang: max((numbers[x][-1][0] for x in langs if x < lang), default=0)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}

        def flush(last):
            for lang, shard in list(shards.items()):
                automaton, rest = shard.windows(last)
                shards[lang] = _Shard(rest)
                cuts = [(before(lang), 0)] + [(i, automaton.place(w)) for i, w in numbers.get(lang, [])]
                out = []
                for (number, a), (_, b) in zip(cuts, [*cuts[1:], (0, len(automaton.weights))]):
                    if a < b:
                        out.append((lang, number, automaton.part(a, b).pack()))
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary()))], names=names)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1).view(pa.binary())):
                if (lang := lang.as_py()) not in shards:
                    shards[lang] = _Shard()
                for tokens in _tokens(text.as_py() + b"\n"):
                    shards[lang].add(tokens)
                    if sum(s.size for s in shards.values()) >= block_words:
                        yield from flush(False)
        yield from flush(True)

    return docs.mapInArrow(build, "lang string, range int, automaton binary")


def _union(least: int, most_windows: int = 2 * BLOCK_WORDS):
    """The automata of a range, united with their weights added up, to its phrases and counts.

    A phrase on the first or last path may go on in a neighbouring range, so it is handed on
    whatever its weight. Phrase "" is the start state: its weight is the number of windows.
    """
    names = ["lang", "n_words", "phrase", "f"]

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def merged() -> Automaton:
            vocabulary = {w: 0 for a in held for w in a.words}
            words = sorted(vocabulary)
            vocabulary.update((w, i + 1) for i, w in enumerate(words))
            maps = [np.array([0, *(vocabulary[w] for w in a.words)], np.int32) for a in held]
            columns = [np.concatenate([m[a.columns[k]] for m, a in zip(maps, held)]) for k in range(LONGEST)]
            return Automaton.build(words, columns, np.concatenate([a.weights for a in held]))

        def phrases():
            whole = merged()
            rows = {"n_words": [np.zeros(1, np.int64)], "phrase": [b""], "f": [whole.weights.sum(keepdims=True)]}
            for depth in range(1, LONGEST + 1):
                first, weights = whole.states(depth)
                wanted = weights >= least
                wanted[[0, -1]] = True
                wanted &= whole.columns[depth - 1][first] > 0
                at = first[wanted]
                rows["n_words"].append(np.full(len(at), depth))
                rows["f"].append(weights[wanted])
                rows["phrase"] += [b" ".join(whole.words[i - 1] for i in path) for path in zip(*(c[at].tolist() for c in whole.columns[:depth]))]
            n = len(rows["phrase"])
            phrase = pa.array(rows["phrase"], pa.binary()).view(pa.string())
            yield pa.record_batch([pa.array([key[0]] * n), pa.array(np.concatenate(rows["n_words"]), pa.int32()), phrase, pa.array(np.concatenate(rows["f"]))], names=names)

        for batch in batches:
            for lang, number, data in zip(*(c.to_pylist() for c in batch.columns)):
                if key is not None and key != (lang, number):
                    yield from phrases()
                    held, size = [], 0
                key = (lang, number)
                held.append(Automaton.unpack(data))
                size += len(held[-1].weights)
                if size > most_windows and len(held) > 1:
                    held = [merged()]
                    size = min(len(held[0].weights), most_windows)
        if key is not None:
            yield from phrases()

    return union


def phrase_counts(docs: DataFrame, least: int, range_bytes: int = RANGE_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``lang, n_words, phrase, f``: every phrase of up to ``LONGEST`` words that occurs ``least`` times
    or more in the pieces of a language, and, as phrase "", the number of its words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    docs = docs.select(lang, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n_rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text").cast("bigint"))).first()
    starts = _range_starts(docs, n_rows, min(MOST_RANGES, -(-(size or 0) // range_bytes)))
    automata = shard_automata(docs, starts, block_words)
    dealt = automata.repartitionById(len(starts) + 1, F.col("range")).sortWithinPartitions("range", "lang")
    found = dealt.mapInArrow(_union(least), "lang string, n_words int, phrase string, f bigint")
    counts = stored(found, "phrases").groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f"))
    return stored(counts.where((F.col("f") >= least) | (F.col("n_words") == 0)), "counts")


def _composed(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """The requests ``lang, part, ...`` with the weight ``f`` of their part.

    The composition of two weighted relations: candidate to part, part to count. A part wanted by
    a great many candidates is dealt into ``SALTS`` portions, each with a row of the counts.
    """
    salted = requests.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    wanted = salted.select("lang", "part", "_salt").distinct()
    weights = wanted.join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    return salted.join(weights, ["lang", "part", "_salt"]).drop("_salt")


def collocations(docs: DataFrame, least: int = 100, percent: int = 100, top: int = 2000, **sizes) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts are cut into pieces at punctuation and line ends, pieces into words at blanks. A phrase of 2
    to ``LONGEST`` words with ``a >= least`` occurrences is a candidate; cut after its first k words
    it scores ``floor(1000 * a * n / (l * r))`` by the counts of its parts and of all words, and its
    lowest cut counts. Candidates within a longer one that has at least ``percent`` of their
    occurrences are dropped; a longer one by one word decides, as those between have no fewer.

    Shards are turned into weighted automata, cut at prefix ranges, and united per range; only
    phrases frequent enough leave a range. ``sizes``: ``range_bytes``, ``block_words``.

    Defined results: null texts are empty, a null language is "und"; a phrase or word may be of any
    length; repeated rows count as often as they are there; ties of score go to more occurrences,
    then to the lower phrase in byte order; other columns take no part; no words, no rows.
    """
    counts = phrase_counts(docs, least, **sizes)
    candidates = counts.where("n_words >= 2").select("lang", "phrase", "n_words", F.col("f").alias("a"))
    words, k = F.split("phrase", " "), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "n_words", "a", words.alias("words"), k)
    join = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    side = lambda name, part, size: F.struct(F.lit(name).alias("side"), part.alias("part"), size.alias("size"))
    left = side("l", join(F.lit(1), F.col("k")), F.col("k"))
    right = side("r", join(F.col("k") + 1, F.col("n_words") - F.col("k")), F.col("n_words") - F.col("k"))
    requests = cuts.select("lang", "phrase", "n_words", "a", "k", F.explode(F.array(left, right)).alias("s")).select("lang", "phrase", "n_words", "a", "k", "s.*")
    totals = candidates.select("lang", "phrase", "n_words", "a", F.lit(0).alias("k"), F.lit("n").alias("side"), F.lit("").alias("part"), F.lit(0).alias("size"))
    weighed = stored(_composed(requests.unionByName(totals), counts), "parts")
    inner = weighed.where((F.col("size") == F.col("n_words") - 1) & (F.col("size") >= 2) & (F.col("a") * 100 >= F.col("f") * percent))
    inner = inner.select("lang", F.col("part").alias("phrase")).distinct()
    of = lambda name: F.max(F.when(F.col("side") == name, F.col("f")))
    per_cut = weighed.where("side <> 'n'").groupBy("lang", "phrase", "a", "k").agg(of("l").alias("l"), of("r").alias("r"))
    total = weighed.where("side = 'n'").select("lang", "phrase", F.col("f").alias("n"))
    # 16 digits each, so the products stay within the 38 of a decimal.
    exact = lambda c: f"cast({c} as decimal(16,0))"
    score = F.expr(f"({exact('a')} * {exact('n')} * cast(1000 as decimal(4,0))) div ({exact('l')} * {exact('r')})")
    scored = per_cut.join(total, ["lang", "phrase"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.join(inner, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = top_per_group(best, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, rank="rank")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
