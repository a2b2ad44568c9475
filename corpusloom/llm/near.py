"""MinHash near-duplicate detection: SuperMinHash signatures, banding, verification, union-find."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.store import literal_array, packed, same, stored
from corpusloom.llm.words import U, byte_classes, chunks, gram_hashes, mix, word_hashes
from corpusloom.operators.ranking import top_per_group

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 5
SMALL = 16  # members up to which a bucket's pairs are listed outright
HAND = 4
EARLY = 4  # bands whose large buckets are linked first
TILE = 1 << 14
SPACE = b" \t\n\x0b\x0c\r"
PLANES = 4  # bits kept of every place of a signature
UNION_STEP, UNION_STEPS = 32, 64
SLACK = 6.0  # standard deviations by which an estimate may be too low
TALLIES, MOST_TALLY = 256, 127
BROADCAST_ROWS = 1_000_000  # shared bands of 16 bytes, or named texts of 40
SKETCH = pa.struct(
    [("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("planes", pa.list_(pa.int64())), ("tallies", pa.list_(pa.int8()))]
)


@cache
def _classes():
    return byte_classes(lambda b: b not in SPACE, lambda b: b + 32 if 65 <= b <= 90 else b)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and where each text's begin."""
    words, first = word_hashes(data, offsets, _classes())
    grams = gram_hashes(words, size)
    bounds, parts = np.zeros(len(first), np.int64), []
    for i in range(len(first) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            part = np.unique(grams[a : b - size + 1])
        elif b > a:
            part = gram_hashes(words[a:b], int(b - a)) + U(b - a)
        else:
            part = grams[:0]
        parts.append(part)
        bounds[i + 1] = bounds[i] + len(part)
    return np.concatenate(parts) if parts else grams[:0], bounds


def superminhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, size: int) -> np.ndarray:
    """SuperMinHash signatures of sets given as element hashes and the set each belongs to.

    Level j gives every element one random value in [j, j + 1) and one place, the next of the
    element's own random permutation of all places. A set is done as soon as every place holds a
    value, for later levels only bring larger ones; so large sets stop after very few levels.
    """
    out = np.full((n_sets, size), np.iinfo(np.uint64).max, U)
    flat = out.reshape(-1)
    state = mix(elements)
    permutation = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(elements), 1))
    rows = np.arange(len(elements))
    for level in range(size):
        state = mix(state + U(0x9E3779B97F4A7C15))
        pick = level + ((state >> U(33)) % U(size - level)).astype(np.int64)
        place = permutation[rows, pick]
        permutation[rows, pick] = permutation[rows, level]
        np.minimum.at(flat, owner * size + place, (U(level) << U(32)) | (state & U(0xFFFFFFFF)))
        if level + 1 < size:
            open_sets = (out >= U(level + 1) << U(32)).any(axis=1)
            keep = open_sets[owner]
            if not keep.any():
                break
            if not keep.all():
                state, owner, permutation = state[keep], owner[keep], permutation[keep]
                rows = np.arange(len(state))
    return out


def _tiles(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of sets of about ``TILE`` elements, so that their permutations stay in the cache."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + TILE, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def sketcher(size: int, bands: int, rows: int):
    """Column function: size of the shingle set, its digest, the hashes of its bands, ``PLANES`` bits of
    every place of the signature, plane by plane in words of 64 bits, and ``tallies``, how many shingles
    fall into each of ``TALLIES`` classes; null for a set with more than ``MOST_TALLY`` in one."""

    def sketch(texts: pa.Array) -> pa.Array:
        counts, keys, hashes, bits, tallies = [], [], [], [], []
        seed = mix(np.arange(1, bands + 1, dtype=U))
        for data, offsets, _ in chunks(texts):
            elements, bounds = shingle_sets(data, offsets, size)
            sizes = np.diff(bounds)
            counts.append(sizes)
            tallies += _tallies(elements, bounds)
            keys += [hashlib.blake2b(elements[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
            for a, b in _tiles(bounds):
                lo, hi = bounds[a], bounds[b]
                owner = np.repeat(np.arange(b - a), sizes[a:b])
                # A set of very many elements is taken in pieces; their minima are combined.
                signature = np.full((b - a, bands * rows), np.iinfo(np.uint64).max, U)
                for x in range(lo, hi, 8 * TILE):
                    y = min(hi, x + 8 * TILE)
                    np.minimum(signature, superminhash(elements[x:y], owner[x - lo : y - lo], b - a, bands * rows), out=signature)
                band = np.broadcast_to(seed, (b - a, bands)).copy()
                for k in range(rows):
                    band = mix(band * U(0x100000001B3) + signature[:, k::rows])
                hashes.append(band)
                few = mix(signature)[:, None, :] >> np.arange(PLANES, dtype=U)[None, :, None] & U(1)
                packed_bits = np.packbits(few.astype(np.uint8), axis=2, bitorder="little")
                whole = np.zeros((b - a, PLANES, 8 * _words(bands * rows)), np.uint8)
                whole[:, :, : packed_bits.shape[2]] = packed_bits
                bits.append(whole.reshape(-1).view(np.int64))
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        flat = np.concatenate(hashes).reshape(-1).view(np.int64) if hashes else np.zeros(0, np.int64)
        plane_words = np.concatenate(bits) if bits else np.zeros(0, np.int64)
        lists = [
            pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * width), pa.array(values))
            for width, values in ((bands, flat), (PLANES * _words(bands * rows), plane_words))
        ]
        classes = pa.array(tallies, pa.list_(pa.int8()))
        return pa.StructArray.from_arrays([pa.array(n), pa.array(keys, pa.binary()), *lists, classes], fields=list(SKETCH))

    return F.arrow_udf(sketch, "n_shingles long, set_key binary, bands array<bigint>, planes array<bigint>, tallies array<tinyint>")


def _tallies(elements: np.ndarray, bounds: np.ndarray) -> list:
    kind = (elements >> U(17)) % U(TALLIES)
    counts = (np.bincount(kind[a:b].astype(np.int64), minlength=TALLIES) for a, b in zip(bounds[:-1], bounds[1:]))
    return [c.astype(np.int8) if c.max() <= MOST_TALLY else None for c in counts]


def _can_be_alike(x: str, y: str, percent: int) -> Column:
    """Whether the tallies leave room for the least similarity. Two sets share no more shingles than the
    lower of their numbers in every class, so this rules out no link; it is open where a set has no tallies."""
    shared = F.aggregate(F.zip_with(f"{x}.tallies", f"{y}.tallies", lambda a, b: F.least(a, b)), F.lit(0), lambda s, v: s + v.cast("int"))
    either = F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")
    return F.coalesce((100 + percent) * shared >= percent * either, F.lit(True))


def _words(places: int) -> int:
    return -(-places // 64)


def variance_share(places: int, union: int) -> float:
    """Variance of a SuperMinHash estimate as a share of that of independent places, for two sets
    with so many elements together; it is well under 1 up to a few times as many as places."""
    low, total = places - 1, 0.0
    for k in range(1, places):
        total += (k / places) ** union * (((k + 1) / low) ** union + ((k - 1) / low) ** union - 2 * (k / low) ** union)
    return 1 - total * low / (union - 1)


def _may_be_alike(x: str, y: str, places: int, percent: int) -> Column:
    """Whether two sketches agree in as many places as sets of the least similarity do, less
    ``SLACK`` standard deviations; places that differ agree in ``PLANES`` bits once in 2**PLANES."""
    agree = percent / 100 + (1 - percent / 100) / (1 << PLANES)
    spread = lambda share: math.sqrt(places * agree * (1 - agree) * share)
    # The variance grows with the union; each entry holds for unions of up to UNION_STEP more.
    shares = [variance_share(places, (i + 1) * UNION_STEP) for i in range(UNION_STEPS - 1)] + [1.0]
    most = literal_array([math.floor(places * (1 - agree) + SLACK * spread(share)) for share in shares], "int")
    union = F.floor(100 * (F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")) / F.lit((100 + percent) * UNION_STEP)).cast("int")
    width, differing = _words(places), F.lit(0)
    for w in range(width):
        planes = [F.get(f"{x}.planes", F.lit(p * width + w)).bitwiseXOR(F.get(f"{y}.planes", F.lit(p * width + w))) for p in range(PLANES)]
        either = planes[0]
        for plane in planes[1:]:
            either = either.bitwiseOR(plane)
        differing = differing + F.bit_count(either)
    sizes = 100 * F.least(f"{x}.n_shingles", f"{y}.n_shingles") >= percent * F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
    close = sizes & (differing <= F.get(most, F.least(union, F.lit(UNION_STEPS - 1))))
    # The second test costs more, so it only meets pairs that pass the first.
    return F.when(close, _can_be_alike(x, y, percent)).otherwise(F.lit(False))


def word_shingles(text: str, size: int) -> set:
    """The shingle set itself, by which links are confirmed."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _confirmer(size: int, percent: int):
    def confirm(a: pa.Array, b: pa.Array) -> pa.Array:
        out, last, left = [], None, set()
        for x, y in zip(a, b):
            x, y = x.as_py(), y.as_py()
            if x != last:
                last, left = x, word_shingles(x, size)
            right = word_shingles(y, size)
            both = len(left & right)
            out.append(100 * both >= percent * (len(left) + len(right) - both) > 0)
        return pa.array(out, pa.bool_())

    return F.arrow_udf(confirm, "boolean")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a < b`` of ``a, n_a, b, n_b`` whose sizes let them be similar enough."""
    fits = rows.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return fits.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough. Only texts named by a pair move, up to
    ``BROADCAST_ROWS`` of them; beyond that all texts are shuffled to meet their names."""
    wanted = stored(pairs, "pairs")
    named = wanted.select(F.explode(F.array("a", "b")).alias("set_key")).distinct().join(nodes, "set_key")
    named = stored(named.select("set_key", F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")), "named")
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_key"))
    found = texts.join(named, "_key").where(same(F.col("doc_id"), F.col("_id")))
    found = found.groupBy("set_key").agg(F.min("text").alias("text"))
    left = found.select(F.col("set_key").alias("a"), F.col("text").alias("text_a"))
    right = found.select(F.col("set_key").alias("b"), F.col("text").alias("text_b"))
    check = _confirmer(size, percent)
    return stored(wanted.join(left, "a").join(right, "b").where(check("text_a", "text_b")).select("a", "b"), "confirmed")


def _small_pairs(buckets: DataFrame) -> DataFrame:
    """Every pair of a bucket of up to ``SMALL`` members."""
    listed = buckets.where(F.col("members") <= SMALL).groupBy("band").agg(F.sort_array(F.collect_list(F.struct("set_key", "n_shingles"))).alias("all"))
    tails = listed.select(F.posexplode("all").alias("i", "x"), "all")
    return _ends(tails.select("x", F.explode(F.slice("all", F.col("i") + 2, SMALL)).alias("y")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("x.set_key").alias("a"), F.col("x.n_shingles").alias("n_a"), F.col("y.set_key").alias("b"), F.col("y.n_shingles").alias("n_b")
    )


def _mixed(large: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows ``band, x`` of large buckets that hold several components, with the ``component`` of each
    and the bucket's largest, ``top``. Components only grow, so a bucket that is left out once never
    comes back, and each round looks at what the last has left."""
    placed = large.select("band", "x").join(labels, F.col("x.set_key") == F.col("node"), "left")
    placed = stored(placed.select("band", "x", F.coalesce("component", "x.set_key").alias("component")), "placed_members")
    parts = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
    return placed.join(largest.where("parts > 1").select("band", F.col("top.component").alias("top")), "band")


def _star_pairs(members: DataFrame, percent: int, places: int) -> DataFrame:
    """In a large bucket each member with the bucket's first and with the first of a hand of about
    ``HAND``, dealt anew in every bucket, which joins most members of a large group whichever of
    them are alike."""
    hand = F.pmod(F.xxhash64("band", "x.set_key"), F.floor(F.col("members") / HAND))
    dealt = members.select("band", "x", hand.alias("hand"))
    stars = [dealt.join(dealt.groupBy(*by).agg(F.min("x").alias("y")), by).select("x", "y") for by in (["band"], ["band", "hand"])]
    return _ends(stars[0].unionByName(stars[1]).where(_may_be_alike("x", "y", places, percent)))


def _open_pairs(mixed: DataFrame, tried: DataFrame, count: int, percent: int, places: int):
    """Pairs of large buckets that are still in different components, and the members they start from.

    Every such pair has an end outside the bucket's largest component. So ``count`` more of the
    members outside it are held against all members of other components, until none is left; only
    pairs whose signatures may be alike come out.
    """
    outside = mixed.where("component <> top").withColumn("set_key", F.col("x.set_key")).join(tried, ["band", "set_key"], "left_anti")
    pivots = stored(top_per_group(outside, ["band"], [F.col("set_key")], count), "pivots")
    ends = pivots.select(F.col("band").alias("_band"), F.col("x").alias("y"), F.col("component").alias("_other"))
    pairs = mixed.join(ends, F.col("band") == F.col("_band")).where((F.col("component") != F.col("_other")) & _may_be_alike("x", "y", places, percent))
    return _ends(pairs), pivots.select("band", "set_key")


def grouped(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_key, component_id`` for each document of ``doc_id, text``.

    ``component_key`` is the component itself (null without shingles); ``component_id`` is its lowest
    doc_id, which several components can share if doc_ids repeat or are null.

    Documents with equal shingle sets are one node. Bands of the signatures bring nodes together;
    each pair is confirmed on the full sets (``100 * both >= percent * either``) and the confirmed
    links are grouped. Buckets of up to ``SMALL`` nodes list their pairs. Larger ones, of a few bands,
    link every node with their first; then all go on with the pairs that are not yet in one
    component until none is left, so no link is lost to a large group and its pairs are not all
    listed. A bound from ``tallies`` rules out most pairs that are not alike before texts are fetched.

    Defined results: a null or blank text has no shingles, is linked with nothing and is its own
    component; fewer words than ``size`` make one shingle; repeated rows stay, each with the result
    of its text; a null doc_id is carried, and counts as a component's id only if all are null.
    What can be missed: two sets just at the threshold share no band with a probability of
    ``(1 - 0.75**5)**40``, 2 in 100,000, and less the more alike they are; in large buckets, a link
    on which alone a component hangs, whose signatures agree ``SLACK`` standard deviations less
    than expected, under 1 in a million.
    """
    sketch = sketcher(size, bands, rows)(F.col("text"))
    rows_ = docs.select("doc_id", F.xxhash64("text").alias("text_key"), sketch.alias("s"))
    sets = stored(rows_.select("doc_id", "text_key", "s.*"), "sets")
    full = sets.where("n_shingles > 0")
    firsts = full.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("min_id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "planes", "tallies")]
    )
    nodes = stored(firsts, "nodes")
    banded = nodes.select("set_key", "n_shingles", F.posexplode("bands").alias("slot", "band"))
    shared = stored(banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    # Most bands belong to one node; up to some size their rows are dropped where they are made.
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    buckets = stored(banded.join(shared, "band"), "buckets")
    large = buckets.where(F.col("members") > SMALL).join(nodes.select("set_key", "planes", "tallies"), "set_key")
    large = stored(large.select("slot", "band", "members", F.struct("set_key", "n_shingles", "planes", "tallies").alias("x")), "large")
    places = bands * rows
    # A few bands join most of a large group; what they leave apart is looked at in all bands.
    first = _small_pairs(buckets).unionByName(_star_pairs(large.where(F.col("slot") < EARLY), percent, places))
    links = _confirmed(_pairs(first, percent), nodes, docs, size, percent)
    labels = components(links)
    tried, count = large.select("band", F.col("x.set_key").alias("set_key")).where("false"), SMALL
    while True:
        large = _mixed(large, labels)
        pairs, pivots = _open_pairs(large, tried, count, percent, places)
        if pivots.isEmpty():
            break
        links = links.unionByName(_confirmed(_pairs(pairs, percent), nodes, docs, size, percent))
        labels = components(links)
        tried, count = tried.unionByName(pivots), 4 * count
    ids = nodes.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    ids = stored(ids.select("set_key", "min_id", F.coalesce("component", "set_key").alias("component")), "placed")
    lowest = ids.groupBy("component").agg(F.min("min_id").alias("component_id"))
    ids = ids.join(lowest, "component").select("set_key", F.col("component").alias("component_key"), "component_id")
    out = sets.select("doc_id", "text_key", "n_shingles", "set_key").join(ids.withColumnRenamed("set_key", "_key"), (F.col("n_shingles") > 0) & (F.col("set_key") == F.col("_key")), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component_key", component.alias("component_id"))


def near_duplicates(docs: DataFrame, **parameters: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each document; see ``grouped``."""
    found = grouped(docs, **parameters).drop("text_key", "component_key")
    return found.withColumn("kept", same(F.col("doc_id"), F.col("component_id")))


def one_per_group(docs: DataFrame, **parameters: int) -> DataFrame:
    """The documents that no document of lower doc_id resembles, directly or over others, and all
    without words. Of several rows of one doc_id in a group one stays, as does one of a group whose
    doc_ids are all null. All columns stay as they are.
    """
    found = grouped(docs, **parameters).where(same(F.col("doc_id"), F.col("component_id")))
    texts = found.where("n_shingles > 0").groupBy("component_key").agg(F.first("component_id").alias("_id"), F.min("text_key").alias("_key"))
    keepers = stored(texts.drop("component_key"), "keepers")
    rows = packed(docs, "doc_id", F.xxhash64("text").alias("text_key"), F.col("text"))
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.where(~blank).join(keepers, (F.col("text_key") == F.col("_key")) & same(F.col("doc_id"), F.col("_id")))
    first = F.row_number().over(Window.partitionBy("text_key", "doc_id").orderBy("text_key"))
    kept = kept.withColumn("_nth", first).where("_nth = 1")
    return kept.select("row.*").unionByName(rows.where(blank).select("row.*"))
