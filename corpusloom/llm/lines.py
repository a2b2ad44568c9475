"""Line dedup by an exact set-similarity join on the words of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import literal_array, packed, same, stored

PERCENT = 90
MOST_WORDS = (1 << 31) - 1
BITMAP_WORDS = 32
MOST_RANK = (1 << 15) - 1
WORD_BITS = 59
LAST = (1 << 63) - 3  # stands after all words and marks
NEAR = 16  # earlier sets with the same token that a set meets in the first round
SHARE = 1000  # a token is dealt out in parts of about one in so many of all tokens
BROADCAST_ROWS = 500_000  # keys of 24 bytes each


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def spaced(text: Column) -> Column:
    """The text with plain spaces between its words, lower-cased; translating is slow, so only a text
    that needs it is translated."""
    return F.when(text.rlike(r"[\t\x0B\f\r]"), F.translate(F.lower(text), "\t\x0b\f\r", "    ")).otherwise(F.lower(text))


def words_of(line: Column) -> Column:
    """Words of a line of a ``spaced`` text."""
    return F.array_remove(F.split(line, " ", -1), "")


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"[^ \t\x0B\f\r]")


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``_key``: rows of the same doc_id and text are one document."""
    return docs.withColumn("_key", F.xxhash64("doc_id", "text"))


def size_classes(percent: int) -> list[tuple[int, int]]:
    """Ranges of set sizes, by their first size, each with the most words by which a set of the range can
    differ from one as large or larger that is similar enough, both sides together. A set's partners lie
    in its own range and the next ones, as a range reaches at least to the size of its first set's largest partner."""
    most = lambda n: (n + 100 * n // percent) * (100 - percent) // (100 + percent)
    out, start = [], 1
    while start < MOST_WORDS:
        allowed, low, high = most(start) + most(start) // 4, start, MOST_WORDS
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if most(middle) <= allowed else (low, middle - 1)
        end = max(low, 100 * start // percent)
        out.append((start, most(end)))
        start = end + 1
    return out


def with_prefix(rows: DataFrame, percent: int) -> DataFrame:
    """The rows with ``prefix``: numbers of the parts by which a ``set`` of word numbers meets others, two lists.

    A size range in which sets differ by up to ``d`` words cuts the range of word numbers into ``d + 2``
    parts. Two similar sets differ in ``d`` parts at most, so they share one of the first ``d + 1``
    in any fixed order of the parts; here those with most words come first, as they are the rarest.
    A set that can have a partner in the range below is also cut as that range is, the second list. Ranges without
    differences need no prefix: similar sets are equal there, and equal sets are one.

    Word numbers end in 5 and the marks between parts in 0, so the sorted list of both, as text, splits at
    the marks, in time linear in the words for any number of parts; ``LAST`` keeps an empty last part.
    """
    classes = size_classes(percent)
    differing = literal_array([d for _, d in classes], "int")
    starts = literal_array([start for start, _ in classes], "int")
    rows = rows.withColumn("own", sum(((F.size("set") >= start).cast("int") for start, _ in classes[1:]), F.lit(0)))
    below = (F.col("own") > 0) & (100 * (F.get(starts, "own").cast("bigint") - 1) >= percent * F.size("set"))
    rows = rows.withColumn("below", F.when(below, F.col("own") - 1))

    def parts(d: Column) -> Column:
        mark = lambda k: F.coalesce(10 * k.cast("bigint") * F.floor(F.lit(1 << WORD_BITS) / (d + 2)), F.lit(0).cast("bigint"))
        mixed = F.sort_array(F.concat("set", F.transform(F.sequence(F.lit(1), d + 1), mark), F.array(F.lit(LAST))))
        return F.when(d > 0, F.split(mixed.cast("string"), "0, "))

    schemes = [(name, f"{name}_parts") for name in ("own", "below")]
    rows = rows.select("*", *[parts(F.get(differing, scheme)).alias(name) for scheme, name in schemes])

    def numbers(scheme: str, name: str) -> Column:
        # The fewer words, the larger; then 48 bits of what is in the part.
        rank = lambda part: F.shiftleft(F.lit(MOST_RANK).cast("bigint") - F.least(F.octet_length(part), F.lit(MOST_RANK)), 48)
        number = lambda part, k: rank(part).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.col(scheme), k, part), 16))
        first = F.slice(F.sort_array(F.transform(name, number)), F.lit(1), F.size(name) - 1)
        return F.when(F.col(name).isNotNull(), first).otherwise(F.array().cast("array<bigint>"))

    return rows.withColumn("prefix", F.array(*[numbers(*x) for x in schemes]))


def line_sets(docs: DataFrame, percent: int) -> DataFrame:
    """One row per distinct word set of a line: its digest, size, first line and prefix.

    A word is the number made of ``WORD_BITS`` bits of its hash and a 5 as last digit. ``bits`` sets one of 64 bits for each word of a set
    of up to ``BITMAP_WORDS``, and none for larger ones, which would fill them. For ``prefix`` see ``with_prefix``.
    """
    rows = _keyed(docs).select("doc_id", "_key", F.posexplode(lines_of(spaced(F.col("text")))).alias("line_no", "line")).where(~is_blank(F.col("line")))
    number = lambda w: 10 * F.shiftrightunsigned(F.xxhash64(w), 64 - WORD_BITS) + 5
    rows = rows.select("doc_id", "_key", "line_no", F.sort_array(F.array_distinct(F.transform(words_of(F.col("line")), number))).alias("set"))
    rows = with_prefix(rows, percent)
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(k, 8).bitwiseAND(F.lit(63)).cast("int"))
    bits = F.aggregate("set", F.lit(0).cast("bigint"), lambda a, k: a.bitwiseOR(one(k)))
    rows = rows.select(
        F.struct("doc_id", "_key", "line_no").alias("first"),
        F.xxhash64("set").alias("h"),
        F.xxhash64(F.lit(1), "set").alias("h2"),
        F.size("set").alias("n"),
        F.when(F.size("set") <= BITMAP_WORDS, bits).otherwise(F.lit(0).cast("bigint")).alias("bits"),
        "prefix",
    )
    # The other columns follow from the digest.
    return rows.groupBy("h", "h2").agg(F.min("first").alias("first"), *[F.first(c).alias(c) for c in ("n", "bits", "prefix")])


def _fits(percent: int) -> Column:
    """What two sets ``x`` and ``y`` that share a part can still be: by their sizes, by the parts that come
    before the first shared one, and by the bits that only one of them has."""
    nx, ny = F.col("x.n"), F.col("y.n")
    least = F.expr(f"cast(({percent}L * (x.n + y.n) + {99 + percent}) div {100 + percent} as int)")
    by_place = nx + ny - F.greatest("x.place", "y.place") >= 2 * least
    only = lambda a, b: F.bit_count(F.col(f"{a}.bits").bitwiseAND(F.bitwise_not(F.col(f"{b}.bits"))))
    by_bits = F.when((nx > BITMAP_WORDS) | (ny > BITMAP_WORDS), True).otherwise(F.least(nx - only("x", "y"), ny - only("y", "x")) >= least)
    return (100 * F.least(nx, ny).cast("bigint") >= percent * F.greatest(nx, ny)) & by_place & by_bits


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Digest of the later set of every pair that is similar enough, by the words themselves."""
    pairs = stored(pairs.distinct(), "pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(sets.select("h", "first"), "h")
    named = stored(named.select("h", "first", F.col("first.doc_id").alias("_id"), F.col("first._key").alias("_k")), "named")
    by_doc = named.groupBy("_id", "_k").agg(F.collect_list(F.struct("h", "first")).alias("asked"))
    if named.count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    texts = _keyed(docs.select("doc_id", "text")).join(by_doc, (F.col("_key") == F.col("_k")) & same(F.col("doc_id"), F.col("_id")))
    rows = texts.select(F.explode("asked").alias("q"), lines_of(spaced(F.col("text"))).alias("lines"))
    words = F.array_distinct(words_of(F.get("lines", F.col("q.first.line_no"))))
    found = stored(rows.select("q.h", "q.first", words.alias("words")).groupBy("h").agg(F.first("first").alias("first"), F.first("words").alias("words")), "words")
    a, b = found.alias("x"), found.alias("y")
    both = pairs.join(a, F.col("a") == F.col("x.h")).join(b, F.col("b") == F.col("y.h"))
    shared = F.size(F.array_intersect("x.words", "y.words"))
    alike = both.where(100 * shared >= percent * (F.size("x.words") + F.size("y.words") - shared))
    return alike.select(F.when(F.col("x.first") < F.col("y.first"), F.col("y.h")).otherwise(F.col("x.h")).alias("h")).distinct()


def _members(sets: DataFrame, tokens: DataFrame) -> DataFrame:
    """``token, members, place, h, n, bits, o`` of every set with one of the tokens in its prefix."""
    sets = sets.withColumn("o", F.coalesce("first.doc_id", F.lit(-(1 << 63))))
    keys = lambda *names: sets.select(*names, F.explode("prefix").alias("parts")).select(*names, F.posexplode("parts").alias("place", "token"))
    if tokens.count() <= BROADCAST_ROWS:
        return keys("h", "n", "bits", "o").join(F.broadcast(tokens), "token")
    # All prefixes are shuffled, so only digests move along.
    return keys("h").join(tokens, "token").join(sets.select("h", "n", "bits", "o"), "h")


def _first_round(members: DataFrame, total: int, percent: int) -> DataFrame:
    """Sets that share a token and fit, ``a`` the earlier and ``h`` the later one: every set with the
    earliest set of its token and with up to ``NEAR`` just before it. Rows with ``a`` null are those
    of tokens whose sets did not all meet that way.

    A token of many of the ``total`` is several tokens here, so no task holds all sets of a frequent one.
    """
    rows = members.withColumn("parts", F.expr(f"1 + members * {SHARE}L div {max(1, total)}L"))
    x = F.struct("h", "n", "place", "bits")
    token = Window.partitionBy("token", F.when(F.col("parts") > 1, F.pmod("h", "parts"))).orderBy("o", "h")
    rows = rows.select(
        "token",
        F.struct("o", "h", "n", "place", "bits").alias("y"),
        F.collect_list(x).over(token.rowsBetween(-NEAR, -1)).alias("near"),
        F.first(x).over(token).alias("centre"),
        ((F.col("members") > NEAR + 1) | (F.col("parts") > 1)).alias("many"),
    )
    nothing = F.array().cast("array<struct<h:bigint,n:int,place:int,bits:bigint>>")
    far = F.when((F.size("near") == NEAR) & (F.get("near", F.lit(0))["h"] != F.col("centre.h")), F.array("centre")).otherwise(nothing)
    itself = F.when(F.col("many"), F.array(F.lit(None).cast("struct<h:bigint,n:int,place:int,bits:bigint>"))).otherwise(nothing)
    met = rows.select("token", "y", F.explode(F.concat("near", far, itself)).alias("x"))
    return met.where(F.col("x").isNull() | _fits(percent)).select(F.col("x.h").alias("a"), "token", "y.*")


def kept_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, _key, kept``: for each document the numbers of its lines that no earlier line equals
    or resembles (Jaccard of the word sets of ``percent`` or more), in order; blank lines apart.

    Lines are ordered by doc_id (null first) and place. Lines of equal sets count as one set with
    the first of them, so copies never meet. Sets that share a token of their prefixes are held against
    each other: two sets alone with a token at once, more of them in two rounds. First every set meets
    the earliest set that shares the token and some just before it, which settles the members of
    large groups of near copies; then only what is still open meets all that share one of the
    larger tokens. Most tokens belong to one set, and only counts of those are shuffled.
    """
    sets = stored(line_sets(docs, percent), "sets")
    tokens = sets.select("h", F.explode(F.flatten("prefix")).alias("token")).groupBy("token")
    shared = stored(tokens.agg(F.count("*").alias("members"), F.min("h").alias("a"), F.max("h").alias("b")).where("members > 1"), "shared")
    total = sets.agg(F.sum(F.size(F.flatten("prefix")))).first()[0] or 0
    met = stored(_first_round(_members(sets, shared.where("members > 2").select("token", "members")), total, percent), "met")
    tried = met.where("a is not null").select(F.least("a", "h").alias("a"), F.greatest("a", "h").alias("b"))
    tried = tried.unionByName(shared.where("members = 2 and a < b").select("a", "b"))
    settled = stored(_verified(tried, sets, docs, percent), "settled")
    more = met.where("a is null").drop("a").join(settled.withColumn("settled", F.lit(True)), "h", "left")
    more = more.select("token", F.struct("o", "h", "n", "place", "bits", F.col("settled").isNull().alias("open")).alias("y"))
    # Two open sets meet in one direction; a settled set is only ever the earlier one. As the tests
    # stand in one expression on both, the two sides are the same rows and are shuffled once.
    meet = F.when(F.col("x.open") & F.col("y.open"), F.col("x.h") < F.col("y.h")).when(F.col("y.open"), F.col("x.o") <= F.col("y.o"))
    both = more.join(more.select("token", F.col("y").alias("x")), "token")
    pairs = both.where(meet & _fits(percent)).select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"))
    settled = settled.unionByName(_verified(pairs, sets, docs, percent)).distinct()
    left = sets.join(settled, "h", "left_anti").select("first.*")
    return left.groupBy("doc_id", "_key").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def _with_kept(docs: DataFrame, percent: int) -> DataFrame:
    """The documents as ``row`` with ``_kept``, the places of the lines that stay, blank ones apart."""
    kept = kept_lines(docs.select("doc_id", "text"), percent).withColumnRenamed("doc_id", "_id").withColumnRenamed("_key", "_k")
    kept = stored(kept, "kept")
    docs = _keyed(packed(docs, "doc_id", "text")).join(kept, (F.col("_key") == F.col("_k")) & same(F.col("doc_id"), F.col("_id")), "left")
    return docs.withColumn("_kept", F.coalesce("kept", F.array().cast("array<int>")))


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_lines, n_blank, n_kept, kept`` (line numbers from 0, joined by commas) per document.

    Defined results: a null text has no lines; blank lines stay and are not counted as kept; a
    repeated row gives the same row again, as it is the same document; other columns are not read.
    """
    counts = _keyed(docs.select("doc_id", "text")).select(
        "doc_id",
        "_key",
        F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.filter(lines_of(F.col("text")), is_blank)), F.lit(0)).cast("bigint").alias("n_blank"),
    )
    kept = kept_lines(docs, percent).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "kept")
    both = counts.join(kept, (F.col("_key") == F.col("_k")) & same(F.col("doc_id"), F.col("_id")), "left")
    n = F.when(F.col("kept").isNull(), 0).otherwise(F.size("kept")).cast("bigint")
    return both.select("doc_id", "n_lines", "n_blank", n.alias("n_kept"), F.coalesce(F.array_join("kept", ","), F.lit("")).alias("kept"))


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without the lines that repeat or resemble an earlier line.

    A document that had words and has no line with words left goes; one without words stays as it
    is. All columns stay, and the text holds the lines that are left, blank ones included.
    """
    full = _with_kept(docs, percent)
    lines = lines_of(F.col("text"))
    blanks = lambda parts: F.filter(F.transform(parts, lambda line, i: F.when(is_blank(line), i)), lambda i: i.isNotNull())
    cut = lambda parts: F.struct(
        F.size(blanks(parts)).alias("blank"),
        F.array_join(F.transform(F.sort_array(F.concat("_kept", blanks(parts))), lambda i: F.get(parts, i)), "\n").alias("text"),
        F.size(parts).alias("n"),
    )
    # The lambda binds the lines, so the text is split once.
    full = full.withColumn("_cut", F.get(F.transform(F.array(lines), cut), F.lit(0)))
    stays = F.col("text").isNull() | (F.size("_kept") > 0) | (F.col("_cut.blank") == F.col("_cut.n"))
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("_cut.text"))
    return full.where(stays).select(F.col("row").withField("text", text).alias("row")).select("row.*")
