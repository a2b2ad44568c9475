"""Prefix trie of conversations, from fingerprints that compose."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import stored

PRIME = (1 << 31) - 1
BASES = (1103515245, 1566083941, 1812433253, 747796405)  # one per lane of a fingerprint
LANES = tuple(f"x{i}" for i in range(len(BASES)))
MOST_HEAD = 3  # turns taken from the base, at most
FAMILY = 20
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1 << 16
NODE = ["depth", "fp"]


def _turn_element(reference: pa.Array, position: pa.Array) -> pa.Array:
    """Lanes of ``t * base**position`` modulo the prime, t being a lane of the turn's reference."""
    at = position.to_numpy(zero_copy_only=False).astype(np.uint64)
    words = np.stack([reference.field(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in range(2)])
    lanes = []
    for i, base in enumerate(BASES):
        value = (words[i // 2] >> np.uint64(31 * (i % 2) + 1)) % np.uint64(PRIME - 1) + np.uint64(1)
        square, rest = np.uint64(base), at.copy()
        while rest.any():
            value = np.where(rest & np.uint64(1), value * square % np.uint64(PRIME), value)
            square, rest = square * square % np.uint64(PRIME), rest >> np.uint64(1)
        lanes.append(pa.array(value.astype(np.int64)))
    return pa.StructArray.from_arrays(lanes, names=list(LANES))


def _joined(lanes: list[Column]) -> Column:
    """Four lanes as one fingerprint of two longs."""
    return F.struct((lanes[0] * (1 << 31) + lanes[1]).alias("a"), (lanes[2] * (1 << 31) + lanes[3]).alias("b"))


def turn_references(turns: DataFrame, role: str, text: str, seed: int) -> Column:
    """128 bits that stand for a turn's role and text."""
    content = F.concat(F.octet_length(role).cast("string"), F.lit(" "), F.col(role), F.col(text))
    return F.struct(F.xxhash64(F.lit(seed), content).alias("u"), F.xxhash64(content, F.lit(~seed)).alias("v"))


def ordered_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """``conv_id, ref, words, at, part``: the turns by reference, numbered from 0.

    The rows are sorted by range, so a conversation may lie in many parts; a turn's number is its
    place in its part after the turns of the parts before, and no conversation is one task's work.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    rows = rows.select("conv_id", "turn", turn_references(rows, "role", "text", seed).alias("ref"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"))
    ranged = rows.repartitionByRange(F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("ref"))
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "turns")
    here = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "ref")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    numbered = ranged.withColumn("nth", F.row_number().over(here)).join(counts, ["conv_id", "part"])
    return numbered.select("conv_id", "ref", "words", (F.col("earlier") + F.col("nth") - 1).alias("at"), "part")


def references_collide(conversations: DataFrame, seed: int) -> bool:
    """Whether two different turns have one reference."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    distinct = conversations.select(text("role"), text("text")).distinct()
    references = distinct.select(turn_references(distinct, "role", "text", seed).alias("ref"))
    return not references.groupBy("ref").count().where("count > 1").isEmpty()


def running_sums(rows: DataFrame, key: str, at: str, columns: list[str], block: int = BLOCK) -> DataFrame:
    """Sums of the columns over a key's rows up to each row, in order of the whole number ``at``; they
    replace the columns. Taken within blocks of ``at`` and then over the blocks."""
    rows = rows.withColumn("_block", F.floor(F.col(at) / block))
    within = Window.partitionBy(key, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, "_block").agg(*[F.sum(c).alias(c) for c in columns])
    blocks = blocks.select(key, "_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    rest = [c for c in rows.columns if c not in columns and c not in (key, "_block")]
    sums = rows.select(key, "_block", *rest, *[F.sum(c).over(within).alias(c) for c in columns]).join(blocks, [key, "_block"])
    return sums.select(key, *rest, *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in columns])


def rebuilt_prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, fp, up, ref, words``: each prefix of each rebuilt conversation, by fingerprint.

    A turn's element is its reference times the base to the power of its place, so the product of a
    run of turns is the sum of their elements, and that of a suffix the difference of two such sums,
    moved by a power of the base. A rebuilt prefix is the product of the base's head and of the own
    suffix: only sums are combined, no rebuilt sequence is ever made. ``up`` is the fingerprint
    before the last turn.
    """
    element = F.arrow_udf(_turn_element, ", ".join(f"{x} bigint" for x in LANES))
    own = stored(turns.withColumn("e", element(F.col("ref"), F.col("at"))).select("conv_id", "at", "ref", "words", "e.*"), "elements")
    heads = own.where(F.col("at") < MOST_HEAD).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "ref", "words", *LANES))).alias("head"))
    base, h = F.col("conv_id") - F.col("conv_id") % FAMILY, F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)
    convs = heads.select("conv_id", base.alias("base"), h.cast("int").alias("h"), F.col("head").alias("own_head"))
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast(convs.schema["head"].dataType)), F.lit(1), F.col("h")))
    convs = convs.withColumn("own_head", F.slice("own_head", F.lit(1), F.col("h")))
    total = lambda head, x, n: F.aggregate(F.slice(head, F.lit(1), n), F.lit(0).cast("bigint"), lambda s, e: (s + e[x]) % PRIME)
    whole = F.lit(MOST_HEAD)
    convs = convs.withColumn("taken", F.size("head"))
    convs = stored(convs, "heads")
    root = convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), _joined([F.lit(0).cast("bigint")] * 4).alias("fp"), F.lit(None).alias("up"), F.lit(None).alias("ref"), F.lit(0).cast("bigint").alias("words"))
    fp_at = lambda n: _joined([total("head", x, n) for x in LANES])
    from_base = convs.select("conv_id", "head", F.posexplode("head").alias("i", "turn"))
    from_base = from_base.select("conv_id", (F.col("i") + 1).cast("bigint").alias("depth"), fp_at(F.col("i") + 1).alias("fp"), fp_at(F.col("i")).alias("up"), "turn.ref", "turn.words")
    suffix = convs.select("conv_id", "h", "taken", *[total("head", x, whole).alias(f"b{x}") for x in LANES], *[total("own_head", x, whole).alias(f"o{x}") for x in LANES])
    own = own.select("*", *[F.col(x).alias(f"e{x}") for x in LANES], F.floor(F.col("at") / BLOCK).alias("block"))
    own = running_sums(own, "conv_id", "at", list(LANES))
    # A conversation's rows meet its head block by block.
    suffix = own.select("conv_id", "block").distinct().join(suffix, "conv_id")
    own = own.join(suffix, ["conv_id", "block"]).where(F.col("at") >= F.col("h"))

    def moved(x: str, i: int, without_last: bool) -> Column:
        back = pow(BASES[i], -1, PRIME)
        factor = F.element_at(F.array(*[F.lit(pow(back, k, PRIME)).cast("bigint") for k in range(MOST_HEAD + 1)]), F.col("h") - F.col("taken") + 1)
        product = F.col(x) - F.col(f"o{x}") - (F.col(f"e{x}") if without_last else F.lit(0))
        return (F.col(f"b{x}") + F.pmod(product, F.lit(PRIME)) * factor) % PRIME

    depth = F.col("at") - F.col("h") + F.col("taken") + 1
    of = lambda without_last: _joined([moved(x, i, without_last) for i, x in enumerate(LANES)])
    from_own = own.select("conv_id", depth.cast("bigint").alias("depth"), of(False).alias("fp"), of(True).alias("up"), "ref", "words")
    kind = from_own.schema
    root = root.select("conv_id", "depth", "fp", F.col("up").cast(kind["up"].dataType), F.col("ref").cast(kind["ref"].dataType), "words")
    return root.unionByName(from_base).unionByName(from_own)


def _digests(ends: DataFrame) -> DataFrame:
    """``depth, fp, digest`` of each node where conversations end: SHA-256 of their ids in order.

    Ids are joined to texts of up to ``BLOCK`` numbers each; a digest runs over these texts in order, so
    a node where a third of all conversations end holds one such text at a time.
    """
    chunk = F.floor(F.col("conv_id") / BLOCK).alias("chunk")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    texts = ends.groupBy(*NODE, chunk).agg(F.array_join(ids, ",").alias("ids"))
    dealt = texts.select("depth", "fp.a", "fp.b", "chunk", "ids").repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "chunk")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []

        def rows():
            columns = list(zip(*out)) if out else [[]] * 4
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["depth", "a", "b", "digest"])

        for batch in batches:
            for depth, a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (depth, a, b):
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows()
            out = []
        if node is not None:
            out.append((*node, state.hexdigest()))
        yield rows()

    found = dealt.mapInArrow(digest, "depth bigint, a bigint, b bigint, digest string")
    return found.select("depth", F.struct("a", "b").alias("fp"), "digest")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, ref``:
    one row per distinct prefix of the rebuilt conversations.

    A conversation c is rebuilt as the first ``crc32(c) % 4`` turns of conversation ``c - c % 20`` and
    its own turns after as many. Prefixes meet by depth and fingerprint. Equality is verified by the
    references: all of a node must have one last turn and one parent, so by induction the same
    turns, and no two distinct turns may share a reference; should either fail, other references
    are drawn. Sums over a subtree need no walk: every node belongs to its lowest member, and a
    member adds to each of its prefixes what its own nodes beyond it are worth.

    Defined results: null roles and texts are empty; null turns come first; of equal turn numbers
    the order is that of their references, equal in all conversations; repeated rows are turns of
    their own; rows without conv_id take no part; an id without rows has no turns; negative ids keep
    the sign in the remainder, as in Spark; other columns take no part; an empty table has no node.
    """
    for seed in range(8):
        if references_collide(conversations, seed):
            continue
        prefixes = stored(rebuilt_prefixes(ordered_turns(conversations, seed)), "prefixes")
        same = [F.min("ref").alias("ref"), F.max("ref").alias("ref_"), F.min("up").alias("up"), F.max("up").alias("up_")]
        nodes = prefixes.groupBy(*NODE).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.first("words").alias("words"), *same)
        nodes = stored(nodes, "nodes")
        if nodes.where("ref <> ref_ or up <> up_").isEmpty():
            break
    else:
        raise RuntimeError("turn references collide under every seed")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("fp"))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = nodes.drop("ref_", "up_").join(children, NODE, "left").na.fill(0, ["n_children"])
    nodes = stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "counted")
    worth = nodes.select(F.col("rep").alias("conv_id"), "depth", "saved", (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    ends = prefixes.groupBy("conv_id").agg(F.max("depth").alias("last"))
    along = prefixes.select("conv_id", *NODE).join(worth, ["conv_id", "depth"], "left").na.fill(0, ["saved", "leaf"])
    along = along.withColumns({"own_saved": F.col("saved"), "own_leaf": F.col("leaf"), "block": F.floor(F.col("depth") / BLOCK)})
    along = running_sums(along, "conv_id", "depth", ["saved", "leaf"])
    totals = worth.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaf"))
    totals = along.select("conv_id", "block").distinct().join(ends.join(totals, "conv_id", "left").na.fill(0, ["all_saved", "all_leaf"]), "conv_id")
    along = stored(along.join(totals, ["conv_id", "block"]), "along")
    beyond = lambda c: F.sum(F.col(f"all_{c}") - F.col(c) + F.col(f"own_{c}"))
    sums = along.groupBy(*NODE).agg(beyond("saved").alias("saved_tokens"), beyond("leaf").alias("n_leaves"))
    digests = _digests(along.where(F.col("depth") == F.col("last")).select(*NODE, "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("up"), F.col("rep").alias("parent_conv_id"))
    found = nodes.join(sums, NODE).join(digests, NODE, "left")
    found = _with_parents(found, parents)
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.lit(nothing)).alias("ends_sha256"), "ref",
    )


def _with_parents(nodes: DataFrame, parents: DataFrame, salts: int = 64) -> DataFrame:
    """A node with very many children is handed to them in ``salts`` portions."""
    salted = nodes.withColumn("_salt", F.pmod(F.xxhash64("fp"), F.lit(salts)).cast("int"))
    wanted = salted.where("depth > 0").select("depth", "up", "_salt").distinct().join(parents, ["depth", "up"])
    return salted.join(wanted, ["depth", "up", "_salt"], "left").drop("_salt")
