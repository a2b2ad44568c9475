"""Language identification by cross-parsing entropy."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import packed
from corpusloom.llm.words import chunks
from corpusloom.operators.ranking import top_per_group

ROWS_PER_LANGUAGE, CHARS_PER_ROW = 48, 500  # the bound of the labelled sample
BLOCK = 1024  # bytes after which a phrase ends in any case
LEAST_MATCH = 2.0  # bytes per phrase under which a text is in none of the languages
UNKNOWN, PAD = 0, 1
GAP = 32


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for measuring; a null doc_id is neither held out nor learned from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def labelled_sample(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE, chars: int = CHARS_PER_ROW) -> list[tuple[str, str]]:
    """Up to ``rows`` distinct labelled texts per language, cut to ``chars``: those of the lowest
    text hash, chosen among all labelled documents that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    hashed = usable.select("lang", F.xxhash64("text").alias("h"))
    chosen = top_per_group(hashed.distinct(), ["lang"], [F.col("h")], rows)
    texts = usable.select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, chars).alias("text"))
    # The chosen are ``rows`` per language.
    found = texts.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    parts = found.groupBy("lang").agg(F.array_join(F.sort_array(F.collect_list("text")), "\n").alias("text"))
    return sorted((r.lang, r.text) for r in parts.collect())


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with letters in lower case and every run of other ASCII characters as one gap; each
    text ends in a gap."""
    upper = (data >= 65) & (data <= 90)
    ascii_letter = upper | ((data >= 97) & (data <= 122))
    out = np.where(upper, data + 32, data)
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    accented = after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out = np.where(accented, out + 32, out).astype(np.uint8)
    gap = (data < 128) & ~ascii_letter
    out[gap] = GAP
    keep = np.ones(len(data), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of a sequence; 0 is its root."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


@lru_cache(maxsize=4)
def _model(sample: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte codes, one table of all languages' automata, their fresh states, and bits per phrase.

    The fresh state is where a phrase is yet to begin. A table entry is twice the next state's row
    (times the number of codes), plus one if the step began a new phrase.
    """
    texts = []
    for _, text in sample:
        data = np.frombuffer(text.encode(), np.uint8)
        texts.append(normalised(data, np.array([0, len(data)]))[0])
    seen = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint8)
    codes = np.zeros(256, np.int64)
    codes[seen] = np.arange(2, len(seen) + 2)
    width = len(seen) + 2
    tables, fresh, bits, base = [], [], [], 0
    for text in texts:
        step = suffix_automaton(codes[text].tolist())
        n = len(step)
        table = np.zeros((n + 1, width), np.int64)
        root = np.full(width, 2 * (base + n) * width + 1)
        for c, to in step[0].items():
            root[c] = 2 * (base + to) * width + 1
        table[:] = root
        for s, moves in enumerate(step):
            for c, to in moves.items():
                table[s, c] = 2 * (base + to) * width
        table[:, PAD] = 2 * (base + np.arange(n + 1)) * width
        tables.append(table)
        fresh.append((base + n) * width)
        bits.append(math.log2(len(text) + 1))
        base += n + 1
    flat = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int64)
    return codes, flat.astype(np.int32) if not len(flat) or flat.max() < 1 << 31 else flat, np.array(fresh), np.array(bits)


def phrase_counts(data: np.ndarray, offsets: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of every text in every language (texts by languages), and the texts' bytes.

    A phrase is the longest match in the language's text from where the last one ended, so each
    step of the automata either goes on with a phrase or begins one. Texts are cut to blocks that
    are parsed side by side, one byte of all blocks and all languages at a time.
    """
    codes, table, fresh, _ = model
    body, bounds = normalised(data, offsets)
    sizes = np.diff(bounds)
    blocks = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = bounds[text] + nth * BLOCK
    size = np.minimum(BLOCK, bounds[text + 1] - start)
    order = np.argsort(-size, kind="stable")
    start, size, owner = start[order], size[order], text[order]
    body = np.append(codes[body], PAD).astype(table.dtype)
    counts = np.zeros((len(fresh), len(start)), np.int32)
    state = np.repeat(fresh[:, None], len(start), axis=1).astype(table.dtype)
    width = np.searchsorted(-size, -np.arange(BLOCK), "left")  # blocks longer than the place
    for k in range(int(size[0]) if len(size) else 0):
        n = width[k]
        step = table.take(state[:, :n] + body[start[:n] + k])
        counts[:, :n] += step & 1
        state[:, :n] = step >> 1
    out = np.zeros((len(sizes), len(fresh)), np.int64)
    np.add.at(out, owner, counts.T)
    return out, sizes


def identifier(sample: list[tuple[str, str]]):
    """Column function: the language, the score and the bytes per phrase of a text."""
    sample = tuple(sample)
    names = [lang for lang, _ in sample]
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("match_bytes", pa.float64())])

    def identify(texts: pa.Array) -> pa.Array:
        model, langs, scores, matches = _model(sample), [], [], []
        for data, offsets, _ in chunks(texts):
            counts, sizes = phrase_counts(data, offsets, model)
            if not names:
                counts = np.ones((len(sizes), 1), np.int64)
            cost = counts * model[3] if names else counts.astype(float)
            best = np.argmin(cost, axis=1)
            rows = np.arange(len(sizes))
            low = cost[rows, best]
            cost[rows, best] = np.inf
            second = cost.min(axis=1)
            scores.append(np.where(np.isfinite(second) & (second > 0), 1 - low / np.where(second > 0, second, 1), 1.0 if len(names) == 1 else 0.0))
            langs += [names[k] for k in best] if names else ["und"] * len(sizes)
            matches.append(sizes / np.maximum(1, counts[rows, best]))
        flat = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), flat(scores), flat(matches)], fields=list(kind))

    return F.arrow_udf(identify, "lang_pred string, score double, match_bytes double")


def with_language(docs: DataFrame, sample: list[tuple[str, str]], least_match: float = LEAST_MATCH) -> DataFrame:
    """The documents with ``lang_pred, score, in_language``; only the text decides.

    The text is parsed into longest matches with each language's sample; the language whose parse
    takes the fewest phrases, each weighed by the bits of a pointer into its sample, wins, ties by
    name. The score is what the runner-up would cost more, as a share of it. Defined results: a
    null text and one without letters is ``und`` with score 0; one learned language scores 1;
    without any, all is ``und``. ``in_language`` is false for ``und`` and for texts of under
    ``least_match`` bytes per phrase, which are in none of the languages.
    """
    found = docs.withColumn("_found", identifier(sample)(F.col("text")))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(sample))
    found = found.withColumn("lang_pred", F.when(letters, F.col("_found.lang_pred")).otherwise("und"))
    found = found.withColumn("score", F.when(letters, F.col("_found.score")).otherwise(0.0))
    return found.withColumn("in_language", letters & (F.col("_found.match_bytes") >= least_match)).drop("_found")


def predict_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learned from the others."""
    found = with_language(docs.select("doc_id", "text"), labelled_sample(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "in_language")


def in_known_language(docs: DataFrame) -> DataFrame:
    """The documents whose text is in one of the labelled languages; all columns stay as they are."""
    return with_language(packed(docs, "text"), labelled_sample(docs)).where("in_language").select("row.*")
