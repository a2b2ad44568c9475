"""The operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.bpe import Tokenizer, encode_documents, fold_merges, merge, rank_map, read_ranks
from corpusloom.llm.counts import scan_separators, write_token_files
from corpusloom.llm.language import LEAST_MATCH, in_known_language, labelled_sample, phrase_counts, predict_languages, suffix_automaton, _model
from corpusloom.llm.leaks import benchmark_matches, tiles, without_leaks
from corpusloom.llm.licenses import KNOWN, find_licenses
from corpusloom.llm import lines, near
from corpusloom.llm.lines import line_report, without_repeated_lines
from corpusloom.llm.near import near_duplicates, one_per_group, superminhash
from corpusloom.llm.queries import QUERIES, public_ranks
from corpusloom.llm.secrets import find_secrets, joined
from corpusloom.llm.shuffle import communication_matrix, shuffled
from corpusloom.llm.store import stored
from corpusloom.llm.topk import top_k

SCHEMA = "doc_id long, text string, row string, _key string, kept string"
EDGE = [None, "", " \t\n ", "one", "x " * 3000, "\x1c …", "a\r\nb\n\na"]


def frame(spark, texts):
    """With columns whose names the operators use inside; the last row is there twice."""
    rows = [(i, t, "r", "k", str(i)) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1]], SCHEMA).repartition(3)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("of the and to in it was for with on".split()) + rng.choice("abcdefgh") for _ in range(n))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.integers(-3, 4, 4) / 8 for i in range(60)}
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    bad = [(100, None), (120, []), (140, [1.0, None, 0.0, 0.0]), (160, [float("nan")] * 4), (None, [1.0] * 4), (180, [float("inf")] * 4)]
    twice = [rows[0], (7, rows[8][1]), rows[7]]
    df = spark.createDataFrame([(*r, "c", 1.0) for r in [*rows, *twice, *bad]], "vec_id long, embedding array<float>, vector string, score double")
    expected = []
    for q in (0, 20, 40):
        held = [*vectors.items(), (0, vectors[0]), (7, vectors[8]), (7, vectors[7])]
        scores = sorted((-int(np.floor(64 * vectors[q]) @ np.floor(64 * v)), i) for i, v in held if i != q)
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    for tile in (7, 1000):
        got = top_k(df, df.where("vec_id % 20 = 0"), 5, tile_rows=tile)
        assert sorted(tuple(r) for r in got.collect()) == expected
    few = spark.createDataFrame([(0, [1e30, 0.0]), (1, [1e30, 1.0]), (2, [3e4, 7.0])], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.score for r in top_k(few, few.where("vec_id = 0"), 5).collect()}
    assert got == {1: 2**63 - 1, 2: min(2**63 - 1, int(64 * float(np.float32(1e30))) * int(64 * float(np.float32(3e4))))}
    assert top_k(df.where("false"), df.where("false"), 5).count() == 0
    again = spark.createDataFrame([(5, [1.0]), (5, [1.0]), (5, [2.0]), (6, [0.5]), (0, [1.0]), (0, [1.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in top_k(again, again.where("vec_id = 0"), 5).orderBy("rank").collect()] == [(5, 8192), (5, 4096), (5, 4096), (6, 2048)]


def test_suffix_automaton_holds_all_substrings():
    word = [1, 2, 1, 1, 2, 3, 1, 2]
    step = suffix_automaton(word)

    def held(part):
        state = 0
        for c in part:
            if c not in step[state]:
                return False
            state = step[state][c]
        return True

    assert all(held(word[i:j]) for i in range(9) for j in range(i, 9))
    assert not held([2, 2]) and not held([3, 3]) and not held([1, 1, 1])


def test_cross_parsing_against_brute_force():
    sample = (("a", "banana bandana"), ("b", "cobra cabana"))
    texts = ["banana cabana", "zz", "Cobra!! bandana", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    counts, sizes = phrase_counts(data, offsets, _model(sample))

    def phrases(text, known):
        at = n = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in known and text[at] in known:
                size += 1
            at, n = at + size, n + 1
        return n

    plain = ["banana cabana", "zz", "cobra bandana", ""]
    assert counts.tolist() == [[phrases(t, known) for _, known in sample] for t in plain]
    assert sizes.tolist() == [len(t) for t in plain]


def test_languages(spark):
    words = {"en": "the house and garden with trees", "de": "das haus und der garten mit bäumen", None: "plain words"}
    rows = [(i, " ".join(random.Random(i).choices(words[lang].split(), k=30)), lang) for i in range(60) for lang in ("en", "de")]
    rows = [(k, t, lang) for k, (_, t, lang) in enumerate(rows)] + [(1000 + k, t, None) for k, t in enumerate(EDGE)] + [(None, "the trees", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    got = predict_languages(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows[:120])
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows[:120]) and by_id[None].held_out is False
    assert [by_id[1000 + k].lang_pred for k in (0, 1, 2, 5)] == ["und"] * 4 and by_id[1000].score == 0
    assert all(0 <= r.score <= 1 for r in got)
    stays = in_known_language(df)
    assert stays.columns == df.columns and {r.score for r in stays.collect()} == {"own"}
    assert set(range(120)) <= {r.doc_id for r in stays.collect()} and LEAST_MATCH > 1
    none = predict_languages(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert labelled_sample(df.where("false")) == []


def test_token_counts(spark):
    rng = np.random.default_rng(2)
    docs = [(i, [int(x) for x in rng.integers(0, 50, rng.integers(0, 40))]) for i in range(30)] + [(100, []), (101, [5] * 200)]
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>").repartition(2)
    files, written = write_token_files(df, 99, block_tokens=16)
    found = scan_separators(files, 99, group=3).join(written, ["file", "doc_no"], "full").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in found) == sorted((i, len(ids)) for i, ids in docs)
    assert all(r.closed for r in found)
    raw = lambda ids: np.array(ids, "<u2").tobytes()
    blocks = [(0, 0, raw([1, 2])), (0, 1, raw([3])), (0, 2, None), (0, 3, raw([9, 9, 4])), (1, 0, b""), (2, 0, raw([7]))]
    table = spark.createDataFrame(blocks, "file int, block long, tokens binary")
    got = sorted(tuple(r) for r in scan_separators(table, 9, group=2).collect())
    assert got == [(0, 0, 0, 3, True), (0, 1, 4, 0, True), (0, 2, 5, 1, False), (2, 0, 0, 1, False)]
    assert scan_separators(table.where("false"), 9).count() == 0


@pytest.mark.parametrize("bad", [99, 65536, -1, None])
def test_token_ids_that_files_cannot_hold(spark, bad):
    docs = spark.createDataFrame([(1, [1, 2]), (2, [3, bad]), (3, None)], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="token id"):
        write_token_files(docs, 99)
    files, written = write_token_files(docs.where("doc_id <> 2").repartition(1), 99)
    found = scan_separators(files, 99).join(written, ["file", "doc_no"]).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in found) == [(1, 2), (3, 0)]


def test_shards(spark):
    df = frame(spark, EDGE + [prose(i, 5) for i in range(150)]).withColumn("slot", F.lit("own"))
    for shards, bucket in ((16, 4), (3, 1000)):
        got = shuffled(df, shards, bucket_rows=bucket).collect()
        sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(shards)]
        assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
        assert sorted(str(r.text) for r in got) == sorted(str(r.text) for r in df.collect())
    assert shuffled(df.where("false")).count() == 0
    sums = np.zeros((2, 3))
    for seed in range(300):
        m = np.array(communication_matrix([7, 0, 5], 3, seed))
        assert m.sum(axis=1).tolist() == [7, 0, 5] and m.sum(axis=0).tolist() == [4, 4, 4]
        sums += m[[0, 2]]
    assert np.abs(sums / 300 - [[7 / 3] * 3, [5 / 3] * 3]).max() < 0.2


def brute_tiles(a, b, shortest):
    """Greedy string tiling by definition: covered words."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n >= shortest and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        i, j, n = best
        free_a[i : i + n] = free_b[j : j + n] = [False] * n


def test_tiles_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        got = tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert got == brute_tiles(a, b, 3)


def test_benchmark_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    half = item.split()
    texts = ["Some words " + item.upper() + ".", "x " + " ".join(half[6:]) + " y " + " ".join(half[:6]), " ".join(half[:5]), prose(1, 80), *EDGE]
    df = frame(spark, texts)
    items = spark.createDataFrame([(7, item), (7, item), (8, "too short"), (9, None), (10, prose(9, 30))], "item_id long, text string")
    for block in (1 << 20, 70):
        got = sorted(tuple(r) for r in benchmark_matches(df, items, block_bytes=block).collect())
        assert got == [(0, 7, 12, 12, 1), (1, 7, 12, 12, 2)]
        left = without_leaks(df, items, block_bytes=block)
        assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [*range(2, len(texts)), len(texts) - 1]
    assert benchmark_matches(df, items.where("false")).count() == 0 and benchmark_matches(df.where("false"), items).count() == 0


def test_secrets(spark):
    hexes, mixed = "0123456789abcdef01234567", "Zk3x9QvT7bLm2RpW8sYc4HdN6"
    texts = [
        f'é {"API_key"}: "{hexes}" token=abc password = abcdef',
        f"key AKIA{'Q7' * 9} and {mixed} word",
        "thequickbrownfoxjumpsoverthelazydog 550e8400-e29b-41d4-a716-446655440000 11111111111111111111111111 aaaaaaaaaaaaaaaaaaaaaaaa1",
        mixed * 200,
        *EDGE,
    ]
    got = {r.doc_id: r for r in find_secrets(frame(spark, texts)).select("doc_id", joined(F.col("base")).alias("b"), joined(F.col("spans")).alias("s")).collect()}
    at = texts[0].index
    assert got[0].b == f"assign:2:{at(hexes) + 24},hex:{at(hexes)}:{at(hexes) + 24},assign:{at('password')}:{len(texts[0])}"
    assert got[1].b == "access:4:26" and got[1].s == "access:4:26,entropy:31:56"
    assert (got[2].b, got[2].s) == ("hex:73:99,hex:100:125",) * 2
    assert got[3].s == f"entropy:0:{len(mixed) * 200}"
    assert all((got[4 + k].b, got[4 + k].s) == ("", "") for k in range(len(EDGE)))


def test_many_matches_in_one_text(spark):
    """Spans take time in proportion to the matches: a text of 64,000 is one of them."""
    n = 64_000
    text = "é token=abcdef1 " * n
    (row,) = find_secrets(frame(spark, [text]).limit(1)).select("base").collect()
    assert len(row.base) == n
    assert [tuple(s) for s in row.base[:2]] == [(2, 0, 15), (18, 0, 31)] and tuple(row.base[-1]) == (16 * (n - 1) + 2, 0, 16 * (n - 1) + 15)


def test_random_tokens_are_secrets_and_identifiers_are_not(spark):
    import base64
    import string

    rng = random.Random(3)
    base62, lower = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits
    some = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    shapes = {p: (lambda p=p: p + some(base62, 36)) for p in ("ghp_", "sk_live_", "glpat-", "npm_", "sk-", "xoxb-123456789012-")}
    shapes |= {f"base64 {n}": (lambda n=n: base64.b64encode(rng.randbytes(n)).decode()) for n in (30, 48, 96)}
    shapes |= {"base62": lambda: some(base62, 20), "lower": lambda: some(lower, 32), "lower 20": lambda: some(lower, 20)}
    shapes |= {"path": lambda: "/srv/sample/" + some(base62, 36), "dummy": lambda: "dummy_" + some(base62, 36), "examples": lambda: "a/examples/" + some(base62, 36)}
    tokens = [(shape, make()) for shape, make in shapes.items() for _ in range(200)]
    names = ["user_profile_image_2x_small", "/usr/local/lib/python3/dist-packages/numpy", "getHTTPResponseCodeAsString", "AbstractBeanFactory-v2-2024", "MAX_RETRY_COUNT_PER_USER"]
    names += ["a-" * 20000, "zzz" * 7000, "ab_" * 7000 + "q1w2e3", "550E8400-e29b-41d4-a716-446655440000", "2024-01-31-12-00-00-000", "XXXXXXXXXXXXab12cd34ef56", "Q7IOSFODNN7EXAMPLEKEY9Z", "/etc/changeme123/sample_dummy_values"]
    rows = find_secrets(frame(spark, [t for _, t in tokens] + names)).select("doc_id", F.size("spans").alias("n")).collect()
    found = {r.doc_id for r in rows if r.n}
    for shape in shapes:
        hits = [i in found for i, (s, _) in enumerate(tokens) if s == shape]
        assert sum(hits) >= 0.97 * len(hits), (shape, sum(hits))
    assert [n[:40] for i, n in enumerate(names, len(tokens)) if i in found] == []


def test_bpe(spark):
    import tiktoken

    path, pattern = public_ranks()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    texts = [*EDGE, prose(1, 50), "naïve 東京 👩‍👩‍👧 don't  stop\n\n", "q" * 500, "<|endoftext|>", "ab" * 400]
    df = frame(spark, texts)
    got = encode_documents(df, path, pattern)
    assert got.columns == [*df.columns, "ids", "decoded"]
    for r in got.collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert encode_documents(df.where("false"), path, pattern).count() == 0
    words = ["the", " house", "xqzj", "東京", "q" * 20]
    folded = spark.createDataFrame([(w,) for w in words], "w string").select("w", fold_merges(F.col("w"), rank_map(path)).alias("ids")).collect()
    assert {r.w: r.ids for r in folded} == {w: merge(w.encode(), read_ranks(path)) for w in words}


def test_licenses(spark):
    texts = ["x\nReleased under the MIT Licence!\ny", "Copyright 2020 A\n" + KNOWN[0][1].upper(), "Licensed under the MIT License. And more", *EDGE]
    got = sorted(tuple(r) for r in find_licenses(frame(spark, texts)).collect())
    assert got == [(0, 1, "MIT"), (1, -1, "MIT")]


def test_license_texts_in_other_wrappings(spark):
    import textwrap

    from corpusloom.llm.licenses import FOLDER, known_texts

    mit = " ".join(KNOWN[0][1].split())
    isc = " ".join(next(text for name, text in KNOWN if name == "ISC").split())
    bsd = (FOLDER / "BSD-3-Clause.txt").read_text()
    bsd = bsd[bsd.index("Redistribution") :]
    foo = bsd.replace("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS").replace("THE REGENTS OR", "THE COPYRIGHT OWNER OR").replace("the University", "Foo Inc.")
    notice = "Copyright (c) 2020 Jane Doe"
    cases = [("MIT", mit), ("MIT", f"MIT License\n\n{notice}\n\n{mit}"), ("MIT", f"MIT License {notice} {mit}"), ("MIT", f"Copyright Foo, Inc.\n{mit}")]
    cases += [("MIT", textwrap.fill(mit, w)) for w in range(30, 110, 7)] + [("ISC", f"ISC License\n\n{notice}\n\n{textwrap.fill(isc, 60)}")]
    cases += [("BSD-3-Clause", f"BSD 3-Clause License\n\n{notice}\nAll rights reserved.\n\n{foo}"), ("BSD-3-Clause", textwrap.fill(foo, 50))]
    for name in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0"):
        text = (FOLDER / f"{name}.txt").read_text()
        cases += [(name if "." in name else name + ".0", t) for t in (text, *(textwrap.fill(text, w, break_long_words=False, break_on_hyphens=False) for w in (45, 60, 72, 90, 10**6)))]
    cases += [(name, text) for name, text in known_texts() if name == "BSD-2-Clause"]
    got = {(r.doc_id, r.license) for r in find_licenses(frame(spark, [text for _, text in cases])).collect() if r.line_no == -1}
    assert [c[0] for i, c in enumerate(cases) if (i, c[0]) not in got] == []
    assert {i for i, _ in got} == set(range(len(cases))) and len(got) == len(cases)
    assert find_licenses(frame(spark, [mit.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, ", ""), mit + " And more"])).count() == 0


def line_oracle(texts, percent=90):
    seen, out = [], {}
    for i, text in enumerate(texts):
        out[i] = []
        for k, line in enumerate([] if text is None else text.split("\n")):
            words = frozenset(w for w in line.lower().translate(str.maketrans("\t\x0b\x0c\r", "    ")).split(" ") if w)
            if words:
                if not any(100 * len(words & s) >= percent * len(words | s) for s in seen):
                    out[i].append(k)
                seen.append(words)
    return out


def test_lines(spark):
    rng = random.Random(5)
    base = [prose(k, 30).split() for k in range(4)]

    def varied(words):
        words = list(words)
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        return " ".join(words)

    texts = ["\n".join(varied(rng.choice(base)) for _ in range(3)) for _ in range(40)] + EDGE
    df = frame(spark, texts)
    expected = line_oracle(texts)
    got = {r.doc_id: r for r in line_report(df).collect()}
    assert {i: r["kept"] for i, r in got.items()} == {i: ",".join(map(str, k)) for i, k in expected.items()}
    left = without_repeated_lines(df).collect()
    assert left[0].asDict().keys() == dict.fromkeys(df.columns).keys() and {r["kept"] for r in left} <= {str(i) for i in range(len(texts))}
    for r in left:
        if r.text is not None:
            lines = texts[r.doc_id].split("\n")
            assert r.text == "\n".join(x for k, x in enumerate(lines) if k in expected[r.doc_id] or not x.strip(" \t\r\x0b\x0c"))
    blank = lambda t: not (t or "").strip(" \t\r\x0b\x0c\n")
    assert {r.doc_id for r in left} == {i for i, k in expected.items() if k or blank(texts[i])}


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_lines_of_few_words(spark, monkeypatch, broadcast_rows):
    """A small vocabulary, so that every word is in many lines; sizes on both sides of each range's ends."""
    monkeypatch.setattr(lines, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(9)
    base = [rng.sample([f"v{k}" for k in range(60)], n) for n in (8, 9, 10, 17, 18, 19, 27, 30, 36, 40, 54)]

    def varied(words):
        words = list(words)
        for _ in range(rng.randrange(0, 4)):
            words.pop(rng.randrange(len(words)))
            words += [f"v{rng.randrange(60)}"] * rng.randrange(0, 3)
        return " ".join(words)

    texts = ["\n".join(varied(rng.choice(base)) for _ in range(4)) for _ in range(100)]
    got = {r.doc_id: r.kept for r in line_report(frame(spark, texts)).collect() if r.doc_id is not None}
    assert got == {i: ",".join(map(str, k)) for i, k in line_oracle(texts).items()} | {i: got[i] for i in got.keys() - set(range(len(texts)))}


def test_unlike_lines_do_not_meet(spark, monkeypatch):
    """Lines that share their rarest words but are not alike; rows that meet must not grow with a word's lines."""
    rows = {}

    def counted(df, name):
        out = stored(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(lines, "stored", counted)
    rng = random.Random(10)
    texts = [" ".join(f"v{rng.randrange(300)}" for _ in range(45)) for _ in range(600)]
    report = line_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.kept == "0" for r in report) and rows["sets"] == 600
    assert rows["met"] + rows["pairs"] < 60


def test_empty_and_null_line_ids(spark):
    assert line_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    line = " ".join(f"v{k}" for k in range(20))
    docs = spark.createDataFrame([(3, line), (None, line + " w"), (2, line + " w x")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in line_report(docs).collect()} == {None: "0", 2: "", 3: ""}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_oracle(texts):
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for b in range(len(sets)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return [(len(sets[i]), root(i)) for i in range(len(texts))]


def test_near_duplicates(spark):
    rng = random.Random(6)
    texts = list(EDGE) + ["One", "a b c", "A  B\tc"]
    for group, size in ((0, 60), (1, 3), (2, 2)):
        words = prose(group, 120).split()
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(1000)}"
            texts.append(" ".join(copy))
    df = frame(spark, texts)
    got = near_duplicates(df).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(near_oracle(texts)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = one_per_group(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i, (_, c) in enumerate(near_oracle(texts)) if c == i]
    assert near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_shared_bands_are_kept_apart(spark, monkeypatch, broadcast_rows):
    """The bands of several nodes are a table of their own, joined either way; links are the same."""
    names = []
    monkeypatch.setattr(near, "stored", lambda df, name: names.append(name) or stored(df, name))
    monkeypatch.setattr(near, "BROADCAST_ROWS", broadcast_rows)
    texts = [prose(k // 2, 60) + " more" * (k % 2) for k in range(12)]
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(near_oracle(texts)))
    assert names.index("shared") < names.index("buckets")


def test_one_per_group_of_null_and_repeated_ids(spark):
    a, b, c, d = (prose(k, 30) for k in range(50, 54))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d + " more"), (8, b + " more"), (None, None), (None, " "), (None, prose(54, 30))]
    got = [tuple(r) for r in one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    alike = [r for r in got if r[1] in (d, d + " more")]
    assert len(alike) == 1 and alike[0][0] == 7
    rest = [(None, a), (7, c), (8, b + " more"), (None, None), (None, " "), rows[-1]]
    assert sorted((r for r in got if r not in alike), key=str) == sorted(rest, key=str)


def test_superminhash_estimates():
    rng = np.random.default_rng(7)
    errors = []
    for _ in range(100):
        shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 20, 20))
        both = [np.concatenate([shared, x]) for x in (a, b)]
        s = [superminhash(x, np.zeros(len(x), np.int64), 1, 200)[0] for x in both]
        errors.append((s[0] == s[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.032


@pytest.mark.parametrize("name", ["op4_shards", "op6_secrets", "op7_byte_bpe"])
def test_digests(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES[name](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        data = texts[r.doc_id].encode()
        if name == "op4_shards":
            assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        elif name == "op7_byte_bpe":
            assert r.decoded_sha256 == hashlib.sha256(data).hexdigest()
        else:
            assert (r.n_assign + r.n_access + r.n_hex == 0) == (r.base_sha256 == hashlib.sha256(b"").hexdigest())
