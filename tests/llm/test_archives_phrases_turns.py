"""Archives, collocations and the conversation trie against brute force."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.collocations import Automaton, collocations, phrase_counts
from corpusloom.llm.turns import prefix_trie, running_sums
from corpusloom.llm.warc import archive_index, archived_pages, normalise_archives, payload_digest, read_archives, write_archives

PAGES = "page_id long, url string, html string, kind string, body string, salt string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", "b", "s") for i, u, h in rows], PAGES).repartition(3)


def test_archives_and_back(spark, tmp_path):
    rows = [(5, "http://a/ b\r\n", "same"), (3, "http://b", "same"), (9, None, "same"), (9, None, "same"), (None, "http://n", "same"), (4, "u", ""), (2, "u", None)]
    rows += [(7, "ü", "line\r\n\r\nWARC/1.1\r\n\r\n\n\nend\n"), (8, "x", "\r\n\r\n"), (10, "y", "ü€ " * 50_000), (11, "z", "\x00\x00"), (None, "q", "alone")]
    got = [tuple(r) for r in archived_pages(pages(spark, rows), f"{tmp_path}/in", f"{tmp_path}/out").collect()]
    assert len(got) == len(rows)
    expected, seen = [], {}
    for page, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        body = (html or "").encode()
        first = body in seen
        expected.append((page, len(body), payload_digest(body), "revisit" if first else "response", seen[body] if first else None))
        seen.setdefault(body, page)
    assert sorted(got, key=str) == sorted(expected, key=str)

    # Each record is a member of its own at the place the index names, and the files are plain gzip.
    index = archive_index(spark, f"{tmp_path}/out")
    assert index.count() == len(rows) == index.select("archive", "offset").distinct().count()
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(f"{tmp_path}/out/sidecar=false").rglob("part-*")))
    inflated = [gzip.decompress(p.read_bytes()) for p in sorted(Path(f"{tmp_path}/in").glob("part-*.gz"))]
    assert sorted(whole.split(b"WARC-Type")) == sorted(b"".join(inflated).split(b"WARC-Type"))
    for archive in index.select("archive").distinct().collect():
        (file,) = Path(f"{tmp_path}/out/sidecar=false/archive={archive[0]}").glob("part-*")
        content = file.read_bytes()
        for r in index.where(F.col("archive") == archive[0]).collect():
            member = zlib.decompressobj(31)
            record = member.decompress(content[r["offset"] : r["offset"] + r["length"]])
            assert member.eof and not member.unused_data and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert f"<{r['id']}>".encode() in record

    # A part of the index reads those records alone, with their payloads.
    some = read_archives(spark, f"{tmp_path}/out", index.where("id like '%:10'")).collect()
    assert [bytes(r.payload).decode() for r in some] == ["ü€ " * 50_000]
    assert {r.uri for r in read_archives(spark, f"{tmp_path}/out").collect()} >= {"http://a/%20b%0D%0A", "ü", None}


def test_archive_edges(spark, tmp_path):
    none = pages(spark, [(1, "u", "x")]).where("false")
    assert archived_pages(none, f"{tmp_path}/in", f"{tmp_path}/out").count() == 0
    short = pages(spark, [(1, "u", "xy"), (2, "u", "xy"), (3, "u", "xyz"), (4, "u", "xyz")])
    got = archived_pages(short, f"{tmp_path}/in2", f"{tmp_path}/out2", least_bytes=3).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]

    # Archives made elsewhere: other record types, members already apart, and one that is cut off.
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 5\r\n\r\na\r\nb\n\r\n\r\n"
    given = tmp_path / "given"
    given.mkdir()
    (given / "one.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(info))
    normalise_archives(spark, str(given), f"{tmp_path}/out3")
    assert [(r.type, r.id, r.payload) for r in read_archives(spark, f"{tmp_path}/out3").collect()] == [("warcinfo", "urn:uuid:1", None)] * 2
    (given / "two.warc.gz").write_bytes(gzip.compress(info + info[:-9]))
    with pytest.raises(Exception, match="ends within a record"):
        normalise_archives(spark, str(given), f"{tmp_path}/out4")


def test_hot_payload(spark, tmp_path):
    rows = [(i, "u", "hot" if i % 3 else f"page {i}") for i in range(3000)]
    write_archives(pages(spark, rows), f"{tmp_path}/in")
    normalise_archives(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = read_archives(spark, f"{tmp_path}/out").groupBy("type", "refers_to").count().collect()
    assert {(r.type, r.refers_to): r["count"] for r in got} == {("response", None): 1001, ("revisit", "urn:x-page:1"): 1999}


def brute_collocations(rows, least, percent, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = [(p[i : i + m], a) for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)]
        dropped = {p for p, a in held if 100 * a >= percent * counts[p]}
        scored = []
        for p, a in candidates.items():
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if p not in dropped:
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("percent", [100, 60])
def test_collocations(spark, percent):
    rng = random.Random(3)
    words = ["The", "of", "ü", "new", "york", "a\x00b", "x" * 40, "city hall"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rng.randrange(60)))) for _ in range(60)]
    rows += [("en", "new york city hall " * 700), ("fr", None), ("fr", ""), ("es", " .,\n"), ("de", "word" * 50_000), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "lang string, text string, phrase string, f int").repartition(3)
    expected = brute_collocations(rows, 5, percent, 30)
    for sizes in ({}, {"range_bytes": 2000, "block_words": 100}):
        got = collocations(df, least=5, percent=percent, top=30, **sizes).collect()
        assert sorted(tuple(r) for r in got) == expected
    assert collocations(df.where("false")).count() == 0


def test_huge_counts_stay_exact(spark):
    """Products beyond 64 bits, by the same expression that scores."""
    a, n, l, r = 10**13, 10**15, 3 * 10**13, 7 * 10**13 + 1
    got = spark.sql(f"select (cast({a} as decimal(16,0)) * cast({n} as decimal(16,0)) * cast(1000 as decimal(4,0))) div (cast({l} as decimal(16,0)) * cast({r} as decimal(16,0))) as s").first().s
    assert got == 1000 * a * n // (l * r)


def test_automata(spark):
    words = sorted([b"a", b"b", b"ba", b"\xc3\xbc"])
    rng = random.Random(5)
    windows = Counter(tuple(rng.choice(range(1, 5)) if i < n else 0 for i in range(5)) for n in (rng.randrange(1, 6) for _ in range(500)))
    import numpy as np

    rows = list(windows.elements())
    automaton = Automaton.build(words, [np.array(c) for c in zip(*rows)], np.ones(len(rows), np.int64))
    again = Automaton.unpack(automaton.pack())
    assert again.words == words and {p: int(w) for *p, w in zip(*again.columns, again.weights) for p in [tuple(map(int, p))]} == windows
    for window in [(b"a",), (b"b", b"a"), (b"b", b"aa"), (b"zz",), (b"\xc3\xbc", b"\xc3\xbc", b"b")]:
        place = automaton.place(window)
        named = [tuple(words[i - 1] for i in p if i) for p in sorted(windows)]
        assert place == sum(p < window for p in named)
    half = automaton.place((b"b",))
    assert automaton.part(0, half).weights.sum() + automaton.part(half, len(automaton.weights)).weights.sum() == 500
    df = spark.createDataFrame([("en", "a b a b")], "lang string, text string")
    assert {r.phrase: r.f for r in phrase_counts(df, 2).collect()} == {"": 4, "a": 2, "b": 2, "a b": 2}


def brute_trie(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda v: v[0])] for c, v in by.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members, children = defaultdict(list), Counter()
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = Counter(), Counter()
    for path, m in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
            leaves[path[:d]] += not children[path]
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), parent, len(m), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_prefix_trie(spark):
    rng = random.Random(7)
    texts = ["hello there", "", None, "yes\x0bno", "ü  x", "long " * 5000]
    rows = []
    for c in [*range(0, 45), *range(101, 130), 2000, 2007, 10**12]:
        for t in range(rng.randrange(1, 6)):
            rows.append((c, None if t == 0 and c % 2 else 3 * t, rng.choice(["user", "assistant", None]), texts[0] if t < 2 else rng.choice(texts)))
    rows += [(None, 1, "user", "no id"), (61, 0, "user", "same"), (61, 0, "user", "same")]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "conv_id long, turn long, role string, text string, fp string, part int").repartition(4)
    got = prefix_trie(df)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == brute_trie(rows)
    assert prefix_trie(df.where("false")).count() == 0
    roots = prefix_trie(df.where("conv_id = 2007")).where("depth = 0").collect()
    assert [(r.conv_id, r.n_convs) for r in roots] == [(2007, 1)]


def test_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t if t < 400 else t + c}") for c in (0, 1, 21) for t in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert sorted((tuple(r)[:8] for r in prefix_trie(df).collect()), key=str) == brute_trie(rows)
    sums = running_sums(df.selectExpr("conv_id", "turn as at", "turn as x"), "conv_id", "at", ["x"], block=7).collect()
    assert all(r.x == r["at"] * (r["at"] + 1) // 2 for r in sums) and len(sums) == 1500
