import re
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.dates import in_last_month, last_month_range
from corpusloom.functions.prompts import build_prompt
from corpusloom.functions.views import views_of_json
from corpusloom.operators.chunking import chunk_counts, chunk_documents, empty_documents, refused_chunks, token_limit, tokenizer_hooks, window_shape


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_every_white_space_character(spark):
    odd = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(odd) == sorted(T.WHITESPACE)
    assert column(spark, [f"a{c}b{c}" for c in odd], T.split_words) == [["a", "b"]] * len(odd)
    assert column(spark, [f"{c}a{c}" for c in odd], T.strip) == ["a"] * len(odd)
    assert column(spark, ["a​b", "a­b"], T.split_words) == [["a​b"], ["a­b"]]


def test_sentences(spark):
    texts = ["A b. C d!  E?F", "", "no end mark", "\n  One. Two?\n\n Three \n", ". . .", "a.b", "   ", None]
    assert column(spark, texts, T.split_sentences) == [
        ["A b.", "C d!", "E?F"],
        [],
        ["no end mark"],
        ["One.", "Two?", "Three"],
        [".", ".", "."],
        ["a.b"],
        [],
        None,
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n .!?aß", max_size=30), min_size=20, max_size=40))
def test_sentences_and_words_of_any_text(spark, texts):
    expected = [[s for s in re.split(r"(?<=[.!?])\s+", t.strip()) if s] for t in texts]
    assert column(spark, texts, T.split_sentences) == expected
    assert column(spark, texts, T.split_words) == [t.split() for t in texts]


def test_names(spark):
    assert column(spark, ['a\\b/c*d?e:f"g<h>i|j k'], T.clean_file_name) == ["abcdefghij k"]
    assert column(spark, ["Computer science"], T.topic_file_stem) == ["Computer_science"]
    assert column(spark, ["Computer science"], T.topic_folder) == ["Computerscience"]
    assert column(spark, ["A b c"], T.url_title) == ["A_b_c"]
    assert column(spark, [" See Also\n", "ÉTÉ"], T.comparable) == ["see also", "été"]
    assert column(spark, ["node-1", "node-9", "node-10", "node", "9" * 30], T.shard_of_name) == [0, 8, 9, None, None]


def test_last_month(spark):
    rows = spark.createDataFrame([("2024-01-15",), ("2024-03-31",), ("2023-03-01",)], "d string").select(
        *last_month_range(F.to_date("d"))
    )
    assert [tuple(r) for r in rows.collect()] == [("20231201", "20231231"), ("20240201", "20240229"), ("20230201", "20230228")]
    days = ["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01"]
    assert column(spark, days, lambda d: in_last_month(d.cast("date"), F.lit("2024-03-31").cast("date"))) == [False, True, True, False]


def test_json_views(spark):
    payloads = ['{"items":[{"views":3},{"x":1}]}', '{"items":[]}', "{}", "not json", '{"items":[{"views":2},{"views":5}]}', None]
    assert column(spark, payloads, views_of_json) == [3, 0, 0, 0, 7, 0]


def test_prompt(spark):
    df = spark.createDataFrame([(["x", "y"], "q?"), (None, "q?")], "c array<string>, q string")
    got = [r[0] for r in df.select(build_prompt(F.col("c"), F.col("q"))).collect()]
    assert got == [
        "You are an AI assistant. Use the following context to answer the question.\n\nContext:\nx\n\ny\n\nQuestion:\nq?\n\nAnswer:",
        None,
    ]


# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTS = {0: 0, 1: 1, 63: 1, 64: 1, 65: 2, 108: 2, 109: 3}


def worded(spark, counts):
    return spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in counts], "n int, text string")


def test_window_edges(spark):
    docs = worded(spark, COUNTS)
    counted = {r["n"]: (r["n_tokens"], r["n_chunks"]) for r in chunk_counts(docs, ["n"], size=64).collect()}
    assert counted == {n: (n, w) for n, w in COUNTS.items()}
    chunks = chunk_documents(docs, ["n"], size=64).collect()
    for n, windows in COUNTS.items():
        mine = sorted((r["chunk_ix"], r["chunk"].split(" ")) for r in chunks if r["n"] == n)
        assert [i for i, _ in mine] == list(range(windows))
        if n > 64:
            assert mine[-1][1] == [f"w{i}" for i in range(44 * (windows - 1), n)]
    assert [r["n"] for r in empty_documents(docs, ["n"]).collect()] == [0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 200), min_size=1, max_size=15, unique=True), st.integers(2, 50), st.data())
def test_windows_cover_and_overlap(spark, counts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    chunks = chunk_documents(worded(spark, counts), ["n"], size=size, overlap=overlap).collect()
    for n in counts:
        mine = [c.split(" ") for _, c in sorted((r["chunk_ix"], r["chunk"]) for r in chunks if r["n"] == n)]
        seen = mine[0] + [w for before, after in zip(mine, mine[1:]) for w in after[overlap:]] if mine else []
        assert seen == [f"w{i}" for i in range(n)]
        assert all(before[-overlap:] == after[:overlap] for before, after in zip(mine, mine[1:]) if overlap)


def test_windows_must_advance():
    for size, overlap, limit in [(20, 20, 8192), (10, 20, 8192), (64, 20, 16), (64, -1, 8192)]:
        with pytest.raises(ValueError):
            window_shape(size, overlap, limit)
    assert window_shape(20_000, 20) == (8192, 8172)
    assert token_limit(object()) == 8192
    short = type("Short", (), {"model_max_length": 256})()
    assert window_shape(512, 20, token_limit(short)) == (256, 236)


def test_null_text_gives_no_chunk(spark):
    docs = spark.createDataFrame([(1, None), (2, " \n"), (3, "a")], "n int, text string")
    assert [r["n"] for r in chunk_documents(docs, ["n"]).collect()] == [3]
    assert sorted(r["n"] for r in empty_documents(docs, ["n"]).collect()) == [1, 2]


def wordlevel_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = {f"w{i}": i for i in range(100)} | {"[UNK]": 100}
    inner = Tokenizer(models.WordLevel(words, unk_token="[UNK]"))
    inner.pre_tokenizer = pre_tokenizers.WhitespaceSplit()

    class Adapter:
        def encode(self, text):
            if text == "broken":
                raise RuntimeError("cannot encode")
            return inner.encode(text).ids

        def decode(self, ids):
            if 99 in ids:
                raise ValueError("bad id")
            return inner.decode(ids, skip_special_tokens=False)

    return Adapter()


def test_subword_tokenizer_hook(spark):
    texts = ["w1 w2 w3 w4 w5", "w1 nope w2", "broken", "w99 w1 w2 w3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    tokenize, detokenize = tokenizer_hooks(wordlevel_tokenizer)
    options = dict(size=3, overlap=1, tokenize=tokenize)
    got = sorted(tuple(r) for r in chunk_documents(docs, ["n"], detokenize=detokenize, **options).collect())
    assert got == [(0, 0, "w1 w2 w3"), (0, 1, "w3 w4 w5"), (1, 0, "w1 [UNK] w2"), (3, 1, "w2 w3")]
    assert {r["n"]: r["n_chunks"] for r in chunk_counts(docs, ["n"], **options).collect()} == {0: 2, 1: 1, 2: 0, 3: 2}
    refused = sorted(tuple(r) for r in refused_chunks(docs, ["n"], detokenize=detokenize, **options).collect())
    assert refused == [(2, None, "RuntimeError: cannot encode"), (3, 0, "ValueError: bad id")]
    # A decoder of one's own that gives null is reported too.
    nulls = chunk_documents(docs, ["n"], detokenize=lambda w: F.lit(None).cast("string"), **options)
    assert nulls.count() == 0
    refused = refused_chunks(docs, ["n"], detokenize=lambda w: F.lit(None).cast("string"), **options).collect()
    assert [r.error for r in refused if r.n == 0] == ["not decoded"] * 2
