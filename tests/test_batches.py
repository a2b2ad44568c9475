import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusloom.functions import batches, vectors
from corpusloom.operators import chunking
from corpusloom.operators.chunking import tokenizer_hooks


def test_slices_hold_every_text_and_few_bytes():
    texts = pa.array([None, "é" * 30, "", "a" * 500, "b", None, "c" * 99, "d"])
    for most in (1, 60, 100, 10_000):
        parts = list(batches.byte_slices(texts, most))
        assert pa.concat_arrays(parts).equals(texts)
        assert all(len(p) == 1 or pc.sum(pc.binary_length(p)).as_py() <= most for p in parts)
    assert list(batches.byte_slices(pa.array([], pa.string()))) == []


def test_batches_of_long_texts_are_worked_on_by_parts(spark, monkeypatch):
    """Neither function makes anything of a whole batch at once."""
    seen = []

    def watched(texts):
        for part in batches.byte_slices(texts, 64):
            seen.append(len(part))
            yield part

    texts = pa.array([f"w{i} ß" * (i % 5) for i in range(40)] + [None])
    whole = vectors.hashed_counts(8)
    expected = _function(whole)(pc.fill_null(texts, "")).to_pylist()
    monkeypatch.setattr(vectors, "byte_slices", watched)
    assert _function(vectors.hashed_counts(8))(pc.fill_null(texts, "")).to_pylist() == expected and max(seen) < 41

    class Ordinals:
        def encode(self, text):
            if "w7" in text:
                raise ValueError("no")
            return np.array([ord(c) for c in text])

        def decode(self, ids):
            return ""

    monkeypatch.setattr(chunking, "byte_slices", watched)
    seen.clear()
    parts = list(tokenizer_hooks(Ordinals)[0].checked.func(iter([texts])))
    rows = pa.concat_arrays(parts).to_pylist()
    assert len(parts) > 3 and len(rows) == 41 and rows[40] == {"ids": [], "error": None}
    assert rows[7] == {"ids": [], "error": "ValueError: no"} and rows[3]["ids"] == [ord(c) for c in texts[3].as_py()]


def _function(embed):
    """The function that an embedder runs on a batch."""
    return next(c.cell_contents for c in embed.__closure__ if hasattr(c.cell_contents, "func")).func
