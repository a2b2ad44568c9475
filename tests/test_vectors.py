import sys
from hashlib import md5

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.catalog import vector_queries
from corpusloom.functions.text import WHITESPACE
from corpusloom.functions.vectors import cosine, hashed_counts, is_usable, model_embedder, unit_length
from corpusloom.operators import nearest as N
from corpusloom.operators import quantised as Q
from corpusloom.operators.cells import assign_cells, cells_to_probe, fit_cells, nearest_in_cells
from corpusloom.operators.nearest import nearest
from corpusloom.operators.pruned import cell_radii, nearest_pruned, place_in_cells
from corpusloom.operators.quantised import Quantiser, encode, fit_codewords, mean_centres, nearest_coded
from corpusloom.sinks.index import write_index

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "id long, vector array<float>, shard int"


def brute_force(asked, items, k, by=None):
    """Per question (and group) the k best ``(score, id)`` by cosine, ties to the lower id."""
    best = {}
    for qid, q, *_ in asked:
        if q is None or not len(q) or not np.any(q):
            continue
        q = np.asarray(q, dtype=np.float32).astype(float)
        for iid, v, shard in items:
            if v is None or len(v) != len(q) or None in list(v):
                continue
            v = np.asarray(v, dtype=np.float32).astype(float)
            if not np.all(np.isfinite(v)) or not np.any(v):
                continue
            score = round(float(q @ v) / float(np.sqrt((q @ q) * (v @ v))), 12)
            best.setdefault((qid, shard if by else None), []).append((-score, iid))
    return {key: [(i, round(-s, 9)) for s, i in sorted(found)[:k]] for key, found in best.items()}


def run(spark, asked, items, k, partitions=5, **options):
    questions = spark.createDataFrame([(q, v) for q, v, *_ in asked], "qid long, vector array<float>")
    things = spark.createDataFrame(items, SCHEMA).repartition(partitions)
    return N.nearest(questions, things, k, asked_keys=["qid"], item_keys=["id"], **options)


def as_dict(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["match_rank"])):
        found.setdefault((r["qid"], None), []).append((r["id"], round(r["score"], 9)))
    return found


def random_items(n, dim, seed, whole=False):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(0, 3, (n, dim)) if whole else rng.normal(size=(n, dim))
    return [(i, [float(x) for x in v], int(i % 4)) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("k", [1, 3, 500])
def test_nearest_equals_brute_force(spark, whole, k):
    items, asked = random_items(300, 8, 1, whole), random_items(40, 8, 2, whole)
    expected = brute_force(asked, items, k)
    assert as_dict(run(spark, asked, items, k).collect()) == expected
    grid = run(spark, asked, items, k, broadcast_bytes=0, cell_bytes=1024)
    assert as_dict(grid.collect()) == expected


@pytest.mark.parametrize("k", [1, 4])
def test_seeded_search_equals_brute_force(spark, k):
    """Floors from a part of the items change nothing but the number of rows handed on."""
    items, asked = random_items(3000, 8, 11, whole=True), random_items(30, 8, 12, whole=True)
    expected = brute_force(asked, items, k)
    for way in ({}, {"broadcast_bytes": 0, "cell_bytes": 8192}):
        seeded = run(spark, asked, items, k, partitions=8, unseeded_rows=0, **way)
        assert as_dict(seeded.collect()) == expected
    items, asked = random_items(3000, 8, 13), random_items(30, 8, 14)
    # Floors of a 64th part pay off with more tasks than that.
    things = spark.createDataFrame(items, SCHEMA).repartition(256)
    questions = spark.createDataFrame([(q, v) for q, v, _ in asked], "qid long, vector array<float>")
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    rows = [N.nearest_candidates(questions, things, k, unseeded_rows=n, **keys).count() for n in (0, 10**9)]
    assert rows[0] < rows[1] / 2
    by_shard = [N.nearest_by_shard(questions, things.withColumn("x", F.col("id") * 2), k, 3, shard="shard", carry=["x"], unseeded_rows=n, **keys) for n in (0, 10**9)]
    got = [sorted(tuple(r) for r in df.select("qid", "shard", "id", "x", "score", "match_rank").collect()) for df in by_shard]
    assert got[0] == got[1] and all(r[3] == 2 * r[2] for r in got[0])


def test_grid_plan_has_no_cross_join(spark):
    items, asked = random_items(50, 8, 1), random_items(20, 8, 2)
    plan = run(spark, asked, items, 2, broadcast_bytes=0, cell_bytes=512)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_copies_tie_and_the_lowest_key_wins(spark):
    """A third of the items are copies of one vector, spread over all partitions."""
    items = random_items(400, 16, 3)
    copied = items[7][1]
    items += [(1000 + i, copied, 0) for i in range(200)]
    asked = [(0, copied), (1, [-x for x in copied]), *random_items(5, 16, 4)]
    asked = [(i, v) for i, (_, v, *_) in enumerate(asked)]
    expected = brute_force(asked, items, 5)
    assert [i for i, _ in expected[(0, None)]] == [7, 1000, 1001, 1002, 1003]
    for parts in (1, 3, 16):
        assert as_dict(run(spark, asked, items, 5, partitions=parts).collect()) == expected


def test_unusable_vectors_never_match(spark):
    items = [(0, [0.0, 0.0], 0), (1, None, 0), (2, [1.0], 0), (3, [1.0, float("nan")], 0), (4, [1.0, None], 0), (5, [0.5, 0.5], 0)]
    asked = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, 1.0])]
    got = as_dict(run(spark, asked, items, 9).collect())
    assert {key[0]: [i for i, _ in v] for key, v in got.items()} == {0: [5], 3: [5]}
    none = run(spark, [(0, None)], items, 2)
    assert none.collect() == [] and "certainty" in none.columns


def test_distance_and_certainty(spark):
    row = run(spark, [(0, [1.0, 0.0])], [(0, [0.0, 2.0], 0)], 1).first()
    assert (row["score"], row["distance"], row["certainty"]) == (0.0, 1.0, 0.5)


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_shards_merge_to_the_overall_best(spark, shards):
    items = [(i, v, i % shards) for i, v, _ in random_items(120, 6, 5)]
    asked = random_items(15, 6, 6)
    questions = spark.createDataFrame([(q, v) for q, v, _ in asked], "qid long, vector array<float>")
    things = spark.createDataFrame(items, SCHEMA).repartition(4)
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    assert as_dict(N.nearest_by_shard(questions, things, 4, 4, **keys).collect()) == brute_force(asked, items, 4)
    # One per shard, merged: the best of each shard and nothing else.
    winners = brute_force(asked, items, 1, by=True)
    got = N.nearest_by_shard(questions, things, 1, shards, **keys).collect()
    assert {(r["qid"], r["shard"]): [(r["id"], round(r["score"], 9))] for r in got} == winners


def test_cells(spark):
    items, asked = random_items(200, 8, 7), random_items(20, 8, 8)
    things = spark.createDataFrame(items, SCHEMA)
    questions = spark.createDataFrame([(q, v) for q, v, _ in asked], "qid long, vector array<float>")
    model = fit_cells(things, 6)
    placed = assign_cells(things, model).repartition(3).cache()
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    assert placed.where("cell is null").count() == 0 and placed.count() == 200
    everything = brute_force(asked, items, 3)
    for extra in ({}, {"unseeded_rows": 0}, {"broadcast_bytes": 0, "cell_bytes": 2048}):
        assert as_dict(nearest_in_cells(questions, placed, model, 3, 6, **keys, **extra).collect()) == everything
    # With fewer probes: the best among the items of the probed cells.
    probed = {r["qid"]: set(r["cells"]) for r in questions.select("qid", cells_to_probe(model, F.col("vector"), 2).alias("cells")).collect()}
    cell = {r["id"]: r["cell"] for r in placed.collect()}
    expected = {}
    for q, v, _ in asked:
        assert len(probed[q]) == 2
        expected |= brute_force([(q, v)], [i for i in items if cell[i[0]] in probed[q]], 3)
    for extra in ({}, {"unseeded_rows": 0}, {"broadcast_bytes": 0, "cell_bytes": 2048}):
        assert as_dict(nearest_in_cells(questions, placed, model, 3, 2, **keys, **extra).collect()) == expected


def test_hashed_counts(spark):
    spaced = "".join(f"w{c}" for c in WHITESPACE)
    texts = ["The cat, the Cat", "", None, "x", " \n", spaced, f"\x1c{spaced}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(hashed_counts(16)(F.col("t"))).collect()]
    for text, vector in zip(texts, got):
        expected = [0.0] * 16
        for word in (text or "").lower().split():
            expected[int(md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        assert vector == expected
    blank = spark.createDataFrame([(1, " "), (2, "")], "i int, t string").select(hashed_counts(4)(F.col("t")))
    assert [r[0] for r in blank.collect()] == [[0.0] * 4] * 2


def test_native_similarity(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(cosine(F.col("a"), F.col("b")).alias("c"), unit_length(F.col("a")).alias("u")).collect()
    assert rows[0]["c"] == pytest.approx(0.96) and rows[0]["u"] == pytest.approx([0.6, 0.8])
    assert rows[1]["c"] is None and rows[1]["u"] is None


def test_usable(spark):
    vectors = [[1.0, 2.0], [1.0], [], None, [1.0, float("nan")], [1.0, None], [float("inf"), 0.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>").orderBy("i")
    assert [r[0] for r in df.select(is_usable(F.col("v"), 2)).collect()] == [True] + [False] * 6
    assert [r[0] for r in df.select(is_usable(F.col("v"))).collect()] == [True, True] + [False] * 5


def shaky_model():
    calls = []

    def encode(texts):
        calls.append(len(texts))
        if any(t.startswith("bad") for t in texts):
            raise ValueError
        return [[float(len(t)), float(max(calls))] for t in texts]

    return encode


def test_model_embedder_keeps_the_rest_of_a_failing_batch(spark):
    texts = ["a", "bad one", "ccc", None, "dd"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = {r["i"]: r["v"] for r in df.select("i", model_embedder(shaky_model, batch=2)(F.col("t")).alias("v")).collect()}
    assert got[0] == [1.0, 2.0] and got[1] is None and got[2] == [3.0, 2.0] and got[3] is None and got[4] == [2.0, 2.0]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_probed_cells(spark, sf):
    found = vector_queries.knn_ivf(spark, f"/root/testdata/{sf}").where("qid <> vec_id")
    exact = vector_queries.knn_topk(spark, f"/root/testdata/{sf}").where("match_rank <= 5")
    found, exact = ({(r.qid, r.vec_id) for r in x.collect()} for x in (found, exact))
    assert len(found & exact) >= 0.9 * len(exact)
    assert vector_queries.SHORT_LIST < spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").count() / 5


def coded_things(spark, n=300, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim)).astype(np.float32)
    vectors[5:9] = vectors[4]
    rows = [(int(i), int(i % 3), v.tolist()) for i, v in enumerate(vectors)]
    odd = [(1000, 0, None), (1001, 0, [0.0] * dim), (1002, 1, [1.0, None] + [0.0] * (dim - 2)), (1003, 1, [1.0]), (1004, 2, [float("nan")] * dim)]
    things = spark.createDataFrame([*rows, *odd], "id long, label int, vector array<float>").repartition(5)
    asked = things.select(F.col("id").alias("qid"), "vector").where("id % 7 = 0 or id >= 1000")
    return things, asked, vectors


def test_coded_search(spark):
    things, asked, vectors = coded_things(spark)
    unit = vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    truth = {q: sorted(range(300), key=lambda i: (-round(float(unit[q] @ unit[i]), 9), i))[:4] for q in range(0, 300, 7)}
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    for rounds in (0, 3):
        quantiser = Quantiser(mean_centres(things, "label"), fit_codewords(things, "id", 6, 32, rounds=rounds))
        index = encode(things, quantiser).cache()
        assert index.where("codes is null").count() == 5 and index.where("octet_length(codes) = 6").count() == 300
        for how in ({}, {"broadcast_bytes": 0, "cell_bytes": 4096}):
            # With every cell and item on the short list the search is exact.
            found = nearest_coded(asked, index, quantiser, 4, probes=3, short_list=300, **keys, **how).collect()
            assert {r.qid for r in found} == set(truth)
            for q, best in truth.items():
                assert [r.id for r in sorted((r for r in found if r.qid == q), key=lambda r: r.match_rank)] == best
        short = nearest_coded(asked, index, quantiser, 4, probes=3, short_list=40, **keys).collect()
        assert sum(r.id in truth[r.qid] for r in short) >= 0.9 * 4 * len(truth)
        # One cell: only its items, whatever their products.
        cell = {r.id: r.cell for r in index.collect()}
        for r in nearest_coded(asked, index, quantiser, 2, probes=1, short_list=5, **keys).collect():
            assert cell[r.id] == cell[r.qid]
    assert nearest_coded(asked.where("false"), index, quantiser, 4, probes=3, short_list=9, **keys).count() == 0
    assert nearest_coded(asked, index.where("false"), quantiser, 4, probes=3, short_list=9, **keys).count() == 0


def test_codes_are_scanned_without_vectors(spark, tmp_path):
    things, asked, _ = coded_things(spark)
    quantiser = Quantiser(mean_centres(things, "label"), fit_codewords(things, "id", 6, 32))
    write_index(encode(things, quantiser), str(tmp_path / "cells"), compact=True, by="cell")
    index = spark.read.parquet(str(tmp_path / "cells"))
    found = nearest_coded(asked, index, quantiser, 4, probes=2, short_list=9, asked_keys=["qid"], item_keys=["id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    (codes,) = [line for line in plan.splitlines() if "Project" in line and "codes" in line]
    assert "vector" not in codes
    with pytest.raises(ValueError, match="equal parts"):
        fit_codewords(things, "id", 5, 4)


def test_cells_out_of_reach_are_not_read(spark, tmp_path):
    """Clustered items, stored by cell: exact results although far cells' files cannot even be read."""
    rng = np.random.default_rng(11)
    centres = np.linalg.qr(rng.normal(size=(8, 8)))[0][:6]
    vectors = np.concatenate([c + rng.normal(scale=0.05, size=(40, 8)) for c in centres]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    items = spark.createDataFrame(rows, "id long, vector array<float>").repartition(4)
    path = tmp_path / "cells"
    write_index(place_in_cells(items, centres), str(path), compact=True, by="cell")
    placed = spark.read.parquet(str(path))
    radii = cell_radii(placed, centres).cache()
    assert sorted((r.cell, r["items"]) for r in radii.collect()) == [(c, 40) for c in range(6)]
    asked = items.where("id % 40 < 3 and id < 120 or id >= 900").select(F.col("id").alias("qid"), "vector")
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    expected = sorted(tuple(r) for r in nearest(asked, items, 7, asked_keys=["qid"], item_keys=["id"]).select("qid", "match_rank", "id").collect())
    assert len(expected) == 9 * 7
    for cell in (3, 4, 5):
        for file in (path / f"cell={cell}").glob("*.parquet"):
            file.write_bytes(b"not parquet")
    got = nearest_pruned(asked, placed, centres, radii, 7, **keys).select("qid", "match_rank", "id")
    assert sorted(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("k", [1, 5, 60])
def test_pruned_search_is_exact(spark, k):
    things, asked, _ = coded_things(spark)
    centres = mean_centres(things, "label")
    placed = place_in_cells(things, centres).cache()
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    rows = lambda df: sorted(tuple(r) for r in df.select("qid", "match_rank", "id").collect())
    assert rows(nearest_pruned(asked, placed, centres, cell_radii(placed, centres), k, **keys)) == rows(nearest(asked, things, k, dim=12, **keys))


def test_the_grid_sends_no_more_copies_as_it_grows():
    """Cells of 64 KB ask for 902 rows and columns at 1 GB; cells stay bounded in bytes and in pairs."""
    for n in (10_256, 102_560, 615_360):
        rows, columns = N._grid_shape(n * 576, n * 576, n * n, 64 << 10)
        assert max(rows, columns) <= N.GRID_COPIES and n * n / (rows * columns) <= N.CELL_PAIRS
    rows, columns = N._grid_shape(40 << 30, 1 << 30, 10**13, N.CELL_BYTES)
    assert rows >= 320 and columns >= 8 and rows * columns >= 10**13 / N.CELL_PAIRS
    assert N._grid_shape(100, 100, 10, 1) == (16, 16)


@pytest.mark.parametrize("step, cells", [(3, 50), (1, 7), (64, 100_000)])
def test_steps_and_tiles_give_the_same_result(monkeypatch, step, cells):
    """Many copies and a floor that rises step by step, by group and over all, against brute force."""
    monkeypatch.setattr(N, "STEP_ROWS", step)
    monkeypatch.setattr(N, "PRODUCT_CELLS", cells)
    items = random_items(150, 4, 3, whole=True)
    batch = N.pa.RecordBatch.from_pydict({"id": [i for i, _, _ in items], "shard": [s for *_, s in items], "_vector": N.pa.array([v for _, v, _ in items], N.pa.list_(N.pa.float32()))})
    questions = N.pa.table({"qid": list(range(40)), "_vector": N.pa.array([v for _, v, _ in items[:40]], N.pa.list_(N.pa.float32()))})
    for k, by in ((1, True), (3, True), (5, False)):
        spec = N.Search(k, ("qid",), ("id",), (), "shard" if by else None, by)
        found = {}
        for r in N._search([batch.slice(0, 70), batch.slice(70)], questions, spec).to_pylist():
            found.setdefault((r["qid"], r["shard"] if by else None), []).append((r["id"], round(r["score"], 9)))
        found = {key: sorted(rows, key=lambda r: (-r[1], r[0])) for key, rows in found.items()}
        assert found == brute_force([(i, v) for i, v, _ in items[:40]], items, k, by)


def test_questions_without_direction_read_no_item(spark):
    questions = spark.createDataFrame([(0, [0.0, 0.0]), (1, None)], "qid long, vector array<float>")
    things = spark.createDataFrame(random_items(10, 2, 1), SCHEMA)
    found = N.nearest_candidates(questions, things, 1, asked_keys=["qid"], item_keys=["id"])
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 0


@pytest.mark.parametrize("step, cells, size", [(5, 40, 4), (64, 10_000, 7), (2_048, 9, 3)])
def test_short_list_equals_the_sum_of_table_entries(monkeypatch, step, cells, size):
    """Steps, tiles and floors against all sums, with many equal codes and cells left out."""
    monkeypatch.setattr(Q, "STEP_ROWS", step)
    monkeypatch.setattr(Q, "PRODUCT_CELLS", cells)
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(90, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    quantiser = Quantiser(unit[:3], np.ascontiguousarray(unit[:5].reshape(5, 4, 2).transpose(1, 0, 2)))
    codes, cell = quantiser.codes(unit), quantiser.cells(unit)
    columns = {"id": list(range(90)), "cell": N.pa.array(cell, N.pa.int32()), "codes": [None if i == 8 else c.tobytes() for i, c in enumerate(codes)]}
    batch = N.pa.RecordBatch.from_pydict(columns)
    asked = N.pa.table({"qid": list(range(30)), "_vector": N.pa.array([list(u) for u in unit[:30]])})
    found = Q._short_list([batch.slice(0, 50), batch.slice(50)], asked, quantiser, (["qid"], ["id"]), 2, size).to_pylist()
    tables = quantiser.tables(Q._units(asked["_vector"].combine_chunks(), 8)[0])
    for q in range(30):
        probed = np.argsort(-(quantiser.centres @ unit[q]), kind="stable")[:2]
        sums = [(-round(float(sum(tables[p, q, codes[i, p]] for p in range(4))), 9), i) for i in range(90) if i != 8 and cell[i] in probed]
        got = sorted((-r["approximate"], r["id"]) for r in found if r["qid"] == q)
        assert [i for _, i in got] == [i for _, i in sorted(sums)[:size]]


@pytest.mark.parametrize("groups", [5, 160])
@pytest.mark.parametrize("k, overall", [(1, None), (3, None), (1, 1), (2, 3)])
def test_packed_products_miss_nothing(monkeypatch, k, overall, groups):
    """Six products of bytes in a double, of folded and of scaled vectors, against brute force by group and over all."""
    for name, value in (("LANE_QUESTIONS", 1), ("LANE_TILE", 16), ("LANE_GROUPS", groups), ("STEP_ROWS", 40), ("FIRST_ROWS", 8), ("CROWDED", 0)):
        monkeypatch.setattr(N, name, value)
    kept, pairs = [], N.Lanes.pairs
    monkeypatch.setattr(N.Lanes, "pairs", lambda *args: [kept.append(len(found[0])) or (part, found) for part, found in pairs(*args)])
    rng = np.random.default_rng(5)
    vectors = rng.poisson(0.3, (500, 24))
    vectors[::9] *= rng.integers(1, 80, (56, 1))  # longer than a byte's product allows
    vectors[20:60] = vectors[3]  # copies
    vectors[:, 0] += 1
    vectors = np.minimum(vectors, 255)
    items = [(int(i), [float(x) for x in v], int(i % 4)) for i, v in enumerate(vectors)]
    asked = [(i, v) for i, (_, v, _) in enumerate(items[::7])]
    batch = N.pa.RecordBatch.from_pydict({"id": [i for i, *_ in items], "shard": [s for *_, s in items], "_vector": N.pa.array([v for _, v, _ in items], N.pa.list_(N.pa.float32()))})
    questions = N.pa.table({"qid": [q for q, _ in asked], "_vector": N.pa.array([v for _, v in asked], N.pa.list_(N.pa.float32()))})
    spec = N.Search(k, ("qid",), ("id",), (), "shard" if overall else None, bool(overall), overall)
    found = {}
    for r in N._search([batch.slice(0, 300), batch.slice(300)], questions, spec).to_pylist():
        found.setdefault((r["qid"], None), []).append((-r["score"], r["id"]))
    found = {key: [(i, round(-s, 9)) for s, i in sorted(rows)[: overall or k]] for key, rows in found.items()}
    by_shard = brute_force(asked, items, k, bool(overall))
    expected = {}
    for (q, _), rows in by_shard.items():
        expected.setdefault((q, None), []).extend(rows)
    expected = {key: sorted(rows, key=lambda r: (-r[1], r[0]))[: overall or k] for key, rows in expected.items()}
    assert found == expected
    assert kept and sum(kept) < len(asked) * len(items) / 4


def test_vectors_are_packed_by_their_values(spark):
    vectors = [[1.0, 255.0, 0.0], [0.5, 1.0, 2.0], [256.0, 0.0, 1.0], [-1.0, 0.0, 0.0], [0.0] * 3, None, [], [float("nan")] * 3, [1.0, None, 2.0], [7.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>").coalesce(1).orderBy("i")
    rows = df.select(N.packed("v").alias("p")).toArrow()["p"]
    assert [None if p is None else len(p) for p in rows.to_pylist()] == [4, 13, 13, 13, None, None, None, None, None, 2]
    usable = N.Vectors.of(rows, np.arange(len(vectors)))
    assert usable.rows.tolist() == [0, 1, 2, 3] and usable.stored.tolist() == vectors[:4]
    small = N.Vectors.of(rows.slice(0, 1), np.arange(1))
    assert small.stored.dtype == np.uint8 and small.stored.tolist() == [[1, 255, 0]] and small.norms.tolist() == [255.0**2 + 1]


def test_many_small_questions_travel_to_the_items(spark):
    """60,000 questions of word counts are 126 MB as doubles, and 19 MB packed: no item is copied to a grid."""
    count = F.transform(F.sequence(F.lit(1), F.lit(256)), lambda i: ((F.col("id") * i) % 7 == 0).cast("float"))
    asked = spark.range(1, 60_001).select(F.col("id").alias("qid"), count.alias("vector"))
    things = spark.createDataFrame(random_items(10, 256, 1, whole=True), SCHEMA).repartition(20)
    found = N.nearest_candidates(asked, things, 1, asked_keys=["qid"], item_keys=["id"], dim=256)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan and "Coalesce" in plan


def test_questions_without_direction_take_no_room(spark):
    """A great many questions that nothing can match do not lead to a grid for the few that something can."""
    vector = F.when(F.col("id") < 5, F.array(F.lit(1.0), F.col("id") + 1.0)).otherwise(F.array(F.lit(0.0), F.lit(0.0))).cast("array<float>")
    asked = spark.range(20_000).select(F.col("id").alias("qid"), vector.alias("vector"))
    things = spark.createDataFrame(random_items(40, 2, 1), SCHEMA)
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    found = N.nearest_candidates(asked, things, 1, broadcast_bytes=1_000, **keys)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert {r.qid for r in found.collect()} == set(range(5))


@pytest.mark.parametrize("lanes", [1, 10**9])
def test_a_task_hands_on_what_no_other_shard_beats(monkeypatch, lanes):
    """One best of all shards is wanted: a row per question leaves the task, and not one per question and shard."""
    monkeypatch.setattr(N, "LANE_QUESTIONS", lanes)
    items = [(i, [float(i % 7 + 1), float(i % 5), float(i % 3 + 2), 1.0], i % 4) for i in range(105)]
    batch = N.pa.RecordBatch.from_pydict({"id": [i for i, *_ in items], "shard": [s for *_, s in items], "_vector": N.pa.array([v for _, v, _ in items], N.pa.list_(N.pa.float32()))})
    questions = N.pa.table({"qid": list(range(30)), "_vector": N.pa.array([v for _, v, _ in items[:30]], N.pa.list_(N.pa.float32()))})
    rows = N._search([batch], questions, N.Search(1, ("qid",), ("id",), (), "shard", True, 1)).to_pylist()
    assert sorted((r["qid"], r["id"]) for r in rows) == [(i, i) for i in range(30)]


def test_many_questions_are_searched_by_a_task_per_core(spark):
    """Every task hands on a row per question, so more tasks than cores only move more rows."""
    vector = F.array(*[F.col("id") % p for p in (2, 3, 5)]).cast("array<float>")
    things = spark.createDataFrame(random_items(200, 3, 1, whole=True), SCHEMA).repartition(40)
    keys = dict(asked_keys=["qid"], item_keys=["id"])
    parts = [N.nearest_candidates(spark.range(1, n).select(F.col("id").alias("qid"), vector.alias("vector")), things, 1, **keys).rdd.getNumPartitions() for n in (50, 20_000)]
    assert parts == [40, spark.sparkContext.defaultParallelism]
