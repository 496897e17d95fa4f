import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ranking

SCHEMA = "id bigint, factors array<float>"


def frame(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)], SCHEMA)


def brute(queries, items, k, first=0):
    out = {}
    for i, q in enumerate(np.asarray(queries, np.float32).astype(float)):
        scored = []
        for j, c in enumerate(np.asarray(items, np.float32).astype(float)):
            total = 0.0
            for a, b in zip(q, c):
                total += a * b
            scored.append((-total, first + j))
        out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, []).append((r.similarId, r.score))
    return {i: sorted(v, key=lambda p: (-p[1], p[0])) for i, v in out.items()}


@pytest.fixture
def small_cells(monkeypatch):
    """Cells of a few vectors, and so grids of several rows and columns."""
    for name, value in dict(CELL_BYTES=120, QUERY_BLOCK=3, CANDIDATE_BLOCK=4, GROUP_ROWS=40).items():
        monkeypatch.setattr(ranking, name, value)


@pytest.mark.parametrize("k", [1, 5, 40])
def test_top_items_equals_brute_force(spark, k):
    rng = np.random.default_rng(k)
    q, c = rng.normal(size=(20, 6)), rng.normal(size=(35, 6))
    assert lists(ranking.top_items(frame(spark, q), frame(spark, c), k)) == brute(q, c, k)


def test_grid_of_cells_equals_brute_force(spark, small_cells):
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(30, 5)), rng.normal(size=(45, 5)) * rng.lognormal(0, 2, size=(45, 1))
    assert lists(ranking.top_items(frame(spark, q), frame(spark, c), 6)) == brute(q, c, 6)


def test_grid_shapes():
    shape = lambda nq, nc, cores: ranking._grid_shape(ranking.Sizes(nq, nc, 200), 100, cores)
    side = ranking._cell_side(200)
    assert shape(2000, 2000, 8) == (1, 1) and shape(0, 5, 8) == (1, 1)
    assert shape(50_000, 50_000, 8) == (16, 1)          # work for all cores, nothing to merge
    for nq, nc, cores in ((10**9, 10**7, 8000), (10**6, 10**6, 8000), (10**7, 1000, 8000)):
        rows, columns = shape(nq, nc, cores)
        assert rows * columns >= min(2 * cores, nq * nc // ranking.MIN_PAIRS)
        assert nq / rows <= side and nc / columns <= side
        assert nq * columns + nc * rows <= 8 * (nq * nc * rows * columns) ** 0.5 or columns == 1
    for nq, nc in ((10**8, 10**4), (1_600_000, 1_600_000)):
        rows, columns = ranking._grid_shape(ranking.Sizes(nq, nc, 10), 100, 8)
        assert nq * nc / (rows * columns) <= 1.01 * ranking.TASK_PAIRS
        assert nq / rows * 100 * ranking.RESULT_BYTES <= ranking.CELL_BYTES


def test_vectors_of_different_lengths_are_an_error(spark):
    for bad in ([1.0], None):
        rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "id bigint, factors array<float>")
        with pytest.raises(Exception, match="different lengths"):
            ranking.top_items(rows, rows, 2).collect()


def test_many_equal_vectors_break_ties_by_id(spark, small_cells):
    c = np.ones((40, 3))
    c[30:] = 0
    q = np.vstack([np.ones((5, 3)), np.zeros((2, 3)), -np.ones((2, 3))])
    assert lists(ranking.top_items(frame(spark, q), frame(spark, c), 4)) == brute(q, c, 4)


def test_block_pruning_is_exact():
    rng = np.random.default_rng(9)
    items = (rng.normal(size=(500, 8)) * rng.lognormal(0, 3, size=(500, 1))).astype(np.float32)
    norms = np.linalg.norm(items, axis=1)
    order = np.argsort(-norms)
    queries = rng.normal(size=(50, 8)).astype(np.float32)
    ids, similar, _ = ranking.best_of_block(
        np.arange(50), queries, np.arange(500)[order], items[order], norms[order], 10)
    exact = queries.astype(float) @ items.T.astype(float)
    for i in range(50):
        assert set(similar[ids == i]) == set(np.argsort(-exact[i])[:10])


def test_similar_items_drop_self_and_non_positive_after_the_limit(spark):
    items = frame(spark, [[1, 0], [0.9, 0.1], [0, 1], [-1, 0]])
    got = lists(ranking.similar_items(items, items, 2))
    assert [j for j, _ in got[0]] == [1]           # itself took one of the two places
    assert [j for j, _ in got[2]] == [1]
    assert 3 not in {j for v in got.values() for j, _ in v if v}


def test_empty_sides(spark):
    some, none = frame(spark, [[1.0]]), spark.createDataFrame([], SCHEMA)
    assert ranking.top_items(some, none, 3).count() == ranking.top_items(none, some, 3).count() == 0
    assert ranking.approx_top_items(some, none, 3).count() == 0


def recall_of(spark, items, ids, k=20, **settings):
    """Share of the true best k of some items that the index finds, and the share of pairs it scores; never by the exact way."""
    queries = spark.createDataFrame([(int(i), items[i].tolist()) for i in ids], SCHEMA)
    found = lists(ranking.approx_top_items(queries, frame(spark, items), k, exact_above=1.0, **settings))
    scores = items[ids].astype(float) @ items.astype(float).T
    hits = 0
    for row, i in zip(scores, ids):
        best = np.argsort(-row, kind="stable")[:k]
        hits += len({j for j, _ in found[int(i)]} & set(best.tolist()))
        assert all(math.isclose(s, row[j], abs_tol=1e-6) for j, s in found[int(i)])
    return hits / (k * len(ids))


@pytest.mark.parametrize("kind", ["even", "clusters", "norms"])
@pytest.mark.parametrize("n", [2_000, 50_000])
def test_the_index_finds_nine_in_ten(spark, n, kind):
    """For every hundredth item, on vectors without any structure, in clusters, and of very different lengths."""
    rng = np.random.default_rng(5)
    items = rng.normal(size=(n, 32)).astype(np.float32)
    if kind == "clusters":
        items = items * 0.3 + 2 * rng.normal(size=(n // 50, 32)).astype(np.float32)[rng.integers(0, n // 50, n)]
    elif kind == "norms":
        items *= rng.lognormal(0, 0.7, (n, 1)).astype(np.float32)
    assert recall_of(spark, items, np.arange(0, n, 100)) >= 0.9


def test_the_index_visits_few_cells_where_vectors_have_structure(spark):
    rng = np.random.default_rng(5)
    items = np.repeat(rng.normal(size=(200, 16)) * 3, 100, axis=0) + rng.normal(size=(20_000, 16)) * 0.2
    df = frame(spark, items)
    centres = ranking._centres(ranking._augmented(ranking._sample(df, 5_000)[1], 30.0), 100, 1)
    probes, share = ranking._measured_probes(df, df, ranking._cell_assigner(centres, 1, 30.0), centres, 20, 0.95)
    assert probes <= 10 and share < 0.15


def test_search_is_exact_where_the_index_saves_nothing(spark):
    rng = np.random.default_rng(7)
    items = rng.normal(size=(900, 24)).astype(np.float32)
    got = lists(ranking.approx_top_items(frame(spark, items[:50]), frame(spark, items), 10))
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in brute(items[:50], items, 10).items()}


def test_index_with_a_hot_cell(spark, small_cells):
    """A third of all candidates are copies of one vector, so one cell is far above its limit."""
    rng = np.random.default_rng(6)
    items = np.vstack([np.tile([2.0, 2.0, 2.0], (60, 1)), rng.normal(size=(120, 3))])
    found = lists(ranking.approx_top_items(frame(spark, items[:3]), frame(spark, items), 8, recall=1.0, leaf_size=10, exact_above=1.0))
    assert {i: [j for j, _ in v] for i, v in found.items()} == {
        i: [j for j, _ in v] for i, v in brute(items[:3], items, 8).items()}


def test_index_of_odd_vectors(spark):
    zero = frame(spark, [[0.0, 0.0]] * 5)
    assert {i: len(v) for i, v in lists(ranking.approx_top_items(zero, zero, 3, leaf_size=2, exact_above=1.0)).items()} == dict.fromkeys(range(5), 3)
    some, none = frame(spark, [[1.0, 0.0], [0.0, 1.0]]), spark.createDataFrame([], SCHEMA)
    assert ranking.approx_top_items(none, some, 3, exact_above=1.0).count() == 0


def test_user_vectors_and_brands(spark, as_rows):
    vectors = frame(spark, [[1, 2], [3, 4]])
    wanted = spark.createDataFrame([(1,), (1,), (7,)], "id bigint")
    assert as_rows(ranking.user_vectors(vectors, wanted), "id", "vectorSize") == [(1, 2)]
    top = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (1, 13), (2, 99)], "id bigint, similarId bigint")
    brands = spark.createDataFrame([(10, "b"), (11, "b"), (12, "a"), (13, None)], "productId bigint, brand string")
    assert as_rows(ranking.user_top_brands(top, brands)) == [(1, "a", 1), (1, "b", 2)]
    assert as_rows(ranking.user_top_brands(top, brands, 1)) == [(1, "b", 2)]
