import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import multi_index, topk
from skytally.llm.multi_index import visited_cells
from skytally.llm.queries import op2_multi_index, op6_exact_top_k
from skytally.llm.topk import SortedLists, top_of_block
from tests.conftest import SF_DIR

NAN, INF = float("nan"), float("inf")


def usable(rows, zeros):
    return {
        i: v for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zeros or any(v))
    }


def brute_force(vectors, asked, k, score):
    out = {}
    for q in vectors:
        if asked(q):
            found = sorted((-score(vectors[q], v), i) for i, v in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return {q: f for q, f in out.items() if f}


def listed(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        assert r["rank"] == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def inner(a, b):
    return float(np.dot(a, b))


def whole(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def table(spark, rows):
    return spark.createDataFrame(
        [(i, v and [x if x is None else float(x) for x in v], 1.0, 1) for i, v in rows],
        "vec_id long, embedding array<double>, score double, id int",
    )


@pytest.fixture
def odd_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-8, 9, 6).astype(float).tolist()) for i in range(300)]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows]
    rows += [(i, [1.0, 0, 2, 0, 0, 0]) for i in range(300, 420)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None, 0, 0, 0, 0]), (None, [1.0] * 6)]
    rows += [(504, [NAN] * 6), (505, [INF, 1, 1, 1, 1, 1]), (506, [1.0, 2.0])]
    return rows


def test_cells_come_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(5)
    counts = rng.integers(0, 4, 35)
    sums = (a[:, None] + b).ravel()
    order = [c for c in sums.argsort() if counts[c]]
    assert visited_cells(a, b, counts, 10**6).tolist() == order
    some = visited_cells(a, b, counts, 12)
    assert some.tolist() == order[: len(some)]
    assert counts[some].sum() >= 12 > counts[some[:-1]].sum()


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    points, queries = (rng.integers(-50, 50, (n, 9)).astype(float) for n in (200, 20))
    lists, exact = SortedLists(points), queries @ points.T
    before = None
    for depth in (1, 20, 100, 200):
        lower, upper = lists.bounds(queries, depth)
        assert (lower <= exact).all() and (exact <= upper).all()
        if before:
            assert (lower >= before[0]).all() and (upper <= before[1]).all()
        before = lower, upper
    assert (before[0] == exact).all() and (before[1] == exact).all()


def test_block_top():
    rng = np.random.default_rng(3)
    points = rng.integers(-3, 4, (500, 5)).astype(float)
    ids = rng.permutation(500)
    q, v, s = top_of_block(points, ids, points[:9], ids[:9], 5, few=4)
    for number in range(9):
        all_ = sorted((-(p @ points[number]), i) for p, i in zip(points, ids) if i != ids[number])
        mine = q == ids[number]
        assert list(zip(-s[mine], v[mine])) == all_[:5]


@pytest.mark.parametrize("block", [10_000, 37])
def test_searches_on_odd_rows(spark, monkeypatch, odd_rows, block):
    for module in (multi_index, topk):
        monkeypatch.setattr(module, "_BLOCK", block)
    monkeypatch.setattr(topk, "_SLICE", 7)
    frame = table(spark, odd_rows)
    got = listed(multi_index.search(frame, F.col("vec_id") % 20 == 0, centroids=5, visit=1.0).collect())
    good = {i: v for i, v in usable(odd_rows, False).items() if len(v) == 6}
    assert got == brute_force(good, lambda i: i % 20 == 0, 20, inner)
    good = {i: v for i, v in usable(odd_rows, True).items() if len(v) == 6}
    got = listed(topk.search(frame, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_force(good, lambda i: i % 50 == 0, 5, whole)


def test_few_rows(spark):
    for search, k, score in ((multi_index.search, 20, inner), (topk.search, 5, whole)):
        rows = [(0, [1.0, 2.0]), (100, [2.0, 1.0]), (3, [0.5, 0.5])]
        got = listed(search(table(spark, rows), F.col("vec_id") % 50 == 0).collect())
        assert got == brute_force(dict(rows), lambda i: i % 50 == 0, k, score)
        assert search(table(spark, rows).limit(0), F.col("vec_id") % 50 == 0).count() == 0
        assert search(table(spark, rows[:1]), F.col("vec_id") % 50 == 0).count() == 0
        twice = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0])]
        assert len(listed(search(table(spark, twice), F.col("vec_id") == 0).collect())[0]) == 1


def test_large_numbers(spark):
    rows = [(0, [1e6, 3.0]), (1, [1e6, 2.0]), (2, [-1e6, 2.5]), (3, [1e30, 1.0])]
    got = listed(topk.search(table(spark, rows), F.col("vec_id") == 0).collect())
    assert got[0][0][0] == 3 and got[0][1:] == [(i, whole(rows[0][1], rows[i][1])) for i in (1, 2)]


def test_whole_table(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    vectors = dict(frame.select("vec_id", "embedding").collect())
    expected = brute_force(vectors, lambda i: i % 50 == 0, 5, whole)
    assert listed(op6_exact_top_k(spark, SF_DIR).collect()) == expected

    got = listed(op2_multi_index(spark, SF_DIR).collect())
    expected = brute_force(vectors, lambda i: i % 20 == 0, 20, inner)
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in got)
    assert hits / (20 * len(got)) >= 0.9
    for q, own in got.items():
        assert len(own) == 20 and q not in dict(own)
        for i, score in own:
            assert abs(score - math.fsum(x * y for x, y in zip(vectors[q], vectors[i]))) < 1e-12


def test_recall_on_a_larger_table(spark):
    frame = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").toPandas()
    points, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = listed(op2_multi_index(spark, SF_DIR.replace("0.001", "0.1")).collect())
    hits = 0
    for q, own in got.items():
        scores = points @ points[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({i for i, _ in own} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert len(got) == (ids % 20 == 0).sum() and hits / (20 * len(got)) >= 0.9
