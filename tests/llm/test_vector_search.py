import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import vector_search as vs


def brute(rows, queries, k):
    out = []
    dim = max((len(x) for _, x in rows), default=0)
    wide = [(i, np.array([*x, *[0] * (dim - len(x))], dtype=object)) for i, x in rows]
    for q, qx in wide:
        if q not in queries:
            continue
        found = sorted((-int((qx * x).sum()) if dim else 0, i) for i, x in wide if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def searched(spark, rows, k, **options):
    frame = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in rows], "vec_id long, x array<double>").repartition(3)
    index = vs.build(frame, pivots=options.get("pivots", 4), block=options.get("block", 16))
    found = vs.search(index, frame.filter("vec_id % 5 = 0"), k, group=options.get("group", 7))
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("seed,block", [(1, 16), (2, 5), (3, 1000)])
def test_search_matches_brute_force(spark, seed, block):
    rng = np.random.default_rng(seed)
    centers = rng.integers(-60, 60, (5, 6))
    rows = [(i, (centers[i % 5] + rng.integers(-5, 6, 6)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # many equal vectors
    rows += [(300, [0] * 6), (305, [9]), (310, []), (315, [-100, 3])]
    queries = {i for i, _ in rows if i % 5 == 0}
    assert searched(spark, rows, 8, block=block) == brute(rows, queries, 8)


def brute_rows(rows, picked, k):
    """Each row of picked is a query of its own; ids may repeat."""
    out = []
    for q, qx in picked:
        found = sorted((-sum(a * b for a, b in zip(qx, x)), i) for i, x in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 16, 1000])
def test_repeated_rows_as_queries(spark, block):
    rng = np.random.default_rng(block)
    rows = [(i, rng.integers(-40, 41, 4).tolist()) for i in range(80)]
    rows += [rows[5], rows[10], rows[10]]  # the same row twice and three times
    rows += [(15, rng.integers(-40, 41, 4).tolist()), (20, [-v for v in rows[20][1]])]  # other vectors under one id
    rows += [rows[7]] * 3  # a candidate several times
    picked = [r for r in rows if r[0] % 5 == 0]
    assert searched(spark, rows, 8, block=block) == brute_rows(rows, picked, 8)


def test_few_candidates_and_none(spark):
    rows = [(0, [1, 2]), (5, [3, 4]), (7, [-1, 0])]
    assert searched(spark, rows, 20) == brute(rows, {0, 5}, 20)
    assert searched(spark, [(0, [1, 2])], 20) == []
    assert searched(spark, [], 20) == []


def test_annuli_are_pruned(spark):
    """Far clusters are not looked at."""
    rng = np.random.default_rng(4)
    centers = rng.integers(-2000, 2000, (12, 4))
    rows = [(i, (centers[i % 12] + rng.integers(-3, 4, 4)).tolist()) for i in range(600)]
    frame = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in rows], "vec_id long, x array<double>")
    index = vs.build(frame, pivots=24, block=16)
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in vs.search(index, frame.filter("vec_id % 20 = 0"), 5).collect())
    assert found == brute(rows, {i for i, _ in rows if i % 20 == 0}, 5)


def test_vectors_that_take_no_part(spark):
    cells = [[0.5, -0.01], None, [1.0, None], [math.nan, 1.0], [math.inf, 1.0], [], [0.999, 1.0]]
    frame = spark.createDataFrame(list(enumerate(cells)), "vec_id long, embedding array<float>")
    got = {r.vec_id: r.x for r in frame.select("vec_id", vs.whole(F.col("embedding")).alias("x")).collect()}
    assert got == {0: [32.0, -1.0], 1: None, 2: None, 3: None, 4: None, 5: [], 6: [63.0, 64.0]}


@pytest.mark.parametrize("size", [1 << 21, (1 << 27) + 1, (1 << 30) - 1])
def test_large_components_are_scored_exactly(spark, size):
    """Scores up to 2^62 that differ in their last digits only."""
    rng = np.random.default_rng(size % 97)
    rows = [(i, [size - int(rng.integers(0, 3)), int(rng.integers(-2, 3)), size if i % 3 else -size, 1]) for i in range(60)]
    queries = {i for i, _ in rows if i % 5 == 0}
    assert searched(spark, rows, 6, block=8) == brute(rows, queries, 6)


def test_a_score_beyond_a_long_is_an_error(spark):
    big = [(i, [float(1 << 40), 1.0]) for i in (0, 1)]
    with pytest.raises(Exception, match="does not fit in a long"):
        frame = spark.createDataFrame(big, "vec_id long, x array<double>")
        vs.search(vs.build(frame), frame.filter("vec_id = 0"), 3).collect()
