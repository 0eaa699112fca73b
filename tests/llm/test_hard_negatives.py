import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import hard_negatives as hn


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (16, 16, 16), (33, 64, 129), (70, 5, 70)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_strassen_is_exact(shape, leaf):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-1000, 1000, shape[:2]), rng.integers(-1000, 1000, shape[1:])
    assert (hn.strassen(a, b, leaf) == a @ b).all()
    big = a.astype(object) * 2**70
    assert (hn.strassen(big, b.astype(object), leaf) == big @ b.astype(object)).all()


def test_sums_in_between_may_wrap():
    """The recursion's sums pass 2^63 although every score fits."""
    a = np.array([[2**61, 2**61], [2**61, 2**61]])
    b = np.array([[1, -1], [-1, 1]])
    got, fits = hn.scores(a, b)
    assert (got == 0).all() and fits.all()
    got, fits = hn.scores(a, np.array([[2, 1], [2, 2]]))
    assert got.tolist() == [[3 << 61, 0]] * 2 and fits.tolist() == [[True, False]] * 2


def brute(rows, every, positives=5, negatives=5):
    """rows: (vec_id, label, x) of usable rows."""
    dim = max((len(x) for _, _, x in rows), default=0)
    wide = [(i, k, [*x, *[0] * (dim - len(x))]) for i, k, x in rows]
    out = []
    for a, label, x in wide:
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, k) for i, k, y in wide if i != a]
        for s, p, _ in sorted(t for t in scored if t[2] == label)[:positives]:
            near = sorted(t for t in scored if t[2] != label and -80 * s <= -100 * t[0] <= -100 * s)[:negatives]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, every, ddl="vec_id long, label long, x array<double>"):
    frame = spark.createDataFrame(rows, ddl).repartition(3)
    got = hn.mine(frame, F.col("vec_id") % every == 0).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("seed,cell", [(1, 8192), (2, 16), (3, 50)])
def test_mine_matches_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(hn, "ROWS", cell)
    monkeypatch.setattr(hn, "ANCHORS", max(2, cell // 8))
    monkeypatch.setattr(hn, "TILE", 7)
    rng = np.random.default_rng(seed)
    centers = rng.integers(-20, 60, (4, 6))
    rows = [(i, int(rng.integers(0, 3)), (centers[i % 4] + rng.integers(-9, 9, 6)).tolist()) for i in range(160)]
    rows += [(200 + i, i % 2, rows[5][2]) for i in range(50)]  # many equal vectors
    rows += [(300, 1, []), (305, 0, [9]), (310, 2, [0] * 6)]
    as_floats = [(i, k, [float(v) for v in x]) for i, k, x in rows]
    assert mined(spark, as_floats, 5) == brute(rows, 5)


def test_nulls_repeats_large_and_empty(spark):
    big = float(2**40)
    rows = [(0, 1, [big, 1.0]), (1, 1, [big / 2**20, 0.0]), (2, 0, [big / 2**20, -5.0]), (3, None, [1.0, 1.0]),
            (None, 1, [1.0, 1.0]), (4, 0, None), (2, 0, [big / 2**20, -5.0])]
    usable = [(i, k, [int(v) for v in x]) for i, k, x in rows if None not in (i, k, x)]
    assert mined(spark, rows, 10) == brute(usable, 10)
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, 1, [1.0])], 10) == []


def test_whole(spark):
    rows = [(1, [0.5, -0.001]), (2, [None]), (3, [float("nan")]), (4, [float("inf")]), (5, None), (6, []), (7, [3e38])]
    got = {r.i: r.w for r in spark.createDataFrame(rows, "i int, x array<float>").select("i", hn.whole(F.col("x")).alias("w")).collect()}
    assert got[1] == [128.0, -1.0] and got[6] == [] and [got[i] for i in (2, 3, 4, 5)] == [None] * 4
    assert got[7] == [256 * float(np.float32(3e38))]
