"""Hard negatives of anchors, by Strassen products of integer tiles and mergeable top-k lists.

Anchors and candidates are cut into tiles of whole numbers. A tile of anchors times a tile of candidates is multiplied by
Strassen's recursion (seven half-size products instead of eight) after padding with zeros to a size that halves as
often as needed. In int64 every addition and product is exact modulo 2^64, so the result is exact whenever the score
itself fits in 63 bits, whatever the sums in between do; tiles whose scores may not fit are multiplied by the same
recursion over Python's unbounded integers. A positive's score that does not fit in a long is an error (the result could
not hold it).

Two passes over (anchor group, candidate group) cells, each a task that walks its candidate tiles:

1. positives: the ``positives`` best rows of the anchor's own label;
2. negatives: for every positive of score s the ``negatives`` best rows of another label with score in [80 % of s, s].

A list of k best is kept per anchor (or per anchor and positive) and merged with every tile's; the lists of the cells
are merged the same way by Spark (a top-k per key, cut to k rows in every map task before the shuffle). A cell holds at
most ``ANCHORS`` anchors and ``ROWS`` candidates, dealt by row number, so no label, vector or id makes a large task.
All anchors meet all rows, in blocks: the anchors are the stated query set.

Rows: a null id or label, a null vector, and a null or not finite component take a row out; shorter vectors are read as
if filled with zeros; rows that share an id are rows of their own, but an anchor never meets a row of its own id; ties
go to the smaller id; an anchor without positives, or a positive without negatives, has no row; an empty table gives no
row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import staged

POSITIVES = 5
NEGATIVES = 5
#: The window of a positive's score that a negative's must lie in, in percent.
LEAST_PERCENT, MOST_PERCENT = 80, 100
SCALE = 256.0
ANCHORS = 512
ROWS = 8192
TILE = 1024
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b by Strassen's recursion down to products with a side of at most ``leaf``; padded with zeros as needed."""
    m, d, n = a.shape[0], a.shape[1], b.shape[1]
    levels = 0
    while min(m, d, n) >> levels > leaf:
        levels += 1
    if not levels:
        return a @ b
    step = 1 << levels

    def padded(x: np.ndarray) -> np.ndarray:
        out = np.zeros([-(-side // step) * step for side in x.shape], dtype=x.dtype)
        out[: x.shape[0], : x.shape[1]] = x
        return out

    return product(padded(a), padded(b), levels)[:m, :n]


def product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, d, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :n], b[:d, n:], b[d:, :n], b[d:, n:]
    p1 = product(a11 + a22, b11 + b22, levels - 1)
    p2 = product(a21 + a22, b11, levels - 1)
    p3 = product(a11, b12 - b22, levels - 1)
    p4 = product(a22, b21 - b11, levels - 1)
    p5 = product(a11 + a12, b22, levels - 1)
    p6 = product(a21 - a11, b11 + b12, levels - 1)
    p7 = product(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((2 * m, 2 * n), dtype=a.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def matrix(vectors, dim: int) -> np.ndarray:
    """Rows of whole doubles, filled with zeros; Python integers where a component is beyond int64."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    if len(out) and np.abs(out).max(initial=0) >= 2.0**62:
        return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)
    return out.astype(np.int64)


def scores(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products of all anchors with all rows as int64, and which of them int64 can hold."""
    largest = lambda x: max(1, int(np.abs(x).max(initial=0)))
    if largest(anchors) * largest(rows) * max(1, anchors.shape[1]) < 1 << 63:
        whole = strassen(anchors.astype(np.int64), rows.astype(np.int64).T)
        return whole, np.ones(whole.shape, dtype=bool)
    exact = strassen(anchors.astype(object), rows.astype(object).T)
    fits = ((exact < 1 << 63) & (exact >= -(1 << 63))).astype(bool)
    return np.where(fits, exact, 0).astype(np.int64), fits


class BestLists:
    """The k best (score, id) of each of n owners; lists merge with any further ones."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.owner, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)  # the k-th best score so far: less cannot enter

    def add(self, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """score: owners x rows; allowed: which of them count."""
        allowed = allowed & (score >= self.least[:, None])
        k = self.k
        if score.shape[1] > 4 * k:  # rows below the k-th best allowed one of this tile go at once
            low = np.iinfo(np.int64).min
            edge = np.partition(np.where(allowed, score, low), score.shape[1] - k, axis=1)[:, score.shape[1] - k]
            allowed &= score >= edge[:, None]
        at, col = np.nonzero(allowed)
        self.merge(at, score[at, col], ids[col])

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        owner = np.concatenate([self.owner, owner])
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        # ~score falls as score rises, without the overflow that -score has at the least int64.
        order = np.lexsort((ids, ~score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = place < self.k
        self.owner, self.score, self.id = owner[keep], score[keep], ids[keep]
        full = place == self.k - 1
        self.least[owner[full]] = score[full]


def window(positive: np.ndarray) -> np.ndarray:
    """The least score of a negative for each positive's score: 80 * positive <= 100 * negative, in whole numbers."""
    return np.array([-((-LEAST_PERCENT * int(s)) // MOST_PERCENT) for s in positive], dtype=object).clip(
        -(1 << 63), (1 << 63) - 1
    ).astype(np.int64)


def tiles(rows: pd.DataFrame, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels, vectors of at most TILE rows."""
    for at in range(0, len(rows), TILE):
        part = rows.iloc[at : at + TILE]
        yield part["c_vec_id"].to_numpy(np.int64), part["c_label"].to_numpy(np.int64), matrix(part["c_x"].tolist(), dim)


def whole(embedding: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component as double; null for vectors that take no part."""
    doubles = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Spark's floor gives a long; a double beyond 2^53 has no fraction to cut.
    floors = F.transform(
        doubles,
        lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale),
    )
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)), floors)


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """rows: vec_id, label, x (array of whole doubles); anchors: which rows are anchors.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    usable = rows.filter("vec_id is not null and label is not null and x is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "x",
        anchors.alias("anchor"),
    )
    # Each row's number is fixed once written; groups of rows are dealt by it.
    numbered = staged(usable.withColumn("row", F.monotonically_increasing_id()), "negative-rows")
    facts = numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("x")).alias("dim")
    ).first()
    dim = int(facts["dim"] or 0)
    row_groups = max(1, -(-int(facts["rows"]) // ROWS))
    anchor_groups = max(1, -(-int(facts["anchors"]) // ANCHORS))
    dealt = F.pmod(F.xxhash64("row"), F.lit(row_groups)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = numbered.select(
        F.col("vec_id").alias("c_vec_id"), F.col("label").alias("c_label"), F.col("x").alias("c_x"), dealt.alias("c_c"),
        every(anchor_groups).alias("c_a"),
    )
    asked = numbered.filter("anchor").withColumn("a", F.pmod(F.xxhash64("row"), F.lit(anchor_groups)).cast("int"))

    def cells(asking: DataFrame, run, schema: str) -> DataFrame:
        per_cell = asking.withColumn("c", every(row_groups)).groupBy("a", "c")
        return per_cell.cogroup(candidates.groupBy("c_a", "c_c")).applyInPandas(run, schema)

    def best_positives(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        ids, labels = asking["vec_id"].to_numpy(np.int64), asking["label"].to_numpy(np.int64)
        best, x = BestLists(len(ids), positives), matrix(asking["x"].tolist(), dim)
        for other, kinds, y in tiles(block, dim) if len(ids) else ():
            alike = (labels[:, None] == kinds[None, :]) & (ids[:, None] != other[None, :])
            score, fits = scores(x, y)
            if (alike & ~fits).any():
                raise OverflowError("the inner product of two rows of one label does not fit in a long")
            best.add(score, alike, other)
        owner = asking["row"].to_numpy(np.int64)[best.owner]
        return pd.DataFrame({"row": owner, "positive_id": best.id, "positive_score": best.score})

    def best_negatives(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        ids, labels = asking["vec_id"].to_numpy(np.int64), asking["label"].to_numpy(np.int64)
        x = matrix(asking["x"].tolist(), dim)
        sizes = asking["windows"].map(len).to_numpy(np.int64) if len(asking) else np.zeros(0, np.int64)
        held = [w for ws in asking["windows"] for w in ws]
        most = np.array([w["positive_score"] for w in held], dtype=np.int64)
        least, owner = window(most), np.repeat(np.arange(len(ids)), sizes)
        best = BestLists(len(owner), negatives)
        for other, kinds, y in tiles(block, dim) if len(owner) else ():
            each, fits = scores(x, y)
            # What does not fit in a long lies outside every window.
            unlike = fits & (labels[:, None] != kinds[None, :]) & (ids[:, None] != other[None, :])
            score = each[owner]
            best.add(score, unlike[owner] & (score <= most[:, None]) & (score >= least[:, None]), other)
        of = owner[best.owner]
        place = np.array([w["place"] for w in held], dtype=np.int64)[best.owner]
        return pd.DataFrame(
            {"row": asking["row"].to_numpy(np.int64)[of], "place": place, "negative_id": best.id, "negative_score": best.score}
        )

    def merged(found: DataFrame, keys: list[str], kind: str, k: int, rank: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.col(f"{kind}_score").desc(), F.col(f"{kind}_id").asc())
        return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)

    found = cells(asked, best_positives, "row long, positive_id long, positive_score long")
    firsts = staged(merged(found, ["row"], "positive", positives, "place"), "negative-positives")
    # At most ``positives`` entries an anchor.
    windows = firsts.groupBy("row").agg(F.collect_list(F.struct("place", "positive_score")).alias("windows"))
    found = cells(asked.join(windows, "row"), best_negatives, "row long, place long, negative_id long, negative_score long")
    lists = merged(found, ["row", "place"], "negative", negatives, "rank")
    names = asked.select("row", F.col("vec_id").alias("anchor_id"))
    return (
        lists.join(firsts, ["row", "place"]).join(names, "row")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
