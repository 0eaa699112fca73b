"""Exact top-k by inner product over a pivot-distance index.

Vectors of whole numbers get one more component, sqrt(M - |x|^2) with M the largest |x|^2; a query gets 0. Then

    d(q, x)^2 = |q|^2 + M - 2 <q, x>

so the largest inner products are the nearest vectors, and distances obey the triangle inequality. Each vector is keyed
by its nearest pivot p and r = d(x, p); vectors sorted by that key are cut into annuli of at most ``block`` vectors,
each a pivot and a range of r.

A query starts in the annuli its own place in the index falls in: its k-th best score there bounds the k-th best of
all from below, and gives a radius R with d(q, x) <= R for every vector that can still matter. The search widens to the
annuli that the triangle inequality leaves, |d(q, p) - r| <= R for some r of the annulus, found by a join of the
queries' distances to the pivots with the annuli on the pivot; an annulus's vectors are scored against the queries
that reach it as one matrix product. Nothing else is looked at, and nothing it leaves out could have been in the
result (bounds are widened by the rounding error).

The index is fitted on at most ``pivots`` vectors (the least hashes of their ids) and holds every vector. Queries of
an annulus are dealt out in groups, so neither a hot vector nor a hot annulus makes a large task.

Rows: a vector that is null, or holds a null or a component that is not finite, takes no part; shorter vectors are
read as if filled with zeros (an empty one scores 0 everywhere); rows that share an id are rows of their own, also as
queries, each with its own list of k, but no query meets a row of its own id; ties go to the smaller id; queries without a candidate have no row; extra columns are
ignored. Scores are exact for all finite vectors: products of doubles while no |x|^2 passes 2^53, beyond that whole
numbers in int64 or, where needed, without bound (``hard_negatives.scores``). Distances then only choose the annuli, with
a slack far above their rounding. A score among the k best that does not fit in a long is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import arrow_rows, staged
from keelson.llm.hard_negatives import matrix as matrix_of_integers
from keelson.llm.hard_negatives import scores as integer_scores

K = 20
PIVOTS = 32
BLOCK = 2048
QUERY_GROUP = 1024
SCALE = 64.0
#: Up to here every sum of products of whole doubles is exact.
EXACT = float(1 << 53)
LOWEST = -(1 << 63)
INDEX = pa.schema(
    [
        ("annulus", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()),
        ("ids", pa.binary()), ("vectors", pa.binary()), ("dim", pa.int32()),
    ]
)
INDEX_DDL = "annulus long, pivot int, low double, high double, ids binary, vectors binary, dim int"


def whole(embedding: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component as double; null for vectors that take no part."""
    doubles = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Spark's floor gives a long; a double beyond 2^53 has no fraction to cut.
    floors = F.transform(
        doubles, lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale)
    )
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)), floors)


def matrix(vectors: Iterable, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def lifted(x: np.ndarray, m: float) -> np.ndarray:
    return np.sqrt(np.maximum(m - (x * x).sum(axis=1), 0.0))


def distances(x: np.ndarray, x_up: np.ndarray, pivots: np.ndarray, p_up: np.ndarray) -> np.ndarray:
    """Between each row (with its added component) and each pivot."""
    squares = (x * x).sum(axis=1) + x_up**2
    p_squares = (pivots * pivots).sum(axis=1) + p_up**2
    d2 = squares[:, None] + p_squares[None, :] - 2 * (x @ pivots.T + x_up[:, None] * p_up[None, :])
    return np.sqrt(np.maximum(d2, 0.0))


class Index:
    """annuli (DataFrame, written to the shared folder), pivots, M."""

    def __init__(self, annuli: DataFrame, pivots: np.ndarray, m: float, dim: int):
        self.annuli, self.pivots, self.m, self.dim = annuli, pivots, m, dim
        self.p_up = lifted(pivots, m) if len(pivots) else np.zeros(0)
        # Distances come from sums of numbers of this size; their errors are far below the slack.
        self.slack = 1e-6 * (1.0 + math.sqrt(m))


def build(vectors: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> Index:
    """vectors: vec_id, x (array of whole doubles)."""
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    facts = vectors.agg(F.max(square), F.max(F.size("x"))).first()
    m, dim = float(facts[0] or 0.0), int(facts[1] or 0)
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()  # at most pivots rows
    p = np.unique(matrix([r.x for r in chosen], dim), axis=0) if chosen else np.zeros((0, dim))
    p_up = lifted(p, m)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1).to_pylist(), dim)
            d = distances(x, lifted(x, m), p, p_up) if len(x) else np.zeros((0, 1))
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])],
                ["vec_id", "x", "pivot", "r"],
            )

    keyed = vectors.select("vec_id", "x").mapInArrow(place, "vec_id long, x array<double>, pivot int, r double")
    # The id splits what many equal vectors would put in one range.
    ordered = keyed.repartitionByRange("pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def annulus() -> pa.RecordBatch:
            nonlocal number, held
            x = matrix([h[1] for h in held], dim)
            row = {
                "annulus": [number], "pivot": [held[0][2]], "low": [held[0][3]], "high": [held[-1][3]],
                "ids": [np.array([h[0] for h in held], dtype=np.int64).tobytes()], "vectors": [x.tobytes()],
                "dim": [dim],
            }
            number += 1
            held = []
            return arrow_rows(row, INDEX)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (held[0][2] != row[2] or len(held) >= block):
                    yield annulus()
                held.append(row)
        if held:
            yield annulus()

    return Index(staged(ordered.mapInArrow(cut, INDEX_DDL), "annuli"), p, m, dim)


def unpacked(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    return i, np.frombuffer(vectors, dtype=np.float64).reshape(len(i), dim)


def products(q: np.ndarray, x: np.ndarray, m: float) -> tuple[np.ndarray, np.ndarray]:
    """Inner products as int64, and which of them int64 can hold; m: the largest |x|^2 of all vectors."""
    if m <= EXACT:
        found = (q @ x.T).astype(np.int64)
        return found, np.ones(found.shape, dtype=bool)
    whole_numbers = lambda v: matrix_of_integers(v.tolist(), v.shape[1])
    return integer_scores(whole_numbers(q), whole_numbers(x))


def best_of(
    q_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int, fits: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(query place, candidate place) of the k best of each row of scores, ties to the smaller id, own id left out."""
    allowed = q_ids[:, None] != ids[None, :]
    if fits is not None and (allowed & ~fits).any():
        raise OverflowError("an inner product does not fit in a long")
    if scores.shape[1] > k:
        held = np.where(allowed, scores, LOWEST)
        edge = np.partition(held, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed &= scores >= edge[:, None]
    q, c = np.nonzero(allowed)
    # ~score falls as score rises, without the overflow that -score has at the lowest long.
    order = np.lexsort((ids[c], ~scores[q, c], q))
    q, c = q[order], c[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], c[rank < k]


def search(index: Index, queries: DataFrame, k: int = K, group: int = QUERY_GROUP) -> DataFrame:
    """queries: vec_id, x. Gives query_id, rank, vec_id, score: k rows for each row of queries."""
    pivots, p_up, m, dim, slack = index.pivots, index.p_up, index.m, index.dim, index.slack
    hits = "query long, query_id long, vec_id long, score long"

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its distance to each pivot, and which is nearest."""
        for batch in batches:
            x = matrix(batch.column(2).to_pylist(), dim)
            d = distances(x, np.zeros(len(x)), pivots, p_up)
            n = len(pivots)
            near = np.zeros(d.shape, dtype=bool)
            if n:
                near[np.arange(len(x)), d.argmin(axis=1)] = True
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n)),
                    pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), n)),
                    pa.array([v.tobytes() for v in x for _ in range(n)], pa.binary()),
                    pa.array(np.repeat((x * x).sum(axis=1), n)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(x))),
                    pa.array(d.ravel()), pa.array(near.ravel()),
                ],
                ["query", "query_id", "q", "square", "pivot", "d", "near"],
            )

    # Each row has a number of its own, fixed once written: ids may repeat.
    spread_out = staged(
        queries.select(
            F.monotonically_increasing_id().alias("query"), F.col("vec_id").cast("long").alias("vec_id"), "x"
        ).mapInArrow(spread, "query long, query_id long, q binary, square double, pivot int, d double, near boolean"),
        "query-pivots",
    )
    annuli = index.annuli
    places = annuli.select("annulus", F.col("pivot").alias("a_pivot"), "low", "high")
    gap = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))

    def scored(pairs: DataFrame) -> DataFrame:
        """pairs: annulus, query, query_id, q, floor (least score that matters). The k best of each pair."""
        spread_groups = pairs.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(groups)))
        wanted = spread_groups.select(F.col("annulus").alias("c_annulus"), F.col("part").alias("c_part")).distinct()
        copies = annuli.select(F.col("annulus").alias("c_annulus"), "ids", "vectors").join(wanted, "c_annulus")

        def run(key: tuple, q: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            out = []
            for ids, vectors in zip(block["ids"], block["vectors"], strict=True):
                ids, x = unpacked(ids, vectors, dim)
                for at in range(0, len(q), 512):
                    part = q.iloc[at : at + 512]
                    q_ids = part["query_id"].to_numpy(dtype=np.int64)
                    qx = np.frombuffer(b"".join(part["q"]), dtype=np.float64).reshape(len(part), dim)
                    scores, fits = products(qx, x, m)
                    i, c = best_of(q_ids, scores, ids, k, fits)
                    got = scores[i, c]
                    ok = got >= part["floor"].to_numpy(dtype=np.int64)[i]
                    out.append(
                        pd.DataFrame(
                            {
                                "query": part["query"].to_numpy(dtype=np.int64)[i[ok]], "query_id": q_ids[i[ok]],
                                "vec_id": ids[c[ok]], "score": got[ok],
                            }
                        )
                    )
            return pd.concat(out) if out else pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

        asking = spread_groups.groupBy("annulus", "part")
        return asking.cogroup(copies.groupBy("c_annulus", "c_part")).applyInPandas(run, hits)

    groups = max(1, math.ceil(queries.count() / group))
    # First: the annulus of the nearest pivot closest to the query's own distance.
    home = (
        spread_out.filter("near").join(places, F.col("pivot") == F.col("a_pivot"))
        .groupBy("query", "query_id", "q", "square").agg(F.min(F.struct(gap.alias("gap"), "annulus"))["annulus"].alias("annulus"))
        .withColumn("floor", F.lit(LOWEST).cast("long"))
    )
    first = staged(scored(home), "first-hits")
    kth = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("score"), False).alias("s"))
    bound = kth.select("query", F.when(F.col("n") >= k, F.element_at("s", k)).alias("bound"))
    reach = F.sqrt(F.greatest(F.col("square") + m - 2 * F.col("bound").cast("double"), F.lit(0.0))) + slack
    pairs = (
        spread_out.join(bound, "query", "left")
        .join(places, F.col("pivot") == F.col("a_pivot"))
        .filter(F.col("bound").isNull() | (gap <= reach))
        .select("annulus", "query", "query_id", "q", F.coalesce("bound", F.lit(LOWEST).cast("long")).alias("floor"))
    )
    all_hits = scored(pairs)
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return (
        all_hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
