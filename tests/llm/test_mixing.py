import hashlib
import math
import random
from collections import defaultdict

import pytest

from keelson.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what is above a cap is reshared, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return {s: capped.get(s, weight[s] * level) for s in names}
        capped |= {s: float(most * sizes[s]) for s in over}


def slow_odds(own, left):
    """{(doc_id, size): p}: more and more documents are certain, until no p of the others reaches 1."""
    pull = {(d, n): math.isqrt(n) + 1 for d, n in own if n}
    certain = set()
    while True:
        open_ = [x for x in pull if x not in certain]
        rest = left - sum(n for _, n in certain)
        c = rest / sum(pull[x] * x[1] for x in open_) if open_ else 0.0
        more = {x for x in open_ if c * pull[x] >= 1}
        if not more:
            return {**{x: c * pull[x] for x in open_}, **{x: 1.0 for x in certain}}
        certain |= more


def slow_mix(rows):
    """rows: (doc_id, size, source). Copies by (doc_id, size, source), all rows of a source ranked at once."""
    sizes = defaultdict(int)
    for _, n, s in rows:
        sizes[s] += n
    target = slow_targets(dict(sizes))
    copies = {}
    for source in sizes:
        own = [(d, n) for d, n, s in rows if s == source]
        factor = target[source] / sizes[source] if sizes[source] else 0.0
        whole = math.floor(factor)
        left = target[source] - whole * sizes[source]
        ranked = []
        extra = set()
        for (d, n), p in slow_odds(own, left).items():
            h = hashlib.md5(f"{mixing.SEED}:{'' if d is None else d}".encode()).hexdigest()
            u = (int(h[:12], 16) + 0.5) / 2.0**48
            if p >= 1:
                extra.add((d, n))
            elif p > 0:
                ranked.append((u / (1 - u) * (1 - p) / p, u, d, n))
        room = left - sum(n for _, n in extra)
        run = 0
        for q, u, d, n in sorted(ranked):
            run += n
            if run - room <= room - (run - n):
                extra.add((d, n))
        for d, n in own:
            copies[d, n, source] = whole + ((d, n) in extra)
    return target, copies


@pytest.mark.parametrize("seed", range(8))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50000]) * rng.randint(0, 5) for i in range(rng.randint(1, 9))}
    sizes[None] = rng.randint(0, 500)
    if seed == 0:  # equal caps by weight
        sizes = {"a": 50, "b": 20, "c": 10, "d": 5000, "e": 20}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = slow_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], rel=1e-9) for s in got)


@pytest.mark.parametrize("bins", [2, 64, 4096])
def test_copies_match_brute_force(spark, bins):
    rng = random.Random(bins)
    rows = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "b", "é", "𝔷", None, "zero"])
        n = 0 if source == "zero" or rng.random() < 0.05 else int(rng.paretovariate(1.1) * 5)
        rows.append((i, min(n, 3000), source))
    docs = spark.createDataFrame(
        [(i, "w " * n if n or i % 2 else None, s, 7) for i, n, s in rows], "doc_id long, text string, source string, size int"
    ).repartition(3)
    target, copies = slow_mix(rows)
    got = mixing.decided(docs, bins=bins).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.copies == copies[r.doc_id, r.size, r.source], r
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
    largest = max(n for _, n, _ in rows)
    for s in target:
        taken = sum(r.copies * r.size for r in got if r.source == s)
        assert abs(taken - target[s]) <= largest
    again = mixing.decided(docs.repartition(7), bins=bins).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mix(docs, bins=bins)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x")] * 4 + [(None, "c", None)] * 2 + [(None, None, None)], "doc_id long, text string, source string"
    )
    rows = mixing.decided(docs).collect()
    assert len(rows) == 7
    assert len({r.copies for r in rows if r.doc_id == 1}) == 1
    assert mixing.decided(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_odds_favour_longer_documents(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', if(id % 2 = 0, 100, 25)) as text", "'s' as source")
    taken = {r.size: r.share for r in mixing.decided(docs).groupBy("size").agg({"copies": "avg"}).withColumnRenamed("avg(copies)", "share").collect()}
    # e = 1.5: one certain copy, and half of the words once more; odds rise with the root of the size.
    assert taken[100] > taken[25] > 1


def test_realised_inclusion_is_near_the_odds(spark):
    """100 sources of equal make-up, each with a few documents that hold a quarter of its words."""
    make_up = [20] * 400 + [60] * 200 + [200] * 80 + [3000] * 4
    runs, share = 100, 1.3
    rows = [(s * 1000 + i, n, f"s{s:03}") for s in range(runs) for i, n in enumerate(make_up)]
    sizes = spark.createDataFrame(rows, "doc_id long, n int, source string").repartition(8)
    docs = sizes.selectExpr("doc_id", "source", "repeat('w ', n) as text")
    got = mixing.decided(docs, weights=(1,), share=share).groupBy("size").agg({"copies": "avg"}).collect()
    p = {n: v for (_, n), v in slow_odds(list(enumerate(make_up)), sum(make_up) * (share - 1)).items()}
    assert p[3000] > 0.7 and p[20] < 0.1
    for r in got:
        draws = runs * make_up.count(r.size)
        # Four standard errors, and what stopping at words rather than at a count may shift.
        near = 4 * math.sqrt(p[r.size] * (1 - p[r.size]) / draws) + 0.005
        assert r["avg(copies)"] - 1 == pytest.approx(p[r.size], abs=near), (r, p[r.size])


def test_long_documents_are_certain_and_short_ones_still_get_in(spark):
    """The long documents' odds stop at 1; what they leave goes to the others by their odds."""
    make_up = [50] * 2000 + [3000] * 5
    docs = spark.createDataFrame(list(enumerate(make_up)), "doc_id long, n int").selectExpr(
        "doc_id", "'s' as source", "repeat('w ', n) as text"
    )
    total = sum(make_up)
    got = mixing.decided(docs, share=1.5).collect()
    odds = slow_odds(list(enumerate(make_up)), total / 2)
    assert odds[2000, 3000] == 1.0 and 0 < odds[0, 50] < 1
    assert all(r.copies == 2 for r in got if r.size == 3000)
    short = [r.copies - 1 for r in got if r.size == 50]
    assert sum(short) / len(short) == pytest.approx(odds[0, 50], abs=0.01)
