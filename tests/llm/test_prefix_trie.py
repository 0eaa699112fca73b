import hashlib
import random
import zlib

import numpy as np
import pytest

from keelson.llm import prefix_trie as pt

DDL = "conv_id long, turn long, role string, text string"


def words(text):
    return len(text.encode().split())


def brute(rows, plain=False):
    """Nodes by walking every prefix; rows: (conv_id, turn, role, text) with distinct turns in a conversation."""
    convs = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, own in convs.items():
        h = 0 if plain else zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, held in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(held) - 1) * words(path[-1][1]) if path else 0
    out = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(built[c]) == len(path)))
        up = min(members[path[:-1]]) if path else None
        out.append((min(held), len(path), up, len(held), kids.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(spark, rows, parts=3, **options):
    frame = spark.createDataFrame(rows, DDL).repartition(parts)
    out = pt.trie(frame, **options)
    return sorted(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in out.collect()
    )


def some(seed, convs=60, longest=6, choices=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, "ua"[t % 2], " ".join("w" * rng.randint(1, choices) for _ in range(rng.randint(0, choices)))))
    return rows


@pytest.mark.parametrize("seed,limit", [(1, None), (2, 7), (3, 25)])
def test_trie_matches_brute_force(spark, seed, limit):
    rows = some(seed)
    assert found(spark, rows, limit=limit) == brute(rows)


def test_hot_prefix_long_conversations_and_copies(spark):
    """Split by Spark down to single nodes; the range partitions cut the long conversations."""
    rows = [(7, t, "u", f"step {t % 3}") for t in range(120)] + [(9, t, "u", f"step {t % 3}") for t in range(90)]
    rows += [(1000 + c, t, "u", f"hello {t}") for c in range(40) for t in range(3)]  # copies
    rows += [(2000 + c, t, "u", f"hello {t}" if t < 2 else f"end {c}") for c in range(30) for t in range(4)]
    from pyspark.sql import functions as F

    got = found(spark, rows, own=F.lit(0), giver=F.col("conv_id"), limit=16)
    assert got == brute(rows, plain=True)


def test_nulls_turnless_negative_and_empty(spark):
    rows = [(20, None, None, None), (20, 1, "a", "x y"), (21, 0, "u", None), (22, 0, None, "a\nb"), (None, 0, "u", "gone"),
            (25, 0, "u", "z" * 100_000), (400, 3, "u", "t"), (401, 0, "u", "t"), (402, 9, "u", "")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    # The giver is not there and its own first turn goes: only the root is left.
    lone = [(next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4), 0, "u", "text")]
    assert found(spark, lone) == brute(lone) and len(brute(lone)) == 1


def test_repeated_turns_and_extra_columns(spark):
    frame = spark.createDataFrame([(40, 0, "u", "a", 1, 2)] * 3, DDL + ", words int, depth int")
    got = pt.trie(frame).collect()
    assert max(r.depth for r in got) == 3 and all(r.n_convs == 1 for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_centroid_totals(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    shape = seed % 3
    parent = np.array([-1] + [
        (i - 1 if shape == 0 else 0 if shape == 1 else int(rng.integers(-1, i))) for i in range(1, n)
    ], dtype=np.int64)
    values = rng.integers(0, 100, (n, 2))
    want = values.copy()
    for v in range(n - 1, -1, -1):
        if parent[v] >= 0:
            want[parent[v]] += want[v]
    assert (pt.centroid_totals(parent, values) == want).all()


def test_prefix_sums_join_at_any_cut():
    rng = np.random.default_rng(5)
    t = rng.integers(0, 2**63, 50).astype(np.uint64)
    for base in pt.BASES:
        whole = np.cumsum(t * pt.power(base, np.arange(1, 51)), dtype=np.uint64)
        for cut in (1, 20, 49):
            later = np.cumsum(t[cut:] * pt.power(base, np.arange(1, 51 - cut)), dtype=np.uint64)
            assert (whole[cut - 1] + pt.power(base, np.full(50 - cut, cut)) * later == whole[cut:]).all()
        assert (pt.power(base, np.array([3])) * pt.power(base, np.array([-3])) == 1).all()
