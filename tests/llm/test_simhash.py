import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from keelson.llm import simhash
from keelson.llm.components import components


def slow_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    top = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(top[a], top[b])
            if (top[a], top[b]) != (low, low):
                top[a] = top[b] = low
                changed = True
    return top


def test_fingerprints():
    for text in ["", "  ", "a", "A b", "A b C", "ÀÉ Straße x\x0by z", "w " * 500, "the cat sat on the mat and it sat"]:
        assert simhash.fingerprint(text.encode()) == slow_print(text)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("depth", [0, 5])
def test_trie_links_are_all_links(seed, depth):
    rng = random.Random(seed)
    center = rng.getrandbits(64)
    pool = {rng.getrandbits(64) for _ in range(80)}
    for base in [center, *list(pool)[:20]]:
        for _ in range(8):
            near = base
            for _ in range(rng.randint(0, 4)):
                near ^= 1 << rng.randrange(64)
            pool.add(near)
    shift = 64 - depth
    for x, y in [(0, 0)] if not depth else [(center >> shift, center >> shift), (center >> shift, center >> shift ^ 1)]:
        pick = lambda p: np.array(sorted(v for v in pool if not depth or v >> shift == p), dtype=np.uint64)
        a, b = pick(x), pick(y)
        got = simhash.trie_links(a, b, 2, depth, x == y)
        have = {frozenset((int(p), int(q))) for p, q in zip(*got, strict=True)}
        want = {frozenset((int(p), int(q))) for p in a for q in b if p != q and (int(p) ^ int(q)).bit_count() <= 2}
        assert have == want


@pytest.mark.parametrize("leaf", [4, 64, 4096])
def test_components_match_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rng = random.Random(leaf)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(160):
        near = rng.choice(prints)
        for _ in range(rng.randint(0, 3)):
            near ^= 1 << rng.randrange(64)
        prints.append(near)
    prints += [0, 1, 3, 2**64 - 1, 2**64 - 2, 2**63, 2**63 + 1]
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "bits long")
    links = simhash.links(frame, leaf=leaf)
    stars = {r.node: r.root for r in components(links).collect()}
    all_links = [(i, j) for i, p in enumerate(prints) for j, q in enumerate(prints) if i < j and (p ^ q).bit_count() <= 2]
    want = roots(len(prints), all_links)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    group = lambda names: sorted(sorted(p for p, n in zip(signed, names, strict=True) if n == m) for m in set(names))
    assert group([stars.get(p, p) for p in signed]) == group(want)


def test_near_duplicates_and_one_of_each(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    for t in texts[:20]:
        texts += [t, t.upper(), t + " tail"]
    texts += ["", None, "  ", "one", "one two", "ONE two"]
    docs = spark.createDataFrame([(i + 10, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, bits string")
    prints = [slow_print(t) for t in texts]
    links = [(i, j) for i, p in enumerate(prints) for j, q in enumerate(prints) if i < j and (p ^ q).bit_count() <= 2]
    want = roots(len(texts), links)
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs.repartition(3)).collect()}
    assert [rows[i + 10].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[i + 10].component_id - 10 for i in range(len(texts))] == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id - 10 for r in kept.collect()) == sorted(set(want))


def test_rows_that_share_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "e f g h i"), (None, None)], "doc_id long, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 4 and {r.component_id for r in rows} == {1, None}
    assert simhash.one_of_each(docs).count() == 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}
