import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from keelson.llm import suffix_dedup as sd


@pytest.mark.parametrize("q", [2, 3, 5, 7, 11, 13, 17])
def test_difference_cover(q):
    v = q * q + q + 1
    cover = sd.difference_cover(q).tolist()
    assert len(cover) == q + 1
    assert {(i - j) % v for i in cover for j in cover} == set(range(v))


def brute(texts, length):
    seen = Counter()
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] += 1
    out = []
    for t in texts:
        hit = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        runs = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        out.append((len(t), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    alphabet = "abcdé"
    some = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [some(rng.randint(40, 160)) for _ in range(6)]
    texts = [some(rng.randint(0, 200)) for _ in range(40)]
    for _ in range(40):
        at = rng.choice(shared)
        cut = rng.randint(0, 30)
        texts.append(some(rng.randint(0, 90)) + at[cut : len(at) - rng.randint(0, 30)] + some(rng.randint(0, 90)))
    near = some(500)
    for _ in range(12):
        spot = rng.randint(0, 499)
        texts.append(near[:spot] + "X" + near[spot + 1 :])
    texts += ["ab" * 100, "a" * 150, "a" * 49, "b" * 50, "b" * 50, "", texts[0], texts[0]]
    return texts


@pytest.mark.parametrize("seed,chunk,parts", [(1, 4 << 20, 1), (2, 300, 3), (3, 1000, 5), (4, 4 << 20, 7)])
def test_spans_match_brute_force(spark, monkeypatch, seed, chunk, parts):
    monkeypatch.setattr(sd, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(sd, "SETTLE_ROWS", 20 * parts)
    texts = corpus(random.Random(seed))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = sorted(sd.repeated_spans(docs, length=50).collect(), key=lambda r: r.doc_id)
    got = [(r.n_bytes, [(s["from"], s["to"]) for s in r.spans], r.kept_sha256) for r in rows]
    want = brute([t.encode() for t in texts], 50)
    bad = [i for i, (a, b) in enumerate(zip(got, want, strict=True)) if a != b]
    assert not bad, (bad[:3], got[bad[0]], want[bad[0]])


def test_rows_that_share_ids(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame(
        [(1, long, "x"), (1, long, "y"), (1, "other " * 3, "z"), (None, None, "n"), (None, "", None)],
        "doc_id long, text string, row string",
    )
    rows = sd.repeated_spans(docs, length=50).collect()
    assert sorted((str(r.doc_id), r.n_bytes, sum(s["to"] - s["from"] for s in r.spans)) for r in rows) == sorted(
        [("1", 300, 300), ("1", 300, 300), ("1", 18, 0), ("None", 0, 0), ("None", 0, 0)]
    )
    left = {r["row"]: r.text for r in sd.without_repeats(docs, length=50).collect()}
    assert left == {"x": "", "y": "", "z": "other " * 3, "n": None, None: ""}
    assert sd.repeated_spans(docs.limit(0), length=50).count() == 0


@pytest.mark.parametrize("size", [0, 1, sd.BLOCK - 1, sd.BLOCK, 3 * sd.BLOCK + 7])
def test_rolling_hashes_tell_strings_apart_wherever_they_stand(size):
    body = random.Random(size).randbytes(size)
    text = body + b"." * 5 + body
    at = sd.Rolling(text, 1)
    first, last = np.arange(0, size + 1, 97), np.full(size // 97 + 1, size)
    assert (at(first, last) == at(first + size + 5, last + size + 5)).all()
    assert len(set(at(first, last).tolist())) == len(first)


class Captured:
    """Stands for a frame and keeps what is to run on its batches."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def peak_mb(frame, batch):
    """MB at most that running over the batch takes; what a process keeps between its tasks counts."""
    tracemalloc.start()
    rows = sum(out.num_rows for out in frame.run([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6, rows


def test_a_chunk_takes_little_memory():
    """A task's process holds one chunk; three steps of 1 MB of text, all of it asked about, within 50 MB."""
    body = random.Random(7).randbytes(1 << 20).hex().encode()[: 1 << 20]
    asked = pa.array([[{"lo": 0, "hi": (1 << 20) - 241}]], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
    some = pa.array([[{"lo": p, "hi": p} for p in range(0, (1 << 20) - 300, 13)]], asked.type)
    for step, ranges, least in ((sd.sample_suffixes, asked, 75_000), (sd.asked_cells, some, 300_000), (sd.asked_strings, asked, 1_000_000)):
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([body.decode()]), ranges], names=["row", "text", "asked"])
        sd.worker_cache("nobody")
        most, rows = peak_mb(step(Captured(), 240), batch)
        assert rows >= least
        assert most < 50, step.__name__


def test_turns_hold_all_suffixes_of_a_seed_and_about_as_many_each():
    """One turn's suffixes are shuffled at a time: half of the disk that all take at once."""
    body = random.Random(3).randbytes(1 << 17).hex()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([body, body[1000:] + "end"])], names=["row", "text"])

    def kinds(*turn):
        out = sd.sample_suffixes(Captured(), 240, *turn).run([batch])
        cells = [list(zip(*(x.column(i).to_pylist() for i in range(5)), strict=True)) for x in out]
        return [(k, w, more & 7) for rows in cells for k, w, _, _, more in rows if more & 7 < sd.SURE]

    whole, parts = kinds(), [kinds(turn, sd.TURNS) for turn in range(sd.TURNS)]
    assert sd.TURNS > 1 and sorted(sum(parts, [])) == sorted(whole)
    assert not set.intersection(*({k for k, _, _ in part} for part in parts))
    assert all(len(part) * sd.TURNS < 1.1 * len(whole) for part in parts)
