import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from keelson.llm import line_quality as lq
from keelson.llm.queries import op3_line_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    n, failed = len(words), len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def slow_viterbi(field, features):
    gain = features @ np.array(field.emit)
    best = None
    for labels in itertools.product((0, 1), repeat=len(gain)):
        score = sum(gain[i] for i, y in enumerate(labels) if y) + sum(field.move[a][b] for a, b in itertools.pairwise(labels))
        if best is None or score > best[0] + 1e-12:
            best = (score, labels)
    return best


def some_texts(rng):
    bits = ["a", "bé", "中文", "x#*", "\x1c", "\x85", "1", "Z.", "&|", " "]
    gaps = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\n\n", " \n "]
    texts = ["".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [*texts, None, "", " ", "\n", "\n\n", "one", "a b c d e " * 40, "line one\n" * 9, "w" * 100000]


def test_base_statistics(spark):
    texts = some_texts(random.Random(2))
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    for r in lq.judge(docs.repartition(3)).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == slow_base(texts[r.doc_id]), texts[r.doc_id]
        assert r.kept == (not r.base_failed and r.content_share >= lq.CONTENT_SHARE)
    assert lq.judge(docs.limit(0)).count() == 0
    twice = lq.judge(docs.limit(3).union(docs.limit(3)))
    assert twice.count() == 6


def test_long_chunks_count_the_same():
    texts = [t.encode() for t in ("a1 B#\n" * 500000, "x y z", "")]  # more than 2^21 bytes
    seen = lq.measure(texts)
    apart = [lq.measure([t]) for t in texts[1:]]
    assert seen.n_symbols.tolist() == [500000, 0, 0]
    assert seen.n_words[1:].tolist() == [int(a.n_words[0]) for a in apart]
    assert seen.word_chars[1:].tolist() == [int(a.word_chars[0]) for a in apart]


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_is_the_best_sequence(seed):
    rng = np.random.default_rng(seed)
    field = lq.Field(tuple(rng.normal(size=3).tolist()), tuple(map(tuple, rng.normal(size=(2, 2)).tolist())))
    lengths = rng.integers(1, 8, 6)
    features = rng.normal(size=(lengths.sum(), 3))
    doc = np.repeat(np.arange(6), lengths)
    got = lq.viterbi(field, features, doc)
    for d in range(6):
        assert tuple(got[doc == d].astype(int)) == slow_viterbi(field, features[doc == d])[1]


def test_fit_raises_the_likelihood():
    rng = np.random.default_rng(1)
    features = np.concatenate([np.ones((300, 1)), rng.normal(size=(300, len(lq.FEATURES) - 1))], axis=1)
    labels = features[:, 3] + 0.3 * rng.normal(size=300) > 0
    doc = np.repeat(np.arange(30), 10)

    def likelihood(field):
        total = 0.0
        for d in range(30):
            f, y = features[doc == d], labels[doc == d]
            score = lambda s: sum((f[i] @ field.emit) * v for i, v in enumerate(s)) + sum(field.move[a][b] for a, b in itertools.pairwise(s))
            alpha = np.array([0.0, f[0] @ field.emit])
            for i in range(1, 10):
                alpha = np.logaddexp.reduce(alpha[:, None] + np.array(field.move), axis=0) + [0.0, f[i] @ field.emit]
            total += score(y.astype(int)) - np.logaddexp.reduce(alpha)
        return total

    fitted = lq.fit(features, doc, labels)
    assert likelihood(fitted) > likelihood(lq.START)
    assert (lq.viterbi(fitted, features, doc) == labels).mean() > 0.8


def test_verdicts_follow_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = [r for r in op3_line_quality(spark, SF001).collect() if r.doc_id in labels]
    right = sum((r.kept and not r.base_failed) == bool(labels[r.doc_id]) for r in rows)
    good_kept = [r.kept for r in rows if labels[r.doc_id] == 1]
    print(right / len(rows), sum(good_kept) / len(good_kept), len(rows))
    assert sum(good_kept) >= 0.95 * len(good_kept)
    assert right >= 0.8 * len(rows)


def test_training_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert lq.train(docs, labels) == lq.START
    assert lq.train(docs, labels.limit(0)) == lq.START
