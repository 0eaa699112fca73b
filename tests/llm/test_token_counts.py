import random

import public_tokenizers
import pytest

from keelson.llm import token_counts as tc


def slow_count(scores, word, by_byte):
    """Best split of one word alone: highest score, then fewest tokens."""
    path = tc.MARK + word
    best = [(0.0, 0)]
    for i in range(1, len(path) + 1):
        n = len(path[i - 1].encode())
        ways = [(best[i - 1][0] + n * by_byte, best[i - 1][1] - n)]
        ways += [(best[j][0] + scores[path[j:i]], best[j][1] - 1) for j in range(i) if path[j:i] in scores]
        best.append(max(ways))
    return -best[-1][1]


@pytest.mark.parametrize("seed", range(10))
def test_shared_scores_are_each_words_own(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abé中▁") for _ in range(rng.randint(1, n)))
    scores = {some(4): -rng.random() * 9 for _ in range(25)}
    counter = tc.TrieCounter(scores)
    words = sorted({some(9) for _ in range(200)})
    assert counter.counts(words) == [slow_count(scores, w, counter.by_byte) for w in words]


def test_table(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = tc.load_scores(path)
    counter = tc.TrieCounter(scores)
    texts = [None, "", " \n", "The cat sat.", "naïve Straße 中文 \U0001f600", "\x1c \x85", "word " * 20000, "x" * 3000, "a\tb\x0bc"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, "a", 2)],
                                 "doc_id long, text string, n_tokens int").repartition(2)
    rows = tc.count_tokens(docs, path).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        words = (texts[r.doc_id] if r.doc_id is not None else "a") or ""
        split = [w.decode() for w in words.encode().split()]
        assert r.n_words == len(split)
        assert r.n_tokens == sum(slow_count(scores, w, counter.by_byte) for w in split)
    assert tc.count_tokens(docs.limit(0), path).count() == 0


def test_full_store_starts_anew(monkeypatch):
    monkeypatch.setattr(tc, "STORED", 5)
    counter = tc.TrieCounter({"a": -1.0, "▁a": -1.5, "b": -2.0})
    texts = [b"a b ab", b"aa bb abab b a c", b"a b ab", b"x y z w v u a"]
    alone = [(len(t.split()), sum(slow_count(counter.scores, w.decode(), counter.by_byte) for w in t.split())) for t in texts]
    assert [counter.totals([t])[0] for t in texts] == alone
    assert counter.totals(texts) == alone
