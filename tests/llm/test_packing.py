import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keelson.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def cost(pos, penalty, cuts, limit, sequence_penalty, least_power):
    total = 0
    for i, j in itertools.pairwise(cuts):
        n = pos[j] - pos[i]
        if n > limit:
            return float("inf")
        power = n & (n - 1) == 0 and n >= least_power
        total += (0 if power else limit - n) + sequence_penalty + (penalty[j] if j < len(pos) - 1 else 0)
    return total


@pytest.mark.parametrize("seed", range(60))
def test_cuts_are_the_best_of_all(seed):
    rng = random.Random(seed)
    pos = [0, *itertools.accumulate(rng.randint(1, 9) for _ in range(rng.randint(1, 10)))]
    penalty = [rng.choice([0, 2, 5]) for _ in pos]
    limit, least, extra = 16, 4, rng.choice([0, 3])
    inner = range(1, len(pos) - 1)
    ways = ([0, *c, len(pos) - 1] for n in range(len(inner) + 1) for c in itertools.combinations(inner, n))
    best = min(cost(pos, penalty, w, limit, extra, least) for w in ways)
    chosen = packing.plan_cuts(pos, penalty, limit, extra, least)
    assert cost(pos, penalty, chosen, limit, extra, least) == best


def checked(rows, texts, limit):
    """Pieces of texts (by doc_id) hold each id once, in order, and fill their sequences without gaps."""
    ids = {d: plain(t) for d, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.length > 0
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit and all(r.sequence_tokens == at for r in parts)
    assert set(by_doc) == set(ids)
    return [sum(r.length for r in parts) for parts in by_sequence.values()]


def test_pieces(spark):
    rng = random.Random(5)
    words = ["the", "Cat", "saß", "on.", "mat!!", "İx", "naïve", "12.5", "it's", "Σας", "\x1ca", "a\x85b", "中文", "%%%"]
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for i in range(60)}
    texts |= {100: None, 101: "", 102: " \n ", 103: "<|ENDOFTEXT|> <|endoftext|>x", 104: "word " * 9000, 105: "x" * 5000}
    docs = spark.createDataFrame(
        [(t, i, "clash") for i, t in texts.items()], "text string, doc_id long, sequence_id string"
    ).repartition(3)
    rows = packing.pack(docs, PATH, limit=256, block_tokens=3000).collect()
    sizes = checked(rows, texts, 256)
    padding = sum(256 - n for n in sizes if n & (n - 1))
    assert padding < 0.1 * sum(sizes)
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(docs, PATH, limit=256, block_tokens=3000).collect()))


def test_order_and_ids(spark):
    docs = spark.createDataFrame([(i, f"text {i}. more text.") for i in range(50)], "doc_id long, text string").coalesce(1)
    rows = sorted(packing.pack(docs, PATH, limit=64, with_ids=True).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    stream = [i for r in rows for i in r.ids]
    assert stream == [i for k in range(50) for i in plain(f"text {k}. more text.")]


def test_repeated_and_null_rows(spark):
    docs = spark.createDataFrame([(1, "a b."), (1, "a b."), (None, "c")], "doc_id long, text string")
    rows = packing.pack(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", len(plain("a b.")))] * 2 + [("None", len(plain("c")))]
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_words_of_letters_need_no_pattern():
    """Nor do marks behind them; a word is tokenized once, whatever mark follows it."""
    ids = packing.WordIds(PATH)
    whole = Tokenizer.from_file(PATH)
    texts = ["reator. reator, Heouan heouan? Èanen émentaux! ciónñesí: ªº.", "naïve; \u0061\u0062"]
    ids.split = None
    seen = []
    tokenized = ids.tokenized
    ids.tokenized = lambda piece: seen.append(piece) or tokenized(piece)
    for text in texts:
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.of(text.encode()), dtype="<u4").tolist() == want
    assert len(seen) == len(set(seen)) == 8


def test_odd_words_have_the_tokenizers_ids():
    rng = random.Random(3)
    odd = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA0, 0x260), 0x1C, 0x85, 0x301, 0x2026, 0x4E2D, 0x3A3, 0x1E9E, 0x2C65)]
    words = ["".join(rng.choice(odd if rng.random() < 0.3 else "abéßñ'.st,ªº²½Ⱥ") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    ids, whole = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for at in range(0, len(words), 7):
        text = " ".join([*words[at : at + 7], "it's", "é!", "é..", "Ⱥ.", "."])
        assert np.frombuffer(ids.of(text.encode()), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
