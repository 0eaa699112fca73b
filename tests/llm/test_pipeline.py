import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_mixing import slow_mix
from test_packing import plain
from test_simhash import roots, slow_print
from test_suffix_dedup import brute

EN = "the cat sat on a mat and then it went away from here with that old dog of mine".split()
DE = "der hund und die katze sitzen auf einer matte weil es nicht mehr regnet heute abend".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    some = lambda words, n: " ".join(rng.choice(words) + rng.choice(["", "", "", "."]) for _ in range(n))
    passage = some(EN, 130)
    rows = []
    for i in range(40):
        words, lang = (EN, "en") if i % 3 else (DE, "de")
        text = some(words, rng.randint(20, 90))
        if i % 5 == 0:
            text = text + " " + passage + " " + some(words, 30)
        rows.append((i, text, lang, f"s{i % 4}" if i % 7 else None))
    rows += [(50 + i, rows[i][1].upper(), rows[i][2], rows[i][3]) for i in range(5)]  # copies but for case
    rows += [(60, "", "en", "s1"), (61, None, "en", "s1"), (62, "12 345 !!", "en", "s2"), (63, "é" * 300 + passage, "en", "s0")]
    return [(*r, len(r[1] or "")) for r in rows]


def slow_pipeline(rows):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    prints = [slow_print(r[1]) for r in rows]
    links = [(i, j) for i, p in enumerate(prints) for j, q in enumerate(prints) if i < j and (p ^ q).bit_count() <= 2]
    rows = [rows[i] for i in sorted(set(roots(len(rows), links)))]
    texts = [r[1].encode() for r in rows]
    left = []
    for row, body, (_, runs, _) in zip(rows, texts, brute(texts, corpus_pipeline.PASSAGE_BYTES), strict=True):
        kept = bytes(b for i, b in enumerate(body) if not any(lo <= i < hi for lo, hi in runs)).decode("utf-8", "ignore")
        if kept or not body:
            left.append((row[0], kept, row[3]))
    sized = [(d, len(t.encode().split()), s) for d, t, s in left]
    _, copies = slow_mix(sized)
    return {d: (t, copies[d, n, s]) for (d, t, s), (_, n, _) in zip(left, sized, strict=True)}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(), COLUMNS).repartition(2).write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def test_pipeline_matches_brute_force(spark, sf_dir):
    want = slow_pipeline(corpus())
    assert any(len(t) < len(dict((r[0], r[1]) for r in corpus())[d]) for d, (t, _) in want.items())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    starts = Counter(r.doc_id for r in rows if r.start == 0)
    assert starts == Counter({d: n for d, (_, n) in want.items() if n})
    for r in rows:
        ids = plain(want[r.doc_id][0])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    assert sum(r.length for r in rows) == sum(n * len(plain(t)) for t, n in want.values())


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir):
    odd = [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "a b c", "en", "s", 5)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(7) for c in ("__n", "__row", "__runs", "__key", "__bytes")})
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * len(rows)
            assert all(r["__row"] == r["__runs"] == r["__key"] == r["__bytes"] == 7 for r in out.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_passages_of_fifty_words_go_and_clean_texts_stay(spark, sf_dir):
    """Passages of 50 to 60 words, 250 to 390 bytes, each in two or three documents."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8)))
    some = lambda n: " ".join(word() for _ in range(n))
    passages, rows, clean = [], [], {}
    while len(passages) < 12:
        if 250 <= len(text := some(rng.randint(50, 60))) < 390:
            passages.append(text)
    for i, text in enumerate(passages):
        for k in range(2 + i % 2):
            rows.append((100 * i + k, f"{some(40)} {text} {some(30)}", "en", "s", 0))
    for i in range(20):
        clean[5000 + i] = some(rng.randint(30, 120))
        rows.append((5000 + i, clean[5000 + i], "en", "s", 0))
    phrase = some(25)  # shared, but far shorter than a passage
    for i in range(3):
        clean[6000 + i] = f"{some(30)} {phrase} {some(30)}"
        rows.append((6000 + i, clean[6000 + i], "en", "s", 0))
    out = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, spark.createDataFrame(rows, COLUMNS), sf_dir).collect()}
    assert {d: t for d, t in out.items() if d >= 5000} == clean
    for d, t in out.items():
        if d < 5000:
            assert 60 <= len(t.split()) <= 72 and passages[d // 100][5:-5] not in t
