"""Quality rules by line sequence labelling.

A linear-chain conditional random field marks each line of a document as content or boilerplate; Viterbi decoding
finds the best sequence, and the share of the words that stand in content lines decides whether the document stays.
Before that, base rules reject texts of few words and texts that repeat themselves.

The field has a weight per line feature (FEATURES) and per pair of neighbouring labels. It is fitted by gradient
ascent on the likelihood of a sample of at most ``most_labelled`` labelled documents, chosen by a hash of their ids:
every line of a good document counts as content unless it repeats an earlier line, every line of a bad one as
boilerplate. Without labels of both kinds the START weights stay.

Judging is map-only. All statistics of a chunk of texts are computed at once over its bytes.

Rows: a null text has no words and no lines; an empty or blank text has lines but no words (share 1, rejected by the
base rules); repeated rows and null ids are judged one by one; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import arrow_rows, expect_long_texts, text_chunks
from keelson.llm.suffix_dedup import Rolling, mixed

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent
CONTENT_SHARE = 0.5
MOST_LABELLED = 2000
CHUNK = 1 << 20
SPACE, SYMBOLS, STOPS = b"\t\n\x0b\x0c\r ", b"#*$%&|<>", b".!?:;\"'"
FEATURES = (
    "bias", "few words", "many words", "symbol share", "digit share", "capital share", "ends a sentence",
    "repeats a line", "word length", "no words",
)
JUDGED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
        ("content_share", pa.float64()), ("kept", pa.bool_()),
    ]
)
JUDGED_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


@dataclass(frozen=True)
class Field:
    """emit: weight of each feature for content; move[a][b]: weight of label b after a (0 boilerplate, 1 content)."""

    emit: tuple[float, ...]
    move: tuple[tuple[float, float], tuple[float, float]]


#: What the fit starts from.
START = Field((1.0, -0.5, 0.5, -6.0, -2.0, -2.0, 0.5, -2.0, 0.0, 0.0), ((0.5, -0.5), (-0.5, 0.5)))


def classes(*groups: bytes) -> np.ndarray:
    """A table that counts up to three groups of bytes in one 64-bit number, 21 bits each."""
    out = np.zeros(256, dtype=np.uint64)
    for i, g in enumerate(groups):
        out[list(g)] += np.uint64(1 << 21 * i)
    return out


# Bytes 80-BF go on with a character; what is not one of them starts one.
FIRST = classes(SPACE, SYMBOLS, bytes(range(0x80, 0xC0)))
SECOND = classes(b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
IS_SPACE = np.isin(np.arange(256), list(SPACE))
IS_STOP = np.isin(np.arange(256), list(STOPS))


@dataclass
class Lines:
    """Statistics of a chunk: per document and per line (lines in order, doc: each line's document)."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    doc: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def totals(table: np.ndarray, data: np.ndarray, n: int) -> list[np.ndarray]:
    """Running counts, with a leading 0, of each group of a table."""
    # Counts wrap at 2^21, and so do differences: right for ranges below 2 MB, which chunks without longer texts are.
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    if len(data) < 1 << 21:
        np.cumsum(table[data], out=sums[1:])
        return [((sums >> np.uint64(21 * i)) & np.uint64((1 << 21) - 1)).astype(np.int64) for i in range(n)]
    out = []
    for i in range(n):
        hit = (table >> np.uint64(21 * i)) & np.uint64(1)
        out.append(np.concatenate([[0], np.cumsum(hit[data].astype(np.int64))]))
    return out


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per key: is it there twice or more; is it not the first of its kind."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    as_before = np.concatenate([[False], k[1:] == k[:-1]]) if len(k) else np.zeros(0, dtype=bool)
    shared = as_before | np.concatenate([as_before[1:], [False]]) if len(k) else as_before
    twice, later = np.zeros(len(k), dtype=bool), np.zeros(len(k), dtype=bool)
    twice[order], later[order] = shared, as_before
    return twice, later


def measure(texts: list[bytes], window: int = WINDOW) -> Lines:
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    start = np.cumsum(size + 1) - size - 1
    stop = start + size
    n = len(texts)
    space, symbol, inner = totals(FIRST, data, 3)
    digit, capital = totals(SECOND, data, 2)
    between = lambda sums, a, b: sums[b] - sums[a]
    word_chars = size - between(inner, start, stop) - between(space, start, stop)

    # Words and their documents.
    gap = IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
    w_start, w_stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    w_doc = np.searchsorted(start, w_start, side="right") - 1
    n_words = np.bincount(w_doc, minlength=n)
    hashed = Rolling(joined, 4)
    code = hashed(w_start, w_stop)

    # Windows of words, kept apart by document.
    n_repeat = np.zeros(n, dtype=np.int64)
    count = len(code) - window + 1
    if count > 0:
        key = np.zeros(count, dtype=np.uint64)
        for i in range(window):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + code[i : i + count])
        inside = w_doc[:count] == w_doc[window - 1 :]
        at = np.flatnonzero(inside)
        twice, _ = repeats(mixed(key[at] ^ (w_doc[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))))
        marks = np.zeros(len(code) + 1, dtype=np.int64)
        marks[at[twice]] += 1
        marks[at[twice] + window] -= 1
        n_repeat = np.bincount(w_doc, np.cumsum(marks[:-1]) > 0, minlength=n).astype(np.int64)

    # Lines: from one line feed to the next; a document's last ends with the document.
    l_stop = np.flatnonzero(data == 10)
    l_start = np.concatenate([[0], l_stop[:-1] + 1])
    doc = np.searchsorted(start, l_start, side="right") - 1
    first_word = np.searchsorted(w_start, l_start)
    last_word = np.searchsorted(w_start, l_stop)
    line_words = last_word - first_word
    worded = line_words > 0
    line_code = mixed(hashed(l_start, l_stop) ^ (doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    again = np.zeros(len(doc), dtype=bool)
    at = np.flatnonzero(worded)
    again[at] = repeats(line_code[at])[1]

    inked = np.maximum(l_stop - l_start - between(space, l_start, l_stop), 1)
    chars = np.maximum(inked - between(inner, l_start, l_stop), 1)
    ending = np.zeros(len(doc), dtype=bool)
    ending[at] = IS_STOP[data[w_stop[last_word[at] - 1] - 1]]
    features = np.stack(
        [
            np.ones(len(doc)), worded & (line_words < 4), line_words >= 12, between(symbol, l_start, l_stop) / chars,
            between(digit, l_start, l_stop) / chars, between(capital, l_start, l_stop) / chars, ending, again,
            np.minimum(chars / np.maximum(line_words, 1), 20) / 10, ~worded,
        ],
        axis=1,
    ).astype(np.float64)
    return Lines(
        n_words, word_chars, between(symbol, start, stop), np.bincount(doc, again, minlength=n).astype(np.int64),
        n_repeat, doc, line_words, features,
    )


def by_step(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first line of each document, number of its lines), longest document first; doc: each line's, in order."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    lines = np.diff(np.append(first, len(doc)))
    order = np.argsort(-lines, kind="stable")
    return first[order], lines[order]


def viterbi(field: Field, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The best labels (True: content) of each document's lines, all documents a step at a time."""
    labels = np.zeros(len(doc), dtype=bool)
    if not len(doc):
        return labels
    gain = features @ np.array(field.emit)
    move = np.array(field.move)
    first, lines = by_step(doc)
    back = np.zeros((len(doc), 2), dtype=bool)
    score = np.stack([np.zeros(len(first)), gain[first]], axis=1)
    for t in range(1, int(lines[0])):
        live = int(np.searchsorted(-lines, -t, side="left"))  # documents with more than t lines
        ways = score[:live, :, None] + move
        at = first[:live] + t
        back[at] = ways[:, 1] > ways[:, 0]
        score[:live] = ways.max(axis=1)
        score[:live, 1] += gain[at]
    now = score[:, 1] >= score[:, 0]
    for t in range(int(lines[0]) - 1, -1, -1):
        live = int(np.searchsorted(-lines, -t, side="left"))
        at = first[:live] + t
        labels[at] = now[:live]
        now[:live] = back[at, now[:live].astype(np.int64)]
    return labels


def fit(features: np.ndarray, doc: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.5) -> Field:
    """Gradient ascent on the mean log-likelihood per line (forward-backward in log space), from START."""
    emit, move = np.array(START.emit), np.array(START.move)
    first, lines = by_step(doc)
    steps = int(lines[0])
    y = labels.astype(np.int64)
    same = doc[1:] == doc[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][same], y[1:][same]), 1)
    seen_emit = features.T @ y
    for _ in range(rounds):
        gain = features @ emit
        local = np.stack([np.zeros(len(gain)), gain], axis=1)
        ahead, behind = local.copy(), np.zeros_like(local)
        for t in range(1, steps):
            live = int(np.searchsorted(-lines, -t, side="left"))
            at = first[:live] + t
            ahead[at] += np.logaddexp.reduce(ahead[at - 1][:, :, None] + move, axis=1)
        for t in range(steps - 1, 0, -1):
            live = int(np.searchsorted(-lines, -t, side="left"))
            at = first[:live] + t
            behind[at - 1] = np.logaddexp.reduce(move + (local[at] + behind[at])[:, None, :], axis=2)
        joint = ahead + behind
        total = np.logaddexp(joint[:, 0], joint[:, 1])
        content = np.exp(joint[:, 1] - total)
        pairs = np.flatnonzero(same)
        ways = ahead[pairs][:, :, None] + move + (local + behind)[pairs + 1][:, None, :]
        expected = np.exp(ways - total[pairs + 1][:, None, None]).sum(axis=0)
        emit += rate * ((seen_emit - features.T @ content) / len(doc) - 0.001 * emit)
        move += rate * ((seen - expected) / len(doc) - 0.001 * move)
    return Field(tuple(emit.tolist()), tuple(map(tuple, move.tolist())))


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Field:
    """docs: doc_id, text; labels: doc_id, quality (0 or 1). Collects the lines of at most most_labelled documents."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("quality in (0, 1)").dropDuplicates(["doc_id"])
    sample = F.broadcast(wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_chunks(batches, ["doc_id", "quality"], "text", CHUNK):
            seen = measure(texts)
            quality = np.array([q for _, q in keys], dtype=np.int64)[seen.doc]
            ids = np.array([k for k, _ in keys], dtype=np.int64)[seen.doc]
            good = (quality == 1) & (seen.features[:, FEATURES.index("repeats a line")] == 0)
            cells = [pa.array(ids), pa.array(np.arange(len(ids))), pa.array(good), pa.array(seen.features.tolist())]
            yield pa.RecordBatch.from_arrays(cells, ["doc_id", "line", "good", "features"])

    rows = known.mapInArrow(run, "doc_id long, line long, good boolean, features array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.line))
    good = np.array([r.good for r in rows], dtype=bool)
    if good.all() or not good.any():
        return START
    return fit(np.array([r.features for r in rows]), np.array([r.doc_id for r in rows]), good)


def judge(
    docs: DataFrame,
    field: Field = START,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_share: float = CONTENT_SHARE,
    least_words: int = LEAST_WORDS,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """One row per row of docs: the base statistics, base_failed, content_share and kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_chunks(batches, ["doc_id"], "text", CHUNK):
            seen = measure(texts)
            content = viterbi(field, seen.features, seen.doc)
            inside = np.bincount(seen.doc, seen.line_words * content, minlength=len(texts))
            share = np.where(seen.n_words > 0, inside / np.maximum(seen.n_words, 1), 1.0)
            failed = (seen.n_words < least_words) | (100 * seen.n_repeat_words > most_repeated * seen.n_words)
            yield arrow_rows(
                {
                    "doc_id": [k for (k,) in keys], "n_words": seen.n_words, "word_chars": seen.word_chars,
                    "n_symbols": seen.n_symbols, "n_dup_lines": seen.n_dup_lines,
                    "n_repeat_words": seen.n_repeat_words, "base_failed": failed, "content_share": share,
                    "kept": ~failed & (share >= content_share),
                },
                JUDGED,
            )

    expect_long_texts(docs.sparkSession)
    narrow = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return narrow.mapInArrow(run, JUDGED_DDL)
