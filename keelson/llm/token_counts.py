"""Token counts under a unigram model, by dynamic programming shared over a trie.

A pre-token is a word with the mark of a word's start before it. Its tokens are the pieces of the best-scoring split;
a character that no piece covers costs one token per UTF-8 byte. The best score of a prefix does not depend on what
follows, so the distinct pre-tokens of a chunk are walked as the depth-first traversal of their trie: sorted, each
keeps the forward scores of the prefix it shares with the one before and computes the rest. The terminal counts are
stored by pre-token and summed over each text's words.

The vocabulary file has no probabilities; a piece's score is that of its place in the file (places follow the order of
merging, so of frequency) under Zipf's law: -log(place + ZIPF).

Map-only; a task holds one chunk's pre-tokens and a store of counts that starts anew when full.

Rows: null, empty and blank texts count 0; repeated rows and null ids are counted one by one; an empty table gives no
row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.common import arrow_rows, expect_long_texts, text_chunks, worker_cache

MARK = "▁"
ZIPF = 10.0
BYTE_PENALTY = 1.0
STORED = 500_000
CHUNK = 4 << 20
COUNTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def load_scores(path: str) -> dict[str, float]:
    """Piece -> score, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    return {p: -math.log(place + ZIPF) for place, p in enumerate(pieces)}


class TrieCounter:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        # Of each last character, the lengths of the pieces that end with it.
        ends: dict[str, set[int]] = {}
        for p in scores:
            ends.setdefault(p[-1], set()).add(len(p))
        self.ends = {c: tuple(sorted(n)) for c, n in ends.items()}
        self.by_byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.stored: dict[bytes, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        """Number of tokens of each of the sorted, distinct words."""
        score, ends, by_byte = self.scores.get, self.ends, self.by_byte
        best: list[tuple[float, int]] = [(0.0, 0)]  # of each prefix: score, minus the number of tokens
        before, out = "", []
        for word in words:
            path = MARK + word
            shared = 0
            for a, b in zip(before, path, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for i in range(shared, len(path)):
                char = path[i]
                n = len(char.encode())
                top = (best[i][0] + n * by_byte, best[i][1] - n)
                for length in ends.get(char, ()):
                    if length > i + 1:
                        break
                    s = score(path[i + 1 - length : i + 1])
                    if s is not None:
                        value, tokens = best[i + 1 - length]
                        way = (value + s, tokens - 1)
                        if way > top:
                            top = way
                best.append(top)
            before = path
            out.append(-best[-1][1])
        return out

    def totals(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        split = [t.split() for t in texts]
        new = {w for words in split for w in words if w not in self.stored}
        if len(self.stored) + len(new) > STORED:
            self.stored.clear()
            new = {w for words in split for w in words}
        listed = sorted((w.decode(), w) for w in new)
        found = self.counts([w for w, _ in listed])
        self.stored.update(zip((w for _, w in listed), found, strict=True))
        of = self.stored.__getitem__
        return [(len(words), sum(map(of, words))) for words in split]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens: one row per row of docs. vocabulary: path of the piece model on the executors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("token counts")
        if ("trie", vocabulary) not in cache:
            cache["trie", vocabulary] = TrieCounter(load_scores(vocabulary))
        counter = cache["trie", vocabulary]
        for keys, texts in text_chunks(batches, ["doc_id"], "text", CHUNK):
            found = counter.totals(texts)
            yield arrow_rows(
                {"doc_id": [k for (k,) in keys], "n_words": [w for w, _ in found], "n_tokens": [t for _, t in found]},
                COUNTS,
            )

    expect_long_texts(docs.sparkSession)
    narrow = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return narrow.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
