"""Packing tokenised documents into training sequences.

Documents keep their table order. Their tokens (each document closed by an end id) form one stream per block of
about ``block_tokens``; a dynamic program chooses the cuts of the stream into windows of at most ``limit`` tokens
that minimise

    padding + cut penalties + sequence_penalty * number of sequences

where a window of n tokens is padded to ``limit`` unless n is a power of two, and a cut costs nothing at a document
boundary, ``sentence_penalty`` at a sentence boundary and ``hard_penalty`` elsewhere. With f(j) the least cost of the
stream up to candidate j,

    f(j) = penalty(j) + limit - pos(j) + min { f(i) + pos(i) : pos(j) - pos(i) <= limit }

so the minimum slides over a window and a monotone queue finds it in constant amortised time; the windows whose
length is a power of two are looked up by position.

The work is map-only: a task reads its part of the table in order and holds one block (a longer document makes a
longer block). Sequence ids carry the task's partition number, so they are unique and a re-run task repeats them.

Rows: a null text counts as empty and gives one piece that holds the end id alone; null or repeated ids, ties and
repeated rows are packed row by row; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from keelson.llm.common import arrow_rows, expect_long_texts, text_chunks, tidy, worker_cache

LIMIT = 4096
END_ID = 2
BLOCK_TOKENS = 1 << 20
SENTENCE_PENALTY = 12
HARD_PENALTY = 64
SEQUENCE_PENALTY = 8
SENTENCE_STRIDE = 32
HARD_STRIDE = 512
LEAST_POWER = 64
CACHED_WORDS = 250_000
#: Behind letters, each of these is a pre-token alone.
MARKS = ".,;:!?"

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("sequence_tokens", pa.int64()),
    ]
)
IDS = pa.schema([*PIECES, pa.field("ids", pa.list_(pa.int32()))])
PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long"
)


class WordIds(dict):
    """Lower-cased word (bytes) -> its ids as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in a row. A word in
    Latin letters is split into the tokenizer's pre-tokens here, which repeat far more often than words do; any other
    word goes to the tokenizer whole. A word of letters is one pre-token, and a mark behind it another, so the pattern is
    for the rest.
    """

    #: Fixed value: the pre-token pattern of the tokenizer file.
    PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        # Every byte beyond ASCII occurs in these characters; the model's sign for it by the byte's number.
        wide = "".join(map(chr, (*range(0x80, 0x800), *range(0x800, 0xD800, 0x800), *range(0xE000, 0x110000, 0x1000))))
        signs = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(wide)[0][0]
        self.signs = dict(zip(wide.encode(), signs, strict=True))
        self.split = regex.compile(self.PRE_TOKENS).findall
        # What was seen lately, and before that: an entry that stays unused for two fillings is dropped.
        self.older: dict[bytes, bytes] = {}
        self.pre_tokens: dict[str, bytes] = {}
        self.older_pre_tokens: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.ends_sentence = np.zeros(size, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_sentence[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
        self.marks = {ord(c): self.tokenized(c) for c in MARKS}

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def tokenized(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.signs)
        found = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(found)}I", *found)

    def pre_token(self, piece: str) -> bytes:
        ids = self.pre_tokens.get(piece)
        if ids is None:
            ids = self.older_pre_tokens.get(piece)
            if ids is None:
                ids = self.tokenized(piece)
            if len(self.pre_tokens) >= CACHED_WORDS:
                self.older_pre_tokens, self.pre_tokens = self.pre_tokens, {}
            self.pre_tokens[piece] = ids
        return ids

    def new(self, word: bytes) -> bytes:
        if word.isalpha():  # in ASCII
            return self.tokenized(word.decode())
        mark = self.marks.get(word[-1])
        if mark and word[:-1].isalpha():
            return self[word[:-1]] + mark
        text = word.decode()
        # Latin letters keep their kind when lower-cased, but for U+0130; other words go to the tokenizer whole.
        if not text.isprintable() or max(text) >= "ɐ" or "İ" in text:
            return self.encoded(text)
        if mark and text[:-1].isalpha():
            return self[word[:-1]] + mark
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).lower()
            if text.isalpha():
                return self.pre_token(text)
        return b"".join(map(self.pre_token, self.split(text)))

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.new(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        low = text.lower()
        if b"<|" in low and any(s in low for s in self.special):
            return self.encoded(text.decode())
        return b"".join(map(self.__getitem__, low.split()))


def word_ids(path: str) -> WordIds:
    cache = worker_cache("packing")
    if ("word_ids", path) not in cache:
        cache["word_ids", path] = WordIds(path)
    return cache["word_ids", path]


def plan_cuts(
    pos: list[int],
    penalty: list[int],
    limit: int = LIMIT,
    sequence_penalty: int = SEQUENCE_PENALTY,
    least_power: int = LEAST_POWER,
) -> list[int]:
    """Indexes into pos of the chosen cuts, from 0 to the last.

    pos rises strictly from 0, no step is above limit; penalty[j] is what a cut at pos[j] costs (the last is free).
    """
    powers = [1 << k for k in range(limit.bit_length()) if least_power <= 1 << k < limit]
    last = len(pos) - 1
    cost = [0] * (last + 1)
    back = [0] * (last + 1)
    at = {0: 0}
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (cost + pos, index, pos), rising in each part
    find = at.get
    for j in range(1, last + 1):
        here = pos[j]
        floor = here - limit
        while queue[0][2] < floor:
            queue.popleft()
        best, came, _ = queue[0]
        best += limit - here
        for p in powers:
            i = find(here - p)
            if i is not None and cost[i] < best:
                best, came = cost[i], i
        best += sequence_penalty + (penalty[j] if j < last else 0)
        cost[j] = best
        back[j] = came
        at[here] = j
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j, here))
    cuts = [last]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def candidates(
    ends: np.ndarray, sentence_ends: np.ndarray, limit: int, sentence_penalty: int, hard_penalty: int
) -> tuple[list[int], list[int]]:
    """Cut positions and their penalties: document ends, sentence ends, and hard cuts in what is long without either."""
    total = int(ends[-1])
    # One sentence end in each SENTENCE_STRIDE tokens is as good as all of them.
    sentence_ends = sentence_ends[np.flatnonzero(np.diff(sentence_ends // SENTENCE_STRIDE, prepend=-1))]
    soft = np.union1d(np.append(ends, 0), sentence_ends)
    stride = min(HARD_STRIDE, limit)
    gaps = np.diff(soft)
    steps = (gaps - 1) // stride  # hard cuts in each gap
    wide = np.flatnonzero(steps)
    hard = [np.arange(soft[g] + stride, soft[g + 1], stride) for g in wide]
    # The block's last sequence can be a power of two long.
    tail = total - (1 << np.arange(limit.bit_length()))
    hard.append(tail[tail > 0])
    pos = np.union1d(soft, np.concatenate(hard))
    penalty = np.full(len(pos), hard_penalty, dtype=np.int64)
    penalty[np.searchsorted(pos, sentence_ends)] = sentence_penalty
    penalty[np.searchsorted(pos, ends)] = 0
    return pos.tolist(), penalty.tolist()


def pack_block(
    doc_ids: list, ids: list[bytes], first_sequence: int, ends_sentence: np.ndarray, limit: int,
    sentence_penalty: int, hard_penalty: int, sequence_penalty: int, with_ids: bool,
) -> tuple[dict[str, list], int]:
    """Pieces of one block (ids: bytes per document, never empty) and the number of its sequences."""
    stream = b"".join(ids)
    tokens = np.frombuffer(stream, dtype="<u4")
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    ends = np.cumsum(lengths)
    known = np.minimum(tokens, len(ends_sentence) - 1)
    sentence_ends = np.flatnonzero(ends_sentence[known] & (tokens < len(ends_sentence))) + 1
    pos, penalty = candidates(ends, sentence_ends, limit, sentence_penalty, hard_penalty)
    cuts = np.array(pos, dtype=np.int64)[plan_cuts(pos, penalty, limit, sequence_penalty)]
    # A piece ends where a document or a sequence does.
    edges = np.union1d(cuts, ends)
    if edges[0] != 0:
        edges = np.concatenate([[0], edges])
    begin, end = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, begin, side="right")
    sequence = np.searchsorted(cuts, begin, side="right") - 1
    view = memoryview(stream)
    out = {
        "doc_id": [doc_ids[d] for d in doc.tolist()],
        "start": begin - (ends - lengths)[doc],
        "length": end - begin,
        "ids_crc32": [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)],
        "doc_tokens": lengths[doc],
        "sequence_id": first_sequence + sequence,
        "offset": begin - cuts[sequence],
        "sequence_tokens": np.diff(cuts)[sequence],
    }
    if with_ids:
        out["ids"] = [tokens[a:b].astype(np.int32) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return out, len(cuts) - 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
    sentence_penalty: int = SENTENCE_PENALTY,
    hard_penalty: int = HARD_PENALTY,
    sequence_penalty: int = SEQUENCE_PENALTY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens
    (and the piece's ids if with_ids). tokenizer: path of the vocabulary file on the executors."""
    expect_long_texts(docs.sparkSession)
    schema = IDS if with_ids else PIECES
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal sequence, doc_ids, ids, held
            pieces, n = pack_block(
                doc_ids, ids, sequence, words.ends_sentence, limit, sentence_penalty, hard_penalty, sequence_penalty,
                with_ids,
            )
            sequence += n
            doc_ids, ids, held = [], [], 0
            return arrow_rows(pieces, schema)

        for keys, texts in text_chunks(batches, ["doc_id"], "text", 1 << 20):
            for (key,), text in zip(keys, texts, strict=True):
                doc_ids.append(key)
                ids.append(words.of(text) + end)
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield block()
        if ids:
            yield block()

    narrow = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return narrow.mapInArrow(tidy(run), PIECES_DDL + (", ids array<int>" if with_ids else ""))
