"""Repeated substrings by blockwise sorting of a difference-cover sample of suffixes.

Every byte covered by a string of ``length`` bytes that starts at two or more places of the corpus is removed. The
places are (document, offset); strings never cross documents.

A difference cover D modulo v holds, for any two offsets i and j, a shift d < v with i + d and j + d both in D (mod
v). So two equal strings of ``length`` bytes share an aligned pair of sample suffixes within their first v bytes, and
those agree in their next length - v + 1 bytes at least. Only sample suffixes (q + 1 of every q*q + q + 1 offsets)
are therefore sorted:

1. Each sample suffix gets a seed (a hash of its first length - v + 1 bytes) and a rank class (a hash of all the bytes
   that strings through it can reach, v - 1 to each side). Suffixes are dealt to buckets by seed, those of one part of
   the seeds after those of another, and one bucket at a time is sorted by (seed, rank class). Equal rank classes settle a long tie at once: all strings through both are
   repeated, without looking at the strings one by one.
2. Suffixes with equal seeds but different rank classes (short passages, edges of copies) leave ties open. For one
   suffix of each such class, the strings through it are taken CELL starts at a time and sorted in the same way: a
   cell's seed is what all its strings share, its rank class all that they reach.
3. What is still open goes string by string.

All sorts see the suffixes of one chunk of text first: what repeats inside the chunk is settled there and only one
representative leaves it, so a passage that a third of all documents share sends one row per chunk and seed, not one
per document. Texts longer than a chunk are hashed in overlapping segments.

Two suffixes, cells or strings count as equal if two 64-bit rolling hashes of different bases agree: of the seed (or
half of the string's hash) and of all bytes that the strings reach.

Rows: null and empty texts have no bytes; rows with equal ids and texts are two places each, so both go; null ids and
ids that repeat with other texts are told apart by a hash of id and text; an empty table gives no row; extra columns
are ignored by ``repeated_spans`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import arrow_rows, expect_long_texts, release, row_key, staged, tidy, unused, worker_cache

LENGTH = 400
CHUNK_BYTES = 1 << 20
BLOCK = 1 << 14
#: So many strings or cells of a chunk are sorted at once: a chunk may be asked about all its starts.
ASKED_ROWS = 1 << 16
CELL = 52
#: Sample suffixes are dealt to their buckets in so many turns, by seed: one turn's shuffle is on disk at a time.
TURNS = 2
SLICE_ROWS = 256
SETTLE_ROWS = 20_000
ONE, SEVERAL, MIXED, SURE, ASK = range(5)
SAMPLE = pa.schema([("k", pa.int64()), ("w", pa.int64()), ("row", pa.int64()), ("lo", pa.int64()), ("more", pa.int64())])
SAMPLE_DDL = "k long, w long, row long, lo long, more long"
RANGES = pa.schema([("row", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("sure", pa.bool_())])
RANGES_DDL = "row long, lo long, hi long, sure boolean"


def difference_cover(q: int) -> np.ndarray:
    """q + 1 numbers below v = q*q + q + 1 (q prime) whose differences are all residues modulo v.

    The powers of a root of an irreducible cubic over GF(q), up to scalars, are the points of a projective plane; the
    exponents of the points on a line are such a set when the root generates all points.
    """
    v = q * q + q + 1
    for c in range(1, q):
        for b in range(q):
            if any((x**3 - b * x - c) % q == 0 for x in range(q)):
                continue
            x, cover = (1, 0, 0), []
            for i in range(v):
                if x[2] == 0:
                    cover.append(i)
                x = (c * x[2] % q, (x[0] + b * x[2]) % q, x[1])
            if len(cover) == q + 1 and len({(i - j) % v for i in cover for j in cover}) == v:
                return np.array(cover, dtype=np.int64)
    raise ValueError(f"no difference cover for {q}")


def cover_for(length: int) -> tuple[np.ndarray, int]:
    """The sparsest cover that leaves seeds of about a fifth of the length."""
    primes = [p for p in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31) if p * p + p + 1 <= 0.8 * length] or [2]
    q = primes[-1]
    if q * q + q + 1 > length:
        raise ValueError(f"strings of {length} bytes are too short")
    return difference_cover(q), q * q + q + 1


class Rolling:
    """Hashes of any substrings of one byte string: differences of prefix sums of byte codes times powers.

    A power is that of its block's start times that within the block, so that besides the sums nothing is as long as
    the string.
    """

    def __init__(self, text: bytes, salt: int):
        codes, low, high, self.low, inverse = tables(salt)
        data = np.frombuffer(text, dtype=np.uint8)
        self.high = powers(inverse, len(data) // BLOCK + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        for at, power in zip(range(0, len(data), BLOCK), powers(high, len(data) // BLOCK + 1), strict=False):
            terms = codes[data[at : at + BLOCK]]
            terms *= low[: len(terms)]
            terms *= power
            terms[:1] += self.sums[at : at + 1]
            np.cumsum(terms, out=self.sums[at + 1 : at + 1 + len(terms)])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = self.sums[stop]
        h -= self.sums[start]
        h *= self.low[start % BLOCK]
        h *= self.high[start // BLOCK]
        h += (stop - start).astype(np.uint64)
        return mixed(h)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def tables(salt: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, int]:
    """Codes of the bytes; of the base and of its inverse: the powers below BLOCK and the power BLOCK."""
    cache = worker_cache("rolling hashes")
    if salt not in cache:
        rng = np.random.Generator(np.random.PCG64(salt))
        codes = rng.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(rng.integers(2**62, 2**63)) * 2 + 1
        cache[salt] = (codes, *(x for b in (base, pow(base, -1, 2**64)) for x in (powers(b, BLOCK), pow(b, BLOCK, 2**64))))
    return cache[salt]


Piece = tuple[int, int, int, bytes, int, int, object]  # row, text length, offset of the piece, piece, core from, to, extra


def pieces(batches: Iterable[pa.RecordBatch], before: int, after: int, extra: str | None = None) -> Iterator[list[Piece]]:
    """Lists of about CHUNK_BYTES of text. A longer text is cut into cores, each with what stands around it."""
    held: list[Piece] = []
    size = 0
    for batch in batches:
        rows = batch.column(batch.schema.get_field_index("row")).to_pylist()
        more = batch.column(batch.schema.get_field_index(extra)) if extra else [None] * len(rows)
        for row, cell, add in zip(rows, batch.column(batch.schema.get_field_index("text")), more, strict=True):
            text = cell.as_buffer() if cell.is_valid else b""
            n = len(text) if cell.is_valid else 0
            view = memoryview(text)
            for core in range(0, n, CHUNK_BYTES):
                lo, hi = max(0, core - before), min(n, core + CHUNK_BYTES + after)
                held.append((row, n, lo, bytes(view[lo:hi]), core, min(n, core + CHUNK_BYTES), add))
                size += hi - lo
                if size >= CHUNK_BYTES:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def pre_sorted(
    k: np.ndarray, w: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray | None = None
) -> pa.RecordBatch:
    """One chunk's suffixes in sorted order, settled as far as the chunk alone allows.

    Kinds: ONE of its seed; SEVERAL, for all of one class; MIXED, that a seed has several classes here; and ranges of
    starts that need no bucket (under keys of their own): SURE (repeated) and ASK (to be looked at closer).

    lo, hi: the starts of the strings through a suffix; at: its own offset, which is what is asked about if given.
    """
    order = np.lexsort((w, k))
    k, w, row, lo, hi = k[order], w[order], row[order], lo[order], hi[order]
    at = None if at is None else at[order]
    more = (hi - lo) << 15 | (0 if at is None else (at - lo) << 3)
    new_k = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    new_class = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])]))
    size_k = np.diff(np.append(new_k, len(k)))
    size_class = np.diff(np.append(new_class, len(k)))
    classes = np.diff(np.append(np.searchsorted(new_class, new_k), len(new_class)))
    whole = np.repeat(classes == 1, size_k)  # by suffix: its seed has one class here
    alone = np.repeat(size_k == 1, size_k)
    shared = np.repeat(size_class > 1, size_class)  # by suffix: its class has several here
    first = np.zeros(len(k), dtype=bool)
    first[new_class] = True

    parts = [(k[alone], w[alone], row[alone], lo[alone], more[alone] | ONE)]
    several = whole & ~alone & first
    parts.append((k[several], w[several], row[several], lo[several], more[several] | SEVERAL))
    some = new_k[classes > 1]
    parts.append((k[some], np.zeros(len(some), dtype=np.uint64), row[some], lo[some], np.full(len(some), MIXED)))
    for pick, kind, a, b in (
        (shared & ~(whole & first), SURE, lo, hi),
        (~whole & first, ASK, *((lo, hi) if at is None else (at, at))),
    ):
        r, a, b = merged(row[pick], a[pick], b[pick])
        own = mixed(r.astype(np.uint64) * np.uint64(31) + a.astype(np.uint64))
        parts.append((own, np.zeros(len(r), dtype=np.uint64), r, a, (b - a) << 15 | kind))
    k, w, row, lo, more = (np.concatenate(x) for x in zip(*parts, strict=True))
    return arrow_rows(
        {"k": k.view(np.int64), "w": w.view(np.int64), "row": row, "lo": lo, "more": more.astype(np.int64)}, SAMPLE
    )


def merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges lo..hi (both included) of each row, joined where they touch."""
    if not len(row):
        return row, lo, hi
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    # Rows one after another on one line, far enough apart not to touch: running maxima then stay within a row.
    starts = np.concatenate([[True], row[1:] != row[:-1]])
    place = np.cumsum(starts) - 1
    shift = place * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + shift)
    new = np.concatenate([[True], (lo + shift)[1:] > reach[:-1] + 1])
    at = np.flatnonzero(new)
    last = np.append(at[1:] - 1, len(row) - 1)
    return row[at], lo[at], reach[last] - shift[at]


def sample_suffixes(docs: DataFrame, length: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """The sample suffixes whose seed is turn modulo turns: all that have a seed come in the same turn."""
    cover, v = cover_for(length)
    seed = length - v + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = (np.arange(0, CHUNK_BYTES + v, v)[:, None] + cover).ravel()
        for held in pieces(batches, v - 1, length):
            rows, places, froms, befores, reaches, ends = [], [], [], [], [], []
            base = 0
            for row, n, offset, body, core, stop, _ in held:
                stop = min(stop, n - seed + 1)
                if n >= length and core < stop:
                    begin = core // v * v  # samples are laid from the text's start
                    a, b = np.searchsorted(pattern, (core - begin, stop - begin))
                    p = pattern[a:b] + begin
                    rows.append(np.full(len(p), row, dtype=np.int64))
                    places.append(p)
                    froms.append(np.full(len(p), base - offset, dtype=np.int64))
                    ends.append(np.full(len(p), n, dtype=np.int64))
                base += len(body)
            if not rows:
                continue
            row, p, shift, n = (np.concatenate(x) for x in (rows, places, froms, ends))
            lo = np.maximum(p - (v - 1), 0)
            stop = np.minimum(p + length, n)  # seed + v - 1 is length
            fits = stop - lo >= length
            row, p, shift, n, lo, stop = (x[fits] for x in (row, p, shift, n, lo, stop))
            if not len(row):
                continue
            text = b"".join(x[3] for x in held)
            k = Rolling(text, 1)(p + shift, p + shift + seed)
            if turns > 1:
                now = k % np.uint64(turns) == turn
                k, row, p, shift, n, lo, stop = (x[now] for x in (k, row, p, shift, n, lo, stop))
                if not len(k):
                    continue
            w = mixed(Rolling(text, 2)(lo + shift, stop + shift) + (p - lo).astype(np.uint64))
            del text
            yield pre_sorted(k, w, row, lo, np.minimum(p, n - length), p)

    return docs.mapInArrow(tidy(run), SAMPLE_DDL)


def ranges_of(asked: pa.Scalar, first: int, stop: int) -> list[np.ndarray]:
    """The numbers from first up to stop that the ranges hold, each once: ranges of several buckets overlap."""
    cells = asked.values
    lo, hi = (cells.field(i).to_numpy() for i in range(2))
    _, lo, hi = merged(np.zeros(len(lo), dtype=np.int64), lo, hi)
    lo, hi = np.maximum(lo, first), np.minimum(hi + 1, stop)
    return [np.arange(a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if a < b]


def asked_places(held: list[Piece], most: int, past: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, place, what to add for the place in the joined pieces, text length), about most at once.

    past: places fewer than so many bytes before the text's end are left out.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    size = base = 0
    for row, n, offset, body, core, stop, asked in held:
        p = np.concatenate([np.zeros(0, dtype=np.int64), *ranges_of(asked, core, min(stop, n - past + 1))])
        for at in range(0, len(p), most):
            some = p[at : at + most]
            parts.append((np.full(len(some), row), some, np.full(len(some), base - offset), np.full(len(some), n)))
            size += len(some)
            if size >= most:
                yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                parts, size = [], 0
        base += len(body)
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def hashes(held: list[Piece], salts: tuple[int, ...]) -> list[Rolling]:
    text = b"".join(x[3] for x in held)
    return [Rolling(text, salt) for salt in salts]


def asked_cells(docs: DataFrame, length: int) -> DataFrame:
    """docs: row, text, asked (array of ranges of offsets of sample suffixes)."""
    _, v = cover_for(length)
    near = np.arange(0, v, CELL)  # a cell's strings start near to far bytes before the suffix
    far = np.minimum(near + CELL, v) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in pieces(batches, v - 1, length, "asked"):
            of = None
            for places in asked_places(held, max(1, ASKED_ROWS // len(near)), 1):
                short, long = np.tile(near, len(places[0])), np.tile(far, len(places[0]))
                row, p, shift, n = (np.repeat(x, len(near)) for x in places)
                lo, hi = np.maximum(p - long, 0), np.minimum(p - short, n - length)
                some = lo <= hi
                row, p, shift, short, long, lo, hi = (x[some] for x in (row, p, shift, short, long, lo, hi))
                if not len(row):
                    continue
                of = of or hashes(held, (1, 2))
                k = mixed(of[0](p - short + shift, p - long + length + shift) + short.astype(np.uint64))
                w = mixed(of[1](lo + shift, hi + length + shift) + (p - lo).astype(np.uint64))
                yield pre_sorted(k, w, row, lo, hi)

    return docs.mapInArrow(tidy(run), SAMPLE_DDL)


def asked_strings(docs: DataFrame, length: int) -> DataFrame:
    """docs: row, text, asked (array of ranges of starts)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in pieces(batches, 0, length, "asked"):
            of = None
            for row, s, shift, _ in asked_places(held, ASKED_ROWS, length):
                of = of or hashes(held, (2, 3))
                k, w = (h(s + shift, s + shift + length) for h in of)
                # Here a class is a string: seeds (first half of its hash) agree by chance only.
                yield pre_sorted(k, w, row, s, s)

    return docs.mapInArrow(tidy(run), SAMPLE_DDL)


def sorted_buckets(sample: DataFrame, asking: str | None) -> DataFrame:
    """Ranges (row, lo, hi, sure) that sorting each bucket by (k, w) settles as repeated starts, or asks about.

    asking: about "starts", about "suffixes" (their own offsets), or None where there is nothing left to ask.
    """

    def settle(k, w, row, lo, more) -> pa.RecordBatch | None:
        kind, hi, own_offset = more & 7, lo + (more >> 15), lo + ((more >> 3) & 0xFFF)
        own = kind >= SURE
        live = ~own
        new_k = np.concatenate([[True], k[1:] != k[:-1]])
        new_class = new_k | np.concatenate([[True], w[1:] != w[:-1]])
        by_k, by_class = np.cumsum(new_k) - 1, np.cumsum(new_class) - 1
        weight = np.where(kind == ONE, 1, 2) * live
        members = np.bincount(by_k, weight)[by_k]
        alike = np.bincount(by_class, weight * (kind != MIXED))[by_class]
        classes = np.bincount(by_k, new_class & live)[by_k]
        mix = (classes > 1) | (np.bincount(by_k, kind == MIXED)[by_k] > 0)
        first = np.zeros(len(k), dtype=bool)
        plain = live & (kind != MIXED)
        at = np.flatnonzero(plain)
        first[at[np.unique(by_class[at], return_index=True)[1]]] = True
        sure = (plain & (alike > 1)) | (kind == SURE)
        out = [merged(row[sure], lo[sure], hi[sure])]
        if asking:
            ask = plain & first & mix & (members > 1)
            a, b = (own_offset, own_offset) if asking == "suffixes" else (lo, hi)
            a, b = np.where(kind == ASK, lo, a), np.where(kind == ASK, hi, b)
            ask |= kind == ASK
            out.append(merged(row[ask], a[ask], b[ask]))
        row, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True))
        if not len(row):
            return None
        flag = np.arange(len(row)) < len(out[0][0])
        return arrow_rows({"row": row, "lo": lo, "hi": hi, "sure": flag}, RANGES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []  # parts not settled yet, as lists of columns
        size = 0
        for batch in batches:
            rest.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            size += batch.num_rows
            if size < SETTLE_ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*rest, strict=True)]
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            rest = [[c[cut:] for c in columns]]
            size = len(columns[0]) - cut
            if cut and (out := settle(*[c[:cut] for c in columns])) is not None:
                yield out
        if size and (out := settle(*[np.concatenate(c) for c in zip(*rest, strict=True)])) is not None:
            yield out

    bucketed = sample.repartition("k").sortWithinPartitions("k", "w")
    return bucketed.mapInArrow(tidy(run), RANGES_DDL)


def by_row(ranges: DataFrame, name: str) -> DataFrame:
    return ranges.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias(name))


def repeated_starts(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, lo, hi): ranges of offsets at which a string of length bytes starts that also starts elsewhere.

    keyed: row (long), text.
    """
    spark = keyed.sparkSession
    expect_long_texts(spark)
    found = None
    for turn in range(TURNS):
        part = staged(sorted_buckets(sample_suffixes(keyed, length, turn, TURNS), "suffixes"), "suffix-buckets")
        found = part if found is None else found.union(part)
        release(spark)
    starts = found.filter("sure")
    for name, strings, asking in (("cells", asked_cells, "starts"), ("strings", asked_strings, None)):
        asked = keyed.join(by_row(found.filter("not sure"), "asked"), "row")
        found = staged(sorted_buckets(strings(asked, length), asking), f"suffix-{name}")
        release(spark)
        starts = starts.union(found.filter("sure"))
    return starts.select("row", "lo", "hi")


def covered(ranges: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs (from, to) of bytes that strings starting in the ranges cover."""
    runs: list[tuple[int, int]] = []
    for r in sorted(ranges, key=lambda r: r["lo"]):
        lo, hi = r["lo"], r["hi"] + length
        if runs and lo <= runs[-1][1]:
            if hi > runs[-1][1]:
                runs[-1] = (runs[-1][0], hi)
        else:
            runs.append((lo, hi))
    return runs


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for lo, hi in runs:
        out.append(text[at:lo])
        at = hi
    out.append(text[at:])
    return b"".join(out)


def with_runs(docs: DataFrame, text_col: str, key: F.Column, length: int, runs: str) -> DataFrame:
    """docs with a column runs: the ranges of repeated starts, null where there are none."""
    keyed = docs.select(key.alias("row"), F.col(text_col).cast("string").alias("text"))
    row = unused([*docs.columns, runs], "__row")
    starts = by_row(repeated_starts(keyed, length), runs).withColumnRenamed("row", row)
    return docs.withColumn(row, key).join(starts, row, "left").drop(row)


def per_text(
    batches: Iterable[pa.RecordBatch], text_col: str, length: int, use: Callable, runs: str
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Small slices of the batches with use(text, runs) of each row."""
    worker_cache("spans")
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            ranges = batch.column(batch.schema.get_field_index(runs))
            yield batch, [
                use(t.as_py() or b"", covered(r.as_py() or [], length)) for t, r in zip(texts, ranges, strict=True)
            ]


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """doc_id, n_bytes, spans (array of byte ranges from, to), kept_sha256, kept_text: one row per row of docs.

    kept_text is what is left as text; a character cut in two is not in it, though its bytes are in the digest.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
            ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept_sha256", pa.string()),
            ("kept_text", pa.string()),
        ]
    )

    def use(body: bytes, runs: list[tuple[int, int]]) -> tuple:
        kept = kept_bytes(body, runs)
        spans = [{"from": a, "to": b} for a, b in runs]
        return len(body), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, out in per_text(batches, "__text", length, use, "__runs"):
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            cells = [list(x) for x in zip(*out, strict=True)] or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(cells, list(schema)[1:], strict=True)]],
                schema=schema,
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    marked = with_runs(narrow, "__text", row_key(narrow, "doc_id", "__text"), length, "__runs")
    return marked.mapInArrow(
        tidy(run), "doc_id long, n_bytes long, spans array<struct<`from`: long, `to`: long>>, kept_sha256 string, kept_text string"
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """docs with the repeated bytes taken out of the text. A character cut in two goes whole."""
    columns = docs.columns
    ranges = unused(columns, "__runs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = lambda body, runs: kept_bytes(body, runs).decode("utf-8", "ignore")
        for batch, out in per_text(batches, text_col, length, use, ranges):
            at = batch.schema.get_field_index(text_col)
            whole = batch.column(at)
            texts = pa.array([t if w.is_valid else None for t, w in zip(out, whole, strict=True)], pa.string())
            cells = [texts if i == at else batch.column(batch.schema.get_field_index(c)) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(cells, names=columns)

    marked = with_runs(docs, text_col, row_key(docs, id_col, text_col), length, ranges)
    return marked.select(*columns, ranges).mapInArrow(tidy(run), docs.schema)
