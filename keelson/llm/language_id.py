"""Language identification by Bayesian evidence fusion.

The evidence on a row's language l:

* its text: a naive Bayes model over hashed byte trigrams of the whole text. Neighbouring trigrams are not independent,
  so the log-likelihood of n trigrams is scaled by 1 / sqrt(n);
* the language its markup declares: P(declared | l), counted over all rows;
* its address: P(l | host), smoothed towards P(l | suffix of the host), and that towards P(l).

Both tables are grouped sums of the text posteriors over all rows (soft counts), so a wrong declaration costs only as
much as declarations are wrong in this corpus, and a host of few rows follows its suffix. Sums are combined before
the shuffle; a hot host is one row of its table.

The trigram model is fitted on at most ``most_labelled`` labelled rows per language, chosen by a hash of the id.

The fitted languages are not all there is: the text is also scored as none of them, its trigrams being then letters in
no order (each by its frequency in the fitted texts) or, as likely, any trigram alike. That model leans on what was
fitted as far as the languages do: few labelled texts leave it, like them, near to all trigrams alike. With a prior of
``NONE`` it is held against the language that fits the text best, by a third of the difference of log-likelihoods, as
each byte is in three trigrams. A declaration or an address does not enter this: it tells which language, not whether
there is one.

A row is rejected when its text holds no letter, when its text is more likely none of the languages, or when the best
language's posterior (among the fitted ones) is below ``least``.

Rows: null and empty texts have no letters; a null or unknown declaration and a null host are values of their own (the
prior of a null host is that of its suffix, the null one); repeated rows are judged one by one; an empty table gives
no row; extra columns stay, also those named like the added ones unless they would hide them (then an error is raised).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import expect_long_texts, give_back, staged, text_chunks, tidy, worker_cache

BUCKET_BITS = 16
CELL_BITS = BUCKET_BITS + 1
MOST_LABELLED = 300
SMOOTH = 0.5
HOST_WEIGHT = 20.0
SUFFIX_WEIGHT = 50.0
LEAST = 0.5
NONE = 0.01
CHUNK = 1 << 19
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class TextModel:
    """languages in order; log P(trigram bucket | language), one row per bucket; P(byte) in trigrams of all languages;
    share of P(trigram | none) that comes from the bytes, the rest is the same for all."""

    languages: tuple[str, ...]
    logs: np.ndarray
    symbols: np.ndarray
    leaning: float


# Letters in lower case; all that is not a letter is a blank. Bytes above 7F belong to letters beyond ASCII.
FOLD = np.full(256, 32, dtype=np.uint32)
FOLD[128:] = np.arange(128, 256)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram, its text, letters per text, its three bytes); a blank stands before and after each text."""
    joined = b" " + b"  ".join(texts) + b" "
    data = FOLD[np.frombuffer(joined, dtype=np.uint8)]
    size = np.array([len(t) for t in texts], dtype=np.int64) + 2
    doc = np.repeat(np.arange(len(texts)), size)
    letter = data != 32
    letters = np.bincount(doc, letter, minlength=len(texts))
    code = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA6B)) ^ (data[2:] * np.uint32(0xC2B2AE35))
    code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKET_BITS)
    # Trigrams around a letter, within one text.
    at = np.flatnonzero(letter[1:-1] & (doc[:-2] == doc[2:]))
    return code[at], doc[at], letters, np.stack([data[at], data[at + 1], data[at + 2]]).astype(np.uint8)


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most_labelled: int = MOST_LABELLED) -> TextModel:
    """Collects one count per language and bucket, whatever the size of docs."""
    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).cast("string").alias("id")
    )
    # The most_labelled least hashes of each language: kept as a bounded set while partitions are merged.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A hash threshold twice as wide as needed bounds what is put in order. Every language is fitted, however many: its
    # row here is small against its column of the model, which goes to every task too.
    near = known.join(F.broadcast(sizes), "lang").filter(
        (F.col("h").cast("double") + 2.0**63) / 2.0**64 <= 2.0 * most_labelled / F.col("n") + 1e-9
    )
    least = (
        near.groupBy("lang").agg(F.slice(F.sort_array(F.collect_set("h")), 1, most_labelled).alias("h"))
        .select("lang", F.explode("h").alias("h"))
    )
    rows = docs.select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).cast("string").alias("text")
    ).join(F.broadcast(least), ["lang", "h"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_chunks(batches, ["lang"], "text", CHUNK):
            bucket, doc, _, three = grams(texts)
            langs = sorted({k for (k,) in keys})
            place = np.array([langs.index(k) for (k,) in keys], dtype=np.int64)[doc] << CELL_BITS
            # Bytes are counted in the cells behind the buckets.
            cells = [place | bucket, *[place | 1 << BUCKET_BITS | b for b in three]]
            cell, n = np.unique(np.concatenate(cells), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[c >> CELL_BITS] for c in cell.tolist()], pa.string()), pa.array(cell & ((1 << CELL_BITS) - 1)), pa.array(n)],
                ["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(tidy(run), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.collect()
    languages = tuple(sorted({r.lang for r in got}))
    buckets = 1 << BUCKET_BITS
    own: dict[str, list] = {lang: [] for lang in languages}
    symbols = np.zeros(256)
    for r in got:
        if r.bucket < buckets:
            own[r.lang].append((r.bucket, r.n))
        else:
            symbols[r.bucket - buckets] += r.n
    # One language at a time in full width: what stays is 4 bytes a bucket and language.
    logs = np.full((buckets, max(len(languages), 1)), -math.log(buckets), dtype=np.float32)
    weights = []
    for i, lang in enumerate(languages):
        column = np.full(buckets, SMOOTH)
        at, n = np.array(own.pop(lang)).T
        column[at] += n
        logs[:, i] = np.log(column / column.sum())
        weights.append(1 - SMOOTH * buckets / column.sum())
    # What the counts weigh against SMOOTH in a language's column; half of it are bytes in no order.
    leaning = float(np.mean(weights)) / 2 if weights else 0.0
    return TextModel(languages, logs, symbols / max(symbols.sum(), 1.0), leaning)


def text_evidence(text: Column, model: TextModel) -> Column:
    """Scaled log-likelihood by language, and behind what the best has over none of them; null for a text without letters."""
    table = active_context().broadcast((model.logs, model.symbols, model.leaning))

    @F.pandas_udf("array<double>")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("language")
        logs, symbols, leaning = table.value
        for part in parts:
            out: list = []
            texts: list[bytes] = []
            held = 0
            for text in part:
                texts.append((text or "").encode())
                held += len(texts[-1])
                if held >= CHUNK:
                    out.extend(scores(texts, logs, symbols, leaning))
                    texts, held = [], 0
            if texts:
                out.extend(scores(texts, logs, symbols, leaning))
            yield pd.Series(out, index=part.index, dtype=object)
        give_back()

    return evidence(text)


def scores(texts: list[bytes], logs: np.ndarray, symbols: np.ndarray | None = None, leaning: float = 0.0) -> list:
    """By language; with symbols, one more: a third of what the best language has over none."""
    bucket, doc, letters, three = grams(texts)
    n = np.bincount(doc, minlength=len(texts))
    total = [np.bincount(doc, logs[bucket, i], minlength=len(texts)) for i in range(logs.shape[1])]
    total = np.stack(total, axis=1)
    scaled = total / np.sqrt(np.maximum(n, 1))[:, None]
    if symbols is not None:
        unordered = symbols[three[0]] * symbols[three[1]] * symbols[three[2]]
        none = np.log(leaning * unordered + (1 - leaning) / (1 << BUCKET_BITS))
        over = total.max(axis=1) - np.bincount(doc, none, minlength=len(texts))
        scaled = np.column_stack([scaled, over / 3])
    return [s if has else None for s, has in zip(scaled, letters > 0, strict=True)]


def active_context():
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext


def softmax(scores: Column) -> Column:
    powers = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def suffix_of(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def identify(
    docs: DataFrame,
    model: TextModel,
    text: Column,
    declared: Column,
    host: Column,
    suffix: Column | None = None,
    least: float = LEAST,
) -> DataFrame:
    """docs with lang_id (null if rejected without evidence), lang_confidence and lang_kept."""
    added = {"lang_id", "lang_confidence", "lang_kept"}
    if added & set(docs.columns):
        raise ValueError(f"columns {sorted(added & set(docs.columns))} are in the way")
    if not model.languages:
        return docs.withColumns(
            {"lang_id": F.lit(None).cast("string"), "lang_confidence": F.lit(0.0), "lang_kept": F.lit(False)}
        )
    expect_long_texts(docs.sparkSession)
    langs = range(len(model.languages))
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        text_evidence(text, model).alias("scored"),
        F.lower(declared.cast("string")).alias("declared"),
        host.cast("string").alias("host"),
        (suffix if suffix is not None else suffix_of(host.cast("string"))).alias("suffix"),
    )
    held = held.withColumn("seen", F.slice("scored", 1, len(model.languages))).withColumn(
        "over_none", F.get("scored", F.lit(len(model.languages)))
    ).drop("scored")
    soft = held.filter("seen is not null").select("declared", "host", "suffix", softmax(F.col("seen")).alias("p"))
    sums = [F.sum(F.element_at("p", i + 1)).alias(f"p{i}") for i in langs]
    counted = staged(soft.groupBy("declared", "host", "suffix").agg(*sums), "language-counts")
    again = lambda *by: counted.groupBy(*by).agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in langs])
    table = lambda: F.array(*[F.col(f"p{i}") for i in langs])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    share = lambda own, prior, weight: F.transform(
        own, lambda x, i: (x + weight * F.get(prior, i)) / (total(own) + weight)
    )

    # One number per language goes through the driver.
    per_lang = [float(x or 0.0) for x in again().first()]
    base = [(x + 1) / (sum(per_lang) + len(per_lang)) for x in per_lang]
    constants = lambda values: F.array(*[F.lit(v) for v in values])
    suffixes = again("suffix").select(
        F.col("suffix").alias("s_suffix"), share(table(), constants(base), SUFFIX_WEIGHT).alias("by_suffix")
    )
    hosts = (
        again("host", "suffix").join(suffixes, F.col("suffix").eqNullSafe(F.col("s_suffix")))
        .select(
            F.col("host").alias("h_host"), F.col("suffix").alias("h_suffix"),
            share(table(), F.col("by_suffix"), HOST_WEIGHT).alias("prior"),
        )
    )
    # Host and declaration tables are as small as their names: within BROADCAST_BYTES they go to every task, so the
    # texts stay where they are; beyond, the join is left to the planner, which splits hot hosts.
    name_bytes = counted.select(
        F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("declared", "host", "suffix")) + 16 * len(per_lang) + 64)
    ).first()[0]
    sent = F.broadcast if (name_bytes or 0) <= BROADCAST_BYTES else (lambda frame: frame)
    declarations = again("declared").select(
        F.col("declared").alias("d_declared"),
        F.transform(table(), lambda x, i: (x + SMOOTH) / (F.get(constants(per_lang), i) + 2 * SMOOTH)).alias("says"),
    )
    fused = (
        held.join(sent(hosts), F.col("host").eqNullSafe(F.col("h_host")) & F.col("suffix").eqNullSafe(F.col("h_suffix")), "left")
        .join(sent(declarations), F.col("declared").eqNullSafe(F.col("d_declared")), "left")
        .withColumn(
            "posterior",
            softmax(F.transform("seen", lambda s, i: s + F.log(F.get("prior", i)) + F.log(F.get("says", i)))),
        )
        .withColumn("lang_confidence", F.coalesce(F.array_max("posterior"), F.lit(0.0)))
    )
    names = F.array(*[F.lit(x) for x in model.languages])
    told = F.col("over_none") >= math.log(NONE / (1 - NONE))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return fused.select(
        "row.*",
        F.when(F.col("posterior").isNotNull(), F.element_at(names, best)).alias("lang_id"),
        "lang_confidence",
        ((F.col("lang_confidence") >= least) & F.coalesce(told, F.lit(False))).alias("lang_kept"),
    )


def markup_text(html: Column) -> Column:
    """What a reader sees: no scripts, styles, tags or entities."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")


def markup_language(html: Column) -> Column:
    """The primary subtag of the html element's lang attribute, or null."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1)
    return F.when(found != "", F.lower(found))
