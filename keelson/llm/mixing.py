"""Mixing sources to target weights by Pareto order sampling, in native expressions.

Targets: the mix holds ``share`` times all words. Sources share it by weight (``weights`` repeats over the sources in
code-point order, null last); a target stops at ``most`` times its source's size and the excess is reshared by weight.
With sources sorted by cap / weight this has a closed form: the sources up to some place stop at their caps, and the
others get one common level times their weight.

Selection: a source whose target is e times its size takes floor(e) certain copies of each document. The words that
remain are an order sample of fixed size. Each document has an inclusion probability p = min(1, c * pull), where pull
rises with the square root of its size and c is the number at which the source's p * size sum to the remaining words.
Documents with p = 1 are taken as certain. Each other one has a uniform number u from a hash of its id; they are ranked by

    q = (u / (1 - u)) / (p / (1 - p))

(ties by u, then id) and taken in that order until the words the certain ones left are reached. The document on the
line goes in if that ends nearer to it; one longer than all words that remain can thus be taken less or more often than p.

c has a closed form per source from the words of each distinct pull (``levels``); there are at most as many pulls as
the root of the longest text's words. No source is sorted as a whole: documents are counted in ``bins`` intervals of
q / (1 + q) per source by a grouped sum, prefix sums over those counts find the interval where the words run out, and
only that interval's documents are put in order. As half the interval scale is where u = p, that interval holds about
one document in ``bins``. The cut (q, u and id) then decides each document by comparison, so a hot source costs no more
than others.

Rows: a null text has size 0 and is never counted; null sources form one source, the last; null ids hash alike; rows
equal in source, id and size rank alike and go in or out together; a source of no words takes none. An empty table
gives no row. Extra columns stay with the rows in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import WORD_PATTERN, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BINS = 4096
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from 50 bits of MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, ...) -> the same with target. One row per source; null is a source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    choose = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    by_cap = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    placed = (
        sizes.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", choose.cast("long"))
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        # What the sources with lower cap / weight hold at their caps, and the weight of this one and those above it.
        .withColumn("below", F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("above", F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("turn", F.row_number().over(by_cap))
        .withColumn("level", (F.col("total") - F.col("below")) / F.col("above"))
    )
    # The first source whose own cap the level does not reach sets the level; without one, all stop at their caps.
    uncapped = F.col("level") * F.col("weight") <= F.col("cap")
    return (
        placed.withColumn("common", F.min(F.when(uncapped, F.struct("turn", "level"))).over(everything)["level"])
        .withColumn(
            "target",
            F.coalesce(
                F.least(F.col("common") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double")
            ),
        )
        .drop("place", "weight", "cap", "total", "below", "above", "turn", "level", "common")
    )


def levels(held: DataFrame, sources: DataFrame) -> DataFrame:
    """The odds of each source's sample: l_source, limit, odds, room.

    held: (source, pull, held), the words of the documents with a pull; sources: (source, left), the words to sample.
    Documents with a pull above limit are certain, the others have p = odds * pull < 1 and fill room words. A source
    all of whose documents are certain has no row.
    """
    upto = W.partitionBy("source").orderBy("pull").rowsBetween(W.unboundedPreceding, 0)
    beyond = W.partitionBy("source").orderBy("pull").rowsBetween(1, W.unboundedFollowing)
    steps = (
        held.filter("held > 0")
        .withColumn("weighted", F.sum(F.col("pull") * F.col("held")).over(upto))
        .withColumn("certain", F.coalesce(F.sum("held").over(beyond), F.lit(0)))
    )
    by = sources.select(F.col("source").alias("l_source"), "left")
    rest = F.col("left") - F.col("certain")
    # p at this pull is below 1 if all larger pulls are certain. That holds up to one pull; the largest such one counts.
    return (
        steps.join(by, F.col("source").eqNullSafe(F.col("l_source")))
        .filter(rest * F.col("pull") < F.col("weighted"))
        .groupBy("l_source")
        .agg(F.max(F.struct(F.col("pull").alias("limit"), (rest / F.col("weighted")).alias("odds"), rest.alias("room"))).alias("at"))
        .select("l_source", "at.*")
    )


def decided(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    bins: int = BINS,
    seed: str = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source, source_size, target, copies (and the columns of keep in a struct named row)."""
    columns = [
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"),
    ]
    with_pull = docs.select(
        *columns, *([F.struct(*[F.col(c) for c in keep]).alias("row")] if keep else [])
    ).withColumn("pull", F.floor(F.sqrt("size")) + 1)
    # Texts are read once for their sizes; ids and sizes are what the rest works on.
    slim = staged(with_pull.drop("row"), "mix-sizes")
    held = staged(slim.groupBy("source", "pull").agg(F.sum("size").alias("held")), "mix-pulls")
    sources = targets(held.groupBy("source").agg(F.sum("held").alias("source_size")), weights, share, most)
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.withColumn("whole", F.floor(factor).cast("long")).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size")
    )
    sources = (
        sources.join(levels(held, sources), F.col("source").eqNullSafe(F.col("l_source")), "left").drop("l_source")
        .withColumn("limit", F.coalesce("limit", F.lit(0)))
    )
    sources = staged(sources, "mix-sources")
    p = F.col("odds") * F.col("pull")
    u = F.col("u")

    def ranked(rows: DataFrame, by: DataFrame) -> DataFrame:
        joined = rows.alias("d").join(by.withColumnRenamed("source", "s_source").alias("s"),
                                      F.col("s_source").eqNullSafe(F.col("d.source"))).drop("s_source")
        return (
            joined.withColumn("u", uniform(F.col("doc_id"), seed))
            .withColumn("q", F.when((F.col("pull") <= F.col("limit")) & (p > 0), u / (1 - u) * (1 - p) / p))
            .withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * bins))
        )

    sampled = ranked(slim, sources).filter((F.col("left") > 0) & (F.col("size") > 0) & F.col("q").isNotNull())
    counted = sampled.groupBy("source", "bin").agg(F.sum("size").alias("held"), F.first("room").alias("room"))
    upto = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    edge = (
        counted.withColumn("upto", F.sum("held").over(upto))
        .filter((F.col("upto") >= F.col("room")) & (F.col("upto") - F.col("held") < F.col("room")))
        .select(F.col("source").alias("e_source"), F.col("bin").alias("e_bin"),
                (F.col("room") - (F.col("upto") - F.col("held"))).alias("e_room"))
    )
    inside = W.partitionBy("source").orderBy("q", "u", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    close = (
        sampled.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bin") == F.col("e_bin")))
        .groupBy("source", "q", "u", "doc_id").agg(F.sum("size").alias("size"), F.first("e_room").alias("e_room"))
        .withColumn("run", F.sum("size").over(inside))
        # The document that crosses the line goes in if that ends nearer to it.
        .filter(F.col("run") - F.col("e_room") <= F.col("e_room") - (F.col("run") - F.col("size")))
        .groupBy("source").agg(F.max(F.struct("q", "u", "doc_id")).alias("last"))
        .select(F.col("source").alias("c_source"), "last")
    )
    lines = (
        sources.join(edge, F.col("source").eqNullSafe(F.col("e_source")), "left").drop("e_source", "e_room")
        .join(close, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    )
    lines = staged(lines, "mix-lines")
    at = F.struct("q", "u", "doc_id")
    extra = (
        F.when((F.col("left") <= 0) | (F.col("size") == 0), 0)
        .when(F.col("pull") > F.col("limit"), 1)
        .when(F.col("q").isNull(), 0)
        .when(F.col("e_bin").isNull(), 1)
        .when(F.col("bin") != F.col("e_bin"), (F.col("bin") < F.col("e_bin")).cast("int"))
        .otherwise(F.coalesce((at <= F.col("last")).cast("int"), F.lit(0)))
    )
    return ranked(with_pull if keep else slim, lines).withColumn("copies", (F.col("whole") + extra).cast("long")).select(
        "doc_id", "size", "source", "source_size", "target", "copies", *(["row"] if keep else [])
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it."""
    chosen = decided(docs, keep=tuple(docs.columns), **options)
    times = F.sequence(F.lit(1), F.col("copies"))
    return chosen.filter("copies > 0").select("row", F.explode(times)).select("row.*")
