"""MinHash near-duplicates with tensored banding.

A text is lower-cased (A-Z), cut into words, and its set is the set of distinct shingles of two words (the whole
sequence where there are fewer words). Two documents are linked if the Jaccard similarity of their sets is 80 % or more.

Tensored banding: two small collections of minhash groups are computed, LEFT groups of LEFT_WIDTH minhashes and RIGHT
groups of RIGHT_WIDTH. Every pair of a left and a right group keys one table, so LEFT * RIGHT tables of
LEFT_WIDTH + RIGHT_WIDTH minhashes each cost only LEFT * LEFT_WIDTH + RIGHT * RIGHT_WIDTH minhashes (62 for 140 tables
of five, where independent tables would need 700). Two sets meet in a table if and only if a left and a right group
agree, so a pair of similarity s is missed with probability 1 - (1 - (1 - s^2)^10) * (1 - (1 - s^3)^14): 8e-5 at 0.8,
4e-7 at 0.9.

1. Documents with equal sets (128-bit fingerprint) become one set: a group of copies is one entry everywhere below.
2. Table entries (key, set) are sorted by range of (key, set), so a key with very many sets spreads over tasks, and only
   entries whose key has company go on.
3. Rounds: in every bucket the first sets are leaders; a leader meets the bucket's later sets that are not yet in its
   component; new pairs are confirmed on the full sets and the components updated. Leaders have met everyone and leave.
   A bucket is done when its sets are in one component. Rounds take 1, then 8, then 64 ... leaders a bucket, so a large
   group of near copies costs about one comparison a set.
4. After ROUNDS rounds the sets of buckets not done (many texts around one passage, which are no copies) are dealt anew
   by the rarest of their own shingles, so many of them that similar sets share one, and the rounds go on there; pairs
   whose parity maps differ in more bins than similar sets can differ in members are not compared. So every pair that
   shares a table is compared, already connected, or proven not to be similar. Nothing is capped: rounds end when no
   bucket holds two components that could still meet.

Rows: null, empty and blank texts have an empty set and are linked with nothing; rows with the same or null ids are
separate rows (a component's id is its least id, null if it has none); an empty table gives no row; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import arrow_rows, expect_long_texts, ids_tell_rows_apart, release, staged, text_chunks, worker_cache
from keelson.llm.components import components

SHINGLE = 2
PERCENT = 80
SEED = 42
LEFT, LEFT_WIDTH = 10, 2
RIGHT, RIGHT_WIDTH = 14, 3
HASHES = LEFT * LEFT_WIDTH + RIGHT * RIGHT_WIDTH
LEADERS = 8
ROUNDS = 1
#: Longs of a set's parity map.
PARITY = 16
#: Ids of documents to be read again, and numbers of sets to be compared, are broadcast up to this many; more are joined.
BROADCAST_IDS = 1 << 20
PRINTS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("signature", pa.binary())]
)
PRINTS_DDL = "doc_id long, n long, f1 long, f2 long, signature binary"
SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("hashes", pa.list_(pa.int64())),
        ("parity", pa.list_(pa.int64())),
    ]
)
SETS_DDL = "doc_id long, f1 long, f2 long, hashes array<long>, parity array<long>"


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@cache
def salts(n: int, seed: int, dtype: type = np.uint64) -> np.ndarray:
    """n numbers, drawn once a process; as a column, to meet a row of hashes."""
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 2 ** (8 * np.dtype(dtype).itemsize), n, dtype=dtype)
    drawn.flags.writeable = False
    return drawn[:, None]


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, sorted. A shingle's hash mixes its words' XXH64 in order."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    of_words = np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), dtype=np.uint64, count=len(words))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    hashes = of_words[:n]
    for at in range(1, width):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + of_words[at : at + n]
    hashes = mixed(hashes)
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def set_print(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart: sums of two independent mixes of the members."""
    return tuple(mixed(hashes ^ salts(2, 7)).sum(axis=1, dtype=np.uint64).view(np.int64).tolist())


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """The least member in each of HASHES orders: of the members' upper halves times an odd number, plus another.

    The members are well mixed already, so that one product of 32 bits deals them anew.
    """
    times, plus = salts(HASHES, SEED, np.uint32) | np.uint32(1), salts(HASHES, SEED + 1, np.uint32)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(upper), 1 << 12):
        dealt = upper[at : at + (1 << 12)] * times
        dealt += plus
        np.minimum(least, dealt.min(axis=1), out=least)
    return least


def signatures(least: np.ndarray) -> np.ndarray:
    """(sets, LEFT + RIGHT) hashes of the left and the right groups of each set's minhashes."""
    groups = []
    for part, width in ((least[:, : LEFT * LEFT_WIDTH], LEFT_WIDTH), (least[:, LEFT * LEFT_WIDTH :], RIGHT_WIDTH)):
        columns = part.reshape(len(part), -1, width).astype(np.uint64)
        held = np.zeros(columns.shape[:2], dtype=np.uint64)
        for i in range(width):
            held = mixed(held * np.uint64(3) + columns[:, :, i])
        groups.append(held)
    return np.concatenate(groups, axis=1)


def signature(hashes: np.ndarray) -> bytes:
    """The hashes of the left and the right groups of minhashes."""
    return signatures(minhashes(hashes)[None, :]).tobytes()


def table_keys(signatures: np.ndarray) -> np.ndarray:
    """(sets, LEFT * RIGHT) keys: each left group with each right group, told apart by the table's number."""
    left, right = signatures[:, :LEFT], signatures[:, LEFT:]
    both = left[:, :, None] * np.uint64(3) + mixed(right)[:, None, :]
    number = np.arange(LEFT * RIGHT, dtype=np.uint64).reshape(1, LEFT, RIGHT) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(both + number).reshape(len(signatures), -1)


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 * PARITY bins the parity of the members in it.

    A member of only one of two sets changes one bin's parity, so the maps differ in no more bins than the sets do in
    members: more differing bins than similar sets may have prove that two sets are not similar.
    """
    counts = np.bincount((hashes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def narrowed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")


def set_prints(docs: DataFrame, shingle: int) -> DataFrame:
    """docs: doc_id, text. One row per row: size, fingerprint and signature of its set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("minhash")
        for keys, texts in text_chunks(batches, ["doc_id"], "text", 1 << 20):
            out: dict[str, list] = {f.name: [] for f in PRINTS}
            least = np.zeros((len(texts), HASHES), dtype=np.uint32)
            for i, ((doc_id,), text) in enumerate(zip(keys, texts, strict=True)):
                hashes = shingle_set(text, shingle)
                least[i] = minhashes(hashes)
                for name, v in zip(("doc_id", "n", "f1", "f2"), (doc_id, len(hashes), *set_print(hashes)), strict=True):
                    out[name].append(v)
            found = signatures(least)
            out["signature"] = [row.tobytes() if n else b"" for row, n in zip(found, out["n"], strict=True)]
            yield arrow_rows(out, PRINTS)

    return docs.mapInArrow(run, PRINTS_DDL)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """docs: doc_id, text. The members of each row's set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("minhash")
        for keys, texts in text_chunks(batches, ["doc_id"], "text", 1 << 18):
            out: dict[str, list] = {f.name: [] for f in SETS}
            for (doc_id,), text in zip(keys, texts, strict=True):
                hashes = shingle_set(text, shingle)
                row = (doc_id, *set_print(hashes), hashes.astype(np.int64), parity_map(hashes))
                for f, v in zip(SETS, row, strict=True):
                    out[f.name].append(v)
            yield arrow_rows(out, SETS)

    return docs.mapInArrow(run, SETS_DDL)


def table_entries(sets: DataFrame) -> DataFrame:
    """(key, set) of every table whose key has company; a key cut by a task's edge may come along alone."""

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                cells = part.column(part.schema.get_field_index("signature")).to_pylist()
                numbers = part.column(part.schema.get_field_index("set")).to_numpy(zero_copy_only=False)
                held = np.frombuffer(b"".join(cells), dtype=np.uint64).reshape(len(cells), LEFT + RIGHT)
                keys = table_keys(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64).ravel()), pa.array(np.repeat(numbers, keys.shape[1]))], ["key", "set"]
                )

    def company(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = True, None
        for batch in batches:
            key, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if held is not None:
                key, number = np.concatenate([held[0], key]), np.concatenate([held[1], number])
            if not len(key):
                continue
            # The last entry waits for the next batch; of a long run only its last entry does.
            same = key[1:] == key[:-1]
            shared = np.concatenate([same, [False]]) | np.concatenate([[held is not None and held[2]], same])
            shared[0] |= first
            first = False
            held = (key[-1:], number[-1:], bool(shared[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][shared[:-1]]), pa.array(number[:-1][shared[:-1]])], ["key", "set"])
        if held is not None:  # the task's last key may go on in the next task
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["key", "set"])

    entries = sets.select("set", "signature").mapInArrow(explode, "key long, set long")
    ordered = entries.repartitionByRange("key", "set").sortWithinPartitions("key", "set")
    return ordered.mapInArrow(company, "key long, set long")


def similar(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of sets whose Jaccard similarity is percent or more, counted on the full sets."""
    sized = members.select("set", F.size("hashes").alias("n"))
    near = (  # sizes alone rule out most wrong pairs before any set moves
        pairs.join(sized.select(F.col("set").alias("a"), F.col("n").alias("na")), "a")
        .join(sized.select(F.col("set").alias("b"), F.col("n").alias("nb")), "b")
        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    )
    near = staged(near.select("a", "b", "na", "nb"), "minhash-near")
    members = asked_members(near, members)
    side = lambda x: members.select(F.col("set").alias(x), F.col("hashes").alias(f"hashes_{x}"))
    both = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return (
        near.join(side("a"), "a").join(side("b"), "b")
        .filter(both * 100 >= (F.col("na") + F.col("nb") - both) * percent)
        .select("a", "b")
    )


def asked_members(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The members of the pairs' sets only, so that a round of few pairs moves few sets; all, if the pairs have many."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    return members.join(F.broadcast(asked), "set", "left_semi") if asked.count() <= BROADCAST_IDS else members


def prefix_entries(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(key, set, size, lead, parity...): each set under the rarest of its shingles; similar sets meet under one of them.

    Two similar sets of n <= m members have o = t / (1 + t) * (n + m) in common at least (t: the similarity), so o >= t * m
    and o >= 2 t / (1 + t) * n. In any one order of all shingles their first common one is then among the first
    m - o + 1 of the larger set and the first n - o + 1 of the smaller; under the latter, a set may lead. The order is
    rarest first, so a passage that many sets share is seldom a key, and hardly ever one that a set leads under.
    """
    members = members.join(sets, "set", "left_semi")
    held = members.select("set", F.size("hashes").alias("size"), F.explode("hashes").alias("key"))
    often = held.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(W.partitionBy("set").orderBy("often", "key"))
    n = F.col("size").cast("long")
    # Whole numbers: n - ceil(a / b) is floor((n * b - a) / b).
    larger = F.floor((n * 100 - n * percent) / 100) + 1
    smaller = F.floor((n * (100 + percent) - n * 2 * percent) / (100 + percent)) + 1
    ranked = held.join(often, "key").withColumn("place", place).filter(F.col("place") <= larger)
    maps = members.select("set", *[F.col("parity")[i].alias(f"{PARITY_MARK}{i}") for i in range(PARITY)])
    entries = ranked.filter("often > 1").select("key", "set", n.alias("size"), (F.col("place") <= smaller).alias("lead"))
    return entries.join(maps, "set").select(*entries.columns, *maps.columns[1:])


PARITY_MARK = "parity_"


class Links:
    """Similar pairs found so far: their components, and which pairs have been compared."""

    def __init__(self, members: DataFrame, percent: int, leaders: int):
        self.members, self.percent, self.leaders = members, percent, leaders
        self.known: DataFrame | None = None
        self.compared: DataFrame | None = None

    def rounds(self, entries: DataFrame, most: int | None = None) -> DataFrame | None:
        """Compare within the buckets of entries until each is in one component, or ``most`` rounds are over.

        entries: key, set, size, lead and perhaps the parity map. In a bucket, sets are in order of (size, set); of those
        that may lead, the first ones meet all after them, and then what is not after the last of them leaves. Gives the
        entries left, if any.
        """
        live, width, n = entries, 1, 0
        maps = [c for c in entries.columns if c.startswith(PARITY_MARK)]
        while True:
            named = live.withColumn("root", F.col("set"))
            if self.known is not None:
                roots = self.known.withColumnRenamed("node", "set")
                named = live.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
            apart = named.groupBy("key").agg(
                F.min("root").alias("low"), F.max("root").alias("high"), F.max("lead").alias("led")
            ).filter("led and low < high")
            held = staged(named.join(apart.select("key"), "key", "left_semi"), "minhash-open")
            if held.isEmpty():
                return None
            if n == most:
                return held.drop("root")
            place = F.row_number().over(W.partitionBy("key").orderBy("size", "set"))
            heads = staged(
                held.filter("lead").withColumn("place", place).filter(F.col("place") <= width)
                .select("key", "place", *[F.col(c).alias(f"{c}_a") for c in ("set", "size", "root", *maps)]),
                "minhash-leaders",
            )
            after = F.struct("size", "set") > F.struct("size_a", "set_a")
            near = (F.col("size_a") * 100 >= F.col("size") * self.percent) & (F.col("root") != F.col("root_a"))
            if maps:
                # percent of the union is what two similar sets have in common at least, the rest is where they differ.
                differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_a"))) for c in maps), F.lit(0))
                both = F.col("size") + F.col("size_a")
                near &= differ * (100 + self.percent) <= both * (100 - self.percent)
            met = held.join(heads, "key").filter(after & near)
            self.compare(met.select(F.least("set_a", "set").alias("a"), F.greatest("set_a", "set").alias("b")))
            last = heads.filter(F.col("place") == width).select("key", "size_a", "set_a")
            live = held.join(last, "key").filter(after).select(*entries.columns)
            width, n = width * self.leaders, n + 1

    def compare(self, pairs: DataFrame) -> None:
        pairs = pairs.distinct()
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["a", "b"], "left_anti")
        pairs = staged(pairs, "minhash-pairs")
        self.compared = pairs if self.compared is None else self.compared.union(pairs)
        found = similar(pairs, self.members, self.percent)
        if self.known is not None:
            found = found.union(self.known.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.known = components(found)


def links(
    entries: DataFrame, members: DataFrame, percent: int = PERCENT, leaders: int = LEADERS, rounds: int = ROUNDS
) -> DataFrame:
    """(node, root) of the components that the similar pairs of each bucket form."""
    found = Links(members, percent, leaders)
    left = found.rounds(entries.select("key", "set", F.lit(0).cast("long").alias("size"), F.lit(True).alias("lead")), rounds)
    if left is not None:
        release(entries.sparkSession)
        found.rounds(prefix_entries(left.select("set").distinct(), members, percent))
    if found.known is None:
        return entries.select(F.col("set").alias("node"), F.col("set").alias("root")).limit(0)
    return found.known


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the component's least id): one row per row of docs."""
    expect_long_texts(docs.sparkSession)
    narrow = narrowed(docs, id_col, text_col)
    prints = staged(set_prints(narrow, shingle), "minhash")
    sets = prints.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("least"), F.min("signature").alias("signature"))
    # A set's number is fixed once written.
    sets = staged(sets.withColumn("set", F.monotonically_increasing_id()), "minhash-sets")
    entries = staged(table_entries(sets), "minhash-entries")
    release(docs.sparkSession)
    met = sets.join(entries.select("set").distinct(), "set", "left_semi").select("set", "least", "f1", "f2")
    met = staged(met, "minhash-met")
    known = links(entries, staged(members(narrow, met, shingle), "minhash-members"), percent)
    rooted = sets.select("set", "least", "f1", "f2").join(known.withColumnRenamed("node", "set"), "set", "left").withColumn(
        "root", F.coalesce("root", "set")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("f1", "f2", F.lit(True).alias("any"), "component_id")
    out = prints.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), is_first(component).alias("kept")
    )


def is_first(component: Column) -> Column:
    return F.col("doc_id").eqNullSafe(component)


def members(docs: DataFrame, met: DataFrame, shingle: int) -> DataFrame:
    """(set, hashes, parity) of the sets of ``met``, read again from one document of each."""
    if ids_tell_rows_apart(docs, "doc_id"):
        ids = met.select(F.col("least").alias("doc_id"))
        docs = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    # A set's fingerprint is its own, as is its number: rows of one set meet by the fingerprint and move once.
    found = full_sets(docs, shingle).dropDuplicates(["f1", "f2"]).join(met.select("set", "f1", "f2"), ["f1", "f2"])
    return found.select("set", "hashes", "parity")
