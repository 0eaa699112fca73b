"""SimHash near-duplicates by a binary trie self-join.

A text is lower-cased (A-Z), cut into words and shingles of three words; a fingerprint bit is 1 if it is set in over
half of the shingles' XXH64 hashes. Distinct fingerprints are the leaves of a binary trie. Pairs of trie nodes of the
same depth are walked together from (root, root): a pair's differing bits are those of the two prefixes, and a pair
with more than ``bits`` of them is dropped with all below it.

Upper levels are walked by Spark, STEP bits a round: the table of open node pairs is joined with the children of both
nodes. A pair whose two nodes hold at most LEAF fingerprints together is handed to one task, which walks on bit by bit
over sorted arrays; other pairs go on. So dense regions of the trie are split further, sparse ones stop early, and no
task gets more than LEAF fingerprints. Links found by a task are reduced to a spanning forest of that task before they
leave it, which keeps components whole; components are then joined up over all tasks.

Copies share a fingerprint, so a group of copies is one leaf.

Rows: null, empty and blank texts have fingerprint 0 and are linked like any other; a text of one or two words is one
shingle; rows with the same or null ids are separate rows (a component's id is its least id, null if it has none); an
empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import arrow_rows, expect_long_texts, ids_tell_rows_apart, staged, text_chunks, tidy, unused, worker_cache
from keelson.llm.components import components

SHINGLE = 3
BITS = 2
SEED = 42
STEP = 4
LEAF = 4096
PRINTS = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[: len(words) - shingle] + 1])
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops[shingle - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, bits (the fingerprint as a signed long), one row per row of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("simhash")
        for keys, texts in text_chunks(batches, ["doc_id"], "text", 1 << 20):
            bits = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).astype(np.int64)
            yield arrow_rows({"doc_id": [k for (k,) in keys], "bits": bits}, PRINTS)

    expect_long_texts(docs.sparkSession)
    narrow = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return narrow.mapInArrow(tidy(run), "doc_id long, bits long")


def trie_links(a: np.ndarray, b: np.ndarray, bits: int, depth: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Values of a and b (sorted, distinct, unsigned) that differ in at most bits bits; same: a is b, pairs once.

    Walks pairs of nodes level by level; a node is a range of the sorted array. Small ranges are compared outright.
    """
    found_a, found_b = [], []
    # One row per node pair: range in a, range in b, differing bits so far.
    top = int(a[0] >> np.uint64(64 - depth) ^ b[0] >> np.uint64(64 - depth)) if depth and len(a) and len(b) else 0
    nodes = np.array([[0, len(a), 0, len(b), top.bit_count()]], dtype=np.int64)
    if not len(a) or not len(b):
        nodes = nodes[:0]
    level = depth
    while len(nodes):
        la, ha, lb, hb, diff = nodes.T
        small = ((ha - la) * (hb - lb) <= 16) | (level >= 64)
        if small.any():
            compare(a, b, nodes[small], bits, same, found_a, found_b)
            nodes = nodes[~small]
            if not len(nodes):
                break
            la, ha, lb, hb, diff = nodes.T
        shift = np.uint64(63 - level)
        split_a = middle(a, la, ha, shift)
        split_b = middle(b, lb, hb, shift)
        kids = [
            np.stack([la, split_a, lb, split_b, diff], axis=1),
            np.stack([split_a, ha, split_b, hb, diff], axis=1),
            np.stack([la, split_a, split_b, hb, diff + 1], axis=1),
            np.stack([split_a, ha, lb, split_b, diff + 1], axis=1),
        ]
        nodes = np.concatenate(kids)
        keep = (nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= bits)
        if same:  # of a node pair and its mirror image, one is enough
            keep &= nodes[:, 0] <= nodes[:, 2]
        nodes = nodes[keep]
        level += 1
    if not found_a:
        return a[:0], b[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


def middle(values: np.ndarray, low: np.ndarray, high: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Where, in each range whose values agree above bit shift, that bit turns to 1."""
    edge = ((values[low] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(values, edge), low, high)


def compare(a, b, nodes, bits, same, found_a, found_b) -> None:
    for at in range(0, len(nodes), 1 << 16):
        la, ha, lb, hb, _ = nodes[at : at + (1 << 16)].T
        size = (ha - la) * (hb - lb)
        row = np.repeat(np.arange(len(size)), size)
        k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        wide = (hb - lb)[row]
        i, j = la[row] + k // wide, lb[row] + k % wide
        near = np.bitwise_count(a[i] ^ b[j]) <= bits
        if same:
            near &= i < j
        found_a.append(a[i[near]])
        found_b.append(b[j[near]])


def forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, as links to each tree's root."""
    parent: dict[int, int] = {}

    def root(n: int) -> int:
        top = n
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[n] != top:
            parent[n], n = top, parent[n]
        return top

    for m, n in zip(x.tolist(), y.tolist(), strict=True):
        p, q = root(m), root(n)
        if p != q:
            parent[max(p, q)] = min(p, q)
    ends = [(n, root(n)) for n in parent]
    ends = [(n, r) for n, r in ends if n != r]
    pairs = np.array(ends, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def node_pairs(prints: DataFrame, bits: int, step: int, leaf: int) -> DataFrame:
    """Leaf pairs of the upper trie: depth, x, y (prefixes)."""
    spark = prints.sparkSession
    done = []
    wide, depth = spark.createDataFrame([(0, 0)], "x long, y long"), 0
    while True:
        depth += step
        kid = F.explode(F.sequence(F.lit(0), F.lit((1 << step) - 1)))
        kids = (
            wide.select("x", "y", kid.alias("i")).select("x", "y", "i", kid.alias("j"))
            .filter("x <> y or i <= j")  # of a pair and its mirror image, one is enough
            .select(
                (F.shiftleft("x", step) + F.col("i")).alias("x"), (F.shiftleft("y", step) + F.col("j")).alias("y")
            )
            .filter(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= bits)
        )
        nodes = prefix(prints, depth).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
        sized = (
            kids.join(nodes.select(F.col("p").alias("x"), F.col("n").alias("nx")), "x")
            .join(nodes.select(F.col("p").alias("y"), F.col("n").alias("ny")), "y")
            .withColumn("small", (F.col("nx") + F.col("ny") <= leaf) | F.lit(depth >= 64))
        )
        sized = staged(sized, "trie-pairs")
        done.append(sized.filter("small").select(F.lit(depth).alias("depth"), "x", "y"))
        wide = sized.filter(~F.col("small")).select("x", "y")
        if depth >= 64 or wide.isEmpty():
            break
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.union(more)
    return pairs


def prefix(prints: DataFrame, depth: int) -> DataFrame:
    return prints.select(F.shiftrightunsigned("bits", 64 - depth).alias("p"), "bits")


def links(prints: DataFrame, bits: int = BITS, step: int = STEP, leaf: int = LEAF) -> DataFrame:
    """(a, b): links between distinct fingerprints that span the components of all links of at most bits bits."""
    pairs = staged(node_pairs(prints, bits, step, leaf), "trie-leaves")
    depths = sorted(r.depth for r in pairs.select("depth").distinct().collect())  # 64 / step + 1 at most
    dealt = None
    for depth in depths:
        at = pairs.filter(F.col("depth") == depth)
        ends = at.select(F.explode(F.array_distinct(F.array("x", "y"))).alias("p"), "depth", "x", "y")
        part = ends.join(prefix(prints, depth), "p").select("depth", "x", "y", "p", "bits")
        dealt = part if dealt is None else dealt.union(part)

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        depth, x, y = (int(k) for k in key)
        values = rows["bits"].to_numpy().astype(np.uint64)
        side = rows["p"].to_numpy()
        a = np.sort(values[side == x])
        b = a if x == y else np.sort(values[side == y])
        near_a, near_b = trie_links(a, b, bits, depth, x == y)
        ends_a, ends_b = forest(near_a.astype(np.int64), near_b.astype(np.int64))
        return pd.DataFrame({"a": ends_a, "b": ends_b})

    if dealt is None:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    return dealt.groupBy("depth", "x", "y").applyInPandas(walk, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of docs."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    leaves = staged(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-leaves")
    stars = components(links(leaves.select("bits"), bits))
    rooted = leaves.join(stars.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "root", F.coalesce("root", "bits")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("bits", "component_id")
    return prints.join(classes, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """docs with one row of each component: that of the least id.

    Where ids are null or repeat, rows are told apart by a hash of id and text; rows equal in both count as one row,
    and the row of the least hash stays.
    """
    columns = docs.columns
    key = unused(columns, "__key")
    if ids_tell_rows_apart(docs, id_col):
        keyed = docs.withColumn(key, F.col(id_col).cast("long"))
    else:
        keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col))).dropDuplicates([key])
    classes = near_duplicates(keyed, key, text_col, shingle, bits)
    kept = classes.filter("doc_id = component_id").select(F.col("doc_id").alias(key))
    return keyed.join(kept, key, "left_semi").select(*columns)
