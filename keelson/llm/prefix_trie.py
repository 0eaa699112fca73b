"""The prefix trie of conversations, rolled up by centroid decomposition.

Laying turns in order: narrow rows (conversation, turn, two 64-bit hashes of role and text, words) are sorted by range of
(conversation, turn, hashes), so a conversation with very many turns spreads over tasks. Each task numbers the turns of
each conversation it holds and keeps the running sums S(j) = t(1) B + ... + t(j) B^j modulo 2^64 (twice, with two bases),
which stand for the first j turns. Where a conversation goes on in the next task, the later part is put behind the
earlier one: numbers shift by its length n and sums become S + B^n S'. The same arithmetic gives the prefixes of a rebuilt
conversation: its first k turns are another's, then come its own after the first h: P(k) + B^(k-h) (S(j) - S(h)).

A trie node is a distinct (depth, prefix); its name is (least member, depth), which is unique since nodes of one depth
share no member. Every node but the root has an edge to its parent; the forest below the root is rolled up by centroids:
a component is split at the deepest node c that holds at least half of its weight; the total of c and what is below it
is c's result and is added to every node on the path from c to the component's top; the part above and each subtree
below c are then components of their own, at most half as heavy, and are split in turn.

Components of more than LIMIT input rows are split by Spark, one level a round for all of them at once; the weight of a
node's subtree is the number of input rows in it, known from the members' lengths without a roll-up. Whether a node is
below c, and which nodes are on a path, is looked up in the table of (conversation, depth, node). Lighter components go
to tasks whole, several at a time, and are split there. The root's totals are sums over the forest's tops.

Digest of a node's end conversations: their ids are sorted by range and joined to texts of at most PIECE ids, and one
task reads a node's texts in order. SHA-256 can only be computed in sequence; nothing is held but one text.

Rows: null ids take no part; null roles and texts are empty; a null turn comes first; rows of one turn are ordered by
their hashes (a fixed order without meaning); repeated rows are turns each; two prefixes are one node if both 64-bit
sums agree; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import WORD_PATTERN, arrow_rows, staged

#: Every conversation takes its first turns from that whose id is the next lower multiple of FAMILY.
FAMILY = 20
HEADS = 4
LIMIT = 1 << 16
PIECE = 1 << 14
#: Odd, and 3 modulo 8, so that differences of powers keep all but a few low bits.
BASES = (0x9E3779B97F4A7C1B, 0xC2B2AE3D27D4EB53)
PARTS = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "part", "j", "t1", "t2", "before1", "before2", "s1", "s2", "words")]
)
CONVERSATIONS = pa.schema(
    [
        (c, pa.int64())
        for c in ("conv_id", "h", "k", "n", "cut1", "cut2", "give1", "give2", "p1", "p2", "top1", "top2")
    ]
)
STEPS = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "p1", "p2", "up1", "up2", "words")])
TEXTS = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("low", pa.int64()), ("ids", pa.string())])
TOTALS = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "n_leaves", "saved_tokens")])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^64; negative exponents by the inverse of the (odd) base."""
    out = np.ones(len(exponents), dtype=np.uint64)
    for sign, b in ((1, base), (-1, pow(base, -1, 1 << 64))):
        left, square = np.maximum(sign * exponents, 0).astype(np.uint64), b
        while left.any():
            out = np.where(left & np.uint64(1), out * np.uint64(square), out)
            left, square = left >> np.uint64(1), square * square % (1 << 64)
    return out


def unsigned(x) -> np.ndarray:
    return np.asarray(x, dtype=np.int64).view(np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each start (starts[0] is 0)."""
    total = np.cumsum(values, dtype=values.dtype)
    base = np.concatenate([np.zeros(1, dtype=values.dtype), total])[starts]
    return total - np.repeat(base, np.diff(np.append(starts, len(values))))


def laid_out(turns: DataFrame) -> DataFrame:
    """turns: conv_id, turn, t1, t2, words. Per turn: its place j and prefix sums within (conversation, part)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        conv, count, sums = None, 0, [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            ids = cells["conv_id"]
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            goes_on = conv is not None and ids[0] == conv
            j = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids)))) + 1
            first = slice(0, starts[1] if len(starts) > 1 else len(ids))
            if goes_on:
                j[first] += count
            out = {"conv_id": ids, "part": np.full(len(ids), part), "j": j, "words": cells["words"]}
            for i in range(2):
                term = unsigned(cells[f"t{i + 1}"]) * power(BASES[i], j)
                s = segment_sums(term, starts)
                if goes_on:
                    s[first] += np.uint64(sums[i])
                out |= {f"t{i + 1}": cells[f"t{i + 1}"], f"before{i + 1}": signed(s - term), f"s{i + 1}": signed(s)}
                sums[i] = int(s[-1])
            conv, count = ids[-1], int(j[-1])
            yield arrow_rows(out, PARTS)

    keys = ["conv_id", "turn", "t1", "t2"]
    return turns.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, ddl(PARTS))


def joined_parts(parts: DataFrame) -> DataFrame:
    """Turns of conversations that several parts hold get their places in the whole conversation."""
    lengths = parts.groupBy("conv_id", "part").agg(F.max(F.struct("j", "s1", "s2")).alias("end"))
    several = lengths.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("conv_id")
    spread = lengths.join(several, "conv_id").select("conv_id", "part", "end.*")

    def shifts(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        shift = np.concatenate([[0], np.cumsum(rows["j"].to_numpy(np.int64))[:-1]])
        out = {"conv_id": rows["conv_id"], "part": rows["part"], "shift": shift}
        for i in range(2):
            moved = unsigned(rows[f"s{i + 1}"].to_numpy(np.int64)) * power(BASES[i], shift)
            out[f"o{i + 1}"] = signed(np.cumsum(moved, dtype=np.uint64) - moved)
        return pd.DataFrame(out)

    # One row for each part of a conversation that goes over a task's edge: at most two conversations a task.
    moves = spread.groupBy("conv_id").applyInPandas(shifts, "conv_id long, part long, shift long, o1 long, o2 long")
    both = parts.join(moves, ["conv_id", "part"], "left").fillna(0, ["shift", "o1", "o2"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            shift = cells["shift"].astype(np.int64)
            for i in range(2):
                factor, offset = power(BASES[i], shift), unsigned(cells[f"o{i + 1}"].astype(np.int64))
                for c in (f"before{i + 1}", f"s{i + 1}"):
                    cells[c] = signed(offset + factor * unsigned(cells[c]))
            yield arrow_rows(cells | {"j": cells["j"] + shift}, PARTS)

    return both.mapInArrow(run, ddl(PARTS))


def rebuilt(turns: DataFrame, own: Column, giver: Column) -> tuple[DataFrame, DataFrame]:
    """(conversations, steps) of the rebuilt conversations.

    own: how many of its first turns (HEADS - 1 at most) a conversation replaces, and giver: by those of which one.
    conversations: conv_id, n (turns), p1, p2 (prefix of all of them), top1, top2 (of the first).
    steps: conv_id, depth, p1, p2, up1, up2 (prefix before it), words; one row per turn.
    """
    placed = staged(joined_parts(staged(laid_out(turns), "trie-parts")), "trie-turns")
    sums = ("s1", "s2")
    # The first HEADS turns and the last one: a row of bounded size per conversation.
    ends = placed.groupBy("conv_id").agg(
        F.max(F.struct("j", *sums)).alias("end"),
        *[
            F.max(F.when(F.col("j") == i, F.struct(*sums, "words"))).alias(f"head{i}") for i in range(1, HEADS + 1)
        ],
    ).withColumns({"h": own, "giver": giver})
    given = ends.select(
        F.col("conv_id").alias("giver"), F.col("end.j").alias("gn"), *[F.col(f"head{i}").alias(f"g{i}") for i in range(1, HEADS)]
    )
    convs = ends.join(given, "giver", "left").withColumn("k", F.least("h", F.coalesce("gn", F.lit(0))))

    def at(prefix: str, place: Column, field: str, most: int) -> Column:
        """The prefix sum of the first ``place`` turns."""
        found = F.lit(0).cast("long")
        for i in range(1, most + 1):
            found = F.when(place == i, F.col(f"{prefix}{i}.{field}")).otherwise(found)
        return found

    low = F.least("h", F.col("end.j"))
    known = convs.select(
        "conv_id", "h", "k", F.col("end.j").alias("own_n"), F.col("end.s1").alias("end1"), F.col("end.s2").alias("end2"),
        *[at("head", low, f"s{i}", HEADS).alias(f"cut{i}") for i in (1, 2)],
        *[at("head", F.col("h") + 1, f"s{i}", HEADS).alias(f"next{i}") for i in (1, 2)],
        *[at("g", F.col("k"), f"s{i}", HEADS - 1).alias(f"give{i}") for i in (1, 2)],
        *[F.col(f"g1.s{i}").alias(f"first{i}") for i in (1, 2)],
        *[F.col(f"g{i}").alias(f"g{i}") for i in range(1, HEADS)],
    )

    def ended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for i, n in enumerate(batch.schema.names)}
            own = np.maximum(c["own_n"] - c["h"], 0)
            out = {x: c[x] for x in ("conv_id", "h", "k", "cut1", "cut2", "give1", "give2")} | {"n": c["k"] + own}
            for i in (1, 2):
                factor, cut = power(BASES[i - 1], c["k"] - c["h"]), unsigned(c[f"cut{i}"])
                moved = lambda s: unsigned(c[f"give{i}"]) + factor * (unsigned(s) - cut)  # noqa: B023, E731
                out[f"p{i}"] = signed(np.where(own > 0, moved(c[f"end{i}"]), unsigned(c[f"give{i}"])))
                out[f"top{i}"] = signed(
                    np.where(c["k"] > 0, unsigned(c[f"first{i}"]), np.where(own > 0, moved(c[f"next{i}"]), np.uint64(0)))
                )
            yield arrow_rows(out, CONVERSATIONS)

    flat = known.select(*[c for c in known.columns if not c.startswith("g") or c.startswith("give")])
    conversations = staged(flat.mapInArrow(ended, ddl(CONVERSATIONS)), "trie-conversations")

    def stepped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            out = {"conv_id": c["conv_id"], "depth": c["j"] - c["h"] + c["k"], "words": c["words"]}
            for i in (1, 2):
                factor = power(BASES[i - 1], c["k"] - c["h"])
                for name, s in (("p", f"s{i}"), ("up", f"before{i}")):
                    out[f"{name}{i}"] = signed(
                        unsigned(c[f"give{i}"]) + factor * (unsigned(c[s]) - unsigned(c[f"cut{i}"]))
                    )
            yield arrow_rows(out, STEPS)

    own_steps = (
        placed.join(conversations.select("conv_id", "h", "k", "cut1", "cut2", "give1", "give2"), "conv_id")
        .filter("j > h")
        .select("conv_id", "j", "h", "k", "s1", "s2", "before1", "before2", "cut1", "cut2", "give1", "give2", "words")
        .mapInArrow(stepped, ddl(STEPS))
    )
    head = lambda i: F.struct(
        F.lit(i).cast("long").alias("depth"), F.col(f"g{i}.s1").alias("p1"), F.col(f"g{i}.s2").alias("p2"),
        *[(F.col(f"g{i - 1}.s{x}") if i > 1 else F.lit(0).cast("long")).alias(f"up{x}") for x in (1, 2)],
        F.col(f"g{i}.words").alias("words"),
    )
    given_steps = known.select("conv_id", "k", F.explode(F.array(*[head(i) for i in range(1, HEADS)])).alias("s")).filter(
        "s.depth <= k"
    ).select("conv_id", "s.*")
    return conversations, own_steps.unionByName(given_steps)


def nodes_of(conversations: DataFrame, steps: DataFrame) -> DataFrame:
    """conv_id (least member), depth, p1, p2, n_convs, words, weight, top1, top2 and the parent's prefix; without root."""
    lengths = conversations.select("conv_id", "n", "top1", "top2")
    return (
        steps.join(lengths, "conv_id").groupBy("depth", "p1", "p2").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
            F.sum(F.col("n") - F.col("depth") + 1).alias("weight"), F.max("up1").alias("up1"), F.max("up2").alias("up2"),
            F.max("top1").alias("top1"), F.max("top2").alias("top2"),
        )
    )


def end_digests(conversations: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of every prefix that is a whole conversation."""
    keys = ["depth", "p1", "p2"]

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def piece() -> pa.RecordBatch:
            row = dict(zip(keys, node, strict=True)) | {"low": held[0], "ids": ",".join(map(str, held))}
            return arrow_rows({k: [v] for k, v in row.items()}, TEXTS)

        for batch in batches:
            for *key, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (key != node or len(held) >= PIECE):
                    yield piece()
                    held = []
                node = key
                held.append(conv)
        if held:
            yield piece()

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        schema = pa.schema([*[(k, pa.int64()) for k in keys], ("ends_sha256", pa.string())])
        done: list[tuple] = []
        for batch in batches:
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            if done:
                yield arrow_rows(dict(zip(schema.names, map(list, zip(*done, strict=True)), strict=True)), schema)
                done = []
        if node is not None:
            yield arrow_rows({k: [v] for k, v in zip(schema.names, (*node, sha.hexdigest()), strict=True)}, schema)

    ends = conversations.select(F.col("n").alias("depth"), "p1", "p2", "conv_id")
    by_id = [*keys, "conv_id"]
    pieces = ends.repartitionByRange(*by_id).sortWithinPartitions(*by_id).mapInArrow(texts, ddl(TEXTS))
    in_order = pieces.repartition(*keys).sortWithinPartitions(*keys, "low")
    return in_order.mapInArrow(digests, "depth long, p1 long, p2 long, ends_sha256 string")


def centroid_totals(parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values (nodes x measures) over every node's subtree, by centroid decomposition of the parent edges.

    parent: index of each node's parent, -1 for a top; parents come before their children.
    """
    n = len(parent)
    up = parent.tolist()
    size = [1] * n
    for v in range(n - 1, -1, -1):
        if up[v] >= 0:
            size[up[v]] += size[v]
    place, free, tops = [0] * n, [0] * n, 0  # depth-first numbers: a subtree is a range
    for v in range(n):
        if up[v] < 0:
            place[v], tops = tops, tops + size[v]
        else:
            place[v] = free[up[v]]
            free[up[v]] += size[v]
        free[v] = place[v] + 1
    place = np.array(place, dtype=np.int64)
    whole = np.empty(n, dtype=np.int64)  # by depth-first number, as all below
    whole[place] = size
    own = np.empty_like(values)
    own[place] = values
    total, held = np.zeros_like(own), whole.copy()
    starts = place[np.flatnonzero(parent < 0)].tolist()
    stack = [np.arange(s, s + whole[s]) for s in starts]
    while stack:
        nodes = stack.pop()
        if len(nodes) == 1:
            total[nodes] += own[nodes]
            continue
        # Nodes that hold half of the component or more are a path from its top: the last one is the centroid.
        c = nodes[2 * held[nodes] >= len(nodes)][-1]
        a, b = np.searchsorted(nodes, (c, c + whole[c]))
        below, above = nodes[a:b], nodes[:a]
        part = own[below].sum(axis=0)
        total[c] += part
        path = above[above + whole[above] > c]
        total[path] += part
        held[path] -= len(below)
        if len(below) < len(nodes):
            stack.append(np.concatenate([above, nodes[b:]]))
        at = 1
        while at < len(below):
            stop = int(np.searchsorted(below, below[at] + whole[below[at]]))
            stack.append(below[at:stop])
            at = stop
    return total[place]


def light_totals(nodes: DataFrame) -> DataFrame:
    """Totals of components that fit in a task; each goes to one task whole, with others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []
        rows = 0

        def settled(c: list[np.ndarray]) -> pa.RecordBatch:
            top, _, depth, conv, parent, leaf, saved, more_leaves, more_saved = c
            number = {k: i for i, k in enumerate(zip(conv.tolist(), depth.tolist(), strict=True))}
            up = np.array(
                [number.get((p, d - 1), -1) for p, d in zip(parent.tolist(), depth.tolist(), strict=True)], dtype=np.int64
            )
            # A parent in the same batch may be of another component; only edges within one count.
            key = np.stack([c[0], c[1]], axis=1)
            up[(up >= 0) & (key[up] != key).any(axis=1)] = -1
            sums = centroid_totals(up, np.stack([leaf, saved], axis=1)) if len(top) else np.zeros((0, 2), np.int64)
            out = {"conv_id": conv, "depth": depth, "n_leaves": sums[:, 0] + more_leaves, "saved_tokens": sums[:, 1] + more_saved}
            return arrow_rows(out, TOTALS)

        for batch in batches:
            rest.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < LIMIT:
                continue
            held = [np.concatenate(c) for c in zip(*rest, strict=True)]
            # The last component may go on in the next batch.
            cut = int(np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[-1:].max(initial=-1)) + 1
            rest, rows = [[c[cut:] for c in held]], len(held[0]) - cut
            if cut:
                yield settled([c[:cut] for c in held])
        if rows:
            yield settled([np.concatenate(c) for c in zip(*rest, strict=True)])

    keys = ["top_conv", "top_depth"]
    dealt = nodes.repartition(*keys).sortWithinPartitions(*keys, "depth", "conv_id")
    return dealt.select(
        *keys, "depth", "conv_id", "parent_conv_id", "leaf", "saved", "more_leaves", "more_saved"
    ).mapInArrow(run, ddl(TOTALS))


def roll_up(nodes: DataFrame, places: DataFrame, limit: int = LIMIT) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens: sums of leaf and saved over every node's subtree.

    nodes: conv_id, depth, parent_conv_id, top_conv, top_depth (its tree), weight (of its subtree), leaf, saved.
    places: conv_id, depth, node (the conv_id of the node that this conversation has at this depth).
    """
    comp = ["top_conv", "top_depth"]
    zero = F.lit(0).cast("long")
    now = staged(nodes.withColumns({"more_leaves": zero, "more_saved": zero}), "trie-components")
    light, settled = [], []
    while True:
        tops = now.filter("conv_id = top_conv and depth = top_depth").filter(F.col("weight") > limit)
        heavy = staged(tops.select(*comp, F.col("weight").alias("all")), "trie-heavy")
        if heavy.isEmpty():
            light.append(now)
            break
        light.append(now.join(heavy, comp, "left_anti"))
        held = now.join(heavy, comp)
        centroids = staged(
            held.filter(F.col("weight") * 2 >= F.col("all")).groupBy(*comp)
            .agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
            .select(*comp, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")),
            "trie-centroids",
        )
        # Conversations through a centroid, and the child of it that they go on to.
        through = places.join(
            centroids.select(*comp, F.col("c_conv").alias("node"), F.col("c_depth").alias("depth")), ["node", "depth"]
        ).select(*comp, "conv_id", F.col("depth").alias("c_depth"))
        child = places.select("conv_id", F.col("depth").alias("child_depth"), F.col("node").alias("child"))
        through = through.withColumn("child_depth", F.col("c_depth") + 1).join(child, ["conv_id", "child_depth"], "left")
        below = F.col("c_depth").isNotNull() & (F.col("depth") >= F.col("c_depth"))
        placed = staged(
            held.drop("all").join(through, [*comp, "conv_id"], "left").withColumn("below", below), "trie-split"
        )
        totals = placed.filter("below").groupBy(*comp).agg(F.sum("leaf").alias("t_leaves"), F.sum("saved").alias("t_saved"))
        of = centroids.join(totals, comp)
        # The path from each centroid to its component's top, in the centroid's own conversation.
        path = (
            places.join(of.withColumnRenamed("c_conv", "conv_id"), "conv_id")
            .filter("depth <= c_depth and depth >= top_depth")
            .select(*comp, F.col("node").alias("conv_id"), "depth", "c_weight", "t_leaves", "t_saved")
        )
        added = placed.join(path, [*comp, "conv_id", "depth"], "left").withColumns({
            "more_leaves": F.col("more_leaves") + F.coalesce("t_leaves", zero),
            "more_saved": F.col("more_saved") + F.coalesce("t_saved", zero),
            "weight": F.when(F.col("below"), F.col("weight")).otherwise(F.col("weight") - F.coalesce("c_weight", zero)),
        })
        added = staged(added, "trie-added")
        centre = F.col("below") & (F.col("depth") == F.col("c_depth"))
        settled.append(
            added.filter(centre).select(
                "conv_id", "depth", F.col("more_leaves").alias("n_leaves"), F.col("more_saved").alias("saved_tokens")
            )
        )
        now = staged(
            added.filter(~centre).withColumns({
                "top_conv": F.when(F.col("below"), F.col("child")).otherwise(F.col("top_conv")),
                "top_depth": F.when(F.col("below"), F.col("child_depth")).otherwise(F.col("top_depth")),
            }).select(*now.columns),
            "trie-components",
        )
    whole = light[0]
    for more in light[1:]:
        whole = whole.unionByName(more)
    out = light_totals(whole)
    for more in settled:
        out = out.unionByName(more)
    return out


def family(conv_id: str = "conv_id", size: int = FAMILY) -> tuple[Column, Column]:
    """(how many first turns a conversation takes, from which one)."""
    c = F.col(conv_id)
    return F.crc32(c.cast("string").cast("binary")) % HEADS, c - c % size


def trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    own: Column | None = None,
    giver: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    own, giver: over conv_id; by default ``family``. With own = 0 conversations stay as they are.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    narrow = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        *[F.xxhash64(F.lit(i), role, text).alias(f"t{i}") for i in (1, 2)],
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    ).filter("conv_id is not null")
    by_family = family()
    conversations, steps = rebuilt(
        narrow, (by_family[0] if own is None else own).cast("long"), (by_family[1] if giver is None else giver).cast("long")
    )
    steps = staged(steps, "trie-steps")
    nodes = staged(nodes_of(conversations, steps), "trie-nodes")
    # Depth 1 hangs below the root, whose least member is the least conversation: no join for the widest node.
    facts = conversations.agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n")).first()
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("above")
    )
    top = nodes.filter("depth = 1").select(F.col("p1").alias("top1"), F.col("p2").alias("top2"), F.col("conv_id").alias("top_conv"))
    linked = staged(
        nodes.join(above, ["depth", "up1", "up2"], "left").join(top, ["top1", "top2"])
        .withColumn("parent_conv_id", F.coalesce("above", F.lit(facts["least"])))
        .select("conv_id", "depth", "p1", "p2", "parent_conv_id", "top_conv", "n_convs", "words", "weight"),
        "trie-linked",
    )
    children = linked.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    counted = linked.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"])
    counted = staged(counted.join(end_digests(conversations), ["depth", "p1", "p2"], "left"), "trie-counted")
    forest = counted.select(
        "conv_id", "depth", "parent_conv_id", "top_conv", F.lit(1).cast("long").alias("top_depth"), "weight",
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    places = steps.join(
        nodes.select("depth", "p1", "p2", F.col("conv_id").alias("node")), ["depth", "p1", "p2"]
    ).select("conv_id", "depth", "node")
    totals = staged(roll_up(forest, places, LIMIT if limit is None else limit), "trie-totals")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = counted.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    if facts["least"] is None:
        return out
    tops = counted.filter("depth = 1").select("conv_id", "depth").join(totals, ["conv_id", "depth"])
    turnless = end_digests(conversations.filter("n = 0")).select("ends_sha256").first()
    root = tops.agg(
        F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    return out.unionByName(
        root.select(
            F.lit(facts["least"]).alias("conv_id"), F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("parent_conv_id"), F.lit(facts["n"]).cast("long").alias("n_convs"), "n_children",
            "n_leaves", "saved_tokens", (F.lit(turnless[0]) if turnless else nothing).alias("ends_sha256"),
        )
    )
