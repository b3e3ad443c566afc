"""Merkle manifest of a dataset by time-forward processing: every row's digest, its group's root, the root, its proof.

Rows are leaves. The leaves of a group, in order of the key, are joined by three into their parent until one node, the
group's subroot, is left; the subroots in order of their groups make the root in the same way. A node's label is
(tree, level, place). Nodes send messages to nodes, and a queue ordered by label delivers them:

* *forward*, digests go from children to parents, by ascending labels;
* *reversed*, proof suffixes (the siblings met from a node up to the root) go from parents to children, by descending
  labels, and arrive at the leaves as whole proofs.

The queue is external. Trees are cut into blocks of ``HEIGHT`` levels over 3^``HEIGHT`` nodes. Messages between blocks
are rows, dealt by block and sorted by label in a shuffle, which spills; inside a block a heap holds at most as
many messages as the block has nodes. So a task keeps one block, whatever the size of a group, and each round over the
rows is followed by one over a 3^``HEIGHT``-th of them. Texts are read once and do not travel: only digests do.

Rows are put in their places by range partitions and counts, so a group of any size spreads over tasks. Rows with equal
keys are ordered by their digests, NULL keys and the NULL group come first. Every column may be NULL (``-`` in a leaf).
Repeated rows are leaves of their own. An empty table gives no rows. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import arrow_map, picked, stage

FANOUT = 3
HEIGHT = 8

PROOF = "array<struct<before:string,after:string>>"
_PROOF = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
Step = tuple[str, str]


def part(value: Column) -> Column:
    """A value's part of a leaf: its UTF-8 length, a colon, and itself; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof make."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]).cast("binary"), 256))


def siblings(proof: Column) -> Column:
    """The digests of a proof, concatenated from the leaf's siblings to the root's children."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def height(size: int) -> int:
    """Levels above ``size`` nodes."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FANOUT), levels + 1
    return levels


def digest_of(run: Iterable[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def forward(digests: Sequence[str], levels: int) -> list[list[str]]:
    """The digests of a block level by level: messages to parents are taken from a queue by label."""
    done: list[list[str]] = [[] for _ in range(levels + 1)]
    queue = [(0, i, 0, d) for i, d in enumerate(digests)]  # (level, place, child, digest): already a heap
    while queue:
        level, place, _, digest = heapq.heappop(queue)
        run = [digest]
        while queue and queue[0][:2] == (level, place):
            run.append(heapq.heappop(queue)[3])
        own = digest_of(run) if level else digest
        done[level].append(own)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // FANOUT, place % FANOUT, own))
    return done


def reversed_sweep(done: list[list[str]], suffix: list[Step]) -> list[list[Step]]:
    """The proof of every node of the lowest level, from the ``suffix`` that the block's root got."""
    above = [suffix]
    for level in done[-2::-1]:
        proofs = []
        for i in range(len(level)):
            first = i - i % FANOUT
            step = ("".join(level[first:i]), "".join(level[i + 1 : first + FANOUT]))
            proofs.append([step, *above[i // FANOUT]])
        above = proofs
    return above


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other, from batches sorted by label."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield list(block)


def placed(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``nodes`` with ``place`` (from 0) within their ``tree`` by ``order`` and ``size``, the number of its nodes."""
    columns = nodes.columns
    ordered = nodes.withColumn("_scan", F.monotonically_increasing_id())
    # the place of the row in the scan only deals equal rows over ranges
    by = ["tree", *order, F.col("_scan")]
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    held = stage(ordered.select(*columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").alias("_at")), "merkle-order")
    runs = held.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")  # a tree has at most one row per range partition here
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(tree).alias("size"))
    held = held.join(runs, ["tree", "_part"])
    return held.select(*columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "size")


def by_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {FANOUT**levels}"))


def delivered(rows: DataFrame) -> DataFrame:
    """The external queue: rows dealt by block and sorted by label, a block's message before its nodes."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("place").asc_nulls_first())


def climbed(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, place, size, digest): the root of every block."""

    def run(batches):
        out: list[tuple] = []
        for rows in blocks(batches):
            size = rows[0]["size"]
            top = forward([r["digest"] for r in rows], min(levels, height(size)))[-1]
            out.append((rows[0]["tree"], rows[0]["block"], -(-size // FANOUT**levels), top[0]))
            if len(out) >= 5000:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    def as_batch(out):
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["tree", "place", "size", "digest"])

    sorted_rows = delivered(by_block(nodes.select("tree", "place", "size", "digest"), levels))
    return arrow_map(sorted_rows, run, "tree string, place bigint, size bigint, digest string")


def rounds_of(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes at the feet of the blocks of every round; in the last, every tree has one node."""
    rounds, largest = [leaves], leaves.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        rounds.append(stage(climbed(rounds[-1].where("size > 1"), levels), "merkle-round"))
        largest = -(-largest // FANOUT**levels)
    return rounds


def proofs(rounds: list[DataFrame], tops: DataFrame, carry: Sequence[str], levels: int, chunk: int = 1000) -> DataFrame:
    """``carry`` columns, tree, proof and top of every leaf; ``tops`` (tree, last, proof, top) says in which round a tree ends."""
    got = None
    for r in range(max(len(rounds) - 2, 0), -1, -1):
        nodes = rounds[r] if r == 0 else rounds[r].where("size > 1")
        # a tree ends in the block below the round in which it has one node; one of a single leaf is a block of no level
        first = tops.where((F.col("last") == r + 1) | (F.col("last") == 0) if r == 0 else F.col("last") == r + 1)
        sent = first.select("tree", F.lit(0).cast("long").alias("block"), "proof", "top")
        if got is not None:
            sent = sent.union(got.select("tree", F.col("place").alias("block"), "proof", "top"))
        kept = ["place"] if r else list(carry)
        rows = by_block(nodes.select(*dict.fromkeys(["tree", "place", "size", "digest", *kept])), levels)
        got = swept(rows.unionByName(sent, allowMissingColumns=True), kept, levels, chunk)
        if r:
            got = stage(got, "merkle-suffixes")
    return got


def swept(rows: DataFrame, kept: Sequence[str], levels: int, chunk: int) -> DataFrame:
    fields = {f.name: f for f in rows.schema.fields}
    schema = ", ".join(["tree string", *[f"`{c}` {fields[c].dataType.simpleString()}" for c in kept], f"proof {PROOF}", "top string"])

    def run(batches):
        types: dict = {}

        def watched():
            for batch in batches:
                types.update({c: batch.schema.field(c).type for c in kept})
                yield batch

        for block in blocks(watched()):
            message, nodes = block[0], block[1:]
            if not nodes:  # no rows at all: the upper tree has a message and no node
                continue
            suffix = [(s["before"], s["after"]) for s in message["proof"]]
            done = forward([n["digest"] for n in nodes], min(levels, height(nodes[0]["size"])))
            found = reversed_sweep(done, suffix)
            for at in range(0, len(nodes), chunk):
                some, paths = nodes[at : at + chunk], found[at : at + chunk]
                steps = [s for path in paths for s in path]
                ends = [0]
                for path in paths:
                    ends.append(ends[-1] + len(path))
                both = [pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)]
                proof = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(both, ["before", "after"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([message["tree"]] * len(some), pa.string()), *[pa.array([n[c] for n in some], types[c]) for c in kept],
                     proof, pa.array([message["top"]] * len(some), pa.string())],
                    names=["tree", *kept, "proof", "top"],
                )

    return arrow_map(delivered(rows), run, schema)


def manifest(docs: DataFrame, columns: Sequence[str], key: str = "doc_id", group: str = "source", levels: int = HEIGHT,
             **extra: Column) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, proof, and the ``extra`` columns, computed where texts are read."""
    tree = F.coalesce(F.concat(F.lit("s"), F.col(f"`{group}`").cast("string")), F.lit("n"))
    names = dict.fromkeys([*columns, key, group])
    rows = picked(docs, *names).select(
        tree.alias("tree"), F.col(f"`{key}`").alias("key"), leaf_of(*[F.col(f"`{c}`") for c in columns]).alias("digest"),
        *[c.alias(f"extra_{name}") for name, c in extra.items()],
    )
    leaves = stage(placed(rows, [F.col("key"), F.col("digest")]), "merkle-leaves")
    rounds = rounds_of(leaves, levels)
    subroots = None
    for last, nodes in enumerate(rounds):
        ended = nodes.where("size = 1").select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest", F.lit(last).alias("last"))
        subroots = ended if subroots is None else subroots.union(ended)
    upper = rounds_of(stage(placed(subroots, [F.col("group")]), "merkle-subroots"), levels)
    root = upper[-1].select("digest").first()  # one row: the upper tree has one node left
    start = docs.sparkSession.range(1).select(
        F.lit("").alias("tree"), F.lit(len(upper) - 1).alias("last"), F.array().cast(PROOF).alias("proof"), F.lit("").alias("top")
    )
    tops = proofs(upper, start, ["group", "digest", "last"], levels).select(
        F.col("group").alias("tree"), "last", "proof", F.col("digest").alias("top")
    )
    made = [f"extra_{name}" for name in extra]
    out = proofs(rounds, stage(tops, "merkle-tops"), ["key", "digest", *made], levels)
    return out.select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"), "proof", *[F.col(f"extra_{name}").alias(name) for name in extra],
    )
