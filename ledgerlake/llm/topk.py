"""Exact top-k inner products over an impact-ordered index, scored segment by segment.

Components become integers floor(1024 x). The index is a table of blocks of rows; in a block every dimension has
a posting list ordered by its values and cut into ``LEVELS`` quantised impacts. For a query each dimension is read from
the end that helps it, so all impacts are at least zero: a row scores a constant plus the sum of |q| x impact.
Segments (one level of one dimension) are processed by descending |q| x impact. A row's score lies between what
its segments have added and that plus the most that levels not yet read can add; rows whose upper end falls
below the k-th best lower end are out. Reading stops when the rest is small enough to be scored exactly (or nothing
is left to read); every row still possible is then scored from its integers, so results are exact.

Each query carries a floor, the k-th best of its exact scores in one block: the k best of all rows reach it, so a block
none of whose rows can is refused from its bounds alone, and rows below it leave no task.

Queries against all rows: query blocks meet index blocks in an equi-join on shelves (index blocks are dealt to
shelves, query blocks copied to each). A pair of blocks is the unit of work and memory; k rows per query leave it and
meet in a top-k window. Of rows only that one block is broadcast, and no queries.

Vectors that are NULL or hold NULL or non-finite components take no part. Shorter vectors count as padded with zeros.
Repeated rows are rows of their own: a query is only kept from meeting its own row. A NULL id is never a
query; as a candidate it comes last among ties. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import arrow_map, held, share, stage

SCALE = 1024
LEVELS = 128
BLOCK = 8192
QUERIES = 256
#: Index blocks on one shelf.
PER_SHELF = 2
ROUNDS = 8


def integers(batch_vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of usable vectors and their integer components."""
    keep, out = [], []
    for i, v in enumerate(batch_vectors):
        values = v.values
        if values is None or values.null_count:
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all():
            keep.append(i)
            out.append(np.floor(SCALE * x).astype(np.int64))
    return np.array(keep, dtype=np.int64), out


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    made = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)), dtype=np.int64)
    for i, v in enumerate(vectors):
        made[i, : len(v)] = v
    return made


def blocks_of(rows: DataFrame, size: int, postings: bool) -> DataFrame:
    """Blocks of at most ``size`` rows (row, id, vector): their ids, integers and, for an index, posting orders."""
    schema = "block bigint, rows array<bigint>, ids array<bigint>, dims int, ints array<bigint>, orders array<int>"

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        held_rows, held_ids, held_vectors = [], [], []

        def flush():
            nonlocal made
            m = matrix(held_vectors)
            orders = np.argsort(-m, axis=0, kind="stable").T.astype(np.int32).ravel() if postings else np.zeros(0, np.int32)
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            yield pa.record_batch(
                [pa.array([(part << 32) + made]), one(held_rows, pa.int64()), one(held_ids, pa.int64()), pa.array([m.shape[1]], pa.int32()),
                 one(m.ravel(), pa.int64()), one(orders, pa.int32())],
                names=["block", "rows", "ids", "dims", "ints", "orders"],
            )
            made += 1
            for held in (held_rows, held_ids, held_vectors):
                held.clear()

        for batch in batches:
            keep, vectors = integers(batch.column(2))
            row, key = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, v in zip(keep.tolist(), vectors):
                held_rows.append(row[i])
                held_ids.append(key[i])
                held_vectors.append(v)
                if len(held_rows) == size:
                    yield from flush()
        if held_rows:
            yield from flush()

    return arrow_map(rows, run, schema)


class Index:
    """Postings of one block: values and row order by dimension, levels and where each level begins."""

    def __init__(self, ints: np.ndarray, orders: np.ndarray, levels: int = LEVELS):
        self.ints = ints
        n, dims = ints.shape
        self.orders = orders.reshape(dims, n)
        self.low, self.high = ints.min(axis=0), ints.max(axis=0)
        self.width = np.maximum(1, -(-(self.high - self.low + 1) // levels))
        self.levels = levels
        rising, falling = (ints - self.low) // self.width, (self.high - ints) // self.width
        # level of each row for a positive and for a negative query component
        self.level = (rising.T.astype(np.uint8), falling.T.astype(np.uint8))
        # how many rows a dimension has at each level
        spread = np.arange(dims)[:, None] * levels
        self.sizes = tuple(
            np.bincount((lv + spread).ravel(), minlength=dims * levels).reshape(dims, levels) for lv in (rising.T, falling.T)
        )

    def best(self, query: np.ndarray, k: int, own: int | None, floor: float = -np.inf) -> np.ndarray:
        """Rows that can be among the k best, ties at the k-th score included, found by descending impact."""
        n, dims = self.ints.shape
        use = np.flatnonzero(query)
        size = np.abs(query[use])
        constant = int(np.where(query > 0, query * self.low, query * self.high).sum())
        if constant + int((size * (self.high - self.low)[use]).sum()) < floor:
            return np.zeros(0, dtype=np.int64)  # no row of the block can reach the floor
        negative = (query[use] < 0).astype(np.int64)
        counts = np.where(negative[:, None] == 0, self.sizes[0][use], self.sizes[1][use])
        # rows above a level come first in reading order
        begin = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        level = np.arange(self.levels)
        impact = size[:, None] * (level * self.width[use, None])
        filled = (counts > 0) & (level > 0)
        dim_of, level_of = np.nonzero(filled)
        order = np.argsort(-impact[dim_of, level_of], kind="stable")
        dim_of, level_of = dim_of[order], level_of[order]
        lengths = counts[dim_of, level_of]
        cuts = np.searchsorted(np.cumsum(lengths), lengths.sum() * np.arange(1, ROUNDS + 1) / ROUNDS) + 1 if len(order) else []
        scores = np.zeros(n)
        possible = np.ones(n, dtype=bool)
        if own is not None:
            possible[own] = False
        alive = np.flatnonzero(possible)
        reached = np.full(len(use), self.levels)  # the lowest level read in each dimension
        start = 0
        for r, stop in enumerate(cuts):
            if stop > start:
                d, lv, m = dim_of[start:stop], level_of[start:stop], lengths[start:stop]
                ends = np.cumsum(m)
                offset = np.arange(int(ends[-1])) - np.repeat(ends - m, m) + np.repeat(begin[d, lv], m)
                back = np.repeat(negative[d], m) == 1
                offset[back] = n - 1 - offset[back]
                docs = self.orders[np.repeat(use[d], m), offset]
                scores += np.bincount(docs, weights=np.repeat(impact[d, lv], m), minlength=n)
                np.minimum.at(reached, d, lv)
                start = stop
            if r < ROUNDS // 2 or len(alive) <= 4 * k:
                continue
            lower = scores[alive] + constant
            bar = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) >= k else floor
            top = np.maximum(level[None, :], (reached - 1)[:, None])
            most = size[:, None] * (top * self.width[use, None] + self.width[use, None] - 1)
            most = np.minimum(most, size[:, None] * (self.high - self.low)[use, None])
            upper = np.full(len(alive), float(constant))
            for j, dim in enumerate(use):
                upper += most[j][self.level[negative[j]][dim][alive]]
            alive = alive[upper >= bar]
            if len(alive) <= 4 * k:  # proof enough: only these can be members
                break
        return alive


def floors_of(ints: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th best score among these rows, its own left out: the k best of all rows reach it."""
    if len(rows) <= k:
        return np.full(len(queries), np.iinfo(np.int64).min)
    dims = min(ints.shape[1], queries.shape[1])
    scores = queries[:, :dims] @ ints[:, :dims].T
    scores[query_rows[:, None] == rows[None, :]] = np.iinfo(np.int64).min
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def with_floors(asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """``asked`` with ``q_floors``, from the first index block: one block, which goes to every task."""
    first = index.orderBy("block").limit(1).select("rows", "dims", "ints").toArrow()
    lists = [np.array(first.column(c)[0].as_py() if first.num_rows else [], dtype=np.int64) for c in ("rows", "ints")]
    shared = share(asked, (lists[0], lists[1].reshape(len(lists[0]), -1) if len(lists[0]) else np.zeros((0, 0), np.int64)))

    def run(batches):
        rows, ints = held(shared)
        for batch in batches:
            floors = []
            for q_rows, q_ints in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                q_rows = np.array(q_rows, dtype=np.int64)
                floors.append(floors_of(ints, rows, np.array(q_ints, dtype=np.int64).reshape(len(q_rows), -1), q_rows, k).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(floors, pa.list_(pa.int64()))], names=[*batch.schema.names, "q_floors"]
            )

    columns = [F.col(c).alias(f"q_{c}") for c in ("rows", "ids", "dims", "ints")]
    schema = "q_rows array<bigint>, q_ids array<bigint>, q_dims int, q_ints array<bigint>, q_floors array<bigint>"
    return arrow_map(asked.select(*columns), run, schema)


def best_of_pair(index: Index, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int, floors: np.ndarray | None = None):
    """(query number, row number in the block, score) of the k best and of all tied with the k-th, for each query.

    ``floors``: scores that the k best of all rows are known to reach; rows below are left out.
    """
    where = {r: i for i, r in enumerate(rows.tolist())}
    dims = max(index.ints.shape[1], queries.shape[1])
    if queries.shape[1] < dims:
        queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    out = []
    for j, q in enumerate(queries[:, : index.ints.shape[1]]):
        floor = -np.inf if floors is None else int(floors[j])
        chosen = index.best(q, k, where.get(int(query_rows[j])), floor)
        exact = index.ints[chosen] @ q
        chosen, exact = chosen[exact >= floor], exact[exact >= floor]
        if len(chosen) > k:
            bar = np.partition(exact, len(exact) - k)[len(exact) - k]
            chosen, exact = chosen[exact >= bar], exact[exact >= bar]
        out.append((np.full(len(chosen), j), chosen, exact))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
           block: int = BLOCK, per_shelf: int = PER_SHELF) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every row where ``is_query`` holds."""
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{vector}`").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = stage(rows, "vectors")  # the row number is a stored value from here on
    index = stage(blocks_of(rows.select("row", "id", "vector"), block, True), "index")
    shelves = max(1, -(-index.count() // per_shelf))
    asked = blocks_of(rows.where("asks").select("row", "id", "vector"), QUERIES, False)
    asked = stage(with_floors(asked, index, k), "queries")
    pairs = index.withColumn("shelf", F.pmod(F.xxhash64("block"), F.lit(shelves))).join(
        asked.withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shelves - 1).cast("long")))), "shelf"
    )

    def run(batches):
        known, last = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                at = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                numpy = lambda name: at[name].values.to_numpy(zero_copy_only=False)
                if at["block"].as_py() != last:
                    last = at["block"].as_py()
                    dims = at["dims"].as_py()
                    ints = numpy("ints")
                    known = Index(ints.reshape(-1, dims) if dims else ints.reshape(len(at["rows"].values), 0), numpy("orders"))
                q_rows = numpy("q_rows")
                number, doc, score = best_of_pair(known, numpy("rows"), numpy("q_ints").reshape(len(q_rows), -1), q_rows, k, numpy("q_floors"))
                q_ids, ids = at["q_ids"].values, at["ids"].values
                yield pa.record_batch(
                    [pa.array(q_rows[number]), q_ids.take(pa.array(number)), ids.take(pa.array(doc)), pa.array(numpy("rows")[doc]), pa.array(score)],
                    names=["q_row", "query_id", "id", "row", "score"],
                )

    found = arrow_map(
        pairs.select("block", "rows", "ids", "dims", "ints", "orders", "q_rows", "q_ids", "q_dims", "q_ints", "q_floors"), run,
        "q_row bigint, query_id bigint, id bigint, row bigint, score bigint",
    )
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
