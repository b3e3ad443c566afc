"""Chat formatting with minimum-cost role repair.

Legal conversations: an optional system turn, then user and assistant in turn, the assistant last. A dynamic program
over the automaton of the role emitted last chooses for every turn the cheapest of keeping it, merging it into the turn
before, or relabelling it, with empty turns inserted where needed; the repaired sequence is rendered with markers.

Conversations of any length: rows are range-partitioned in conversation order and packed into blocks of at most
``BLOCK`` turns of one conversation. Most conversations are one block. For the others min-plus matrices of blocks give the
costs at every block's start, each block then maps its possible last states to first states, and composing these maps
backwards fixes the state at each end: the result is that of one pass over the whole, ties included, while what
meets in one place is a few numbers per block, never the turns.

Turns are ordered by turn (NULL last), then role, then a hash of the text. NULL texts are empty; a NULL or unknown role
must be relabelled. A NULL conversation id is a conversation of its own. Repeated rows are turns of their own. Among
repairs of equal cost: at each turn the least state before it (order of STATES), in it fewest insertions,
then keep, merge, relabel. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, held, share, stage

BLOCK = 2048
BLOCK_BYTES = 8 << 20
STATES = ("none", "system", "user", "assistant")
#: Roles that may follow each state.
FOLLOWS = {"none": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"
FAR = 1 << 50


@dataclass(frozen=True)
class Costs:
    insert: int = 4
    relabel: int = 3
    relabel_unknown: int = 2
    merge_same: int = 1
    merge_other: int = 5


class Repair:
    """Transition tables of the automaton for each observed role."""

    def __init__(self, costs: Costs):
        n = len(STATES)
        self.costs = costs
        # cheapest way to reach a state by inserted empty turns alone: the roles inserted
        self.inserts = [[None] * n for _ in range(n)]
        for s in range(n):
            self.inserts[s][s] = ()
            todo = [s]
            while todo:
                at = todo.pop(0)
                for role in FOLLOWS[STATES[at]]:
                    to = STATES.index(role)
                    if role != "system" and self.inserts[s][to] is None:
                        self.inserts[s][to] = (*self.inserts[s][at], role)
                        todo.append(to)
        self.roles = {r: self._table(r) for r in (*STATES[1:], None)}
        self.ends = [min(costs.insert * len(self.inserts[s][3]), FAR) if s else 0 for s in range(n)]

    def _table(self, role: str | None):
        """[before][after] = (cost, inserted roles, action)."""
        c, n = self.costs, len(STATES)
        table = [[(FAR, (), "keep")] * n for _ in range(n)]
        for before in range(n):
            ways = []
            for middle in range(n):
                inserted = self.inserts[before][middle]
                if inserted is None:
                    continue
                base = c.insert * len(inserted)
                for to in FOLLOWS[STATES[middle]]:
                    change = 0 if to == role else (c.relabel if role else c.relabel_unknown)
                    ways.append((base + change, len(inserted), 0 if to == role else 2, STATES.index(to), inserted, "keep" if to == role else "relabel"))
                if middle:
                    cost = c.merge_same if STATES[middle] == role else c.merge_other
                    ways.append((base + cost, len(inserted), 1, middle, inserted, "merge"))
            for cost, _, _, to, inserted, action in sorted(ways, key=lambda w: w[:4]):
                if cost < table[before][to][0]:
                    table[before][to] = (cost, inserted, action)
        return table

    def of(self, role: str | None):
        name = (role or "").strip().lower()
        return self.roles[name if name in STATES[1:] else None]

    def matrix(self, roles) -> list[int]:
        """Costs from each first to each last state over a run of turns."""
        out = []
        for s in range(len(STATES)):
            vector = [FAR] * len(STATES)
            vector[s] = 0
            out += self.forward(roles, vector)[0]
        return out

    def forward(self, roles, vector: list[int]) -> tuple[list[int], list[list[int]]]:
        """Costs after the run from costs before it, and for each turn the best state before each state after it."""
        n, trace = range(len(STATES)), []
        for role in roles:
            table = self.of(role)
            best, source = [FAR] * len(STATES), [0] * len(STATES)
            for s in n:
                if vector[s] < FAR:
                    for t in n:
                        cost = vector[s] + table[s][t][0]
                        if cost < best[t]:
                            best[t], source[t] = cost, s
            vector = best
            trace.append(source)
        return vector, trace

    def last_state(self, vector: list[int]) -> int:
        return min(range(len(STATES)), key=lambda s: (vector[s] + self.ends[s], s))

    def start_of(self, trace: list[list[int]], last: int) -> int:
        for source in reversed(trace):
            last = source[last]
        return last

    def actions(self, roles, trace, last: int) -> list[tuple[int, int, tuple, str]]:
        """(state before, state after, inserted roles, action) of each turn."""
        out = []
        for role, source in zip(reversed(roles), reversed(trace)):
            first = source[last]
            _, inserted, action = self.of(role)[first][last]
            out.append((first, last, inserted, action))
            last = first
        return out[::-1]

    def render(self, roles, texts, vector, last: int, is_last: bool) -> tuple[str, int, int, list[str]]:
        """Rendered text of a block, its cost, the number of turns begun in it, and the actions taken."""
        after, trace = self.forward(roles, vector)
        parts, turns, taken, cost = [], 0, [], 0
        for (first, to, inserted, action), text, role in zip(self.actions(roles, trace, last), texts, roles):
            cost += self.of(role)[first][to][0]
            open_ = first != 0
            for extra in inserted:
                parts.append((CLOSE if open_ else "") + OPEN.format(role=extra))
                open_ = True
                turns += 1
            if action == "merge":
                parts.append("\n" + escaped(text))
            else:
                parts.append((CLOSE if open_ else "") + OPEN.format(role=STATES[to]) + escaped(text))
                turns += 1
            taken.append("".join("insert," for _ in inserted) + action)
        if is_last and last:
            for extra in self.inserts[last][3]:
                parts.append(CLOSE + OPEN.format(role=extra))
                turns += 1
                taken.append("insert")
            parts.append(CLOSE)
            cost += self.ends[last]
        return "".join(parts), cost, turns, taken


def escaped(text: str | None) -> str:
    """Text in which no marker can begin."""
    return (text or "").replace("\\", "\\\\").replace("<|", "<\\|")


def parsed(rendered: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a rendered conversation."""
    out = []
    for piece in rendered.split(CLOSE)[:-1]:
        head, text = piece[2:].split("|>\n", 1)
        out.append((head, text.replace("<\\|", "<|").replace("\\\\", "\\")))
    return out


def packed(turns: DataFrame, conv: str, turn: str, role: str, text: str, costs: Costs, block: int) -> DataFrame:
    """Blocks (conv, part, block, roles, texts, matrix) in conversation order."""
    c = lambda name: F.col(f"`{name}`")
    rows = turns.select(
        c(conv).alias("conv"), c(turn).alias("turn"), c(role).cast("string").alias("role"), c(text).cast("string").alias("text"),
        F.xxhash64(c(text)).alias("h"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.asc("h")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    conv_type = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {conv_type}, part int, block bigint, roles array<string>, texts array<string>, matrix array<bigint>"

    def run(batches):
        repair = Repair(costs)
        part, made = TaskContext.get().partitionId(), 0
        open_conv, roles, texts, size = None, [], [], 0
        kind = None
        done = []

        def close():
            nonlocal made, size
            done.append((open_conv, part, made, list(roles), list(texts), repair.matrix(roles)))
            made += 1
            size = 0
            roles.clear()
            texts.clear()

        def flush():
            conv_, part_, block_, roles_, texts_, matrix_ = zip(*done)
            done.clear()
            return pa.record_batch(
                [pa.array(conv_, kind), pa.array(part_, pa.int32()), pa.array(block_, pa.int64()), pa.array(roles_, pa.list_(pa.string())),
                 pa.array(texts_, pa.list_(pa.string())), pa.array(matrix_, pa.list_(pa.int64()))],
                names=["conv", "part", "block", "roles", "texts", "matrix"],
            )

        waiting = 0
        for batch in batches:
            kind = batch.column(0).type
            for conv_, role_, text_ in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if roles and (conv_ != open_conv or len(roles) == block or size > BLOCK_BYTES):
                    waiting += size
                    close()
                    if waiting > BLOCK_BYTES or len(done) >= 2000:
                        yield flush()
                        waiting = 0
                open_conv = conv_
                roles.append(role_)
                texts.append(text_ or "")
                size += len(text_ or "")
        if roles:
            close()
        if done:
            yield flush()

    return arrow_map(ranged, run, schema)


def _meet(blocks: DataFrame, fn, out: str) -> DataFrame:
    """Apply ``fn`` to the few numbers of all blocks of each conversation, in block order."""
    return blocks.groupBy("conv").applyInArrow(fn, out)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """Per block of a conversation: conv, block (0, 1, ... within it), n_in, n_out, cost, actions, rendered.

    The rendered texts of a conversation's blocks, joined in order, are its rendering; nearly all have one block.
    """
    blocks = stage(packed(turns, conv, turn, role, text, costs, block), "chat-blocks")
    heads = blocks.select("conv", "part", "block", "matrix")
    kind = heads.schema["conv"].dataType.simpleString()
    several = heads.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    shared = share(turns, costs)
    n = len(STATES)

    def entries(table: pa.Table) -> pa.Table:
        """Costs in front of every block; the number of blocks."""
        table = table.sort_by([("part", "ascending"), ("block", "ascending")])
        vector, found = [0] + [FAR] * (n - 1), []
        for matrix in table.column("matrix").to_pylist():
            found.append(vector)
            m = np.array(matrix, dtype=np.int64).reshape(n, n)
            vector = np.minimum((np.array(vector)[:, None] + m).min(axis=0), FAR).tolist()
        last = Repair(held(shared)).last_state(vector)
        size = table.num_rows
        return pa.table({
            "conv": table.column("conv"), "part": table.column("part"), "block": table.column("block"),
            "number": pa.array(range(size), pa.int64()), "vector": pa.array(found, pa.list_(pa.int64())),
            "end": pa.array([last if i == size - 1 else -1 for i in range(size)], pa.int32()),
        })

    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & (a["part"] == b["part"]) & (a["block"] == b["block"])
    long_heads = heads.join(several, heads["conv"].eqNullSafe(several["conv"]), "left_semi")
    fronts = stage(
        _meet(long_heads, entries, f"conv {kind}, part int, block bigint, number bigint, vector array<bigint>, end int"), "chat-fronts"
    )

    def maps(batches):
        repair = Repair(held(shared))
        for batch in batches:
            starts = []
            for roles, vector in zip(batch.column(5).to_pylist(), batch.column(4).to_pylist()):
                trace = repair.forward(roles, vector)[1]
                starts.append([repair.start_of(trace, s) for s in range(n)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], batch.column(6), pa.array(starts, pa.list_(pa.int32()))], names=["conv", "part", "block", "number", "end", "starts"]
            )

    inner = blocks.join(fronts, same(blocks, fronts)).select(
        fronts["conv"], fronts["part"], fronts["block"], "number", "vector", "roles", "end"
    )
    mapped = arrow_map(inner, maps, f"conv {kind}, part int, block bigint, number bigint, end int, starts array<int>")

    def exits(table: pa.Table) -> pa.Table:
        """The state after every block, from the last one backwards."""
        table = table.sort_by([("number", "ascending")])
        states, at = [], table.column("end")[table.num_rows - 1].as_py()
        for starts in reversed(table.column("starts").to_pylist()):
            states.append(at)
            at = starts[at]
        return pa.table({
            "conv": table.column("conv"), "part": table.column("part"), "block": table.column("block"),
            "exit": pa.array(states[::-1], pa.int32()),
        })

    backs = _meet(mapped, exits, f"conv {kind}, part int, block bigint, exit int")
    known = stage(
        fronts.join(backs, same(fronts, backs)).select(fronts["conv"], fronts["part"], fronts["block"], "number", "vector", "end", "exit"),
        "chat-states",
    )

    def render(batches):
        repair = Repair(held(shared))
        for batch in batches:
            found = []
            for roles, texts, number, vector, end, exit_ in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                if vector is None:  # a conversation of one block
                    vector = [0] + [FAR] * (n - 1)
                    exit_ = end = repair.last_state(repair.forward(roles, vector)[0])
                rendered, cost, turns_out, taken = repair.render(roles, texts, vector, exit_, end >= 0)
                found.append((number or 0, len(roles), turns_out, cost, taken, rendered))
            numbers, n_in, n_out, cost, taken, rendered = zip(*found) if found else ([],) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(n_in, pa.int64()), pa.array(n_out, pa.int64()),
                 pa.array(cost, pa.int64()), pa.array(taken, pa.list_(pa.string())), pa.array(rendered, pa.string())],
                names=["conv", "block", "n_in", "n_out", "cost", "actions", "rendered"],
            )

    ready = blocks.join(known, same(blocks, known), "left").select(
        blocks["conv"], "roles", "texts", "number", "vector", "end", "exit"
    )
    out = arrow_map(ready, render, f"conv {kind}, block bigint, n_in bigint, n_out bigint, cost bigint, actions array<string>, rendered string")
    return out.withColumnRenamed("conv", conv)
