"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shard files.

1. Texts are tokenized, an end token after each, and packed into sequences of ``length`` tokens inside a task; only the last
   sequence of a task is shorter. They are written once, so numbers given to them from here on do not move.
2. Sequences get dense numbers 0..N-1 (task offsets plus place) and slots 0..N-1 by a keyed Feistel network on the
   next even number of bits, walked on until it falls below N: a permutation that any reader can compute and invert
   from (key, N) alone.
3. Each task hands its sequences on grouped by shard and compressed; a shard is a range of slots and one
   partition, whose task writes one file of equal records: 16 bytes (sequence number, token count), then ``length`` tokens,
   little-endian, padded with the end token. Slot s lies at record s mod per_shard of file s // per_shard.

A file is written under a name of its own and then renamed, so a repeated task replaces it by the same bytes. The manifest
comes last: while it is missing the shards are not whole. Readers take lengths, token width, key and N from it.
Reading goes by pyarrow's file systems, so shards may lie wherever those and Spark both reach.

NULL and empty texts are one end token. Repeated rows are tokenized each. An empty table makes no shard.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_dir
from .base import arrow_map, held, mix64, share, text_chunks

LENGTH = 1024
PER_SHARD = 8192
HEADER = 16
ROUNDS = 6
#: zstandard level of sequences at rest between the two steps and in the shuffle.
PACK_LEVEL = 6
# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Order:
    """The permutation of 0..n-1 under a key."""

    n: int
    key: int

    def _half(self) -> int:
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def _once(self, x: np.ndarray, rounds) -> np.ndarray:
        half = np.uint64(self._half())
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for r in rounds:
            secret = mix64(np.uint64((self.key + 0x9E3779B97F4A7C15 * (r + 1)) % (1 << 64)))
            left, right = right, left ^ (mix64(right ^ secret) & mask)
        # the last swap is undone, so the same code with rounds reversed inverts it
        return (right << half) | left

    def _walk(self, x, rounds) -> np.ndarray:
        out = np.array(x, dtype=np.uint64)
        open_ = np.arange(len(out))
        while len(open_):
            out[open_] = self._once(out[open_], rounds)
            open_ = open_[out[open_] >= self.n]
        return out.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, range(ROUNDS))

    def numbers(self, slots) -> np.ndarray:
        return self._walk(slots, range(ROUNDS - 1, -1, -1))


MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Layout:
    """What a reader has to know of the shards below a path."""

    sequences: int
    key: int
    length: int
    per_shard: int
    token_bytes: int
    end: int

    @property
    def stride(self) -> int:
        return HEADER + self.token_bytes * self.length

    @property
    def kind(self):
        return np.uint16 if self.token_bytes == 2 else np.uint32

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.per_shard)

    @property
    def order(self) -> Order:
        return Order(self.sequences, self.key)


def put(path: str, name: str, content) -> None:
    """Write a file below ``path`` under a name of its own, then give it its name."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    attempt = f"{root}/_attempts/{uuid.uuid4().hex}"
    system.create_dir(f"{root}/_attempts", recursive=True)
    with system.open_output_stream(attempt) as out:
        out.write(content)
    system.move(attempt, f"{root}/{name}")


def read_layout(path: str) -> Layout:
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    with system.open_input_stream(f"{root}/{MANIFEST}") as file:
        return Layout(**json.loads(file.read()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def packed(docs: DataFrame, ranks: dict[bytes, int], end: int, key: str, text: str, length: int) -> DataFrame:
    """(task, place, n_tokens, keys, tokens): sequences in order within each task."""
    shared = share(docs, ranks)
    kind = np.uint16 if max(end, max(ranks.values(), default=0)) < 1 << 16 else np.uint32
    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = f"task int, place bigint, n_tokens int, keys array<{key_type}>, tokens binary"

    def run(batches):
        import tiktoken

        coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=held(shared), special_tokens={})
        task, place = TaskContext.get().partitionId(), 0
        rest, owners = np.zeros(0, kind), []  # tokens not yet in a sequence; (end position, key) of texts among them

        def cut(tokens, owners, whole: bool, key_array):
            nonlocal place
            n = len(tokens) // length if not whole else -(-len(tokens) // length)
            if not n:
                return None
            bounds = np.array([o[0] for o in owners])
            lists, sizes, blobs = [], [], []
            for i in range(n):
                a, b = i * length, min((i + 1) * length, len(tokens))
                first, last = np.searchsorted(bounds, a, side="right"), np.searchsorted(bounds, b - 1, side="right")
                lists.append([owners[j][1] for j in range(first, last + 1)])
                sizes.append(b - a)
                blobs.append(tokens[a:b].tobytes())
            made = pa.record_batch(
                [pa.array([task] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(lists, pa.list_(key_array)), pa.array(blobs, pa.binary())],
                names=["task", "place", "n_tokens", "keys", "tokens"],
            )
            place += n
            return made

        key_array = pa.null()
        for batch in batches:
            key_array = batch.column(0).type
            for part, raw in text_chunks(batch, "text"):
                keys = part.column(0).to_pylist()
                coded = coder.encode_ordinary_batch([r.decode() for r in raw], num_threads=1)
                arrays, at = [rest], len(rest)
                for k, ids in zip(keys, coded):
                    ids.append(end)
                    arrays.append(np.array(ids, dtype=kind))
                    at += len(ids)
                    owners.append((at, k))
                tokens = np.concatenate(arrays)
                made = cut(tokens, owners, False, key_array)
                if made is not None:
                    yield made
                    used = made.num_rows * length
                    rest = tokens[used:]
                    owners = [(e - used, k) for e, k in owners if e > used]
                else:
                    rest = tokens
        if len(rest):
            yield cut(rest, owners, True, key_array)

    return arrow_map(rows, run, schema)


def materialise(docs: DataFrame, ranks: dict[bytes, int], end: int, path: str, key: str = "doc_id", text: str = "text",
                length: int = LENGTH, per_shard: int = PER_SHARD, secret: int = 2024) -> tuple[DataFrame, DataFrame, Layout]:
    """Write the shards below ``path``.

    Returns the sequences (number, slot, shard, record, n_tokens, keys), the shards (shard, file, records) and the layout.
    """
    spark = docs.sparkSession
    size = 2 if max(end, max(ranks.values(), default=0)) < 1 << 16 else 4
    where = scratch_dir(spark, "sequences")
    packed(docs, ranks, end, key, text, length).write.options(
        **{"compression": "zstd", "parquet.compression.codec.zstd.level": str(PACK_LEVEL)}
    ).parquet(where)
    staged = spark.read.parquet(where)
    counts = staged.groupBy("task").agg(F.count("*").alias("n")).orderBy("task").toArrow()  # one row per task
    n = counts.column("n").to_numpy()
    layout = Layout(int(n.sum()), secret, length, per_shard, size, end)
    order, stride = layout.order, layout.stride
    starts = dict(zip(counts.column("task").to_pylist(), (np.cumsum(n) - n).tolist()))
    placed = share(docs, (order, starts))
    pad = np.full(length, end, dtype=np.uint16 if size == 2 else np.uint32).tobytes()

    def numbered(columns):
        task, place = columns[0].to_numpy(), columns[1].to_numpy()
        plan, begin = held(placed)
        number = np.array([begin[t] for t in task.tolist()], dtype=np.int64) + place
        return number, plan.slots(number)

    def deal(batches):
        """Records of one shard from one batch together, compressed."""
        import zstandard

        pack = zstandard.ZstdCompressor(level=PACK_LEVEL)
        for batch in batches:
            number, slot = numbered(batch.columns)
            sizes, tokens = batch.column(2).to_numpy(), batch.column(3)
            by = np.argsort(slot, kind="stable")
            shard = slot[by] // per_shard
            for group in np.split(by, np.flatnonzero(np.diff(shard)) + 1):
                if not len(group):
                    continue
                head = np.stack([slot[group], number[group], sizes[group].astype(np.int64)], axis=1)
                body = head.tobytes() + b"".join([tokens[int(i)].as_py() for i in group])
                yield pa.record_batch(
                    [pa.array([int(slot[group[0]]) // per_shard], pa.int32()), pa.array([len(group)], pa.int32()),
                     pa.array([pack.compress(body)], pa.binary())],
                    names=["shard", "n", "body"],
                )

    def write(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        open_shard, held_bytes, got = None, None, 0

        def flush():
            put(path, f"shard-{open_shard:08d}.bin", held_bytes)
            return pa.record_batch(
                [pa.array([open_shard], pa.int32()), pa.array([f"shard-{open_shard:08d}.bin"]), pa.array([got], pa.int64())],
                names=["shard", "file", "records"],
            )

        for batch in batches:
            for shard, count, body in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != open_shard:
                    if open_shard is not None:
                        yield flush()
                    open_shard, got = shard, 0
                    held_bytes = bytearray(stride * min(per_shard, order.n - shard * per_shard))
                raw = memoryview(unpack.decompress(body))
                head = np.frombuffer(raw[: 24 * count], dtype=np.int64).reshape(count, 3)
                at = 24 * count
                for slot, number, tokens in head.tolist():
                    to = (slot - shard * per_shard) * stride
                    held_bytes[to : to + 8] = number.to_bytes(8, "little")
                    held_bytes[to + 8 : to + HEADER] = tokens.to_bytes(8, "little")
                    used = tokens * size
                    held_bytes[to + HEADER : to + stride] = raw[at : at + used].tobytes() + pad[used:]
                    at += used
                got += count
        if open_shard is not None:
            yield flush()

    dealt = arrow_map(staged.select("task", "place", "n_tokens", "tokens"), deal, "shard int, n int, body binary")
    tasks = max(1, layout.shards)
    written = arrow_map(
        dealt.repartitionById(tasks, F.col("shard")).sortWithinPartitions("shard"), write, "shard int, file string, records bigint"
    )
    index = scratch_dir(spark, "shard-index")
    written.write.parquet(index)
    put(path, MANIFEST, json.dumps(asdict(layout)).encode())

    def locate(batches):
        for batch in batches:
            number, slot = numbered(batch.columns)
            yield pa.record_batch(
                [pa.array(number), pa.array(slot), pa.array((slot // per_shard).astype(np.int32)), pa.array((slot % per_shard).astype(np.int32)),
                 batch.column(2), batch.column(3)],
                names=["number", "slot", "shard", "record", "n_tokens", "keys"],
            )

    keys = staged.schema["keys"].dataType.simpleString()
    sequences = arrow_map(
        staged.select("task", "place", "n_tokens", "keys"), locate,
        f"number bigint, slot bigint, shard int, record int, n_tokens int, keys {keys}",
    )
    return sequences, spark.read.parquet(index), layout


def read_slots(path: str, first: int, last: int, layout: Layout | None = None):
    """(slot, sequence number, tokens) of the slots first..last-1, by one seek per shard: what a resumed reader does."""
    from pyarrow import fs

    layout = layout or read_layout(path)
    system, root = fs.FileSystem.from_uri(path)
    stride, kind, per_shard = layout.stride, layout.kind, layout.per_shard
    last = min(last, layout.sequences)
    while first < last:
        shard, record = divmod(first, per_shard)
        many = min(last - first, per_shard - record)
        with system.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            file.seek(record * stride)
            data = file.read(many * stride)
        for i in range(many):
            head = np.frombuffer(data, dtype=np.int64, count=2, offset=i * stride)
            yield first + i, int(head[0]), np.frombuffer(data, dtype=kind, count=int(head[1]), offset=i * stride + HEADER)
        first += many


def read_back(shards: DataFrame, path: str) -> DataFrame:
    """(slot, number, in_place, n_tokens, crc32 of the tokens' bytes) of every record on disk, shard by shard.

    ``in_place``: the record holds the sequence that the order has there, as the manifest alone tells.
    """

    def run(batches):
        layout = read_layout(path)
        order, per_shard = layout.order, layout.per_shard
        for batch in batches:
            for shard, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [(s, n, len(t), zlib.crc32(t.tobytes())) for s, n, t in
                         read_slots(path, shard * per_shard, shard * per_shard + records, layout)]
                slot, number, tokens, crc = zip(*found)
                yield pa.record_batch(
                    [pa.array(slot, pa.int64()), pa.array(number, pa.int64()), pa.array(order.numbers(slot) == np.array(number)),
                     pa.array(tokens, pa.int32()), pa.array(crc, pa.int64())],
                    names=["slot", "number", "in_place", "n_tokens", "crc32"],
                )

    return arrow_map(shards.select("shard", "records"), run, "slot bigint, number bigint, in_place boolean, n_tokens int, crc32 bigint")


def shard_path(spark: SparkSession) -> str:
    """A fresh folder on the session's shared storage, as a URI."""
    made = scratch_dir(spark, "shards")
    return made if "://" in made else made.replace("file:", "", 1) if made.startswith("file:") else made
