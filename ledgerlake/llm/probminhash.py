"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

Texts are split at ASCII white space, ASCII letters lower-cased; their shingles are runs of five words (a shorter
text is one shingle). Two different texts are linked if the Jaccard similarity of their shingle sets is 0.8 or more;
classes are the connected components of links.

Signature: every distinct shingle is a Poisson process whose points fall on random registers; a register keeps the
shingle of its earliest point. A process ends as soon as its next point comes later than the latest register. At rate
1 equal registers estimate the similarity of the sets, by which links are defined; at rate 1 + ln(count) they
estimate the probability Jaccard similarity. Texts are banded by both kinds, so a pair whose repeat counts differ is
found as surely as any other. Without a repeated shingle the two kinds are the same.

Work: equal texts collapse to one node first (by digest, counted in each task). Nodes meet in buckets of equal
bands. Each bucket links its members to its least node (a star, linear in the bucket), these candidates are
verified on the texts, and components are formed. Where a bucket still holds several components, further stars
to other members follow while they connect much; what is left, members of different components of one bucket, is
compared in blocks of bounded size: by signatures first, then on the texts of members with a likely partner. No bucket
is cut, no pair inside a component is made, and pairs are verified where they meet, so only links leave a task.

With 32 bands of 6 registers a pair at similarity 0.8 shares no bucket with probability 6e-5, at 0.85 3e-7.
The signature comparison in blocks, of registers at rate 1, asks for 0.65; a pair at 0.8 falls below with 5e-7.

NULL texts are empty; empty texts are equal to each other. Repeated rows belong to the class of their text. A row
without id takes part; class_id is the least id in the class, NULL if it has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, mix64, stage, text_chunks
from .components import components
from .sieve import split_by

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 32, 6
NEAR = 0.65
#: Texts of more than ``COPIES`` copies count as hot, the ``HOT`` most frequent of them.
COPIES, HOT = 200, 20_000
BLOCK = 256

_h = xxhash.xxh3_64_intdigest
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles and the number of the text of each, texts in order."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        hashes.extend(map(_h, words))
        counts[i] = len(words)
    h = np.array(hashes, dtype=np.uint64)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + np.repeat(np.cumsum(counts) - counts, made)
    width = np.repeat(np.minimum(counts, size), made)
    out = np.zeros(len(owner), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            use = width > k
            out[use] = mix64(out[use] * _ODD + h[at[use] + k] + np.uint64(k))
    return out, owner


def weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with weight 1 + ln(count)."""
    joint = hashes ^ mix64(owner.astype(np.uint64) + np.uint64(77))
    _, first, counts = np.unique(joint, return_index=True, return_counts=True)
    return hashes[first], owner[first], 1 + np.log(counts)


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """(n x size) registers: the shingle whose point came first, 0 where a text has no shingle."""
    time = np.full(n * size, np.inf)
    first = np.zeros(n * size, dtype=np.uint64)
    clock = np.zeros(len(hashes))
    x, d, w = hashes, owner.astype(np.int64), weight
    step = 0
    unit = 1.0 / (1 << 53)
    with np.errstate(over="ignore"):
        while len(x):
            step += 1
            draw = mix64(x + np.uint64(step) * _ODD)
            u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * unit
            clock = clock - np.log(u) / w
            slot = d * size + (mix64(draw + _ODD) % np.uint64(size)).astype(np.int64)
            np.minimum.at(time, slot, clock)
            won = time[slot] == clock
            first[slot[won]] = x[won]
            if step <= 4 or step % 8 == 0:  # later steps have few points left: the limit need not be exact
                limit = time.reshape(n, size).max(axis=1)
            go = clock < limit[d]
            x, d, w, clock = x[go], d[go], w[go], clock[go]
    return first.reshape(n, size)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(registers), axis=0)
    with np.errstate(over="ignore"):
        for r in range(rows):
            keys = mix64(keys * _ODD + registers[:, r : bands * rows : rows])
    return keys.view(np.int64)


def both_signatures(raw: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Registers at rate 1 and at rate 1 + ln(count); the same ones for a text without a repeated shingle."""
    hashes, owner, weight = weighted(*shingles(raw))
    plain = signatures(hashes, owner, np.ones(len(hashes)), len(raw), size)
    heavy = plain.copy()
    again = np.unique(owner[weight > 1])
    if len(again):
        of = np.isin(owner, again)
        heavy[again] = signatures(hashes[of], np.searchsorted(again, owner[of]), weight[of], len(again), size)
    return plain, heavy


def sketch(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """(digest, bands, marks), one row per distinct text: band keys of the plain and then of the weighted registers, and
    one byte per plain register."""
    size = bands * rows

    def run(batches):
        for batch in batches:
            for part, raw in text_chunks(batch, "text", 3 << 20):
                plain, heavy = both_signatures(raw, size)
                keys = np.concatenate([band_keys(plain, bands, rows), band_keys(heavy, bands, rows)], axis=1)
                marks = (mix64(plain) & np.uint64(255)).astype(np.uint8)
                offsets = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * 2 * bands)
                yield pa.record_batch(
                    [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                     pa.array([m.tobytes() for m in marks], pa.binary())],
                    names=["digest", "bands", "marks"],
                )

    made = arrow_map(texts.select("digest", "text"), run, "digest binary, bands array<bigint>, marks binary")
    return made.groupBy("digest").agg(F.first("bands").alias("bands"), F.first("marks").alias("marks"))


def fetched(texts: DataFrame, wanted: DataFrame, label: str) -> DataFrame:
    """(digest, text) of the digests in ``wanted``. Texts that nobody asked for do not travel, and copies meet before they do."""
    sifted = split_by(texts, F.col("digest"), wanted, "digest")[1]
    each = sifted.groupBy("digest").agg(F.first("text").alias("text"))
    return stage(each.join(wanted, "digest", "left_semi"), label)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets of shingle hashes have a Jaccard similarity of ``least`` or more; empty ones do not."""
    low, high = sorted((len(a), len(b)))
    if high == 0 or low < least * high:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (low + high - common) - 1e-9


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of digests whose texts have shingle sets of similarity ``least`` or more."""
    pairs = stage(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct()
    # only texts in some pair travel, each distinct one once
    needed = fetched(texts, stage(wanted, "wanted"), "pair-texts")
    both = (
        pairs.join(needed.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
        .join(needed.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
    )

    def run(batches):
        last, kept = None, None
        for batch in batches:
            names = batch.schema.names
            a, b = batch.column(names.index("a")), batch.column(names.index("b"))
            good = np.zeros(batch.num_rows, dtype=bool)
            done = 0
            for part, raw in text_chunks(batch, "text_b"):
                left = part.column(names.index("text_a")).cast(pa.binary())
                for i, text in enumerate(raw):
                    key = a[done].as_py()
                    if key != last:
                        last, kept = key, np.unique(shingles([left[i].as_py()])[0])
                    good[done] = similar(kept, np.unique(shingles([text])[0]), least)
                    done += 1
            chosen = pa.array(good)
            yield pa.record_batch([a.filter(chosen), b.filter(chosen)], names=["a", "b"])

    return arrow_map(both.select("a", "b", "text_a", "text_b"), run, "a binary, b binary")


def dealt_in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Meetings (band, lo, hi) of blocks of members with what they carry; ``low``: the member is of the first block.

    ``members``: (band, digest, root, ...). Members outside the bucket's least root are dealt into blocks; each such
    block meets every other one and every block of members of that root. A block has about ``block`` members.
    """
    shape = members.groupBy("band").agg(F.min("root").alias("main"), F.count("*").alias("n")).join(
        members.groupBy("band", "root").agg(F.count("*").alias("of_root")), "band"
    ).where("root = main").select("band", "main", (F.col("n") - F.col("of_root")).alias("others"), "of_root")
    shape = shape.where("others > 0").select(
        "band", "main", F.ceil(F.col("others") / block).cast("int").alias("no"), F.ceil(F.col("of_root") / block).cast("int").alias("nm")
    )
    placed = members.join(shape, "band").withColumn("is_main", F.col("root") == F.col("main"))
    place = F.pmod(F.xxhash64("digest", F.lit(5)), F.when(F.col("is_main"), F.col("nm")).otherwise(F.col("no"))).cast("int")
    placed = placed.withColumn("place", place)
    # blocks of the main root are counted from ``no`` on
    meet_main = F.transform(F.sequence(F.lit(0), F.col("no") - 1), lambda i: F.struct(i.alias("lo"), (F.col("place") + F.col("no")).alias("hi")))
    meet_other = F.transform(
        F.sequence(F.lit(0), F.col("no") + F.col("nm") - 1),
        lambda j: F.struct(F.least(j, F.col("place")).alias("lo"), F.greatest(j, F.col("place")).alias("hi")),
    )
    met = placed.withColumn("m", F.explode(F.when(F.col("is_main"), meet_main).otherwise(meet_other)))
    return met.select(
        *members.columns, F.col("m.lo").alias("lo"), F.col("m.hi").alias("hi"),
        (~F.col("is_main") & (F.col("place") == F.col("m.lo"))).alias("low"),
    )


def alike(table: pa.Table, near: float):
    """Yield (i, js) of one meeting: members of different roots whose marks agree on ``near`` of the registers.

    A pair may share several buckets; it belongs to the first band it shares, so it comes up once.
    """
    n = table.num_rows
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), dtype=np.uint8).reshape(n, -1)
    bands = np.array(table.column("bands").to_pylist(), dtype=np.int64).reshape(n, -1)
    band = table.column("band")[0].as_py()
    roots = np.unique(np.array([r.hex() for r in table.column("root").to_pylist()]), return_inverse=True)[1]
    low = table.column("low").to_numpy()
    one_block = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
    rows, cols = (np.arange(n),) * 2 if one_block else (np.flatnonzero(low), np.flatnonzero(~low))
    for i in rows:
        other = cols[(roots[cols] != roots[i]) & ((cols > i) if one_block else True)]
        other = other[(marks[other] == marks[i]).mean(axis=1) >= near]
        if len(other):
            shared = bands[other] == bands[i]
            other = other[bands[i][shared.argmax(axis=1)] == band]
            if len(other):
                yield int(i), other, roots


def compared_in_blocks(members: DataFrame, texts: DataFrame, least: float, near: float, block: int) -> DataFrame:
    """Verified links between members of different roots of a bucket, at most as many from a meeting as connect it.

    ``members``: (band, digest, root, marks, bands). Signatures tell which members have a likely partner; only their
    texts are fetched, and the pairs are verified where they meet. No pair leaves a task unverified.
    """
    def likely(table: pa.Table) -> pa.Table:
        chosen: set[int] = set()
        for i, others, _ in alike(table, near):
            chosen.add(i)
            chosen.update(others.tolist())
        return table.select(["band", "digest"]).take(pa.array(sorted(chosen), pa.int64()))

    flagged = dealt_in_blocks(members, block).groupBy("band", "lo", "hi").applyInArrow(likely, "band bigint, digest binary").distinct()
    flagged = stage(flagged, "likely")
    wanted = stage(flagged.select("digest").distinct(), "wanted")
    needed = fetched(texts, wanted, "likely-texts")
    carried = stage(members.join(flagged, ["band", "digest"], "left_semi").join(needed, "digest"), "likely-members")

    def verify(table: pa.Table) -> pa.Table:
        digests, raw = table.column("digest").to_pylist(), table.column("text").cast(pa.binary()).to_pylist()
        sets: dict[int, np.ndarray] = {}

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.unique(shingles([raw[i]])[0])
            return sets[i]

        joined: dict[int, int] = {}

        def top(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        a, b = [], []
        for i, others, roots in alike(table, near):
            for j in others.tolist():
                if top(int(roots[i])) != top(int(roots[j])) and similar(of(i), of(j), least):
                    joined[top(int(roots[i]))] = top(int(roots[j]))
                    x, y = sorted((digests[i], digests[j]))
                    a.append(x)
                    b.append(y)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    meetings = dealt_in_blocks(carried, max(1, block // 4))
    return meetings.groupBy("band", "lo", "hi").applyInArrow(verify, "a binary, b binary").distinct()


def links(texts: DataFrame, bands: int = BANDS, rows: int = ROWS, least: float = LEAST, near: float = NEAR,
          block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) between digests of ``texts`` (digest, text), enough of them to connect every class."""
    nodes = stage(sketch(texts, bands, rows), "sketches")
    spread = nodes.select("digest", F.explode(F.array_distinct("bands")).alias("band"))
    buckets = spread.groupBy("band").agg(F.min("digest").alias("least"), F.count("*").alias("n")).where("n > 1")
    met = stage(spread.join(buckets.select("band", "least"), "band"), "buckets")
    star = met.where("digest != least").select(F.col("least").alias("a"), F.col("digest").alias("b")).distinct()
    found = stage(verified(star, texts, least), "links")
    before, step = None, 0
    while True:
        roots = components(found)
        named = met.join(roots, met["digest"] == roots["node"], "left").select(
            "band", "digest", F.coalesce("root", "digest").alias("root")
        )
        named = stage(named, "bucket-roots")
        mixed = named.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
        # two members: their star has compared them
        mixed = mixed.where("lo != hi and n > 2").select("band")
        open_members = stage(named.join(mixed, "band", "left_semi"), "open-members")
        now = open_members.count()
        if now == 0 or (before is not None and now > 0.8 * before):
            break
        # another star, to another member of each bucket that is still mixed, for those not connected with it
        before, step = now, step + 1
        centre = open_members.groupBy("band").agg(
            F.min(F.struct(F.xxhash64("digest", F.lit(step)).alias("h"), "digest", "root")).alias("c")
        ).select("band", F.col("c.digest").alias("centre"), F.col("c.root").alias("centre_root"))
        star = open_members.join(centre, "band").where("root != centre_root").select(
            F.least("centre", "digest").alias("a"), F.greatest("centre", "digest").alias("b")
        ).distinct()
        more = stage(verified(star, texts, least), "links")
        found = found.unionByName(more)
    if now == 0:
        return found
    members = stage(open_members.join(nodes.select("digest", "marks", "bands"), "digest"), "open-marks")
    return stage(found.unionByName(compared_in_blocks(members, texts, least, near, block)), "links")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def grouped(docs: DataFrame, key: str, text: str, **options) -> tuple[DataFrame, DataFrame]:
    """(key, digest) of every row, and (digest, root, n_links, least, copies) of every text with copies or links."""
    column = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("key"), digest_of(column).alias("digest"))
    edges = links(docs.select(digest_of(column).alias("digest"), F.coalesce(column, F.lit("")).alias("text")), **options)
    ends = edges.select(F.col("a").alias("digest")).unionByName(edges.select(F.col("b").alias("digest")))
    degree = ends.groupBy("digest").agg(F.count("*").alias("n_links"))
    owned = rows.groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    named = owned.join(components(edges).withColumnRenamed("node", "digest"), "digest", "left").join(degree, "digest", "left")
    named = named.where("copies > 1 or n_links is not null").select(
        "digest", F.coalesce("root", "digest").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "least", "copies"
    )
    return rows, stage(named, "grouped-texts")


def joined_to(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` (key, digest, ...) with the columns of ``table`` (digest, copies, ...), NULL where a digest is not in it.

    The texts with most copies, at most ``HOT``, are broadcast, so their copies stay where they are; the rows that
    found theirs go through the second join by keys of their own.
    """
    names = [c for c in table.columns if c not in ("digest", "copies")]
    # a bounded list: all other texts have fewer copies than one HOT-th of the rows
    hot = stage(table.where(F.col("copies") > COPIES).orderBy(F.desc("copies"), "digest").limit(HOT), "hot-texts")
    first = rows.join(F.broadcast(hot.select(F.col("digest").alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in names])),
                      F.col("digest") == F.col("_hot"), "left")
    own = F.concat(F.col("digest"), F.monotonically_increasing_id().cast("string").cast("binary"))
    first = first.withColumn("_digest", F.when(F.col("_hot").isNull(), F.col("digest")).otherwise(own))
    second = table.select(F.col("digest").alias("_of"), *[F.col(c).alias(f"_cold_{c}") for c in names])
    both = first.join(second, F.col("_digest") == F.col("_of"), "left")
    return both.select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in names])


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: key, class_id (least key in its class) and verified_links, the links verified at its text.

    Links inside a component that was already connected are not looked for: verified_links is not the number of links.
    """
    rows, named = grouped(docs, key, text, **options)
    least = named.groupBy("root").agg(F.min("least").alias("class_id"))
    table = stage(named.join(least, "root").select("digest", "copies", "class_id", "n_links", F.lit(True).alias("grouped")), "classes")
    return joined_to(rows, table).select(
        F.col("key").alias(key), F.when(F.col("grouped"), F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("verified_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class with all its columns: the one with the least key, then the least digest of the text.

    Rows equal in key and text count as one; which of them stays is not defined if other columns differ.
    """
    rows, named = grouped(docs, key, text, **options)
    best = named.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "digest")).alias("best"))
    keepers = stage(named.join(best, "root").select(
        "digest", "copies", (F.col("digest") == F.col("best.digest")).alias("keep"), "least", F.lit(True).alias("grouped")
    ), "keepers")
    twice = rows.groupBy("key", "digest").agg(F.count("*").alias("n")).where("n > 1").select("digest").distinct()
    repeated = stage(twice.join(keepers.where("keep").select("digest"), "digest", "left_semi"), "repeated")
    # the columns of docs go as one struct, so none can clash; texts without copies or links stay where they are
    column = lambda name: F.col(f"`{name}`")
    packed = docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(key).alias("key"), digest_of(column(text)).alias("digest"))
    others, maybe = split_by(packed, F.col("digest"), keepers, "digest")
    joined = joined_to(maybe, keepers).where(F.col("grouped").isNull() | (F.col("keep") & F.col("key").eqNullSafe(F.col("least"))))
    if repeated.isEmpty():
        return others.select("row.*").unionByName(joined.select("row.*"))
    single = joined.join(repeated, "digest", "left_anti").select("row.*")
    several = joined.join(repeated, "digest", "left_semi").dropDuplicates(["key", "digest"]).select("row.*")
    return others.select("row.*").unionByName(single).unionByName(several)
