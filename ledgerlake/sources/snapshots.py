"""Tables kept as whole snapshots, one ``ver=`` partition per version.

A version holds each key once, so per key there are at most as many rows as versions kept:
the windows by key below have that bound whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import path_exists

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
INSERT, PREIMAGE, POSTIMAGE, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def write_snapshot(df: DataFrame, path: str, ver) -> str:
    """Write one version folder; a committed version is never touched.

    Committed means that the folder has its success marker. What a failed write left behind has none and is
    replaced, so the number it took stays free.
    """
    dest = f"{path.rstrip('/')}/ver={ver}"
    if path_exists(df.sparkSession, f"{dest}/_SUCCESS"):
        raise FileExistsError(f"version {dest} already exists")
    df.write.mode("overwrite").parquet(dest)
    return dest


def list_versions(spark: SparkSession, path: str) -> list[str]:
    """Committed version values (those with a success marker), ascending."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = []
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/ver=*/_SUCCESS")):
        found.append(status.getPath().getParent().getName().split("=", 1)[1])
    return sorted(found, key=lambda v: (0, int(v), v) if v.isdigit() else (1, 0, v))


def read_snapshots(spark: SparkSession, path: str, versions: Sequence | None = None) -> DataFrame:
    """All (or the named) committed versions with ``ver`` as a column."""
    base = path.rstrip("/")
    chosen = versions if versions is not None else list_versions(spark, path)
    if not chosen:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.option("basePath", base).parquet(*[f"{base}/ver={v}" for v in chosen])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Newest committed version only; the other folders are not listed or opened."""
    return read_snapshots(spark, path, list_versions(spark, path)[-1:])


def current_snapshot(df: DataFrame, ver: str = "ver") -> DataFrame:
    """Rows of the newest version. A partition column makes this a pruned scan."""
    return df.where(F.col(ver) == df.agg(F.max(ver)).scalar())


def snapshot_asof(df: DataFrame, ver: str, at) -> DataFrame:
    """Rows of the newest version not after ``at``."""
    newest = df.where(F.col(ver) <= F.lit(at)).agg(F.max(ver))
    return df.where(F.col(ver) == newest.scalar())


def _versions(df: DataFrame, ver: str) -> list:
    # version values only: as many as there are version folders
    return sorted(r[0] for r in df.select(ver).distinct().collect())


def changes_since(
    snapshots: DataFrame,
    keys: Sequence[str],
    ver: str = "ver",
    start=None,
    types: Sequence[str] = (INSERT,),
    keep_meta: bool = False,
) -> DataFrame:
    """Row changes committed after version ``start`` (exclusive; None reads all).

    Consecutive versions are compared in one shuffle by key, without a join per version pair.
    """
    versions = _versions(snapshots, ver)
    if start is not None:
        earlier = [v for v in versions if v <= start]
        if earlier:  # the version before the first change is needed to compare with
            snapshots = snapshots.where(F.col(ver) >= F.lit(earlier[-1]))
            versions = [v for v in versions if v >= earlier[-1]]
    attrs = [c for c in snapshots.columns if c not in keys and c != ver]
    vtype = snapshots.schema[ver].dataType
    if len(versions) > 1:
        follows = F.create_map(*[F.lit(v) for pair in zip(versions, versions[1:]) for v in pair])
        next_of = follows[F.col(ver)]
        prev_map = F.create_map(*[F.lit(v) for pair in zip(versions[1:], versions) for v in pair])
        prev_of = prev_map[F.col(ver)]
    else:
        next_of = prev_of = F.lit(None)
    w = Window.partitionBy(*keys).orderBy(ver)
    row = F.struct(*[F.col(c) for c in attrs]) if attrs else F.struct(F.lit(1).alias("_"))
    seen = (
        snapshots.withColumn("_row", row)
        .withColumn("_pv", F.lag(ver).over(w))
        .withColumn("_prow", F.lag("_row").over(w))
        .withColumn("_nv", F.lead(ver).over(w))
        .withColumn("_prev", prev_of.cast(vtype))
        .withColumn("_next", next_of.cast(vtype))
    )
    kept_on = F.coalesce(F.col("_pv") == F.col("_prev"), F.lit(False))
    changed = kept_on & ~F.col("_row").eqNullSafe(F.col("_prow"))
    gone = F.col("_next").isNotNull() & ~F.coalesce(F.col("_nv") == F.col("_next"), F.lit(False))

    def event(kind: str, version, payload):
        return F.struct(F.lit(kind).alias("kind"), version.alias("at"), payload.alias("row"))

    possible = {
        INSERT: F.when(~kept_on, event(INSERT, F.col(ver), F.col("_row"))),
        PREIMAGE: F.when(changed, event(PREIMAGE, F.col(ver), F.col("_prow"))),
        POSTIMAGE: F.when(changed, event(POSTIMAGE, F.col(ver), F.col("_row"))),
        DELETE: F.when(gone, event(DELETE, F.col("_next"), F.col("_row"))),
    }
    events = F.filter(F.array(*[possible[t] for t in types]), lambda e: e.isNotNull())
    out = seen.select(*keys, F.explode(events).alias("_e"))
    if start is not None:
        out = out.where(F.col("_e.at") > F.lit(start))
    meta = [F.col("_e.kind").alias(CHANGE_TYPE), F.col("_e.at").alias(COMMIT_VERSION)] if keep_meta else []
    return out.select(*keys, *[F.col(f"_e.row.{c}").alias(c) for c in attrs], *meta)


def snapshot_history(
    snapshots: DataFrame, keys: Sequence[str], ver: str = "ver", limit: int | None = None
) -> DataFrame:
    """Versions newest first with row count and inserted / updated / deleted counts."""
    rows = snapshots.groupBy(ver).agg(F.count("*").alias("registros"))
    all_changes = changes_since(
        snapshots, keys, ver, types=(INSERT, POSTIMAGE, DELETE), keep_meta=True
    )
    kinds = {"inseridos": INSERT, "alterados": POSTIMAGE, "removidos": DELETE}
    changes = all_changes.groupBy(F.col(COMMIT_VERSION).alias(ver)).agg(
        *[F.count(F.when(F.col(CHANGE_TYPE) == kind, 1)).alias(name) for name, kind in kinds.items()]
    )
    out = rows.join(changes, ver, "left").fillna(0, list(kinds)).orderBy(F.desc(ver))
    return out.limit(limit) if limit else out


def high_water(df: DataFrame, version: str, where=None, default=0) -> DataFrame:
    """One row: the highest version seen, or ``default``."""
    df = df.where(where) if where is not None else df
    return df.agg(F.coalesce(F.max(version), F.lit(default)).alias("ultima_versao"))


def consume_changes(
    snapshots: DataFrame,
    offsets: DataFrame,
    consumer: str,
    fn: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    ver: str = "ver",
    types: Sequence[str] = (INSERT,),
    keep_meta: bool = False,
) -> tuple[DataFrame | None, DataFrame]:
    """Hand the changes since this consumer's last version to ``fn``: inserts, or the kinds in ``types``.

    ``keep_meta`` adds the kind and the version of each change. ``offsets`` is (consumidor, versao). Returns fn's result (None when nothing is new) and
    the offsets to store once the result is written. A consumer without offset reads it all.
    """
    last = offsets.where(F.col("consumidor") == consumer).agg(F.max("versao")).first()[0]
    newest = snapshots.agg(F.max(ver)).first()[0]
    if newest is None or (last is not None and newest <= last):
        return None, offsets
    result = fn(changes_since(snapshots, keys, ver, start=last, types=types, keep_meta=keep_meta))
    moved = offsets.where(F.col("consumidor") != consumer).unionByName(
        snapshots.sparkSession.range(1).select(
            F.lit(consumer).alias("consumidor"),
            F.lit(newest).cast(offsets.schema["versao"].dataType).alias("versao"),
        )
    )
    return result, moved


def rewrite_clustered(df: DataFrame, path: str, cols: Sequence[str], n_files: int) -> None:
    """Compact into ``n_files`` files, range-clustered by ``cols``.

    A row hash follows the cluster columns in the range key, so one value that holds a large
    part of the rows is cut over several files too.
    """
    spread = "_spread"
    (
        df.withColumn(spread, F.xxhash64(*df.columns))
        .repartitionByRange(n_files, *cols, spread)
        .sortWithinPartitions(*cols)
        .drop(spread)
        .write.mode("errorifexists")
        .parquet(path)
    )
