"""Upsert, change classification, validity history (SCD type 2), erasure, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import presets
from ..sources.scratch import stage
from ..sources.tables import conform, write_partitioned
from .aggregates import table_counts
from .joins import guarded_join

NEW, CHANGED, SAME, GONE = "novo", "alterado", "igual", "ausente"
START, END, CURRENT = "data_inicio", "data_fim", "atual"
#: The days on which batches held a version, kept where late batches are to be taken.
SEEN = "dias_vistos"


class DuplicateKeyError(ValueError):
    pass


class LateBatchError(ValueError):
    pass


def _date(value) -> Column:
    return F.lit(str(value)).cast("date")


def _open_end() -> Column:
    return _date(presets.OPEN_END)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice in a batch (a target row would have two new values)."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    if not repeated.isEmpty():
        raise DuplicateKeyError(f"the batch holds a key of {list(keys)} more than once")


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    """NULL-safe equality of all ``cols`` between two aliases."""
    left = F.struct(*[F.col(f"{a}.{c}").alias(c) for c in cols])
    return left.eqNullSafe(F.struct(*[F.col(f"{b}.{c}").alias(c) for c in cols]))


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Classify every key: novo, alterado, igual or ausente. Attributes come from the newer side."""
    a = old.select(*keys, *compare, F.lit(True).alias("_in")).alias("a")
    b = new.select(*keys, *compare, F.lit(True).alias("_in")).alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    kind = (
        F.when(F.col("a._in").isNull(), NEW)
        .when(F.col("b._in").isNull(), GONE)
        .when(_same("a", "b", compare), SAME)
        .otherwise(CHANGED)
    )
    newer = F.col("b._in").isNotNull()
    return a.join(b, cond, "full").select(
        *[F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in keys],
        *[F.when(newer, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in compare],
        kind.alias("mudanca"),
    )


def upsert(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], check: bool = True
) -> DataFrame:
    """Source rows replace target rows of equal key, other source rows are added.

    Target rows without a match pass through one anti join; a small batch is broadcast, so
    the target is not shuffled. Columns new in either side are kept, NULL where unknown.
    """
    if check:
        require_unique(source, keys)
    if target is None:
        return source
    kept = guarded_join(target, source.select(*keys), list(keys), "left_anti")
    return conform(kept, source.schema).select(*target.columns, *[c for c in source.columns if c not in target.columns]).unionByName(
        source, allowMissingColumns=True
    )


def scd2_start(batch: DataFrame, asof) -> DataFrame:
    """First load: every row is current from ``asof``."""
    return batch.withColumns({START: _date(asof), END: _open_end(), CURRENT: F.lit(True)})


def scd2_apply(
    hist: DataFrame | None,
    batch: DataFrame,
    key: str,
    asof,
    mode: str = "changes",
    tracked: Sequence[str] | None = None,
    close_missing: bool = False,
    check: bool = True,
) -> DataFrame:
    """History after a batch; validity is half open, ``data_inicio <= day < data_fim``.

    ``changes`` opens a version only when a tracked attribute changed (NULL-safe);
    ``snapshot`` opens one for every row of the batch. A second run on the same day replaces
    that day's versions. Closed versions are passed through; current ones meet the batch in
    one full join by key.
    """
    if mode not in ("changes", "snapshot"):
        raise ValueError(f"unknown mode {mode}")
    if check:
        require_unique(batch, [key])
    if hist is None:
        return scd2_start(batch, asof)
    if check and not hist.where(F.col(CURRENT) & (F.col(START) > _date(asof))).isEmpty():
        raise LateBatchError(f"history already holds versions newer than {asof}; scd2_splice takes late days")
    attrs = [c for c in batch.columns if c != key]
    tracked = list(tracked or attrs)
    columns = [key, *attrs, START, END, CURRENT]
    today = _date(asof)
    closed = hist.where(~F.col(CURRENT)).select(*columns)
    a = hist.where(F.col(CURRENT)).select(*columns).alias("a")
    b = batch.select(key, *attrs).alias("b")

    def version(alias: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key),
            *[F.col(f"{alias}.{c}").alias(c) for c in attrs],
            start.alias(START),
            end.alias(END),
            F.lit(current).alias(CURRENT),
        )

    only_old, only_new = F.col(f"b.{key}").isNull(), F.col(f"a.{key}").isNull()
    keep = version("a", F.col(f"a.{START}"), F.col(f"a.{END}"), True)
    close = version("a", F.col(f"a.{START}"), today, False)
    fresh = version("b", today, _open_end(), True)
    same_day = F.col(f"a.{START}") == today
    unchanged = _same("a", "b", tracked) if mode == "changes" else F.lit(False)
    gone = F.array(F.when(same_day, keep).otherwise(close)) if close_missing else F.array(keep)
    rows = (
        F.when(only_new, F.array(fresh))
        .when(only_old, gone)
        .when(unchanged, F.array(keep))
        .when(same_day, F.array(fresh))
        .otherwise(F.array(close, fresh))
    )
    moved = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.inline(rows))
    return closed.unionByName(moved)


def scd2_splice(hist: DataFrame | None, batch: DataFrame, key: str, asof, check: bool = True) -> DataFrame:
    """History after the batch of any day, in whatever order the days arrive.

    Every version carries the days on which it was seen (``SEEN``), so a history tells what a day between two of its
    dates would have found. A late day cuts the version that covers it into the days before and after, the
    batch's row goes between, and neighbours of equal attributes are joined. A day that comes again replaces the row
    it had. All attributes are tracked, keys missing in a batch keep their state: after any order of the same
    batches the history equals ``scd2_from_snapshots`` of all of them.

    Only keys of the batch are rewritten, each from its own versions (no more than days); the others pass through an anti
    join. The splice is an expression over the versions of a key, so it stays in the engine.
    """
    if check:
        require_unique(batch, [key])
    attrs = [c for c in batch.columns if c != key]
    columns = [key, *attrs, START, END, CURRENT, SEEN]
    first = batch.withColumns({START: _date(asof), END: _open_end(), CURRENT: F.lit(True), SEEN: F.array(_date(asof))})
    if hist is None:
        return first.select(*columns)
    keys = batch.select(key)
    rest = guarded_join(hist.select(*columns), keys, [key], "left_anti")
    # one piece per version: the days it was seen, then its attributes; pieces of a key never share a day
    piece = lambda days, row: F.struct(days.alias("days"), row.alias("row"))
    old = guarded_join(hist, keys, [key], "left_semi").select(
        key, piece(F.col(SEEN), F.struct(*attrs)).alias("piece")
    ).groupBy(key).agg(F.collect_list("piece").alias("pieces"))
    new = batch.select(key, piece(F.array(_date(asof)), F.struct(*attrs)).alias("new"))
    day = _date(asof)

    def cut(p: Column) -> Column:
        before, after = F.filter(p["days"], lambda d: d < day), F.filter(p["days"], lambda d: d > day)
        return F.filter(F.array(piece(before, p["row"]), piece(after, p["row"])), lambda q: F.size(q["days"]) > 0)

    def joined(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.array(piece(F.concat(last["days"], p["days"]), last["row"]))
        same = (F.size(done) > 0) & F.get(done, F.size(done) - 1)["row"].eqNullSafe(p["row"])
        return F.when(same, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), longer)).otherwise(F.concat(done, F.array(p)))

    met = new.join(old, key, "left")
    around = F.flatten(F.transform(F.coalesce("pieces", F.filter(F.array("new"), lambda _: F.lit(False))), cut))
    # the first day decides the order of pieces, since they share no day
    in_order = F.array_sort(F.concat(around, F.array("new")), lambda a, b: F.when(a["days"][0] < b["days"][0], -1).otherwise(1))
    met = met.select(key, in_order.alias("pieces"))
    met = met.select(key, F.aggregate("pieces", F.filter("pieces", lambda _: F.lit(False)), joined).alias("pieces"))
    # there is a piece at least; the plain form would make all pieces twice more, to filter by their number first
    versions = met.select(key, "pieces", F.posexplode_outer("pieces").alias("at", "piece"))
    until = F.get("pieces", F.col("at") + 1)["days"][0]
    spliced = versions.select(
        key, *[F.col(f"piece.row.{c}").alias(c) for c in attrs], F.col("piece.days")[0].alias(START),
        F.coalesce(until, _open_end()).alias(END), until.isNull().alias(CURRENT), F.col("piece.days").alias(SEEN),
    )
    return rest.unionByName(spliced)


def scd2_from_snapshots(snapshots: DataFrame, key: str, tracked: Sequence[str], day: str) -> DataFrame:
    """Full rebuild from dated snapshots: runs of equal attributes become versions.

    One row per key and snapshot date, so a key's window is bounded by the number of dates.
    """
    w = Window.partitionBy(key).orderBy(day)
    row = F.struct(*tracked)
    starts = snapshots.select(key, *tracked, day).withColumn("_prev", F.lag(row).over(w)).where(
        F.col("_prev").isNull() | ~row.eqNullSafe(F.col("_prev"))
    )
    end = F.lead(day).over(w)
    return starts.select(
        key,
        *tracked,
        F.col(day).cast("date").alias(START),
        F.coalesce(end.cast("date"), _open_end()).alias(END),
        end.isNull().alias(CURRENT),
    )


def scd2_current(hist: DataFrame) -> DataFrame:
    return hist.where(F.col(CURRENT))


def scd2_at(hist: DataFrame, date) -> DataFrame:
    """Versions valid on a date."""
    return hist.where((F.col(START) <= _date(date)) & (_date(date) < F.col(END)))


def scd2_days(hist: DataFrame, asof, out: str = "dias_neste_perfil") -> DataFrame:
    """Days each version was in force, open ones counted up to ``asof``."""
    return hist.withColumn(out, F.datediff(F.least(F.col(END), _date(asof)), F.col(START)))


def scd2_history(hist: DataFrame, key: str, attr: str, asof, more_than: int = 0) -> DataFrame:
    """Per key: versions, first and current value, since when, last change, days in the current state."""
    out = hist.groupBy(key).agg(
        F.count("*").alias("versoes"),
        F.min_by(attr, START).alias("valor_inicial"),
        F.max(F.when(F.col(CURRENT), F.col(attr))).alias("valor_atual"),
        F.min(START).alias("desde"),
        F.max(START).alias("ultima_mudanca"),
        F.max(F.when(F.col(CURRENT), F.datediff(_date(asof), F.col(START)))).alias("dias_no_estado"),
    )
    return out.where(F.col("versoes") > more_than)


def scd2_transitions(hist: DataFrame, key: str, attr: str, since, until, fast_days: int = 30) -> DataFrame:
    """Moves between states that started in ``[since, until)``, with the fast ones among them."""
    w = Window.partitionBy(key).orderBy(START)
    moves = hist.select(
        F.lag(attr).over(w).alias("de"),
        F.col(attr).alias("para"),
        START,
        F.datediff(F.col(START), F.lag(START).over(w)).alias("_days"),
    ).where(
        F.col("_days").isNotNull()
        & ~F.col("de").eqNullSafe(F.col("para"))
        & (F.col(START) >= _date(since))
        & (F.col(START) < _date(until))
    )
    return moves.groupBy("de", "para").agg(
        F.count("*").alias("transicoes"),
        F.count(F.when(F.col("_days") < fast_days, 1)).alias("rapidas"),
    )


def erase_subject(
    tables: Mapping[str, DataFrame], key: str, keys: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Remove the subjects in ``keys`` from every table; also count the removed rows per table."""
    subjects = keys.select(key).distinct()
    remaining = {n: guarded_join(df, subjects, [key], "left_anti") for n, df in tables.items()}
    removed = {n: guarded_join(df, subjects, [key], "left_semi") for n, df in tables.items()}
    return remaining, table_counts(removed).withColumnRenamed("registros", "removidos")


def erase_in_place(spark: SparkSession, path: str, by: Sequence[str], key: str, keys: DataFrame) -> list[str]:
    """Remove the subjects in ``keys`` from a table partitioned by ``by``, rewriting only partitions that hold one of them.

    The files with a matching row name the partitions. Their remaining rows are written aside first, then take the place
    of the partition, by dynamic overwrite where rows remain and as an empty folder where none do; every other file
    stays as it is. A run that fails is repeated: rows are only ever replaced by a copy that is already whole. Returns the folders rewritten.
    """
    base = path.rstrip("/")
    table = spark.read.option("basePath", base).parquet(base)
    subjects = keys.select(key).distinct()
    # names of folders: as many as partitions that are touched
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1).alias("_folder")
    held = guarded_join(table.select(key, folder), subjects, [key], "left_semi").select("_folder").distinct()
    folders = sorted(r[0] for r in held.collect())
    if not folders:
        return []
    # the engine names files as URIs
    touched = spark.read.schema(table.schema).option("basePath", base).parquet(*map(unquote, folders))
    kept = stage(guarded_join(touched.select("*", folder), subjects, [key], "left_anti"), "kept")
    remain = {r[0] for r in kept.select("_folder").distinct().collect()}
    write_partitioned(kept.select(*table.columns), base, by)
    for emptied in sorted(set(folders) - remain):
        kept.select(*[c for c in table.columns if c not in by]).limit(0).write.mode("overwrite").parquet(unquote(emptied))
    return folders


def daily_states(hist: DataFrame, attr: str, since, until) -> DataFrame:
    """(dia, attr, clientes): how many keys were in each state on every day in ``[since, until)``.

    A version adds one to its state where it begins and takes one where it ends; running sums over the days give the
    counts. No row is made per key and day: per state there are as many rows as days.
    """
    first, last = F.greatest(F.col(START), _date(since)), F.least(F.col(END), _date(until))
    moves = hist.where((F.col(START) < _date(until)) & (F.col(END) > _date(since))).select(
        F.col(attr), F.explode(F.array(F.struct(first.alias("dia"), F.lit(1).alias("n")), F.struct(last.alias("dia"), F.lit(-1).alias("n")))).alias("m")
    )
    sums = moves.groupBy(attr, F.col("m.dia").alias("dia")).agg(F.sum("m.n").alias("n"))
    days = sums.groupBy(attr).agg(F.lit(None).alias("_none")).select(
        attr, F.explode(F.sequence(_date(since), F.date_sub(_date(until), 1))).alias("dia")
    )
    grid = days.select(attr, "dia", F.lit(0).cast("bigint").alias("n")).unionByName(sums.where(F.col("dia") < _date(until)))
    grid = grid.groupBy(attr, "dia").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(attr).orderBy("dia").rowsBetween(Window.unboundedPreceding, 0)
    return grid.select("dia", attr, F.sum("n").over(running).alias("clientes")).where(F.col("clientes") > 0)


def retain(df: DataFrame, date_col: str, days: int, asof) -> DataFrame:
    """Keep the last ``days`` up to ``asof``; on a partition column this only prunes folders."""
    oldest = dt.date.fromisoformat(str(asof)) - dt.timedelta(days=days)
    return df.where(F.col(date_col) >= _date(oldest))
