"""Window analytics that do not put a whole key on one task.

Two devices are used. Statistics of a whole key are aggregated and joined back. Trailing
frames are computed per (key, time slot): a row is copied into the following slot when its
frame reaches there, and only the rows that own the slot are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import presets
from ..functions import SUM_TYPE, dec_round, flag, safe_div
from ..sources.scratch import ensure_checkpoint_dir, stage
from .joins import guarded_join


class Trailing(NamedTuple):
    """Output column = fn(col) over the ``days`` before a row's date and that date."""

    out: str
    fn: str
    col: str
    days: int
    digits: int | None = None


_FNS = {
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def _slotted(df: DataFrame, position: Column, span: int, width: int) -> DataFrame:
    """Copy each row into its own slot and, when a frame of ``span`` reaches it, the next one."""
    own = F.floor(position / width)
    slots = F.array_distinct(F.array(own, F.floor((position + span) / width)))
    return df.withColumn("_own", own).withColumn("_slot", F.explode(slots))


def _owned(df: DataFrame) -> DataFrame:
    return df.where(F.col("_slot").eqNullSafe(F.col("_own"))).drop("_slot", "_own")


def trailing(
    df: DataFrame, day: str, specs: Sequence[Trailing], keys: Sequence[str] = (), slot_days: int | None = None
) -> DataFrame:
    """Trailing date-range aggregates, frame ``[day - n, day]`` inclusive.

    Meant for series with one row per (key, day): a slot then holds at most
    ``slot_days + longest frame`` rows, whatever key it belongs to.
    """
    span = max(s.days for s in specs)
    width = slot_days or max(4 * span, 366)
    pos = F.unix_date(day)
    base = Window.partitionBy(*keys, "_slot").orderBy(pos)

    def column(s: Trailing) -> Column:
        frame = base.rangeBetween(-s.days, 0)
        if s.fn in ("sum", "avg"):  # exact decimal sums, so the frame's order does not matter
            out = F.sum(F.col(s.col).cast(SUM_TYPE)).over(frame).cast("double")
            out = out if s.fn == "sum" else F.try_divide(out, F.count(s.col).over(frame))
        else:
            out = _FNS[s.fn](s.col).over(frame)
        return out if s.digits is None else dec_round(out, s.digits)

    return _owned(_slotted(df, pos, span, width).withColumns({s.out: column(s) for s in specs}))


def rolling_corr(
    df: DataFrame,
    key: str,
    day: str,
    x: str,
    y: str,
    days: int = 90,
    out: str = "correlacao",
    digits: int = 4,
    slot_days: int | None = None,
) -> DataFrame:
    """Pearson correlation over the trailing ``days``, on rows where both values are known.

    NULL where one of the two does not vary in the frame.
    """
    width = slot_days or max(4 * days, 366)
    pos = F.unix_date(day)
    w = Window.partitionBy(key, "_slot").orderBy(pos).rangeBetween(-days, 0)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = df.withColumn("_x", F.when(both, F.col(x))).withColumn("_y", F.when(both, F.col(y)))
    corr = safe_div(
        F.covar_pop("_x", "_y").over(w), F.stddev_pop("_x").over(w) * F.stddev_pop("_y").over(w)
    )
    return _owned(_slotted(pairs, pos, days, width).withColumn(out, dec_round(corr, digits))).drop("_x", "_y")


def key_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample deviation of a key: one row per key, combined map-side."""
    return df.groupBy(key).agg(F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio"))


def zscore(df: DataFrame, key: str, value: str, k: float = 2.0, names=("zscore", "anomalia", "tipo_anomalia")):
    """z-score within the key, flag |z| > k and label.

    The per-key statistics are written out, so their size is known when they are joined back:
    few keys are broadcast and the rows are not shuffled; many keys are joined by shuffle.
    """
    z, is_odd, label = names
    stats = stage(key_stats(df, key, value), "zscore").withColumnRenamed("media", "_m").withColumnRenamed("desvio", "_s")
    scored = guarded_join(df, stats, key).withColumn(
        z, dec_round(safe_div(F.col(value) - F.col("_m"), F.col("_s")), 4)
    )
    return label_z(scored.drop("_m", "_s"), z, k, is_odd, label)


def label_z(df: DataFrame, z: str, k: float, is_odd: str, label: str) -> DataFrame:
    return df.withColumns({
        is_odd: flag(F.abs(z) > k),
        label: F.when(F.col(z) > k, presets.ANOMALY_UP)
        .when(F.col(z) < -k, presets.ANOMALY_DOWN)
        .otherwise(presets.NORMAL),
    })


def pct_change(
    df: DataFrame, keys: Sequence[str], order: str, col: str, out: str, digits: int = 4, diff: bool = False
) -> DataFrame:
    """Change against the previous period of the key, in percent (or as a difference).

    For series with one row per key and period. The first period has no change (NULL).
    """
    prev = F.lag(col).over(Window.partitionBy(*keys).orderBy(order))
    change = F.col(col) - F.col("_prev")
    value = change if diff else safe_div(change, F.col("_prev")) * 100
    return df.withColumn("_prev", prev).withColumn(out, dec_round(value, digits)).drop("_prev")


def rank_by(df: DataFrame, order: Sequence[Column], out: str = "rank_volume") -> DataFrame:
    """Positions 1..n in a grouped result (one row per symbol, say)."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def rank_rows(df: DataFrame, order: Sequence[Column], out: str = "posicao", parts: int | None = None) -> DataFrame:
    """Positions 1..n over any number of rows; ``order`` must be total.

    Rows are range-partitioned by the order, sorted there, and fixed with their place by a checkpoint: one shuffle.
    A row's position is its place within the partition plus the rows of the partitions before it. Only the counts
    per partition (as many rows as partitions) are brought together.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition in its upper and the place in the partition in its lower 33 bits
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = placed.select(
        *df.columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")
    ).checkpoint()
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row per range partition, hence the broadcast
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_place") + 1 + F.col("_before"))
        .drop("_part", "_place", "_before")
    )


def velocity_flag(
    df: DataFrame,
    key: str,
    ts: str,
    span_seconds: int,
    n: int,
    count: str = "eventos_janela",
    out: str = "alerta_velocidade",
    slot_seconds: int = 60,
) -> DataFrame:
    """Events of the key in the trailing ``span_seconds`` (inclusive) and flag count >= n.

    Every event arrives (+1) and expires just after the span (-1); the running sum is the
    number of events in the trailing span. It is taken per (key, short time slot) on top of
    the balance of the earlier slots, so a key with very many events is spread over its slots
    and no frame is ever recounted. Events without key or time stay, with a NULL count and no flag.
    """
    unknown = F.col(key).isNull() | F.col(ts).isNull()
    apart = df.where(unknown).select("*", F.lit(None).cast("bigint").alias(count), F.lit(False).alias(out))
    df = df.where(~unknown)
    span = span_seconds * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    arrive = F.struct(us.alias("at"), F.lit(1).alias("d"))
    expire = F.struct((us + span + 1).alias("at"), F.lit(-1).alias("d"))
    slot = F.floor(F.col("_m.at") / (slot_seconds * 1_000_000))
    moves = df.withColumn("_m", F.explode(F.array(arrive, expire))).withColumn("_slot", slot)

    # few rows: one per (key, slot), summed before the shuffle
    totals = moves.groupBy(key, "_slot").agg(F.sum("_m.d").alias("_t"))
    earlier = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    balance = totals.select(key, "_slot", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_b"))

    # the expiry half carries no payload through the shuffle
    payload = [F.when(F.col("_m.d") > 0, F.col(c)).alias(c) for c in df.columns if c != key]
    lean = moves.select(key, *payload, "_m", "_slot")
    inside = Window.partitionBy(key, "_slot").orderBy("_m.at").rangeBetween(Window.unboundedPreceding, 0)
    running = lean.join(balance, [key, "_slot"]).withColumn(count, F.sum("_m.d").over(inside) + F.col("_b"))
    counted = running.where(F.col("_m.d") > 0).select(*df.columns, count, (F.col(count) >= n).alias(out))
    return counted.unionByName(apart)


def sessionize(df: DataFrame, key: str, ts: str, gap_seconds: int, value: str | None = None) -> DataFrame:
    """Sessions of a key: a pause longer than the gap starts a new one; end = last event + gap.

    Events are first combined into cells one gap wide. Two events of one cell are always in
    the same session, so only cells are ordered per key: at most (time span / gap) of them.
    """
    gap = gap_seconds * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    aggs = [F.min("_us").alias("_lo"), F.max("_us").alias("_hi"), F.count("*").alias("_n")]
    sums = []
    if value is not None:
        aggs.append(F.sum(F.col(value).cast(SUM_TYPE)).alias("_v"))
        sums = [F.round(F.sum("_v"), 2).cast("double").alias("valor_total")]
    cells = df.withColumn("_us", us).groupBy(key, F.floor(F.col("_us") / gap).alias("_cell")).agg(*aggs)
    w = Window.partitionBy(key).orderBy("_lo")
    starts = F.coalesce((F.col("_lo") - F.lag("_hi").over(w) > gap).cast("int"), F.lit(1))
    numbered = cells.withColumn("_new", starts).withColumn("_sid", F.sum("_new").over(w))
    return (
        numbered.groupBy(key, "_sid")
        .agg(F.min("_lo").alias("_a"), F.max("_hi").alias("_b"), F.sum("_n").alias("eventos"), *sums)
        .select(
            key,
            F.timestamp_micros("_a").alias("inicio"),
            F.timestamp_micros(F.col("_b") + gap).alias("fim"),
            "eventos",
            *(["valor_total"] if value is not None else []),
        )
    )


def sliding_agg(
    df: DataFrame, key: str, ts: str, window_seconds: int, slide_seconds: int, value: str
) -> DataFrame:
    """Count and sum per key over sliding windows.

    Rows are combined into panes one slide wide before any copy is made, so each event is
    aggregated once instead of once per window it falls into.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    slide = slide_seconds * 1_000_000
    panes_per_window = window_seconds // slide_seconds
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    panes = df.groupBy(key, F.floor(us / slide).alias("_pane")).agg(
        F.count("*").alias("_n"), F.sum(F.col(value).cast(SUM_TYPE)).alias("_v")
    )
    spread = panes.withColumn(
        "_w", F.explode(F.sequence(F.col("_pane") - (panes_per_window - 1), F.col("_pane")))
    )
    return (
        spread.groupBy(key, "_w")
        .agg(F.sum("_n").alias("eventos"), F.round(F.sum("_v"), 2).cast("double").alias("valor_total"))
        .select(
            key,
            F.timestamp_micros(F.col("_w") * slide).alias("inicio"),
            F.timestamp_micros((F.col("_w") + panes_per_window) * slide).alias("fim"),
            "eventos",
            "valor_total",
        )
    )


