"""The velocity rule on a stream: events of a key in a trailing span, counted as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .trades import with_watermark

#: Groups that integer and text keys are dealt to. A stream keeps the number its checkpoint began with.
GROUPS = 512


def state_schema(kind: T.DataType) -> T.StructType:
    """The keys of a group; per key and distinct time that may still count: place of the key, microseconds, events.

    The last three are arrays of 64-bit integers, kept as their bytes.
    """
    fields = [T.StructField(name, T.BinaryType()) for name in ("places", "times", "events")]
    return T.StructType([T.StructField("keys", T.ArrayType(kind)), *fields])


def merged(places: np.ndarray, times: np.ndarray, events: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry per key and distinct time, ascending by both, with its events; then the entry each given one went to."""
    order = np.lexsort((times, places))
    places, times = places[order], times[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (places[1:] != places[:-1]) | (times[1:] != times[:-1])
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = np.cumsum(first) - 1
    return places[first], times[first], np.add.reduceat(events[order], np.flatnonzero(first)), entry


def counted(places: np.ndarray, times: np.ndarray, events: np.ndarray, span: int) -> np.ndarray:
    """Events of its key in the trailing span of every entry, as ``merged`` gives them."""
    # moments are numbered, so that key and moment make one number that cannot overflow
    moments, number = np.unique(np.concatenate([times, times - span]), return_inverse=True)
    base, n = places * len(moments), len(times)
    total = np.concatenate([[0], np.cumsum(events)])
    return total[1:] - total[np.searchsorted(base + number[:n], base + number[n:], side="left")]


def stream_velocity(
    df: DataFrame, key: str, ts: str, span_seconds: int, n: int, delay: str = "10 minutes",
    count: str = "eventos_janela", out: str = "alerta_velocidade", groups: int = GROUPS,
) -> DataFrame:
    """Every event with the events of its key in the trailing ``span_seconds`` (inclusive), and whether they reach ``n``.

    An event counts all that have arrived by the end of its micro-batch, so with times in order across batches the
    result is that of ``velocity_flag``. An event that comes late, but before the watermark, gets its full count; what was
    given out before it is not changed. Events behind the watermark are dropped by the engine.

    Integer and text keys are dealt to ``groups`` groups by hash, other keys are a group each; one call counts all keys of a
    group together, since a call costs far more than the few events of one key. The state of a group holds the times of its
    keys within span and delay, one entry per key and distinct time, and is removed by an event-time timer when the
    watermark has passed the span of its last event. Events without key or time pass with a NULL count and no flag.
    """
    columns = df.columns
    kind = df.schema[key].dataType
    dealt = isinstance(kind, T.IntegralType) or kind == T.StringType()
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    apart = df.where(~known).select(*columns, F.lit(None).cast("bigint").alias(count), F.lit(False).alias(out))
    rows = with_watermark(df.where(known).withColumn("_at", F.col(ts).cast("timestamp")), "_at", delay)
    rows = rows.withColumn("_us", F.unix_micros("_at"))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)) if dealt else F.col(key))
    span = span_seconds * 1_000_000
    schema = T.StructType([*df.schema.fields, T.StructField(count, T.LongType()), T.StructField(out, T.BooleanType())])

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        batch = pd.concat(list(frames), ignore_index=True)
        at = batch["_us"].to_numpy(np.int64)
        ids = batch[key] if dealt else pd.Series(np.zeros(len(at), dtype=np.int64))
        held, *entries = state.get if state.exists else ([], b"", b"", b"")
        places, times, events = (np.frombuffer(x, dtype=np.int64) for x in entries)
        # keys of the state come first, so their places stay
        codes, keys = pd.factorize(pd.concat([pd.Series(held, dtype=ids.dtype), ids], ignore_index=True))
        old, new = len(places), codes[len(held):].astype(np.int64)
        places, times, events, entry = merged(
            np.concatenate([places, new]), np.concatenate([times, at]), np.concatenate([events, np.ones_like(at)])
        )
        batch[count] = counted(places, times, events, span)[entry[old:]]
        batch[out] = batch[count] >= n
        # whatever still comes is not before the watermark, so older times cannot count again
        kept = times >= state.getCurrentWatermarkMs() * 1000 - span
        live, places_kept = np.unique(places[kept], return_inverse=True)
        state.update((keys[live].tolist(), places_kept.astype(np.int64).tobytes(), times[kept].tobytes(), events[kept].tobytes()))
        state.setTimeoutTimestamp(int(max(int(times.max()) + span, state.getCurrentWatermarkMs() * 1000) // 1000) + 1)
        yield batch[[*columns, count, out]]

    grouped = rows.groupBy("_group")
    flagged = grouped.applyInPandasWithState(
        step, schema, state_schema(kind if dealt else T.LongType()), "append", GroupStateTimeout.EventTimeTimeout
    )
    return flagged.unionByName(apart)
