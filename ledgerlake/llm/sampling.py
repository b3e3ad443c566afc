"""Bounded, repeatable samples of labelled rows, and classifiers fitted on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import fields

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, release

#: A sample holds at most so many bytes of text of each label.
LABEL_BYTES = 24 << 20


def fitted_on_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, per_label: int, sample_bytes: int,
                     fit: Callable, label_bytes: int = LABEL_BYTES):
    """``fit(texts, labels, share)`` on a sample; ``share`` is that of label 1 among all labelled keys (0.5 without any).

    The keys are chosen from the labels alone: of each label the ``per_label`` keys with the smallest hash. That list
    is bounded, so it is broadcast to ``docs``, and no text travels but the chosen ones, of at most
    ``sample_bytes`` each. If rows of ``docs`` repeat a key, ``per_label`` bounds the rows as well. NULL keys
    and labels are left out.

    The sample goes to one task, which takes texts in order of the hash while ``label_bytes`` of their label are not
    used up, fits there, and returns the fields of the model, a dataclass.
    """
    marks = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").alias("_label"))
    marks = marks.where("_key is not null and _label in (0, 1)").distinct()
    counts = dict(marks.groupBy("_label").count().collect())  # two rows at most
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    order = F.xxhash64(F.col("_key").cast("string"), F.lit(8))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    rows = rows.where(F.octet_length("_text") <= sample_bytes)
    sample = None
    for value in (0, 1):
        keys = marks.where(F.col("_label") == value).orderBy(order, "_key").limit(per_label)
        chosen = rows.join(F.broadcast(keys), "_key").orderBy(order, "_key", "_text").limit(per_label)
        chosen = chosen.select("_label", order.alias("_order"), "_key", "_text")
        sample = chosen if sample is None else sample.union(chosen)
    sample = sample.repartition(1).sortWithinPartitions("_label", "_order", "_key", "_text").select("_label", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys, room = [], [], {0: label_bytes, 1: label_bytes}
        batch = None
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                room[y] -= len(text)
                if room[y] >= 0:
                    texts.append(text)
                    ys.append(y)
        batch = None
        release()  # what tasks before this one left
        model = fit(texts, ys, share)
        values = [getattr(model, f.name) for f in fields(model)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(values)], pa.binary())], names=["model"])

    made = arrow_map(sample, run, "model binary").collect()
    # no task runs without a row
    model = fit([], [], share)
    return type(model)(*pickle.loads(made[0][0])) if made else model
