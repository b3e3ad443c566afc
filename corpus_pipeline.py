"""A training corpus from raw documents: filter, filter, deduplicate, decontaminate, tokenize.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; the tables ``labels`` and
``benchmark`` come from ``sf_dir``. All stages but the last return the columns of ``docs``; the last adds ``ids`` and
``lossless``. ``run`` writes every stage's rows to the session's shared folder and reads them again, so a lost
executor never costs more than one stage.

Any column may be NULL. A NULL or empty text is scored as such by both classifiers, is one class with other empty
texts, contains no benchmark passage and has no ids. Rows without id are kept or dropped by their text. Equal rows are one
class, so one stays. Empty tables give empty stages; without labels no row is dropped by a classifier whose share
of label 1 says keep. Extra columns go through every stage; a column that a stage needs for itself (``RESERVED``)
is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import compression, decontaminate, pieces, probminhash, toxicity
from ledgerlake.llm.base import free_shared
from ledgerlake.llm.queries import PIECE_MODEL, held_out_in, table
from ledgerlake.sources.scratch import stage

#: A document stays if its quality score reaches this, and if its toxicity score stays below.
LEAST_QUALITY = 0.3
MOST_TOXIC = 0.5
#: Names for what a stage adds for itself; no document column may be called so.
SCORE = "_stage_score"
RESERVED = (SCORE, "ids", "lossless")


def _learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.where(~held_out_in(labels))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = compression.train(docs, _learnable(spark, sf_dir), "quality")
    return compression.score(docs, model, out=SCORE).where(F.col(SCORE) >= LEAST_QUALITY).drop(SCORE)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, _learnable(spark, sf_dir), "toxic")
    return toxicity.score(docs, model, out=SCORE, spans=None).where(F.col(SCORE) < MOST_TOXIC).drop(SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.add_ids(docs, pieces.load(PIECE_MODEL))


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("sentencepiece", tokenized),
]

#: Trained classifiers and seeded signatures are beyond SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    taken = sorted({c.lower() for c in docs.columns} & set(RESERVED))
    if taken:
        raise ValueError(f"documents have columns of the pipeline's own names: {taken}")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        free_shared()  # the stage's rows are written, so its model is not asked for again
    return docs
