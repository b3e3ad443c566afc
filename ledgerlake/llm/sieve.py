"""Bloom filters as bounded tables: rows that cannot match a key set are told apart before they would travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stage

#: 2^18 words of 64 bits: safe to broadcast whatever the number of keys.
WORDS = 18


def _marked(df: DataFrame, key: Column, words: int) -> DataFrame:
    """``df`` with the word (``_word``) that ``key`` has in the filter and its two bits there (``_bits``)."""
    hashed = df.withColumn("_hash", F.xxhash64(key, F.lit(1)))
    bits = F.expr("shiftleft(1L, cast(_hash & 63 as int)) | shiftleft(1L, cast(shiftright(_hash, 6) & 63 as int))")
    return hashed.withColumns({"_word": F.pmod(F.shiftright("_hash", 12), F.lit(1 << words)), "_bits": bits}).drop("_hash")


def sieve_of(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """(word, mask): the filter over the column ``key``; both bits of a key are in one word, so one look finds them."""
    marked = _marked(keys.select(F.col(f"`{key}`").alias("_key")), F.col("_key"), words)
    return stage(marked.groupBy(F.col("_word").alias("word")).agg(F.bit_or("_bits").alias("mask")), "sieve")


def split_by(df: DataFrame, key: Column, keys: DataFrame, of: str, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(others, maybe): rows whose ``key`` is certainly not among ``keys.of``, and all rows that may match.

    Few of the second kind do not match; with many more keys than bits all rows become such, and nothing else changes.
    """
    sieve = sieve_of(keys, of, words).select(F.col("word").alias("_of"), F.col("mask").alias("_mask"))
    marked = _marked(df, key, words).join(F.broadcast(sieve), F.col("_word") == F.col("_of"), "left")
    hit = F.coalesce(F.col("_mask").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.where(~hit).select(*columns), marked.where(hit).select(*columns)
