"""Readers for landed files: mapped CSV, JSON series, nested JSON, event envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets


def read_csv_mapped(spark: SparkSession, path: str, mapping: Mapping[str, str], schema: str) -> DataFrame:
    """CSV with header and a declared schema, columns renamed to canonical names."""
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE").withColumnsRenamed(dict(mapping))


def tag_extract(df: DataFrame, asof: str, env: str | None = None, **tags: str) -> DataFrame:
    """Constant extract tags: data_extracao, ambiente and whatever else is given."""
    cols = {"data_extracao": F.lit(asof)}
    if env is not None:
        cols["ambiente"] = F.lit(env)
    return df.withColumns({**cols, **{k: F.lit(v) for k, v in tags.items()}})


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower-case names, blanks to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def read_series_json(spark: SparkSession, path: str, name: str, asof: str, env: str = "dev") -> DataFrame:
    """Landed ``[{"data": …, "valor": …}]`` payloads as a long series.

    The JSON reader splits the top-level array itself; rows without a date or with a value
    that is not a number are left out, so an empty or foreign payload gives no rows.
    """
    raw = spark.read.schema("data string, valor string").option("multiLine", True).json(path)
    rows = raw.select("data", F.expr("try_cast(valor as double)").alias("valor")).where(
        F.col("data").isNotNull() & F.col("valor").isNotNull()
    )
    return tag_extract(rows.withColumn("indicador", F.lit(name)), asof, env)


def read_nested_json(
    spark: SparkSession, path: str, name: str, asof: str, source: str = "world_bank", env: str = "dev"
) -> DataFrame:
    """Landed ``[meta, [{"date": …, "value": …}]]`` payloads, one file per request."""
    parts = spark.read.text(path, wholetext=True).select(
        F.get(F.from_json("value", "array<string>"), 1).alias("rows")
    )
    items = parts.select(
        F.explode(F.from_json("rows", "array<struct<date:string,value:double>>")).alias("r")
    )
    rows = items.select(F.col("r.date").alias("ano"), F.col("r.value").alias("valor")).where(
        F.col("valor").isNotNull()
    )
    return tag_extract(rows.withColumn("indicador", F.lit(name)), asof, env, fonte=source)


def decode_envelope(
    df: DataFrame, body: str = "Body", schema: str = presets.TRADE_SCHEMA, keep: Sequence[str] = ()
) -> DataFrame:
    """Binary body -> text -> JSON by a fixed schema -> columns. Works on batch and stream."""
    return df.select(*keep, F.from_json(F.col(body).cast("string"), schema).alias("t")).select(*keep, "t.*")


def validate_payload(
    df: DataFrame,
    payload: str,
    fields: Sequence[str] = presets.TRADE_FIELDS,
    number: str = "preco",
    integer: str = "quantidade",
    domain: tuple[str, Sequence[str]] = ("tipo", presets.TRADE_SIDES),
) -> DataFrame:
    """Add ``valido`` and ``motivo`` (first failing reason) for a JSON text column.

    The text is parsed once to a variant, so "12" and 12 are told apart without a UDF. The variant and the reason are
    made by generators of one row each: a filter on either does not make it again, as it would with a projection,
    whose expression the planner copies into every place that names it.
    """
    doc = F.try_parse_json(F.col(payload).cast("string"))
    side, allowed = domain

    def path(name):
        return F.try_variant_get(F.col("_doc"), f"$.{name}", "variant")

    def kind(name):
        return F.schema_of_variant(path(name))

    is_int = kind(integer) == "BIGINT"
    is_number = kind(number).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    label = F.try_variant_get(F.col("_doc"), f"$.{side}", "string")
    reason = F.when(F.col("_doc").isNull(), presets.REASON_JSON)
    for name in fields:
        reason = reason.when(path(name).isNull(), presets.REASON_MISSING + name)
    reason = (
        reason.when(~is_number, presets.REASON_PRICE)
        .when(~is_int, presets.REASON_QUANTITY)
        .when(
            ~F.coalesce(label.isin(*allowed), F.lit(False)),
            F.concat(F.lit(presets.REASON_SIDE), F.coalesce(label, F.lit("null"))),
        )
        .otherwise(presets.REASON_OK)
    )
    return (
        df.withColumn("_doc", F.explode(F.array(doc)))
        .withColumn("motivo", F.explode(F.array(reason)))
        .withColumn("valido", F.col("motivo") == presets.REASON_OK)
        .drop("_doc")
    )


def union_extracts(*frames: DataFrame | None) -> DataFrame:
    """Union by name of the extracts that arrived; a failed source is passed as None."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("no extract to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def stream_files(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 1
) -> DataFrame:
    """Incremental file source: each file is read once, ``max_files`` per trigger."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)
