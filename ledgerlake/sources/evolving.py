"""JSON lines whose fields change: a stored schema, and a column that rescues what does not fit it.

A field that the schema lacks, a value that is not of its type and a line that is no JSON are kept as JSON text in
``RESCUED``. Between two runs of a stream ``evolve`` takes new fields into the schema. The stream reads lines of text, so its checkpoint
does not hang on the schema, and readers fill new columns of older rows from what was rescued.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from . import snapshots

RESCUED = "_resgatado"
#: The name under which a line that is no JSON object is rescued.
LINE = "_linha"
_MAP = "map<string,string>"
_KINDS = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def store_schema(spark: SparkSession, path: str, schema: T.StructType | str) -> int:
    """Store the next version of a schema; returns its number."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = snapshots.list_versions(spark, path)
    ver = int(known[-1]) + 1 if known else 1
    snapshots.write_snapshot(spark.range(1).select(F.lit(fields.json()).alias("esquema")), path, ver)
    return ver


def stored_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(snapshots.read_current(spark, path).first()["esquema"]))


def _unfit(name: Column, value: Column, typed: dict[str, Column]) -> Column:
    """Whether a field has no column, or a value that its column could not take."""
    out = ~name.isin(list(typed)) if typed else F.lit(True)
    for field, column in typed.items():
        out = out | ((name == field) & value.isNotNull() & column.isNull())
    return out


def parse_rescuing(lines: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """The columns of ``schema`` and ``RESCUED``, one row per line. Only the lines are read."""
    rows = lines.select(
        F.col(col).alias("_text"), F.from_json(col, schema).alias("_typed"), F.from_json(col, _MAP).alias("_all")
    )
    typed = {f.name: F.col("_typed")[f.name] for f in schema.fields}
    rest = F.map_filter("_all", lambda k, v: _unfit(k, v, typed))
    broken = F.to_json(F.create_map(F.lit(LINE), F.col("_text")))
    rescued = F.when(F.col("_all").isNull(), F.when(F.length(F.trim("_text")) > 0, broken)).when(F.size(rest) > 0, F.to_json(rest))
    return rows.select(*[c.alias(n) for n, c in typed.items()], rescued.alias(RESCUED))


def rescuing_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema_path: str, max_files: int = 1000, trigger: str | None = None
) -> StreamingQuery:
    """Lines that arrived -> rows of the stored schema -> append. A run keeps the schema it began with."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(source)
    writer = parse_rescuing(lines, stored_schema(spark, schema_path)).writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start(target)


def evolve(spark: SparkSession, target: str, schema_path: str) -> list[str]:
    """Take new fields among the rescued values into the schema, as whole numbers, numbers or text; returns their names."""
    schema = stored_schema(spark, schema_path)
    rescued = spark.read.schema(f"{RESCUED} string").parquet(target).where(F.col(RESCUED).isNotNull())
    values = rescued.select(F.explode(F.from_json(RESCUED, _MAP)).alias("name", "value"))
    values = values.where(~F.col("name").isin([*schema.names, LINE, RESCUED]))
    # one row per new field
    found = values.groupBy("name").agg(
        F.count("value").alias("n"),
        F.count(F.expr("try_cast(value as bigint)")).alias("whole"), F.count(F.expr("try_cast(value as double)")).alias("number"),
    ).orderBy("name").collect()
    if not found:
        return []
    kind = lambda r: "long" if r["n"] and r["whole"] == r["n"] else "double" if r["n"] and r["number"] == r["n"] else "string"
    store_schema(spark, schema_path, T.StructType([*schema.fields, *[T.StructField(r["name"], _KINDS[kind(r)]) for r in found]]))
    return [r["name"] for r in found]


def read_rescued(spark: SparkSession, target: str, schema_path: str) -> DataFrame:
    """All rows under the newest schema; what was rescued before a column was known stands in that column."""
    schema = stored_schema(spark, schema_path)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).parquet(target)
    rows = rows.withColumn("_all", F.from_json(RESCUED, _MAP))
    filled = {
        f.name: F.coalesce(F.col(f"`{f.name}`"), F.expr(f"try_cast(_all['{f.name}'] as {f.dataType.simpleString()})"))
        if isinstance(f.dataType, T.AtomicType) else F.col(f"`{f.name}`") for f in schema.fields
    }
    rest = F.map_filter("_all", lambda k, v: _unfit(k, v, filled))
    return rows.select(*[c.alias(n) for n, c in filled.items()], F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED))
