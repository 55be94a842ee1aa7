"""JSON-lines tables: strict reads, sorted writes, and manifests that tell whether a stage is current."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_jsonl(spark: SparkSession, path: str, schema: StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Rows of a JSON-lines file or folder; a missing one is empty, blank lines are skipped, a bad line fails the read.

    Strings are trimmed, absent columns get their defaults.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    tidy = {f.name: F.trim(f.name) for f in schema if isinstance(f.dataType, StringType)}
    tidy |= {f.name: F.transform(f.name, lambda v: F.trim(v)) for f in schema if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType)}
    return rows.withColumns(tidy).withColumns({k: F.coalesce(F.col(k), v) for k, v in (defaults or {}).items()})


def unknown_fields(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``(field, n)`` of top-level keys that the schema doesn't have."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    keys = lines.select(F.explode(F.json_object_keys("value")).alias("field"))
    return keys.filter(~F.col("field").isin(schema.fieldNames())).groupBy("field").agg(F.count("*").alias("n"))


def write_jsonl(df: DataFrame, path: str, key: str | None = None, files: int | None = None) -> None:
    """Writes JSON lines, ordered by the key as a string across the files; the output committer makes it atomic."""
    ordered = df.orderBy(F.col(key).cast("string")) if key else df
    (ordered.coalesce(files) if files else ordered).write.mode("overwrite").json(path)


def stage_manifest(inputs: list[DataFrame], parameters: dict) -> str:
    """A fingerprint of a stage: order-free sums over its input tables, their schemas and its parameters."""
    parts = [json.dumps(parameters, sort_keys=True, ensure_ascii=False)]
    for df in inputs:
        row = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
        parts.append(f"{df.schema.simpleString()}|{row[0]}|{row[1]}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def current(spark: SparkSession, path: str, manifest: str) -> bool:
    """Whether the output at ``path`` was written by a stage with this manifest."""
    where = f"{path}/_manifest"
    return _exists(spark, where) and spark.read.text(where).first()[0] == manifest


def commit(df: DataFrame, path: str, manifest: str) -> None:
    """Writes a stage's output and then its manifest."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    df.sparkSession.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_manifest")
