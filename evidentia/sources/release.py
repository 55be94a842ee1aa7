"""Release packages: tables, reports and configurations with counts and checksums, and their validation."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions.text import has_personal_field

# Paths of private machines, and reviewers named by their address.
PRIVATE_PATH = r"(?:/root/|/Users/|[A-Za-z]:\\\\Users\\\\|autodl-container-|autodl-tmp/)"
REVIEWER_ADDRESS = r"(?i)reviewer\s*[:=][^;\n]*@[\w.-]+"
MANIFEST = "name string, rows long, file string, bytes long, sha256 string"


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(file, bytes, sha256)`` of the files below a folder, by executors; hidden files and marks of success are passed over."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    return files.select(name.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).filter(~F.col("file").rlike(r"/[_.][^/]*$"))


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _fs(spark, path)
    return fs.exists(place)


def copy_files(spark: SparkSession, files: dict[str, str], folder: str) -> list[str]:
    """Copies files ``{name: path}`` into a folder; returns the paths that aren't there."""
    missing = []
    for name, path in files.items():
        place, fs = _fs(spark, path)
        if not fs.exists(place):
            missing.append(path)
            continue
        target, to = _fs(spark, f"{folder}/{name}")
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, place, to, target, False, True, spark._jsc.hadoopConfiguration())
    return missing


def package(tables: dict[str, DataFrame], path: str, reports: dict[str, str] | None = None, configs: dict[str, str] | None = None, allow_missing: bool = False) -> DataFrame:
    """Writes each table below ``path``, copies reports and configurations ``{name: path}`` and returns the manifest, a row for each file.

    A missing configuration always fails the package; missing reports do unless ``allow_missing``. Reports and
    configurations have no row count.
    """
    spark = next(iter(tables.values())).sparkSession
    lost = copy_files(spark, configs or {}, f"{path}/configs")
    if lost:
        raise FileNotFoundError(f"missing release configurations: {', '.join(lost)}")
    lost = copy_files(spark, reports or {}, f"{path}/reports")
    if lost and not allow_missing:
        raise FileNotFoundError(f"missing release reports: {', '.join(lost)}")
    counts = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        counts.append((name, spark.read.parquet(f"{path}/{name}").count()))
    rows = spark.createDataFrame(counts, "name string, rows long")
    files = file_hashes(spark, path).withColumn("name", F.substring_index("file", "/", 1))
    return files.join(rows, "name", "left").select(*(c.split()[0] for c in MANIFEST.split(", ")))


def review_counts(facts: DataFrame, questions: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: manually checked facts and questions, and audit samples."""
    one = facts.agg(F.count_if("manual_checked").alias("facts"))
    two = questions.agg(F.count_if("manual_checked").alias("questions"))
    return one.join(F.broadcast(two)).join(F.broadcast(samples.agg(F.count("*").alias("audit_samples"))))


def write_manifest(manifest: DataFrame, path: str, extra: dict | None = None) -> None:
    """The manifest, a bounded number of files, as one JSON document beside the package."""
    spark = manifest.sparkSession
    rows = [r.asDict() for r in manifest.orderBy("file").collect()]
    text = json.dumps({"files": rows} | (extra or {}), ensure_ascii=False, sort_keys=True, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(f"{path}/_manifest", wholetext=True).first()[0]
    return spark.createDataFrame([tuple(f.get(c.split()[0]) for c in MANIFEST.split(", ")) for f in json.loads(text)["files"]], MANIFEST)


def _found(strings: list[Column], test) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(test(c), F.lit(False)) for c in strings))


def check_package(spark: SparkSession, path: str, manifest: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """``(name, problem)``: missing files, other checksums or row counts, private paths, reviewers' addresses, personal fields.

    ``required``: files, as in the manifest, that a package has to have. Only ``evidence_text`` is searched for personal fields.
    """
    now = file_hashes(spark, path).select("file", F.col("sha256").alias("now"))
    met = manifest.join(now, "file", "left")
    problems = met.filter("file is null or now is null").select("name", F.lit("missing file").alias("problem"))
    problems = problems.union(met.filter("now <> sha256").select("name", F.lit("checksum mismatch").alias("problem")))
    if required:
        wanted = spark.createDataFrame([(f,) for f in required], "file string").join(now, "file", "left_anti")
        problems = problems.union(wanted.select("file", F.lit("missing required file")))
    expected = {r["name"]: r["rows"] for r in manifest.filter("rows is not null").select("name", "rows").distinct().collect()}
    for name, rows in expected.items():
        df = spark.read.parquet(f"{path}/{name}")
        if df.count() != rows:
            problems = problems.union(spark.createDataFrame([(name, "row count mismatch")], "name string, problem string"))
        strings = [F.col(c) for c, t in df.dtypes if t == "string"]
        checks = {"private path": _found(strings, lambda c: c.rlike(PRIVATE_PATH)), "reviewer address": _found(strings, lambda c: c.rlike(REVIEWER_ADDRESS))} if strings else {}
        if "evidence_text" in df.columns:
            checks["personal field"] = has_personal_field(F.col("evidence_text"))
        for problem, bad in checks.items():
            problems = problems.union(df.filter(bad).limit(1).select(F.lit(name), F.lit(problem)))
    return problems.distinct()


def export(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Each table as the Parquet split ``full`` of a configuration of its name; returns ``(name, rows)``."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/full")
    return reduce(DataFrame.union, (spark.read.parquet(f"{path}/{name}/full").agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name in tables))
