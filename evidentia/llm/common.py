"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts the same words.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Rows of a table that may be broadcast or read by the driver: the proven bound for small tables.
SMALL_ROWS = 20_000
#: Bytes of one Arrow batch: a batch of very long texts still fits a Python worker with its copies.
BATCH_BYTES = 4 << 20

_FALLBACK: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; in local mode, where it may be unset, one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _FALLBACK:
        own = tempfile.mkdtemp(prefix="evidentia-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _FALLBACK.append(f"file://{own}")
    return _FALLBACK[0]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/evidentia/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialise`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch; rows are taken as before, and no result depends on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def numbered_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ...: no name of a caller's column can clash with an operator's own."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def own_columns(docs: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """Columns that turn ``numbered_columns(docs)`` back, less those in ``without``."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in without]


def number_of(docs: DataFrame, column: str) -> str:
    """The name of ``column`` in ``numbered_columns(docs)``."""
    return f"c{docs.columns.index(column)}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Texts in fewer files than there are cores are dealt to all cores first; more files are read as they are."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in ("documents", "pages") and len(df._jdf.inputFiles()) < cores else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, where a lambda would compute it for each element."""
    return F.transform(F.array(value), body)[0]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Tells rows apart that share an id: the id and two hashes of the text."""
    return [F.col(id_col), F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(1), F.col(text_col))]
