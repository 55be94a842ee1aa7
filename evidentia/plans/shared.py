"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_LEFT: dict[str, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local mode, where it may be unset, a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        own = tempfile.mkdtemp(prefix="evidentia-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN.append(f"file://{own}")
    return _OWN[0]


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    _LEFT[path] = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read again, which cuts its lineage. What nobody deletes before goes when the driver ends."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


#: Rows of a task whose work a row costs far more than to move it.
ROWS_A_TASK = 25_000
#: Bytes of an Arrow batch: what Python makes of its rows is many times larger.
BATCH_BYTES = 4 << 20


def dealt(df: DataFrame) -> DataFrame:
    """``df``, counted and dealt to as many tasks as its rows need: a small file may hold rows that grow when they are read."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch; no result depends on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def written_bytes(df: DataFrame) -> int:
    """The size of a table of ``written``."""
    place, conf = _LEFT[df._path]
    return place.getFileSystem(conf).getContentSummary(place).getLength()


def delete(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for df in tables:
        place, conf = _LEFT.pop(df._path)
        place.getFileSystem(conf).delete(place, True)


def _delete_left() -> None:
    for path in list(_LEFT):
        place, conf = _LEFT.pop(path)
        with contextlib.suppress(Exception):  # the session may have ended before the interpreter
            place.getFileSystem(conf).delete(place, True)


atexit.register(_delete_left)
