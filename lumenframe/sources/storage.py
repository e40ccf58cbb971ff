"""Shared folders and the few file operations that tables with versions need, over Hadoop's file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; a temporary one on a single machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="lumenframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that nothing of it is computed twice."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by keys to four tasks a core at least: a small file is one task, whatever the work that its rows bring."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def dealt(df: DataFrame, rows: int, *keys: str, each: int = 150_000) -> DataFrame:
    """``df`` dealt by keys to tasks of some ``each`` rows, of which the larger side of a join has ``rows``: what a task holds does
    not grow with the table. Tables that are dealt by the same keys and number meet without another shuffle."""
    few = min(df.sparkSession.sparkContext.defaultParallelism, rows // 20_000 + 1)
    return df.repartition(max(few, rows // each + 1), *keys)


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is no such folder."""
    target, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that nobody has written yet; False if it is there already.

    The text goes to a file of its own first, which is then renamed without overwriting: others see all
    of it or nothing. The rename is atomic on HDFS and its like; on object stores it needs a
    file system with conditional writes.
    """
    target, fs = _path(spark, path)
    draft, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    keep = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    keep[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, keep)
        return True
    except Exception as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise
