"""Lineage cuts in the shared folder, and the tables of a scale-factor directory."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A temporary one only where that is unset and all tasks run in this JVM, as in tests;
    on a cluster an unset folder raises an error."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='quirewise-')}"
    return _OWN[context.applicationId]


def hadoop_path(spark: SparkSession, folder: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _cuts(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/quirewise/{spark.sparkContext.applicationId}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: later stages reuse it, and a lost executor costs no recomputation.

    The tables of an application are deleted when its JVM ends, or before by `drop_cuts`.
    """
    spark, folder = df.sparkSession, _cuts(df.sparkSession)
    path, fs = hadoop_path(spark, folder)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    there = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(there)
    return spark.read.schema(df.schema).parquet(there)


def drop_cuts(spark: SparkSession) -> None:
    """Delete all tables cut by this application: between queries whose results have been taken."""
    path, fs = hadoop_path(spark, _cuts(spark))
    fs.delete(path, True)


def commit_exclusively(spark: SparkSession, written: str, final: str, text: str) -> bool:
    """Write `text` to one path, complete, and give it the final one in one step that fails if that is taken: whether this call took it."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    source, fs = hadoop_path(spark, written)
    target, _ = hadoop_path(spark, final)
    out = fs.create(source, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            # A rename in a local file system replaces what is there; a link doesn't.
            at = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(at(target), at(source))
        else:
            none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
