"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app_name: str = "fleethazard", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing ``spark.checkpoint.dir`` is an error, since a machine-local path
    would be lost with its machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="fleethazard-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark can write."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder on any file system Spark can read; none if it isn't there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def _put_file(spark: SparkSession, path: str, content: bytes, how: str) -> None:
    """Write a small file beside its place and rename it there, in one step."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target, fresh = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(fresh, True)
    out.write(bytearray(content))
    out.close()
    option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    option[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, how)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(fresh), files.makeQualified(target), option)
    except Py4JJavaError as error:
        files.delete(fresh, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise FileExistsError(path) from None
        raise


def replace_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Put a small file in place in one step: readers see the old content or the new."""
    _put_file(spark, path, content, "OVERWRITE")


def create_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Put a small file where there is none, in one step; FileExistsError if there is one."""
    _put_file(spark, path, content, "NONE")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder, among the tables of this application."""
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def clean_tables(spark: SparkSession) -> None:
    """Remove what this application has written by `written` and `scratch`; call it when no result is read any more."""
    remove(spark, f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}")


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a zip in the shared folder on the path of Python workers."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if any(name.startswith("fleethazard-") for name in context._python_includes):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    path = f"{shared_dir(spark)}/packages/fleethazard-{context.applicationId}.zip"
    replace_file(spark, path, buffer.getvalue())
    context.addPyFile(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so later reads see the same rows in the same partitions."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: for wide tables that are read many times, few columns at a time."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Run the jobs of the block with generated methods that the JVM compiles.

    HotSpot interprets methods of more than 8,000 bytes; Spark's own limit is far above that, and a stage over dozens of columns
    exceeds it. Spark's advice for HotSpot is this value: such a stage then runs from smaller methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
