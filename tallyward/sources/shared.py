"""Folder for tables that must outlive one executor, and the few file operations that Spark's readers and writers lack."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    """The path and its file system, as Spark reaches it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, wherever Spark can reach it; nothing happens if there is none."""
    where, store = _store(spark, path)
    store.delete(where, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    where, store = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(where)) if store.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _store(spark, path)
    return store.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of the driver's own."""
    where, store = _store(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that is there whole or not at all; false if there is one of this name already.

    It is written under another name and renamed, which does not replace a file.
    """
    jvm = spark._jvm
    where, store = _store(spark, path)
    if store.exists(where):
        return False
    draft, _ = _store(spark, f"{where.getParent()}/.{where.getName()}-{uuid.uuid4().hex}")
    stream = store.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(store.makeQualified(draft), store.makeQualified(where), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        store.delete(draft, False)
        return False
    return True


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`, removed when the program ends; a temporary one only for a
    local session without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        folder = f"{base.rstrip('/')}/tallyward-{uuid.uuid4().hex}"
        atexit.register(_remove_at_exit, spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyward-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Without a running session there is nothing left to remove it with."""
    if spark.sparkContext._jsc is not None:
        remove(spark, folder)
