"""Folders that driver and executors share, and what is in a folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own, which only a local master can share with its executors."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def files_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name -> path of the files right in a folder, hidden and empty ones too, by name. Names alone reach the driver."""
    fs, path = file_system(spark, folder)
    return dict(sorted((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(path) if s.isFile()))


def head_of(spark: SparkSession, path: str, size: int) -> tuple[bytes, bool]:
    """The first `size` bytes of a file, and whether that is all of it."""
    fs, found = file_system(spark, path)
    length = fs.getFileStatus(found).getLen()
    stream = fs.open(found)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(size, length))), length <= size
    finally:
        stream.close()


def visible(spark: SparkSession, files: dict[str, str]) -> tuple[dict[str, str], dict[str, int]]:
    """Files (name -> path) as Spark's readers can see them, and their sizes: names with a leading `_` or `.` are copied to other ones in the shared folder."""
    out, sizes, aside = {}, {}, f"{shared_dir(spark)}/visible-{uuid.uuid4().hex}"
    for k, (name, path) in enumerate(files.items()):
        fs, found = file_system(spark, path)
        sizes[name] = fs.getFileStatus(found).getLen()
        if name[0] in "_.":
            to_fs, to = file_system(spark, f"{aside}/file-{k}.csv")
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, found, to_fs, to, False, spark._jsc.hadoopConfiguration())
            path = to.toString()
        out[name] = path
    return out, sizes


def names_in(spark: SparkSession, folder: str, folders: bool = False) -> list[str]:
    """The names of what is right in a folder: its files, or its folders; none if it is not there."""
    fs, path = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() == folders] if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, found = file_system(spark, path)
    if not fs.exists(found):
        return None
    return head_of(spark, path, fs.getFileStatus(found).getLen())[0].decode()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a whole file where none is, or says that one is there: written aside, and given its name by a step that only one writer can win.

    Distributed file systems refuse to rename onto a name that is taken; a local one does not, but refuses to link onto one.
    """
    fs, target = file_system(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs.mkdirs(target.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            to_local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(to_local(target), to_local(aside))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(aside, target, none)
        return True
    except Py4JJavaError as e:
        if any(s in e.java_exception.getClass().getName() for s in ("FileAlreadyExists", "FileExists")):
            return False
        raise
    finally:
        fs.delete(aside, False)
