"""Tiny file-system helpers over the Hadoop FileSystem of the session.

Works for any URI the cluster can read (``file:``, ``hdfs:``, object stores);
only names, existence, headers and manifests are looked up here -- data always
moves through Spark readers and writers.
"""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fsys, p = _fs_path(spark, path)
    return bool(fsys.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fsys, p = _fs_path(spark, path)
    if not fsys.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fsys.listStatus(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fsys, p = _fs_path(spark, path)
    if not fsys.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fsys.listStatus(p) if st.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file at ``path``, or the data files of the folder there."""
    fsys, p = _fs_path(spark, path)
    if fsys.getFileStatus(p).isFile():
        return [path]
    return [f"{path.rstrip('/')}/{n}" for n in list_names(spark, path) if not n.startswith(("_", "."))]


def greatest_file(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the largest of some files."""
    return max((_fs_path(spark, f)[0].getFileStatus(_fs_path(spark, f)[1]).getLen() for f in paths), default=0)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder (metadata only)."""
    fsys, p = _fs_path(spark, path)
    return int(fsys.getContentSummary(p).getLength())


def state(spark: SparkSession, path: str) -> str:
    """Names, sizes and modification times of the file or data files at ``path``, as text: equal if nothing was written."""
    out = []
    for f in data_files(spark, path):
        status = _fs_path(spark, f)[0].getFileStatus(_fs_path(spark, f)[1])
        out.append(f"{status.getPath().getName()}:{status.getLen()}:{status.getModificationTime()}")
    return f"{path} " + hashlib.sha256("|".join(out).encode()).hexdigest()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a name that is free."""
    fsys, p = _fs_path(spark, target)
    if fsys.exists(p):
        raise FileExistsError(target)
    fsys.mkdirs(p.getParent())
    if not fsys.rename(_fs_path(spark, source)[1], p):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small metadata file (a manifest) as text."""
    fsys, p = _fs_path(spark, path)
    stream = fsys.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file (a CSV header), without reading the rest."""
    fsys, p = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fsys.open(p), "UTF-8"))
    try:
        return (reader.readLine() or "").lstrip("\ufeff")
    finally:
        reader.close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if somebody has created it before.  Of several creators one wins.

    The file system decides: HDFS by its name node, a local one by the operating system (Hadoop's local
    ``create`` looks first and writes then).
    """
    fsys, p = _fs_path(spark, path)
    fsys.mkdirs(p.getParent())
    uri = fsys.makeQualified(p).toUri()
    if uri.getScheme() == "file":
        return bool(spark.sparkContext._jvm.java.io.File(uri.getPath()).createNewFile())
    try:
        fsys.create(p, False).close()
        return True
    except Py4JJavaError as error:
        if fsys.exists(p):
            return False
        raise error


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, written aside and renamed, so that readers see it whole or not at all."""
    fsys, p = _fs_path(spark, path)
    if fsys.exists(p):
        raise FileExistsError(path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fsys.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fsys.rename(aside, p):
        raise OSError(f"cannot rename {aside} to {path}")


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder or file of a table the library owns."""
    fsys, p = _fs_path(spark, path)
    return bool(fsys.delete(p, True))
