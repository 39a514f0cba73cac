"""Path checks through the Hadoop FileSystem API of the session.

Works for any scheme the cluster is configured for (hdfs, s3a, file, ...).
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the immediate sub-folders of ``path`` (empty if absent)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def delete_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (empty if absent)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename one file, replacing a file at the target."""
    fs, p = _fs_path(spark, source)
    _, to = _fs_path(spark, target)
    if fs.exists(to):
        fs.delete(to, False)
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {source} to {target}")


def swap_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of the one at ``path`` by one rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, temporary = _fs_path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, p = _fs_path(spark, path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(temporary), fs.makeQualified(p), options)


def modified_at(spark: SparkSession, path: str) -> datetime:
    """When the file was last written (UTC, without zone)."""
    fs, p = _fs_path(spark, path)
    return datetime.fromtimestamp(fs.getFileStatus(p).getModificationTime() / 1000, timezone.utc).replace(tzinfo=None)


def read_file(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, p = _fs_path(spark, path)
    data = fs.open(p)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()
