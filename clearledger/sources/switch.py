"""One small file that is replaced in one step, so that readers see the old or the new one."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _open(spark: SparkSession, path: str):
    folder = _jvm(spark).org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small file, None where there is none."""
    file, fs = _open(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return _jvm(spark).org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def switch_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace the contents of a small file in one step, by renaming over it.

    Where the store has no such rename, the file is put as one object, which object stores do in
    one step as well.
    """
    file, fs = _open(spark, path)
    fs.mkdirs(file.getParent())
    hadoop = _jvm(spark).org.apache.hadoop.fs
    fresh = hadoop.Path(file.getParent(), f"_{file.getName()}-{uuid.uuid4().hex}")
    _put(fs, fresh, text)
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    try:
        context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    except Exception as unknown:  # a store that only has the older interface
        if "UnsupportedFileSystem" not in str(unknown):
            raise
        _put(fs, file, text)
        fs.delete(fresh, False)
        return
    context.rename(fs.makeQualified(fresh), fs.makeQualified(file), options)


def _put(fs, file, text: str) -> None:
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, hidden ones left out."""
    folder, fs = _open(spark, path)
    if not fs.exists(folder):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(n for n in found if n[0] not in "._")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all that is in it."""
    folder, fs = _open(spark, path)
    fs.delete(folder, True)
