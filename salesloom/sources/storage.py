"""Small file operations on whatever store a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def content_length(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    files, target = _located(spark, path)
    return files.getContentSummary(target).getLength()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is absent."""
    files, target = _located(spark, path)
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def data_files(spark: SparkSession, root: str, below: str) -> list[str]:
    """Paths relative to ``root`` of the files below ``root/below``, or of that file itself, hidden ones left out."""
    files, top = _located(spark, root)
    prefix = files.makeQualified(top).toString().rstrip("/") + "/"
    _, target = _located(spark, f"{root}/{below}")
    if not files.exists(target):
        return []
    found, listed = [], files.listFiles(target, True)
    while listed.hasNext():
        path = listed.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append(path.toString()[len(prefix):])
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder, making the folder it goes into."""
    files, source = _located(spark, old)
    _, target = _located(spark, new)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _located(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that is complete as soon as it is seen; an existing one is an error and stays."""
    files, target = _located(spark, path)
    folder, name = path.rsplit("/", 1)
    _, draft = _located(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(f"{path} was written by another run")
