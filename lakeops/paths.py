"""Small file-system calls that work on every storage Spark can reach (through Hadoop's FileSystem)."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def literal(path: str) -> str:
    """A path Spark's readers take as it is, also with characters that would make it a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isFile()


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.delete(hadoop_path, True)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless it exists; False when it does. One writer wins, and nobody sees half a file.

    The text is written beside the path first. A rename that does not replace, or on a local disk a hard link, then gives it its name.
    """
    fs, final = _resolve(spark, path)
    jvm = spark._jvm
    if fs.exists(final):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}.tmp")
    try:
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        try:
            if fs.getScheme() == "file":
                local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(final), local(draft))
            else:
                none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
                context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
        except Py4JJavaError as error:
            if fs.exists(final):
                return False
            raise error
    finally:
        fs.delete(draft, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a string."""
    fs, hadoop_path = _resolve(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8", comment: str | None = None) -> str:
    """First line of a text file that is not blank and no comment; only the start of the file is read."""
    fs, hadoop_path = _resolve(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding))
        line = reader.readLine()
        while line is not None and (not line.strip() or (comment and line.startswith(comment))):
            line = reader.readLine()
        return line or ""
    finally:
        stream.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, one listing call; empty when the folder is missing."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, hadoop_path = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in (fs.globStatus(hadoop_path) or []))


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """One row per file (path, uri, length, modificationTime). The file contents are never read.

    ``uri`` is the URL-encoded path, as in ``_metadata.file_path`` of a data scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(folders))
        .select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime")
    )
