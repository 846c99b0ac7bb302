"""Which files a caller's list means, and the first lines of a file."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession


def listed_files(spark: SparkSession, path: str) -> list[str]:
    """The data files that a file name, folder or glob stands for, sorted; hidden files are left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found, waiting = [], list(system.globStatus(hadoop) or [])
    if not waiting:
        raise ValueError(f"no such file: {path}")
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting += [s for s in system.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
        else:
            found.append(status.getPath().toString())
    return sorted(found)


def escaped(path: str) -> str:
    """A file name that Spark's readers do not take for a glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def first_lines(spark: SparkSession, file: str, charset: str) -> Iterator[str]:
    """The lines of a file, read one by one as the caller asks for them."""
    jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(configuration).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(configuration).getCodec(path)
        data = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, charset))
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        stream.close()
