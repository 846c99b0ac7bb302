"""Binary files in the folder that all executors share, through ``pyarrow.fs`` (local, HDFS, S3 and GCS paths)."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark import TaskContext


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there."""
    if ":" not in path.split("/", 1)[0]:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def own_file(folder: str, ending: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path and name of a file of this task attempt's own.

    Only the rows of the attempt that Spark accepts tell the name, so a repeated or lost attempt leaves at worst a
    file that nothing refers to.
    """
    task = TaskContext.get()
    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}{ending}"
    system, root = open_store(folder)
    system.create_dir(root, recursive=True)
    return system, f"{root}/{name}", name
