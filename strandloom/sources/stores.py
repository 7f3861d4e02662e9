"""Files of a path, for readers and writers that work on byte ranges in Python workers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import InputPartition


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there; a path without a scheme is local."""
    if re.match("file:/", path):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def reachable(path: str) -> bool:
    """Whether Python workers can open a path themselves; stores that only Spark reads are read through Spark."""
    try:
        where, inner = store(path)
        return where.get_file_info(inner).type != fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of a path's files in the order of their names; hidden ones of a folder are left out."""
    where, inner = store(path)
    info = where.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    found = where.get_file_info(fs.FileSelector(inner))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")


@dataclass
class Range(InputPartition):
    """Bytes of a file; ``end`` is -1 for a file that can only be read from its beginning."""

    file: str
    start: int
    end: int
