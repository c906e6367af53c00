"""Paths as the session's Hadoop file systems see them.

Whatever looks for files goes through here, so that it finds what ``spark.read`` and
``df.write`` mean by the same path: relative to ``fs.defaultFS``, with the session's
credentials, through mount tables.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _on(path: str):
    """(file system, Hadoop path)"""
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(path: str) -> bool:
    system, place = _on(path)
    return system.exists(place)


def is_file(path: str) -> bool:
    system, place = _on(path)
    return system.exists(place) and system.getFileStatus(place).isFile()


def qualified(path: str) -> str:
    """The full URI of a path; local ones stay plain where Spark means the local disk by that."""
    system, place = _on(path)
    uri = system.makeQualified(place).toString()
    plain = re.sub(r"^file:/+", "/", uri)
    return plain if plain != uri and _default_is_local() else uri


def _default_is_local() -> bool:
    return _on("/")[0].getUri().getScheme() == "file"


def resolved(path: str) -> str:
    """The URI behind mount tables, as other readers than Hadoop's need it."""
    system, place = _on(path)
    if system.getUri().getScheme() == "viewfs":
        return system.resolvePath(place).toString()
    return system.makeQualified(place).toString()


def list_files(directory: str, recursive: bool = False) -> list[str]:
    """Full URIs of the files in a directory (or the one file of that name)."""
    system, place = _on(directory)
    found, files = [], system.listFiles(system.makeQualified(place), recursive)
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return found


def list_folders(directory: str) -> list[str]:
    """Names of the folders in a directory; hidden ones left out."""
    system, place = _on(directory)
    found = [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]
    return sorted(name for name in found if name[0] not in "._")


def delete(path: str) -> None:
    system, place = _on(path)
    system.delete(place, True)


def read_text(path: str) -> str | None:
    """The content of a small file, None if there is none."""
    system, place = _on(path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    system, place = _on(path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move(source: str, target: str) -> None:
    """Rename a folder, making the parents of its new place; there must be nothing at that place."""
    system, place = _on(source)
    _, there = _on(target)
    system.mkdirs(there.getParent())
    if not system.rename(place, there):
        raise OSError(f"Cannot rename {source} to {target}")
