"""Tables that are replaced without ever being half there.

A table's folder has data folders, each written once, and numbered pointers. A pointer is a small file
that names the data folders in use, by part; the highest one that is complete counts. A reader sees the
old version or the new one; a failure leaves the old one. A pointer is created only if its number is free,
so of two writers one fails and publishes nothing. A version stays for a day after the next one, so what is
still being read from it can be read to the end; then it is removed by the next switch.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from brickrow.sources import files

_POINTER = "pointer-"
_DATA = "data-"
#: Seconds that a superseded version stays.
KEEP = 24 * 3600


def new_folder(path: str) -> str:
    """Name of a data folder that nothing refers to yet."""
    return f"{_DATA}{uuid.uuid4().hex}"


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """Part -> data folder of the version in use; empty if there is none."""
    found = _pointers(spark, path)
    return found[max(found)] if found else {}


def switch(spark: SparkSession, path: str, folders: dict[str, str], keep: float = KEEP) -> None:
    """Make ``folders`` the version in use, then remove what has been out of use for ``keep`` seconds."""
    names = [n for n in files.names(spark, path) if n.startswith(_POINTER)]
    number = max((int(n.removeprefix(_POINTER)) for n in names), default=-1) + 1
    try:
        files.create(spark, _pointer(path, number), json.dumps(folders) + "\n")
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            raise FileExistsError(f"another writer has just switched {path}") from error
        raise
    _remove_old(spark, path, number, keep)


def _remove_old(spark: SparkSession, path: str, number: int, keep: float) -> None:
    now = files.changed(spark, _pointer(path, number))  # by the file system's clock
    found = _pointers(spark, path)
    following = dict(zip(sorted(found), sorted(found)[1:]))
    for old, new in following.items():
        if now - files.changed(spark, _pointer(path, new)) >= keep:
            files.remove(spark, _pointer(path, old))
            del found[old]
    used = {folder for folders in found.values() for folder in folders.values()}
    for name in files.names(spark, path):
        # A folder that is not used may be one that is being written; if it is old, a run broke off.
        if name.startswith(_DATA) and name not in used and now - files.changed(spark, f"{path}/{name}") >= keep:
            files.remove(spark, f"{path}/{name}")


def _pointer(path: str, number: int) -> str:
    return f"{path}/{_POINTER}{number:012d}"


def _pointers(spark: SparkSession, path: str) -> dict[int, dict[str, str]]:
    """The complete pointers: number -> part -> data folder."""
    found = {}
    for name in files.names(spark, path):
        if name.startswith(_POINTER):
            text = files.read(spark, f"{path}/{name}")
            if text.endswith("}\n"):
                found[int(name.removeprefix(_POINTER))] = json.loads(text)
    return found
