"""Staged commit of output tables.

Tables are written below a hidden folder of the destination. One rename of that folder
marks them as complete; only then do they take the places of earlier ones, which stay
readable until that moment. A run that dies before the rename leaves the earlier output
as it was; one that dies after it is finished by the next writer, or by ``finish``.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tillstar.shared import file_system, remove_path

_WRITING, _COMPLETE, _REPLACED = "_writing-", "_complete-", "_replaced"
# Below this folder of a run lie tables of which only the partitions are replaced.
PARTS = "_parts"
_ONE_AT_A_TIME = threading.Lock()


def _rename(spark: SparkSession, old: str, new: str) -> None:
    source, files = file_system(spark, old)
    if not files.rename(source, file_system(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def _exists(spark: SparkSession, path: str) -> bool:
    place, files = file_system(spark, path)
    return files.exists(place)


def _children(spark: SparkSession, path: str) -> list[str]:
    place, files = file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _partitions(spark: SparkSession, table: str) -> list[str]:
    """The folders ``column=value/...`` of a table that hold no further ones."""
    inner = [c for c in _children(spark, table) if "=" in c]
    return [
        f"{c}/{below}" if below else c
        for c in inner
        for below in _partitions(spark, f"{table}/{c}") or [""]
    ]


def _move_in(spark: SparkSession, destination: str, complete: str) -> None:
    """Put complete tables and partitions in their places. Done again after a failure, it
    goes on where it stopped: each is in its place or still in the folder, never in
    neither."""
    place = f"{destination}/{complete}"
    replaced, files = file_system(spark, f"{place}/{_REPLACED}")
    files.mkdirs(replaced)

    def move(old: str, new: str) -> None:
        if _exists(spark, new):
            _rename(spark, new, f"{place}/{_REPLACED}/{uuid.uuid4().hex}")
        files.mkdirs(file_system(spark, new)[0].getParent())
        _rename(spark, old, new)

    for name in _children(spark, place):
        if name not in (_REPLACED, PARTS):
            move(f"{place}/{name}", f"{destination}/{name}")
    for table in _children(spark, f"{place}/{PARTS}"):
        for part in _partitions(spark, f"{place}/{PARTS}/{table}"):
            move(f"{place}/{PARTS}/{table}/{part}", f"{destination}/{table}/{part}")
    remove_path(spark, place)


def finish(spark: SparkSession, destination: str) -> list[str]:
    """Finish what an earlier run had completed but not put in place; returns its folders.

    A destination has one writing process at a time.
    """
    destination = destination.rstrip("/")
    with _ONE_AT_A_TIME:
        found = [c for c in _children(spark, destination) if c.startswith(_COMPLETE)]
        for complete in found:
            _move_in(spark, destination, complete)
    return found


def discard(spark: SparkSession, destination: str) -> list[str]:
    """Remove what runs that died had written below the destination without completing it;
    returns the folders. Not to be called while another run writes there."""
    destination = destination.rstrip("/")
    found = [c for c in _children(spark, destination) if c.startswith(_WRITING)]
    for unfinished in found:
        remove_path(spark, f"{destination}/{unfinished}")
    return found


@contextmanager
def staged(spark: SparkSession, destination: str) -> Iterator[str]:
    """A folder to write tables to. They replace those of the same names below the
    destination, all together, when the block ends; if it fails nothing changes. Tables
    written below its folder PARTS replace only the partitions they have."""
    destination = destination.rstrip("/")
    finish(spark, destination)
    run = uuid.uuid4().hex
    place = f"{destination}/{_WRITING}{run}"
    try:
        yield place
    except BaseException:
        remove_path(spark, place)
        raise
    if not _exists(spark, place):  # nothing was written
        return
    with _ONE_AT_A_TIME:
        _rename(spark, place, f"{destination}/{_COMPLETE}{run}")
        _move_in(spark, destination, f"{_COMPLETE}{run}")
