"""Outputs that are replaced as a whole: versions in folders, and a pointer that names the one in force.

A version is invisible until the pointer names it. Pointers are files with growing numbers, each put in place by one
rename; the highest whole one counts. So the switch is a single step on a file system, and on an object store, where a
rename is a copy, a pointer half-written is passed over.
"""

import re
import uuid

from pyspark.sql import SparkSession

VERSIONS = "versions"
POINTER = re.compile(r"current-(\d{12})")
#: Ends a pointer's text; what lacks it was not written to the end.
WHOLE = "\n.\n"


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(out: str) -> str:
    """A folder that no other run writes to."""
    return f"{out}/{VERSIONS}/{uuid.uuid4().hex}"


def _pointers(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(number, version's folder) of every whole pointer, the oldest first."""
    folder, files = _open(spark, out)
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        number = POINTER.fullmatch(status.getPath().getName())
        if number is None:
            continue
        stream = files.open(status.getPath())
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if text.endswith(WHOLE):
            found.append((int(number[1]), f"{out}/{VERSIONS}/{text.removesuffix(WHOLE)}"))
    return sorted(found)


def current(spark: SparkSession, out: str) -> str | None:
    """The folder of the version in force; None before the first switch."""
    pointers = _pointers(spark, out)
    return pointers[-1][1] if pointers else None


def switch(spark: SparkSession, out: str, version: str, *, keep: int = 2) -> None:
    """Put ``version`` in force; the last ``keep`` versions stay, older ones and their pointers go.

    Folders of runs that never got here are left to whoever started them: one may still be running.
    """
    pointers = _pointers(spark, out)
    number = pointers[-1][0] + 1 if pointers else 1
    target, files = _open(spark, f"{out}/current-{number:012d}")
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/.switch-{uuid.uuid4().hex}")
    stream = files.create(temporary, False)
    try:
        stream.write((version.rsplit("/", 1)[1] + WHOLE).encode())
    finally:
        stream.close()
    if not files.rename(temporary, target):
        files.delete(temporary, False)
        raise RuntimeError(f"another run has published number {number} in {out}")
    pointers.append((number, version))
    kept = {v for _, v in pointers[-keep:]}
    for old, folder in pointers[:-keep]:
        files.delete(_open(spark, f"{out}/current-{old:012d}")[0], False)
        if folder not in kept:
            files.delete(_open(spark, folder)[0], True)
