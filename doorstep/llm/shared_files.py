"""Files that tasks write to and read from the shared folder, whatever store it is in."""

from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


def move_into_place(path: str, temporary: str) -> None:
    """A finished file takes its final name; another attempt of the task replaces it by the same bytes."""
    files, target = store(path)
    files.move(store(temporary)[1], target)
