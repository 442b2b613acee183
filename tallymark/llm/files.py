"""Files that tasks write to and read from the folder all executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or of a plain local path, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return fs.LocalFileSystem(), uri


class Writing:
    """A file that gets its name when it is whole, so that a task that is lost or runs twice leaves no part of one."""

    def __init__(self, uri: str):
        self._fs, self._path = opened(uri)
        self._fs.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._unfinished = f"{self._path}.{uuid.uuid4().hex}.unfinished"
        self._out = self._fs.open_output_stream(self._unfinished, compression=None)

    def write(self, data: bytes) -> None:
        self._out.write(data)

    def tell(self) -> int:
        return self._out.tell()

    def finish(self) -> None:
        self._out.close()
        self._fs.move(self._unfinished, self._path)


def reading(uri: str):
    """A file for reads at any place."""
    system, path = opened(uri)
    return system.open_input_file(path)
