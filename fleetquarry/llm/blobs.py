"""Files that tasks write to and read from the shared folder, in any file system pyarrow reaches."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def _at(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class BlobWriter:
    """Written under a name of its own and then renamed, so a retried task leaves whole files only."""

    def __init__(self, uri: str):
        self._system, self._path = _at(uri)
        self._system.create_dir(self._path.rsplit("/", 1)[0], recursive=True)
        self._own = f"{self._path}.{uuid.uuid4().hex}.tmp"
        self._out = self._system.open_output_stream(self._own)

    def write(self, data: bytes) -> None:
        self._out.write(data)

    def close(self) -> None:
        self._out.close()
        self._system.move(self._own, self._path)

    def abort(self) -> None:
        self._out.close()
        self._system.delete_file(self._own)


def write_blob(uri: str, parts: list[bytes]) -> None:
    out = BlobWriter(uri)
    for part in parts:
        out.write(part)
    out.close()


def read_blob(uri: str) -> bytes:
    system, path = _at(uri)
    with system.open_input_file(path) as f:
        return f.read()


class Ranges:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        system, path = _at(uri)
        self._file = system.open_input_file(path)

    def read(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        return self._file.read(size)

    def close(self) -> None:
        self._file.close()
