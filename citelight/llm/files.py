"""Binary files in the shared folder, written and read by tasks as streams."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it.

    Spark's names are understood: a plain path or ``file:`` is a folder all machines
    mount, ``s3a`` and ``s3n`` are ``s3``; ``gs``, ``abfs`` and ``hdfs`` work where Arrow can reach them.
    """
    scheme, found, rest = uri.partition(":")
    if not found or scheme == "file":
        path = "/" + (rest if found else uri).lstrip("/")
        return fs.LocalFileSystem(), path
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(folder: str, suffix: str):
    """A fresh file ``(name, stream)`` below ``folder``.

    The name is never used twice, so a task that runs again after a loss writes another
    file; only files that a finished task has reported are ever read.
    """
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        yield name, out


def open_at(folder: str, name: str, start: int):
    """A readable file positioned at ``start``."""
    system, path = open_folder(folder)
    stream = system.open_input_file(f"{path}/{name}")
    stream.seek(start)
    return stream
