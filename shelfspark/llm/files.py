"""Raw files in the shared folder, written by tasks.

The folder is named by a URI (file, hdfs, s3, gs); Arrow's file systems open it. A
file is written under a name of its task attempt and then moved to its final name,
so a task that runs again after a lost executor just replaces equal bytes.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = open_folder(uri)
    system.create_dir(path, recursive=True)


def put(uri: str, name: str, data: bytes) -> None:
    """Write one whole file; the final name appears only when all bytes are there."""
    system, path = open_folder(uri)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, f"{path}/{name}")
