"""Arrays in files of the shared folder: written whole by a task, mapped by others.

A file system the worker has mounted is memory-mapped; any other one that pyarrow
knows is read whole, which is why files are kept small by their writers.  A file
appears under its name only when it is complete, so a task that is run again, or
twice at once, puts the same file in its place.
"""

from __future__ import annotations

import json
import mmap
import uuid

import numpy as np
from pyarrow import fs


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    head, at = {}, 0
    for key, array in arrays.items():
        head[key] = (array.dtype.str, at, len(array))
        at += -(-array.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(np.array([len(text)], dtype="<i8").tobytes() + text)
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).tobytes())
            out.write(b"\0" * (-array.nbytes % 8))
    system.move(part, f"{path}/{name}")


def load(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The arrays of a file, or None if there is none."""
    system, path = _place(folder)
    path = f"{path}/{name}"
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with system.open_input_file(path) as file:
            data = file.read()
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = json.loads(bytes(data[8 : 8 + n]))
    return {key: np.frombuffer(data, kind, count, 8 + n + at) for key, (kind, at, count) in head.items()}
