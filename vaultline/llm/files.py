"""Files in the shared folder, written and read by tasks."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, and its path there."""
    return fs.FileSystem.from_uri(uri)


def put(folder: str, name: str, *parts) -> str:
    """Write a file under its final name at once: an attempt that dies leaves nothing that is read, and a repeated one
    replaces the same content."""
    system, path = opened(folder)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for p in parts:
            out.write(p)
    system.move(draft, f"{path}/{name}")
    return f"{folder}/{name}"


def names(folder: str) -> list[str]:
    """The files in a folder that have their final names."""
    system, path = opened(folder)
    return [f.base_name for f in system.get_file_info(fs.FileSelector(path)) if not f.base_name.startswith(".")]


def mapped(uri: str) -> np.ndarray:
    """A file's bytes, memory-mapped: in place if the folder is a mounted one, else from a copy that has no name and so
    goes with the process."""
    system, path = opened(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with tempfile.NamedTemporaryFile() as copy, system.open_input_stream(path) as source:
        while piece := source.read(1 << 20):
            copy.write(piece)
        copy.flush()
        return np.memmap(copy.name, np.uint8, "r") if os.path.getsize(copy.name) else np.zeros(0, np.uint8)
