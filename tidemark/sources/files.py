"""Landed files as Arrow's file systems show them, for readers and writers that run in Python workers."""

from __future__ import annotations

import os
import re

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path as Spark writes it, and the path in it; an error where Arrow has none."""
    if re.match(r"file:|[^:]*$", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def shown(uri: str, path: str) -> str:
    """A path of the file system of ``uri``, as Spark writes it."""
    return f"file:{path}" if re.match(r"file:|[^:]*$", uri) else re.match(r"[^:]+://", uri)[0] + path


def files_below(uri: str) -> list[tuple[str, int]]:
    """(path in its file system, length) of the files below ``uri`` that hold data, by path; names that start with ``_`` or ``.`` hold none, as for Spark."""
    system, root = filesystem(uri)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    data = [(x.path, x.size) for x in found if x.is_file and not any(p[:1] in "_." for p in os.path.relpath(x.path, root).split("/"))]
    return sorted(data)


def read_text(uri: str) -> str | None:
    """The content of a small file, or None if there is none."""
    system, path = filesystem(uri)
    try:
        with system.open_input_file(path) as f:
            return f.read().decode()
    except FileNotFoundError:
        return None


def write_bytes(uri: str, data: bytes) -> None:
    system, path = filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as f:
        f.write(data)
