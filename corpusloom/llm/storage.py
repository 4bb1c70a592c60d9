"""Binary files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs


def write_file(folder: str, name: str, content: bytes | list[bytes]) -> str:
    """Write one file under a name that no other attempt uses; return its URI.

    A lost task leaves a file that no manifest names; the rows of its next attempt name a new one.
    """
    stem, dot, suffix = name.partition(".")
    uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:12]}{dot}{suffix}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        for part in [content] if isinstance(content, bytes) else content:
            out.write(part)
    return uri


def read_file(uri: str) -> bytes:
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as source:
        return source.read()


def read_at(uri: str, offset: int, length: int) -> bytes:
    """``length`` bytes from ``offset``; from the end where ``offset`` is negative."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as source:
        return source.read_at(length, offset if offset >= 0 else source.size() + offset)
