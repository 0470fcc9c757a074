"""Files of any size in the shared folder, read and written by tasks through Arrow's file systems."""

from __future__ import annotations

from contextlib import contextmanager

from pyarrow import fs


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def written(folder: str, name: str, attempt: str):
    """A file that appears under its name only once it is whole; a repeated attempt of a task replaces it by its own."""
    system, path = open_uri(folder)
    system.create_dir(path, recursive=True)
    system.create_dir(f"{path}/_attempts", recursive=True)
    part = f"{path}/_attempts/{attempt}-{name}"
    with system.open_output_stream(part, compression=None) as stream:
        yield stream
    system.move(part, f"{path}/{name}")
