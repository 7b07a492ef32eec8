"""Files of shared storage, opened by tasks: by URI, without Spark's file sources around them."""

from __future__ import annotations

from pyarrow import fs


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a local path; the same on the driver and in tasks."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
