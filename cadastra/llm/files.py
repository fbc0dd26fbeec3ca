"""Binary files in the folder that the driver and all executors share."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)
