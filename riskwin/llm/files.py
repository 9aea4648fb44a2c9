"""Binary files in the folder that all executors share."""

from __future__ import annotations

import re

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, for a path as Spark writes it."""
    path = re.sub(r"^file:/+", "file:///", path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)
