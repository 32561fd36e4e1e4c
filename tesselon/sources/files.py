"""Files by path or URI with random access, for data sources whose tasks open them where they run."""

from __future__ import annotations

import fnmatch
from typing import Any

from pyarrow import fs


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def open_file(path: str) -> Any:
    system, inner = _system(path)
    return system.open_input_file(inner)


def matching(pattern: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files whose name matches, or of those in a folder (hidden ones left out); the pattern's
    folder is taken as written."""
    system, inner = _system(pattern)
    folder, _, name = pattern.rstrip("/").rpartition("/")
    if not set(name) & set("*?[") and system.get_file_info(inner).type == fs.FileType.Directory:
        folder, name = pattern.rstrip("/"), "[!._]*"
    system, inner = _system(folder)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted((f"{folder}/{f.base_name}", f.size) for f in found if f.is_file and fnmatch.fnmatchcase(f.base_name, name))
