"""Random reads of files for data sources whose tasks need parts of a file: by the scheme of the path, local or a store that pyarrow knows."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs


def opened(path: str) -> pa.NativeFile:
    """A file that can be sought and read."""
    store, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(inner)


def part(file: pa.NativeFile, at: int, size: int) -> bytes:
    file.seek(at)
    found = file.read(size)
    if len(found) != size:
        raise EOFError(f"{size} bytes at {at} asked for, {len(found)} found")
    return found


def listed(path: str, ending: str) -> list[str]:
    """The path itself, or what a folder or a path with * in its last part holds, in order."""
    import fnmatch

    head, _, tail = path.rpartition("/")
    scheme = path[: path.index("://") + 3] if "://" in path else ""
    store, inner = fs.FileSystem.from_uri(path.rpartition("/")[0] if "*" in tail else path) if scheme or path.startswith("file:") else (fs.LocalFileSystem(), head if "*" in tail else path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    pattern = tail if "*" in tail else f"*{ending}"
    found = sorted(f.path for f in store.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern))
    return [("file://" if scheme.startswith("file") else scheme) + f for f in found]
