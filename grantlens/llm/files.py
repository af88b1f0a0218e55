"""Files that tasks write and read themselves, on any file system that all of them reach."""

import pyarrow.fs as pafs


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address, and the path on it."""
    if ":/" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder
