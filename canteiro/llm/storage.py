"""Files that tasks write to and read from the folder that all executors share.

A task names its file after itself and a random part, and returns the name as a row. Only files named in the rows
that Spark has committed count; a lost or repeated attempt leaves a file that nobody reads.
"""

from __future__ import annotations

import uuid

from pyarrow import NativeFile, fs


def new_file(folder: str, part: int, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{part:06d}-{uuid.uuid4().hex}{suffix}"


def _found(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Hadoop's names of the S3 scheme are one."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri.removeprefix(scheme)
    return fs.FileSystem.from_uri(uri)


def opened_for_writing(uri: str) -> NativeFile:
    system, path = _found(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def opened_for_reading(uri: str) -> NativeFile:
    """A file that can be read at any place."""
    system, path = _found(uri)
    return system.open_input_file(path)
