"""Files in a place that all workers share: a mount, HDFS or an object store."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared place."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return pafs.LocalFileSystem(), uri


def publish(uri: str, chunks: Iterable[bytes]) -> int:
    """Write chunks to a private name, then move the finished file into place.

    A repeated or speculative task replaces the file with equal bytes, so
    readers never see a part of one. Returns the number of bytes.
    """
    store, path = opened(uri)
    private = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(private, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(private, path)
    return size
