"""Task-side reader of each landing file's header: its first line.

A scan cannot stop after one line per file, so a header pass over a scan would
read all the data once more.  This reader runs in the tasks over the file
*listing* and reads only up to the line's end, at most ``MAX_HEADER`` bytes,
through pyarrow's file systems (local and shared folders, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 16
#: A header longer than this is an error, not a reason to load the file.
MAX_HEADER = 1 << 20
_TOO_LONG = "the first line of {} is longer than {} bytes"


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    scheme = uri.split(":", 1)[0] if ":" in uri.split("/", 1)[0] else "file"
    if scheme == "file":
        path = uri[5:] if uri.startswith("file:") else uri
        return pafs.LocalFileSystem(), "/" + path.lstrip("/")
    root, _, rest = uri.partition("://")
    store, path = pafs.FileSystem.from_uri(f"{root}://{rest.split('/', 1)[0]}/")
    return store, f"{path.rstrip('/')}/{rest.split('/', 1)[-1]}"


def opens(uri: str) -> bool:
    """Can Python open files of this file system?"""
    try:
        store_of(uri)
        return True
    except (OSError, ValueError):      # Arrow's errors are among these
        return False


def read_header(uri: str, skip_blank: bool = False) -> tuple[str | None, int]:
    """First line as Java's ``readLine`` sees it (ends at \\n, \\r or \\r\\n), or the
    first that is not blank, and its position in the file; None for a file
    without one. A leading byte-order mark is removed."""
    store, path = store_of(uri)
    held, at, at_end = b"", 0, False
    with store.open_input_stream(path) as fh:
        while True:
            ends = [i for i in (held.find(b"\n"), held.find(b"\r")) if i >= 0]
            if ends or at_end:
                cut = min(ends, default=len(held))
                if cut > MAX_HEADER:
                    raise ValueError(_TOO_LONG.format(uri, MAX_HEADER))
                line = held[:cut].decode("utf-8", errors="replace").lstrip("﻿")
                blank = not line.strip("".join(map(chr, range(33))))
                if not held or not (skip_blank and blank):
                    return (line if held else None), at
                held, at = held[cut + 1:], at + cut + 1
                if not held and at_end:
                    return None, at
                continue
            if len(held) > MAX_HEADER:
                raise ValueError(_TOO_LONG.format(uri, MAX_HEADER))
            more = fh.read(CHUNK)
            at_end = not more
            held += more


def read_first_line(uri: str, skip_blank: bool = False) -> str | None:
    return read_header(uri, skip_blank)[0]


def header_batches(skip_blank: bool):
    """mapInArrow body: (file, path) -> (file, path, header, header_at)."""
    def run(batches):
        for b in batches:
            found = [read_header(p, skip_blank) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([h for h, _ in found], pa.string()),
                 pa.array([at for _, at in found], pa.int64())],
                names=["file", "path", "header", "header_at"]).filter(
                    pa.array([h is not None for h, _ in found]))
    return run
