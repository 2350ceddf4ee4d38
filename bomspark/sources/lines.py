"""The line scan of landing drops: every line of every file, with its position.

Spark's text and CSV readers leave out names that begin with ``_`` or ``.``, do
not say where in its file a line stands, and drop blank lines together with
the header.  Here a drop is listed once, its files are cut into ranges of
bytes as Spark cuts them (``spark.sql.files.maxPartitionBytes`` and
``openCostInBytes``), and tasks turn each range into Arrow batches of

    file   number of the file in the listing
    at     byte position of the line in its file
    value  the line, without its end (\\n, \\r or \\r\\n) and double quotes
    plain  no line of the batch had quotes or control characters

with array operations, no Python per line.  A double quote anywhere in a line switches
quoting (S3): quotes are taken out, and as a line holds no line break, \\n stands
for a quoted | and \\r for a quoted comma until the line has been split.  A line belongs to the range in which
it begins, so a range reads on to the end of its last line.  The header is the line
at the position that the header pass found; everything behind it is data,
blank lines included.

A file system that Python cannot open is read by Spark's text reader, whose
lines are numbered from the start of their block; such names are then refused.
"""

from __future__ import annotations

import fnmatch
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import first_line
from .first_line import opens, store_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_GLOB = "*.[cC][sS][vV]"
#: Bytes that a task reads at a time.
CHUNK = 4 << 20

Paths = "str | list[str] | Drop"

# ``_metadata.file_path`` is URI-encoded (space -> %20, % -> %25, '+' kept); '+' is
# protected first because URL decoding would turn it into a space.
FILE_PATH_SQL = "try_url_decode(replace(_metadata.file_path, '+', '%2B'))"


@dataclass(frozen=True)
class File:
    number: int
    path: str
    size: int
    modified_ns: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


@dataclass(frozen=True)
class Drop:
    """The files of a landing drop, listed once; the driver holds their names, as
    it does for any file scan."""

    spark: SparkSession
    files: tuple[File, ...]
    #: what Spark's readers are handed, if Python cannot open the file system
    sources: tuple[str, ...] | None = None
    glob: str = CSV_GLOB

    def only(self, test: Callable[[str], bool]) -> Drop:
        """The files whose names pass, under the same numbers."""
        return replace(self, files=tuple(f for f in self.files if test(f.name)))


# ------------------------------------------------------------------ listing

def _uri(folder: str) -> str:
    """A folder's URI as Spark spells it: local ones as ``file:/...``."""
    if folder.startswith("file:"):
        return "file:/" + folder[5:].lstrip("/")
    return folder if ":" in folder.split("/", 1)[0] else f"file:{folder}"


def _expanded(spark: SparkSession, pattern: str) -> list[str]:
    """What a path pattern stands for."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    return [s.getPath().toString() for s in found]


def _infos(path: str) -> Iterator[tuple[str, pafs.FileInfo]]:
    """(URI, info) of a file, or of what lies directly in a folder."""
    store, at = store_of(path)
    info = store.get_file_info(at)
    if info.type == pafs.FileType.Directory:
        root = _uri(path).rstrip("/")
        for i in store.get_file_info(pafs.FileSelector(at)):
            yield f"{root}/{i.base_name}", i
    else:
        yield _uri(path), info


def list_drop(spark: SparkSession, paths: Paths, glob: str = CSV_GLOB) -> Drop:
    """The regular files of a folder, a path pattern or a list of files whose names
    match, whatever they begin with, in order of their paths."""
    if isinstance(paths, Drop):
        return paths
    if isinstance(paths, str) and not opens(paths or "/"):
        return _native_drop(spark, paths, glob)
    if isinstance(paths, str) and re.search(r"[*?\[{]", paths) and not _is_folder(paths):
        paths = _expanded(spark, paths)
    elif isinstance(paths, str):
        if store_of(paths)[0].get_file_info(store_of(paths)[1]).type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"no landing drop at {paths}")
        paths = [paths]
    elif paths and not opens(paths[0]):
        return _native_drop(spark, paths, glob)
    found = {}
    for path in paths:
        for uri, info in _infos(path):
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(uri)
            if info.is_file and fnmatch.fnmatchcase(info.base_name, glob):
                found[uri] = info
    return Drop(spark, tuple(File(i, p, found[p].size or 0, found[p].mtime_ns or 0)
                             for i, p in enumerate(sorted(found))), glob=glob)


def _is_folder(path: str) -> bool:
    store, at = store_of(path)
    return store.get_file_info(at).type == pafs.FileType.Directory


def _literal(path: str) -> str:
    """A path that the readers, which expand glob patterns, take literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _native_drop(spark: SparkSession, paths: str | list[str], glob: str) -> Drop:
    sources = [paths] if isinstance(paths, str) else [_literal(p) for p in paths]
    # every name has to be listed here, as the readers would silently leave some out
    hadoop = spark._jvm.org.apache.hadoop.fs
    hidden = []
    for path in [f"{paths.rstrip('/')}/[_.]*"] if isinstance(paths, str) else sources:
        at = hadoop.Path(path)
        found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
        hidden += [s.getPath().getName() for s in found if s.isFile()]
    hidden = [n for n in hidden if n[:1] in ("_", ".") and fnmatch.fnmatchcase(n, glob)]
    if hidden:
        raise ValueError("Spark's readers leave out names that begin with '_' or '.': "
                         + ", ".join(sorted(hidden)[:20]))
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(sources)
               .select("path", "length", "modificationTime").orderBy("path").collect())
    return Drop(spark, tuple(File(i, r["path"], r["length"],
                                  int(r["modificationTime"].timestamp() * 1e9))
                             for i, r in enumerate(listing)), tuple(sources), glob)


def file_rows(drop: Drop) -> DataFrame:
    """(file, path, length, modificationTime) of a drop, a table of its own."""
    table = pa.table({
        "file": pa.array([f.number for f in drop.files], pa.int32()),
        "path": pa.array([f.path for f in drop.files], pa.string()),
        "length": pa.array([f.size for f in drop.files], pa.int64()),
        "modificationTime": pa.array([f.modified_ns // 1000 for f in drop.files],
                                     pa.timestamp("us", "UTC"))})
    return _local(drop.spark, table)


def _local(spark: SparkSession, table: pa.Table) -> DataFrame:
    if table.num_rows:
        return spark.createDataFrame(table)
    from pyspark.sql.pandas.types import from_arrow_schema
    return spark.createDataFrame([], from_arrow_schema(table.schema))


# ------------------------------------------------------------------ ranges

def bytes_setting(spark: SparkSession, key: str) -> int:
    """A setting that is a size; below zero stands for none."""
    value = spark.conf.get(key)
    if value.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def _groups(drop: Drop) -> list[list[tuple[int, str, int, int]]]:
    """Ranges (file, path, start, end) of all files, several small ones to a task, by the
    rule of Spark's file scans."""
    cost = bytes_setting(drop.spark, "spark.sql.files.openCostInBytes")
    most = bytes_setting(drop.spark, "spark.sql.files.maxPartitionBytes")
    cores = drop.spark.sparkContext.defaultParallelism
    total = sum(f.size + cost for f in drop.files)
    each = max(1, min(most, max(cost, total // cores)))
    ranges = [(f.number, f.path, at, min(at + each, f.size))
              for f in drop.files for at in range(0, f.size, each)]
    ranges.sort(key=lambda r: r[2] - r[3])                   # longest first
    groups, held, size = [], [], 0
    for r in ranges:
        if held and size + r[3] - r[2] > each:
            groups.append(held)
            held, size = [], 0
        held.append(r)
        size += r[3] - r[2] + cost
    return groups + [held] if held else groups


_RANGE = pa.struct([("file", pa.int32()), ("path", pa.string()), ("start", pa.int64()),
                    ("end", pa.int64())])


def _line_ends(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines end, and where the next ones begin."""
    ends = np.flatnonzero(a == 10)
    if not (a == 13).any():
        return ends, ends + 1
    before = np.concatenate([[0], a[:-1]])
    after = np.concatenate([a[1:], [0]])
    pair = before[ends] == 13                     # \r\n ends where its \r stands
    alone = np.flatnonzero((a == 13) & (after != 10))
    stops = np.concatenate([ends - pair, alone])
    order = np.argsort(stops, kind="stable")
    return stops[order], np.concatenate([ends + 1, alone + 1])[order]


def _unquoted(a: np.ndarray, starts: np.ndarray, stops: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines a[start:stop] with their quoted delimiters replaced and without quotes."""
    quote = a == 34
    before = np.concatenate([[0], np.cumsum(quote)])        # quotes in front of a byte
    delimiters = np.flatnonzero((a == 124) | (a == 44))
    line = np.maximum(np.searchsorted(starts, delimiters, "right") - 1, 0)
    inside = delimiters[(before[delimiters] - before[starts[line]]) % 2 == 1]
    a = a.copy()
    a[inside] = np.where(a[inside] == 124, 10, 13)
    return a[~quote], starts - before[starts], stops - before[stops]


def _batch(number: int, data: bytes | pa.Buffer, starts: np.ndarray, stops: np.ndarray,
           at: np.ndarray) -> pa.RecordBatch:
    """The lines data[start:stop]: every second slot of an array over the buffer, whose
    other slots are the line ends."""
    n = len(starts)
    a = np.frombuffer(data, np.uint8)[starts[0]:stops[-1]]
    ends = int((starts[1:] - stops[:-1]).sum())             # bytes between the lines
    plain = int((a < 32).sum()) == ends
    if (a == 34).any():
        plain, first = False, starts[0]
        a, starts, stops = _unquoted(a, starts - first, stops - first)
        data = a.tobytes()
    bounds = np.empty(2 * n + 1, np.int64)
    bounds[0:-1:2], bounds[1::2] = starts, stops
    bounds[-1] = bounds[-2]
    # slot 2i is starts[i]..stops[i], slot 2i + 1 stops[i]..starts[i + 1]
    slots = pa.LargeStringArray.from_buffers(2 * n, pa.py_buffer(bounds), pa.py_buffer(data))
    value = slots.take(pa.array(np.arange(0, 2 * n, 2))).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number, np.int32)), pa.array(at), value,
         pa.array(np.full(n, plain))], names=["file", "at", "value", "plain"])


def range_lines(number: int, path: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The lines that begin in [start, end) of a file."""
    store, at = store_of(path)
    with store.open_input_file(at) as fh:
        size = fh.size()
        end = min(end, size)
        pos = max(start - 1, 0)
        skipping = start > 0                # up to the first line end from start - 1 on
        parts: list[bytes] = []
        line_at = pos
        while line_at < end:
            chunk = fh.read_at(min(CHUNK, size - pos), pos) if pos < size else b""
            while chunk.endswith(b"\r") and pos + len(chunk) < size:
                chunk += fh.read_at(1, pos + len(chunk))      # never between \r and \n
            base, pos = pos, pos + len(chunk)
            stops, nexts = _line_ends(np.frombuffer(chunk, np.uint8))
            if not chunk:                         # the last line has no end
                if not skipping and line_at < size:
                    data = b"".join(parts)
                    yield _batch(number, data, np.zeros(1, np.int64),
                                 np.array([len(data)]), np.array([line_at]))
                return
            if not len(stops):
                parts.append(b"" if skipping else chunk)
                continue
            if skipping:
                skipping, parts = False, []
                line_at = base + int(nexts[0])
                chunk, base = chunk[int(nexts[0]):], line_at
                stops, nexts = stops[1:] - nexts[0], nexts[1:] - nexts[0]
            held = b"".join(parts)
            data = held + chunk if held else chunk
            stops, nexts, base = stops + len(held), nexts + len(held), base - len(held)
            starts = np.concatenate([[0], nexts[:-1]]) if len(nexts) else nexts
            own = int(np.searchsorted(base + starts, end))
            if own:
                yield _batch(number, data, starts[:own], stops[:own], base + starts[:own])
            last = int(nexts[-1]) if len(nexts) else 0
            parts, line_at = [data[last:]], base + last


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for ranges in b.column(0).to_pylist():
            for r in ranges:
                yield from range_lines(r["file"], r["path"], r["start"], r["end"])


LINE_SCHEMA = "file int, at long, value string, plain boolean"


LINE_NAMES = ("file", "at", "value", "plain")


def lines(drop: Drop) -> DataFrame:
    """(file, at, value, plain) of every line of the drop."""
    if drop.sources is not None:
        return _native_lines(drop)
    groups = _groups(drop)
    table = pa.table({
        "task": pa.array(range(len(groups)), pa.int32()),
        "ranges": pa.array([[dict(zip(("file", "path", "start", "end"), r)) for r in g]
                            for g in groups], pa.list_(_RANGE))})
    dealt = _local(drop.spark, table).repartitionById(max(len(groups), 1), "task")
    return dealt.select("ranges").mapInArrow(_read_ranges, LINE_SCHEMA)


def _native_lines(drop: Drop) -> DataFrame:
    """The same from Spark's text reader, for file systems that Python cannot open: lines
    are numbered within their block, whose start precedes the number."""
    files = drop.spark.createDataFrame([(f.path, f.number) for f in drop.files],
                                       "path string, file int")
    text = (drop.spark.read.option("pathGlobFilter", drop.glob).text(list(drop.sources))
            .select("value", F.expr(FILE_PATH_SQL).alias("path"),
                    F.col("_metadata.file_block_start").alias("block")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, 0
        for b in batches:
            at = []
            for key in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                now, count = key, count + 1 if key == now else 0
                at.append(key[1] + count)     # a line takes a byte at least
            if at:
                value = b.column(0).cast(pa.large_string())
                bounds = np.frombuffer(value.buffers()[1], np.int64)[
                    value.offset:value.offset + len(value) + 1]
                own = _batch(0, value.buffers()[2] or b"", bounds[:-1], bounds[1:], np.array(at))
                yield pa.RecordBatch.from_arrays([b.column(1), *own.columns[1:]],
                                                 names=["path", *LINE_NAMES[1:]])
    return (text.mapInArrow(run, LINE_SCHEMA.replace("file int", "path string"))
            .join(files, "path").select(*LINE_NAMES))


def first_lines(drop: Drop, skip_blank: bool = False) -> DataFrame:
    """Header pass: (file, path, header, header_at) of every file that has one, its first
    line or the first that is not blank; ``header_at`` is its position."""
    rows = file_rows(drop).select("file", "path")
    schema = "file int, path string, header string, header_at long"
    if drop.sources is None:
        return rows.mapInArrow(first_line.header_batches(skip_blank), schema)
    from ..functions.text import java_trim, strip_bom
    own = lines(drop)
    if skip_blank:
        own = own.where(java_trim(strip_bom("value")) != "")
    heads = own.groupBy("file").agg(strip_bom(F.min_by("value", "at")).alias("header"),
                                    F.min("at").alias("header_at"))
    return rows.join(heads, "file").select("file", "path", "header", "header_at")
