"""Container log files that grow and rotate, as a streaming source.

``spark.readStream.format("container_tail").load(path)`` after
``register(spark)``. The offset is a map file id -> byte position, so lines
appended after a run arrive in the next one, and the checkpoint is the
shipper's position store. The source needs no state of its own: everything is
read off the files.

* A file's id is its folder and the digest of its first whole line (of its
  first 64 KiB, if that is longer). A renamed file keeps its id, so what was
  appended before a rotation is still read from its position; a file truncated
  and written anew has another first line, hence another id, read from 0. One
  that begins with the same line and is shorter than before starts at 0 too.
* A copy made for rotation and its original have one id while both hold the
  same text; the longer one is read.
* A live file (``*.log``) ends at its last newline; the unfinished line waits.
  A rotated one (``*.log.1``, ``*.log-2024...``) ends at its last byte.
* ``file`` is the live name, whichever name a file has now. ``block_start``
  orders the lines of that name: rotated files first, by age, then by byte.
* A batch that is planned again after a rotation finds its files by id.
  Lines that are gone fail the batch instead of being skipped.

Big ranges are cut into parts of ``partitionBytes`` at line ends. Paths may be
local (a folder that all executors see) or any URI that pyarrow can open.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .containers import SHIPPER_FILES

FORMAT = "container_tail"
SCHEMA = "file string, value string, block_start bigint, line_no bigint"
LIVE = re.compile(r"\.log$")
ROTATED = re.compile(r"^(.*\.log)(?!.*\.(?:gz|zst|bz2|tmp)$)[.-].+$")
ID_BYTES = BLOCK = 1 << 16
BATCH_BYTES = 4 << 20
#: Lines of the g-th file of a name are ordered from g << GENERATION.
GENERATION = 44
_ARROW = pa.schema([("file", pa.string()), ("value", pa.string()), ("block_start", pa.int64()), ("line_no", pa.int64())])


@dataclass
class Range(InputPartition):
    path: str
    id: str
    file: str
    start: int
    end: int
    order: int


class Folder:
    """The log files below a path."""

    def __init__(self, path: str):
        self.uri = path
        self.seen: dict[str, tuple] = {}
        self._open()

    def _open(self) -> None:
        self.fs, self.root = (pafs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("file:")
                              else (pafs.LocalFileSystem(), self.uri))

    def __getstate__(self):
        return {"uri": self.uri}

    def __setstate__(self, state):
        self.uri, self.seen = state["uri"], {}
        self._open()

    def read(self, path: str, at: int, size: int) -> bytes:
        with self.fs.open_input_file(path) as f:
            f.seek(at)
            return f.read(size)

    def id_of(self, path: str, size: int, final: bool) -> str | None:
        head = self.read(path, 0, min(size, ID_BYTES))
        line, newline, _ = head.partition(b"\n")
        if not newline and len(head) < ID_BYTES and not final:
            return None  # the first line is not finished
        return f"{posixpath.dirname(path)}#{hashlib.sha256(line).hexdigest()[:32]}" if line or newline else None

    def last_line_end(self, path: str, size: int) -> int:
        at = size
        while at > 0:
            low = max(0, at - BLOCK)
            found = self.read(path, low, at - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
        return 0

    def files(self) -> dict[str, dict]:
        """id -> path, live name, end of what can be read now, and place among
        the files of that name."""
        found: dict[str, dict] = {}
        seen = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            path = info.path
            rotated = ROTATED.match(path)
            if not info.is_file or not (LIVE.search(path) or rotated) or re.search(SHIPPER_FILES, rotated[1] if rotated else path):
                continue
            known = (info.size, info.mtime_ns)
            if self.seen.get(path, (None,))[0] == known:
                _, id_, end = self.seen[path]
            else:
                id_ = self.id_of(path, info.size, bool(rotated)) if info.size else None
                end = info.size if rotated else self.last_line_end(path, info.size)
            seen[path] = (known, id_, end)
            if id_ is not None and (id_ not in found or found[id_]["end"] < end):
                found[id_] = {"path": path, "file": rotated[1] if rotated else path, "end": end, "age": (not rotated, info.mtime_ns or 0, path)}
        self.seen = seen
        by_name: dict[str, list] = {}
        for f in found.values():
            by_name.setdefault(f["file"], []).append(f)
        for same in by_name.values():
            for i, f in enumerate(sorted(same, key=lambda f: f["age"])):
                f["order"] = i
        return {k: {c: f[c] for c in ("path", "file", "end", "order")} for k, f in sorted(found.items())}

    def locate(self, part: Range) -> str:
        """Where the file of a range is now."""
        for info in self.fs.get_file_info(pafs.FileSelector(posixpath.dirname(part.path), allow_not_found=True)):
            rotated = bool(ROTATED.match(info.path))
            if info.is_file and info.size >= part.end and (rotated or LIVE.search(info.path)) and self.id_of(info.path, info.size, rotated) == part.id:
                return info.path
        raise RuntimeError(f"{part.path} was removed or truncated before its bytes {part.start} to {part.end} were read")

    def lines(self, part: Range) -> Iterator[tuple[int, bytes]]:
        """(byte position, line) of the lines that begin in the range."""
        path = part.path
        info = self.fs.get_file_info(path)
        if not info.is_file or info.size < part.end or self.id_of(path, info.size, bool(ROTATED.match(path))) != part.id:
            path = self.locate(part)
        with self.fs.open_input_file(path) as f:
            at = part.start
            f.seek(max(0, at - 1))
            held = b""
            if at and f.read(1) != b"\n":  # the line before the range ends in it
                skipped = self._until_newline(f)
                at += skipped
            while at < part.end:
                block = f.read(BLOCK)
                held += block
                *whole, rest = held.split(b"\n")
                for line in whole:
                    if at >= part.end:
                        return
                    yield at, line
                    at += len(line) + 1
                held = rest
                if not block:
                    if held and at < part.end:
                        yield at, held
                    return

    def _until_newline(self, f) -> int:
        skipped = 0
        while block := f.read(BLOCK):
            found = block.find(b"\n")
            if found >= 0:
                f.seek(f.tell() - len(block) + found + 1)
                return skipped + found + 1
            skipped += len(block)
        return skipped


def _ranges(start: dict, end: dict, size: int) -> list[Range]:
    out = []
    for id_, f in sorted(end["files"].items()):
        at = start["files"].get(id_, {}).get("end", 0)
        at = 0 if f["end"] < at else at
        while at < f["end"]:
            to = min(f["end"], at + size)
            out.append(Range(f["path"], id_, f["file"], at, to, f["order"]))
            at = to
    return out


def _read(folder: Folder, part: Range) -> Iterator[pa.RecordBatch]:
    places, lines, held = [], [], 0

    def batch():
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([part.file] * n, pa.string()), pa.array(lines, pa.string()), pa.array(places, pa.int64()), pa.array([0] * n, pa.int64())], schema=_ARROW)

    for at, line in folder.lines(part):
        places.append((part.order << GENERATION) + at)
        lines.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
        held += len(line) + 32
        if held >= BATCH_BYTES:
            yield batch()
            places, lines, held = [], [], 0
    if lines:
        yield batch()


class TailStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, size: int):
        self.folder, self.size = Folder(path), size

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": self.folder.files()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return _ranges(start, end, self.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition)


class TailReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.folder, self.size = Folder(path), size

    def partitions(self) -> list[Range]:
        return _ranges({"files": {}}, {"files": self.folder.files()}, self.size) or [Range("", "", "", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition) if partition.end else iter(())


class ContainerTail(DataSource):
    """Options: ``path``, ``partitionBytes`` (64 MiB)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, int]:
        return self.options["path"].rstrip("/"), int(self.options.get("partitionBytes", 64 << 20))

    def reader(self, schema) -> TailReader:
        return TailReader(*self._options())

    def streamReader(self, schema) -> TailStreamReader:
        return TailStreamReader(*self._options())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ContainerTail)


def tail_container_logs(spark: SparkSession, path: str, stream: bool = True, partition_bytes: int = 64 << 20) -> DataFrame:
    """(file, value, block_start, line_no): every whole line once, what is
    appended and rotated later included; ``stream=False`` reads what is there."""
    register(spark)
    reader = spark.readStream if stream else spark.read
    return reader.format(FORMAT).option("partitionBytes", partition_bytes).load(path)
