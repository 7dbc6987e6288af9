"""Folders of photo files as a data source, for reading and writing.

Reading: the folder is listed by the tasks. Each task looks at the top level, keeps the entries whose name hashes to its
number, and walks down into the folders among them, so every file below a sub-folder is listed once.

Writing: each task attempt writes its files into a folder of its own below `_temporary`. When the whole job has
succeeded, the driver moves one folder for each task into place, `part-<job>-<n>`; files of failed attempts and
of failed jobs are deleted and never seen. The driver makes the job's folder before the tasks begin, and tasks make none
above their own: an attempt that outlives its job fails instead of bringing back what was deleted. Folders whose names begin with `_` or `.` are not read.

Both reach the folder by `pyarrow.fs`, as a path or a URI that every executor can open.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "photo_folder"
SCHEMA = "path string, photo_file string, length bigint, content binary"
TEMPORARY = "_temporary"
#: Bytes of files that a task hands over at once.
BATCH_BYTES = 32 << 20
PARTITIONS = 16
CLEAN_TRIES = 20


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _visible(name: str) -> bool:
    return not name.startswith(("_", "."))


@dataclass
class Share(InputPartition):
    number: int
    of: int

    def __post_init__(self):
        super().__init__(self.number)

    def holds(self, name: str) -> bool:
        return zlib.crc32(name.encode()) % self.of == self.number


class PhotoReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.shares = int(options.get("partitions", PARTITIONS))
        self.extensions = tuple(e.lower() for e in options.get("extensions", "").split(",") if e)
        self.contents = options.get("contents", "true").lower() == "true"

    def partitions(self):
        return [Share(i, self.shares) for i in range(self.shares)]

    def files(self, store: fs.FileSystem, folder: str, share: Share) -> Iterator[fs.FileInfo]:
        for entry in store.get_file_info(fs.FileSelector(folder)):
            if not (_visible(entry.base_name) and share.holds(entry.base_name)):
                continue
            if entry.type != fs.FileType.Directory:
                yield entry
                continue
            below = [entry.path]
            while below:
                for inner in store.get_file_info(fs.FileSelector(below.pop())):
                    if not _visible(inner.base_name):
                        continue
                    if inner.type == fs.FileType.Directory:
                        below.append(inner.path)
                    else:
                        yield inner

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(self.path)
        names = ["path", "photo_file", "length", "content"]
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for entry in self.files(store, folder, share):
            if self.extensions and not entry.base_name.lower().endswith(self.extensions):
                continue
            content = None
            if self.contents:
                with store.open_input_stream(entry.path) as stream:
                    content = stream.read()
            rows.append((entry.path, entry.base_name, entry.size, content))
            size += 200 + len(content or b"")
            if size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: int


class PhotoWriter(DataSourceArrowWriter):
    """Rows `photo_file, content` as files; a name may have folders in it, which stay below the task's own."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.job = uuid.uuid4().hex
        store, root = open_folder(self.path)
        store.create_dir(f"{root}/{TEMPORARY}/{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = open_folder(self.path)
        folder = f"{root}/{TEMPORARY}/{self.job}/{uuid.uuid4().hex}"
        seen: set[str] = set()
        for batch in iterator:
            for name, content in zip(batch.column("photo_file").to_pylist(), batch.column("content")):
                if not name or ".." in name.split("/") or name.startswith("/"):
                    raise ValueError(f"not a file name: {name!r}")
                if content.as_py() is None:
                    raise ValueError(f"no content for {name!r}")
                if name in seen:
                    raise ValueError(f"two files are named {name!r}")
                if not seen:
                    store.create_dir(folder, recursive=False)
                seen.add(name)
                for i in (i for i, sign in enumerate(name) if sign == "/"):
                    store.create_dir(f"{folder}/{name[:i]}", recursive=False)
                with store.open_output_stream(f"{folder}/{name}") as out:
                    out.write(content.as_py())
        return Written(folder, len(seen))

    def commit(self, messages: list[Written | None]) -> None:
        store, root = open_folder(self.path)
        store.create_dir(root)
        if self.overwrite:
            for entry in store.get_file_info(fs.FileSelector(root)):
                if entry.type == fs.FileType.Directory and entry.base_name.startswith("part-"):
                    store.delete_dir(entry.path)
        for i, message in enumerate(m for m in messages if m is not None and m.files):
            store.move(message.folder, f"{root}/part-{self.job[:8]}-{i:05d}")
        self._clean(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = open_folder(self.path)
        self._clean(store, root)

    def _clean(self, store: fs.FileSystem, root: str) -> None:
        """Delete what this job has left behind, and the folder of all jobs if no other one is writing."""
        temporary = f"{root}/{TEMPORARY}"
        for left in reversed(range(CLEAN_TRIES)):
            if store.get_file_info(f"{temporary}/{self.job}").type != fs.FileType.Directory:
                break
            try:
                store.delete_dir(f"{temporary}/{self.job}")
            except OSError:  # a killed attempt may have added a file meanwhile
                if not left:
                    raise
        if store.get_file_info(temporary).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(temporary)):
            store.delete_dir(temporary)


class PhotoFolder(DataSource):
    """Options: `path`; for reading `partitions`, `extensions` (comma-separated) and `contents` (`false` leaves them null)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PhotoReader:
        return PhotoReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> PhotoWriter:
        return PhotoWriter(self.options, overwrite)


def read_folder(
    spark: SparkSession, folder: str, extensions: tuple[str, ...] = (), contents: bool = True, partitions: int = PARTITIONS
) -> DataFrame:
    """`path, photo_file, length, content` of the files in a folder and the folders below it."""
    spark.dataSource.register(PhotoFolder)
    return (
        spark.read.format(FORMAT).option("partitions", partitions).option("extensions", ",".join(extensions))
        .option("contents", str(contents).lower()).load(folder)
    )


def write_folder(files: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Write `photo_file, content` as files below `folder`; all of them, or none if the job fails.

    A name that comes twice in one task ends the job; the rows are not brought together to look for others.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    files.sparkSession.dataSource.register(PhotoFolder)
    rows = files.select("photo_file", F.col("content").cast("binary").alias("content"))
    rows.write.format(FORMAT).mode(mode).save(folder)
