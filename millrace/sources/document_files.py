"""A data source of one file per document: ``<path>/<split>/<label>/<doc_id>``.

Spark's own writers make a directory for each value of a partition column; here a task writes all
its documents as files of existing directories. A file is written under a temporary name and then
renamed, so it is whole or absent, and a task that runs again replaces its own files. When
all tasks are done the driver leaves a ``_SUCCESS`` file; if the job fails, what its finished tasks wrote is
deleted. The reader packs files into tasks by their bytes. Paths are local or of any file system
that Arrow knows by its scheme; names are escaped as in URLs, and ids must be unique.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = "split string, label string, doc_id string, text string"

#: Bytes of files that one task reads, where each file counts for at least ``OPEN_BYTES``.
TASK_BYTES = 64 << 20
OPEN_BYTES = 16 << 10
_ROWS = 512


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _name(value: str) -> str:
    """A file name for any text; none begins like the names that readers pass over."""
    if not value:
        raise ValueError("an empty split, label or id has no place in the tree")
    escaped = quote(value, safe="")
    return f"%{ord(value[0]):02X}{escaped[1:]}" if value[0] in "._" else escaped


@dataclass
class Written(WriterCommitMessage):
    files: int
    folders: tuple[str, ...]
    attempt: str


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = located(self.path)
        attempt, made, files = uuid.uuid4().hex, set(), 0
        for batch in iterator:
            columns = [batch.column(name) for name in ("split", "label", "doc_id", "text")]
            for split, label, doc_id, text in zip(*columns, strict=True):
                if not (split.is_valid and label.is_valid and doc_id.is_valid):
                    raise ValueError("a document without split, label or id has no place in the tree")
                folder = f"{root}/{_name(split.as_py())}/{_name(label.as_py())}"
                if folder not in made:
                    where.create_dir(folder)
                    made.add(folder)
                name = _name(doc_id.as_py())
                hidden = f"{folder}/.{name}.{attempt}"
                with where.open_output_stream(hidden) as out:
                    if text.is_valid:
                        out.write(text.as_buffer())
                where.move(hidden, f"{folder}/{name}")
                files += 1
        return Written(files, tuple(sorted(made)), attempt)

    def commit(self, messages: list[Written | None]) -> None:
        where, root = located(self.path)
        where.create_dir(root)
        with where.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """The tree is new (an existing one is refused), so all of it belongs to the failed job."""
        where, root = located(self.path)
        if where.get_file_info(root).type == fs.FileType.Directory:
            where.delete_dir(root)


@dataclass
class Pack(InputPartition):
    names: list[str]


class FilesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Pack]:
        where, root = located(self.path)
        packs: list[Pack] = []
        room = 0
        for info in where.get_file_info(fs.FileSelector(root, recursive=True)):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")):
                continue
            size = max(info.size, OPEN_BYTES)
            if not packs or size > room:
                packs.append(Pack([]))
                room = TASK_BYTES
            packs[-1].names.append(info.path)
            room -= size
        return packs

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        where, _ = located(self.path)
        for begin in range(0, len(partition.names), _ROWS):
            rows: list[tuple] = []
            for name in partition.names[begin : begin + _ROWS]:
                with where.open_input_stream(name) as file:
                    rows.append((*(unquote(part) for part in name.split("/")[-3:]), file.read()))
            split, label, doc_id, text = zip(*rows, strict=True)
            columns = [*(pa.array(c, pa.string()) for c in (split, label, doc_id)), pa.array(text, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["split", "label", "doc_id", "text"])


class DocumentFiles(DataSource):
    """Format ``document_files`` with the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        path = self.options["path"]
        where, root = located(path)
        if where.get_file_info(root).type != fs.FileType.NotFound:
            raise ValueError(f"{path} exists")
        return FilesWriter(path)


def write_document_tree(docs: DataFrame, path: str) -> None:
    """Write ``split, label, doc_id, text`` as one file each; a null text is an empty file."""
    docs.sparkSession.dataSource.register(DocumentFiles)
    columns = [F.col(c).cast("string").alias(c) for c in ("split", "label", "doc_id", "text")]
    docs.select(*columns).write.format("document_files").mode("append").save(path)


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_document_tree` wrote, or any tree of that shape; texts are UTF-8."""
    spark.dataSource.register(DocumentFiles)
    return spark.read.format("document_files").load(path)
