"""Zipped point clouds as a data source (S7, S8): a partition for each member, unpacked as a stream.

Archives are opened by Arrow's file systems and only their directory and the member's own bytes are read, so neither an
archive nor a member has to fit into memory, whatever its size; a member can't be split, as its packing can't.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes that are unpacked and handed on at a time.
BLOCK = 4 << 20
_SCHEMA = "path string, member string, value string"


def _open(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def line_blocks(stream, size: int = BLOCK) -> Iterator[list[str]]:
    """The lines of a binary stream, those of about ``size`` bytes at a time."""
    rest = b""
    while block := stream.read(size):
        *lines, rest = (rest + block).split(b"\n")
        if lines:
            yield [x.decode("utf-8", "replace").rstrip("\r") for x in lines]
    if rest:
        yield [rest.decode("utf-8", "replace").rstrip("\r")]


@dataclass
class Member(InputPartition):
    path: str
    member: str

    def __init__(self, path: str, member: str):
        self.path, self.member = path, member


class ArchiveLines(DataSource):
    """Format ``zip_lines``: (path, member, value), a row a line. Options: paths (JSON list), suffix, every (all members or the first), block."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths: list[str] = json.loads(options["paths"])
        self.suffix, self.every, self.block = options.get("suffix", ""), options.get("every", "false") == "true", int(options.get("block", BLOCK))

    def partitions(self) -> list[Member]:
        out = []
        for path in self.paths:
            with _open(path) as f, zipfile.ZipFile(f) as z:
                names = [n for n in z.namelist() if n.lower().endswith(self.suffix) and not n.endswith("/")]
            out += [Member(path, n) for n in (names if self.every else names[:1])]
        return out or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with _open(partition.path) as f, zipfile.ZipFile(f) as z, z.open(partition.member) as lines:
            for block in line_blocks(lines, self.block):
                n = len(block)
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * n), pa.array([partition.member] * n), pa.array(block)], names=["path", "member", "value"])


def read_archive_lines(spark: SparkSession, path: str, suffix: str = "", every: bool = True, block: int = BLOCK) -> DataFrame:
    """(path, member, value) of the text members whose name ends in ``suffix`` in any case; of each archive all or the first one.

    ``path`` may be a folder or pattern. Bytes that are no UTF-8 are replaced. No archive gives no rows.
    """
    spark.dataSource.register(ArchiveLines)
    paths = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect()]
    return spark.read.format("zip_lines").option("paths", json.dumps(paths)).option("suffix", suffix.lower()).option("every", str(every).lower()).option("block", block).load()


def write_archives(df: DataFrame, path: str, member: str = "points.xyz") -> list[str]:
    """Each partition of (value string) as an archive of one text member below ``path``; the archives' names.

    An archive appears under its name once it is whole; a task that runs again replaces its own.
    """

    def run(batches):
        from pyspark import TaskContext

        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name, part = f"{folder}/part-{task.partitionId():05}.zip", f"{folder}/.part-{task.partitionId():05}-{task.taskAttemptId()}"
        rows = 0
        with system.open_output_stream(part) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(member, "w", force_zip64=True) as f:
            text = io.TextIOWrapper(f, "utf-8", newline="\n")
            for b in batches:
                for line in b.column(0).to_pylist():
                    text.write(f"{line or ''}\n")
                    rows += 1
            text.flush()
            text.detach()
        system.move(part, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.int64())], names=["name", "rows"])

    return sorted(r["name"] for r in df.select("value").mapInArrow(run, "name string, rows long").collect())
