"""One file per document, created and never written over: a sink for texts and tables that people fetch one by one.

Rows (name, content) of one name, side by side, become the file ``name`` of a mounted folder all executors share. A file
is written in a folder of the job and then linked to its name, which fails where the name is taken; so a reader sees
whole files only, and a task that runs again after a lost executor knows the files of its job (the same file under two
names) from those of others. If the job fails, the links it made go; if it ends, only the folder of the job goes.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

FORMAT = "document_files"
#: What goes on from a task that reads at once.
FILES_AT_ONCE, BYTES_AT_ONCE = 2048, 8 << 20


@dataclass
class Written(WriterCommitMessage):
    files: int


class DocumentFilesWriter(DataSourceWriter):
    def __init__(self, folder: str, job: str, head: str = "") -> None:
        self.folder, self.parts, self.head = folder, os.path.join(folder, f".{job}"), head.encode()

    def _publish(self, written: str, name: str) -> None:
        own, final = os.path.join(self.parts, name), os.path.join(self.folder, name)
        try:
            os.link(written, own)
        except FileExistsError:
            pass  # a former attempt of this task had written all of it
        os.unlink(written)
        try:
            os.link(own, final)
        except FileExistsError:
            if not os.path.samefile(own, final):
                raise FileExistsError(f"{final} exists and is not written over") from None

    def write(self, iterator: Iterator[Row]) -> Written:
        drafts = os.path.join(self.parts, ".drafts")
        os.makedirs(drafts, exist_ok=True)
        file, draft, current = None, os.path.join(drafts, uuid.uuid4().hex), None
        seen: set[str] = set()
        try:
            for row in iterator:
                if file is None or row["name"] != current:
                    if file is not None:
                        file.close()
                        self._publish(draft, current)
                    current = row["name"]
                    if not current or current in seen or current.startswith(".") or os.path.basename(current) != current:
                        raise ValueError(f"not the name of one file of its own: {current!r}")
                    seen.add(current)
                    file = open(draft, "wb")
                    file.write(self.head)
                content = row["content"]
                file.write(content.encode() if isinstance(content, str) else bytes(content or b""))
            if file is not None:
                file.close()
                self._publish(draft, current)
        finally:
            if file is not None:
                file.close()
        return Written(len(seen))

    def commit(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[Written | None]) -> None:
        if os.path.isdir(self.parts):
            for entry in os.scandir(self.parts):
                final = os.path.join(self.folder, entry.name)
                if entry.is_file() and os.path.exists(final) and os.path.samefile(entry.path, final):
                    os.unlink(final)
        shutil.rmtree(self.parts, ignore_errors=True)


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DocumentFilesWriter:
        if overwrite:
            raise ValueError("files that exist are never written over: append")
        return DocumentFilesWriter(self.options["path"], self.options["job"], self.options.get("head", ""))


def write_document_files(df: DataFrame, folder: str, name: Column, content: Column, order: Column | None = None, head: str = "") -> None:
    """The files of a folder (made if it is not there), one per ``name``: ``head``, then its rows' ``content`` by ``order``.

    Any name that exists already, or is no plain file name, fails the job, and none of its files stay.
    """
    spark = df.sparkSession
    spark.dataSource.register(DocumentFiles)
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    rows = df.select(name.alias("name"), content.alias("content"), (order if order is not None else F.lit(0)).alias("_order"))
    sorted_ = rows.repartition("name").sortWithinPartitions("name", "_order").select("name", "content")
    sorted_.write.format(FORMAT).mode("append").option("path", folder).option("job", uuid.uuid4().hex).option("head", head).save()


def read_document_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a mounted folder as (file, content): path and bytes. Those of a job at work and folders in it are left out.

    Each task lists the folder and reads the names whose hash is its own, so neither a list of millions of names nor a
    task for every few files falls to the driver.
    """
    folder, tasks = folder.removeprefix("file:"), 2 * spark.sparkContext.defaultParallelism

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (n for batch in batches for n in batch.column(0).to_pylist()):
            files, contents, size = [], [], 0
            for entry in os.scandir(folder):
                if zlib.crc32(os.fsencode(entry.name)) % tasks != own or entry.name.startswith(".") or not entry.is_file():
                    continue
                with open(entry.path, "rb") as file:
                    contents.append(file.read())
                files.append(entry.path)
                size += len(contents[-1])
                if len(files) == FILES_AT_ONCE or size > BYTES_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(contents, pa.binary())], ["file", "content"])
                    files, contents, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(contents, pa.binary())], ["file", "content"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(read, "file string, content binary")
