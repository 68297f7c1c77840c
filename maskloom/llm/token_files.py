"""Flat token files: unsigned ids, 64-bit offsets of documents, both memory-mapped when read.

A folder holds for each part ``part-<n>-<attempt>.bin`` (ids, little-endian, 16 bit where the
vocabulary allows, else 32), ``.off`` (64-bit offsets of its documents in the part, one more than
documents) and ``.doc`` (their 64-bit doc_ids), and a Parquet table ``manifest`` with a row per part.
Parts are ranges of doc_id; where a part starts in the whole is a prefix sum over the manifest.

Cases: a null text has the end id only; rows with equal doc_id stay, ordered by text; a null doc_id
comes first and reads back as null; an empty table gives no parts and no rows; other columns are
ignored. A lost executor's task writes its part again under a new name; the manifest names the one
that counts.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskloom.llm.store import lean, opened, stored
from maskloom.llm.tokens import encoder

MANIFEST = "part int, file string, width int, n_docs long, n_tokens long"
SPANS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: What stands for a null doc_id in a .doc file.
NO_ID = np.iinfo(np.int64).min


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder`` in doc_id order; gives the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(tokenizer), TaskContext.get().partitionId()
        name, end = f"part-{part:07d}-{uuid.uuid4().hex}", np.array([end_id], words.dtype).tobytes()
        system, inner = opened(folder)
        system.create_dir(inner, recursive=True)
        docs_n = tokens_n = 0
        with (
            system.open_output_stream(f"{inner}/{name}.bin") as ids,
            system.open_output_stream(f"{inner}/{name}.off") as offsets,
            system.open_output_stream(f"{inner}/{name}.doc") as names,
        ):
            offsets.write(np.zeros(1, "<u8").tobytes())
            for batch in batches:
                names.write(batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                ends = []
                for found in words.batch(v.as_py() for v in batch.column(1)):
                    ids.write(found + end)
                    tokens_n += len(found) // words.dtype.itemsize + 1
                    ends.append(tokens_n)
                offsets.write(np.array(ends, "<u8").tobytes())
                docs_n += len(ends)
        if docs_n:
            yield pa.RecordBatch.from_pylist([
                {"part": part, "file": name, "width": words.dtype.itemsize, "n_docs": docs_n, "n_tokens": tokens_n}
            ], pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    manifest = ordered.mapInArrow(lean(write), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def mapped(folder: str, name: str, dtype: np.dtype) -> np.ndarray:
    """A file's values: memory-mapped where the file system is mounted, read otherwise."""
    system, inner = opened(f"{folder}/{name}")
    info = system.get_file_info(inner)
    if not info.size:
        return np.empty(0, dtype)
    if system.type_name == "local":
        return np.memmap(inner, dtype, "r")
    with system.open_input_file(inner) as file:
        return np.frombuffer(file.read(), dtype)


def based(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: the ids in all parts before. One small row per part is summed."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: where it starts in the whole, its ids' number and checksum."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids = mapped(folder, f"{row['file']}.bin", np.dtype(f"<u{row['width']}"))
            ends = mapped(folder, f"{row['file']}.off", np.dtype("<u8")).astype(np.int64)
            names = mapped(folder, f"{row['file']}.doc", np.dtype("<i8"))
            for first in range(0, row["n_docs"], 8192):
                cut = ends[first : min(first + 8192, row["n_docs"]) + 1]
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:])]
                doc_ids = np.asarray(names[first : first + len(sums)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID), pa.array(cut[:-1] + row["base"], pa.int64()),
                    pa.array(np.diff(cut), pa.int64()), pa.array(sums, pa.int64()),
                ], schema=schema)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    parts = stored(based(manifest), "token-parts")
    count = parts.count()
    return parts.repartitionByRange(max(count, 1), "part").mapInArrow(lean(read), SPANS)
