"""Documents in: text tables, files, inline base64."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.functions import files

# A table smaller than this per core is spread over the cores; a larger one has splits enough.
SPREAD_BYTES_PER_CORE = 32 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Size of what a DataFrame reads, as the optimizer knows it; nothing is run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a small table over all cores by its keys.

    A small parquet file is often one row group, so one task would do all the text work. The
    exchange is worth it only while the table is small, so a table at scale is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores > 1 and input_bytes(df) < cores * SPREAD_BYTES_PER_CORE:
        return df.repartition(cores, *keys)
    return df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A table of texts from parquet."""
    return spark.read.parquet(path)


def read_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files as (path, filename, content_type, size, bytes).

    Filter on size and content_type first: ``bytes`` is read only for the rows and plans that use it.
    Spark's listing leaves empty files out, so the check for these applies to other sources.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.load(path)
    name = files.basename(F.col("path"))
    return df.select(
        "path", name.alias("filename"), files.supported_type(name).alias("content_type"),
        F.col("length").alias("size"), F.col("content").alias("bytes"),
    )


def decode_base64_documents(df: DataFrame, value: str = "base64", filename: str = "filename") -> DataFrame:
    """Inline base64 to bytes with type, size and the reason for a refusal (``code``, ``message``)."""
    problem = files.base64_problem(F.col(value))
    decoded = df.withColumn("bytes", files.decode_base64(F.col(value))).withColumn(
        "content_type", files.supported_type(F.col(filename))
    )
    size = F.octet_length("bytes").cast("bigint")
    check = files.file_check(F.col(filename), F.col("content_type"), size)
    return decoded.select(
        "*", size.alias("size"),
        F.when(problem.isNotNull(), "invalid_request").otherwise(check["code"]).alias("code"),
        F.when(problem.isNotNull(), F.format_string("file %s: %s", F.col(filename), problem))
        .otherwise(check["message"]).alias("message"),
    )


def check_limits(df: DataFrame) -> DataFrame:
    """Adds ``ok``, ``code``, ``message`` from filename, content_type and size."""
    check = files.file_check(F.col("filename"), F.col("content_type"), F.col("size"))
    return df.withColumn("_check", check).select(
        *df.columns, F.col("_check.ok").alias("ok"), F.col("_check.code").alias("code"),
        F.col("_check.message").alias("message"),
    )


def check_preview(df: DataFrame) -> DataFrame:
    """Adds ``ok`` and ``code`` by the preview's own, lower limit."""
    check = files.preview_check(F.col("size"))
    return df.select("*", check["ok"].alias("ok"), check["code"].alias("code"))


def with_output_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Where the redacted file, its table and its text go, beside the input."""
    out: Column = files.redacted_path(F.col(path))
    return df.select(
        "*", out.alias("redacted_path"), files.correspondence_path(out).alias("correspondence_path"),
        files.document_text_path(out).alias("document_text_path"),
        files.restored_path(F.col(path)).alias("restored_path"),
    )
