"""Results out: never over what is there, short ones inline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import files


def write_outputs(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """All of it or nothing (the job commit), and an existing path is refused."""
    df.write.mode("errorifexists").format(fmt).options(**options).save(path)


def route_document_text(df: DataFrame, text: str = "text", max_inline: int = C.MAX_INLINE_TEXT_BYTES,
                        where: str | None = None) -> DataFrame:
    """Short texts inline; long ones by reference (``where`` is the column naming their place)."""
    routed = df.withColumn("_route", files.text_route(F.col(text), max_inline))
    place = F.col(where) if where else F.lit(None).cast("string")
    return routed.select(
        *[c for c in df.columns if c != text], "_route.*",
        F.when(~F.col("_route.inline"), place).alias("document_text_path"),
    )


def route_payload(df: DataFrame, content: str = "bytes", max_inline: int = C.MAX_INLINE_BYTES,
                  where: str | None = None) -> DataFrame:
    """Small outputs as base64, all with size and the place to fetch them from."""
    routed = df.withColumn("_route", files.payload_route(F.col(content), max_inline))
    place = F.col(where) if where else F.lit(None).cast("string")
    return routed.select(
        *[c for c in df.columns if c != content], "_route.*", place.alias("download_url")
    )
