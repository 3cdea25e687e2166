"""Raw item dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.schemas import RAW

_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def read_items(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Items of a dump: one JSON object per line (splittable), or one array per file with `multiline`."""
    return spark.read.schema(RAW).options(multiLine=multiline, **_JSON).json(path)


def stream_items(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Dump files as they arrive in a folder."""
    reader = spark.readStream.schema(RAW).options(**_JSON)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)
