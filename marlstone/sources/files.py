"""Messages from files, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Formats whose rows become one message each.
FORMATS = ("text", "binaryFile", "parquet", "json", "csv", "orc")


def messages(spark: SparkSession, path: str, fmt: str = "text", stream: bool = False, schema=None, column: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """value: the bytes of each message. text: a line; binaryFile: a whole file; else the given column, or all columns
    of a row as JSON. Streams need a schema for the last kinds."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is none of {', '.join(FORMATS)}")
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    reader = reader.schema(schema) if schema is not None and fmt not in ("text", "binaryFile") else reader
    df = reader.format(fmt).load(path)
    if fmt == "text":
        value = F.col("value").cast("binary")
    elif fmt == "binaryFile":
        value = F.col("content")
    elif column:
        value = F.col(column).cast("binary")
    else:
        value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary")
    return df.select(value.alias("value"))


def broker(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """A stream of messages from a broker whose connector is on the class path, such as kafka."""
    return spark.readStream.format(fmt).options(**options).load().select(F.col("value").cast("binary").alias("value"))
