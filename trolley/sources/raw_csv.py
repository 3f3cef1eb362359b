"""Raw CSV files with a header row; every column is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT_ROW = "_short"


def _options(multi_line: bool) -> dict[str, str]:
    return {
        "header": "true",
        "enforceSchema": "false",  # a file with other columns is an error, not misread
        "mode": "PERMISSIVE",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "columnNameOfCorruptRecord": "_corrupt",
    }


def header_of(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    return spark.read.options(**_options(multi_line)).csv(path).columns


def read_raw_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Read the files as text columns, plus where each row came from and whether it was short.

    Spark reads an empty field as NULL; here an empty field is ``''`` and NULL means that the row
    ended before the field. ``_file`` and ``_block`` name the input split, for the arrival order.
    Set ``multi_line`` only if fields hold line breaks: such files cannot be split.
    """
    columns = columns or header_of(spark, path, multi_line)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    raw = spark.read.schema(schema).options(**_options(multi_line)).csv(path)
    short = F.col("_corrupt").isNotNull() & F.col(columns[-1]).isNull()
    return raw.select(
        *[F.when(F.col(c).isNull() & ~short, F.lit("")).otherwise(F.col(c)).alias(c) for c in columns],
        short.alias(SHORT_ROW),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def read_raw_csv_stream(spark: SparkSession, path: str, columns: list[str], files_per_trigger: int = 1):
    """The same columns as a stream of files; the trigger and ``files_per_trigger`` set the pace."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    raw = (
        spark.readStream.schema(schema)
        .options(**_options(False))
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(path)
    )
    short = F.col("_corrupt").isNotNull() & F.col(columns[-1]).isNull()
    return raw.select(
        *[F.when(F.col(c).isNull() & ~short, F.lit("")).otherwise(F.col(c)).alias(c) for c in columns],
        short.alias(SHORT_ROW),
    )
