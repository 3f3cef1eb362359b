"""Shopping events from the generic ``events`` test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.schema import CART, REMOVE, REPLAY_STEP_MS
from trolley.functions.text import epoch_ms, ms_to_ntz
from trolley.session import hadoop_path

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def read_table_stream(
    spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The table as a stream of its files: all at once, or so many per micro-batch.

    The table may be one file or a folder of files.
    """
    reader = spark.readStream.schema(TABLE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path, files = hadoop_path(spark, f"{sf_dir}/events.parquet")
    if files.getFileStatus(path).isFile():
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/events.parquet")


# Types of the table that stand for other shopping events.
STANDS_FOR = {"click": CART, "error": REMOVE}


def as_shopping_events(table: DataFrame, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Map the table onto the shopping-event columns (clicks are carts, errors are removals).

    The table's dense ``event_id`` is the arrival order, so it also drives the replay clock.
    ``kinds`` keeps only these event types, as a filter on the table's own column, which reaches
    the Parquet scan; a filter on the mapped type would not.
    """
    kind = F.col("event_type")
    if kinds:
        stored = {shop: own for own, shop in STANDS_FOR.items()}
        table = table.where(kind.isin(*[stored.get(k, k) for k in kinds]))
    arrival_ms = F.col("event_id") * F.lit(REPLAY_STEP_MS)
    return table.select(
        F.when(kind == "click", CART).when(kind == "error", REMOVE).otherwise(kind).alias("event_type"),
        F.get_json_object("props", "$.k").alias("product_id"),
        "user_id",
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("user_session"),
        F.col("value").alias("price"),
        F.col("ts").alias("event_ts"),
        F.col("ts").isNotNull().alias("time_ok"),
        F.col("event_id").alias("ordinal"),
        arrival_ms.alias("arrival_ms"),
        ms_to_ntz(arrival_ms).alias("arrival_ts"),
        epoch_ms(F.col("ts")).alias("event_ms"),
    )


def shopping_events(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ()) -> DataFrame:
    return as_shopping_events(read_table(spark, sf_dir), kinds)
