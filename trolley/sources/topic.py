"""Events as JSON lines: on a topic, or in text files standing in for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions.text import (
    epoch_ms,
    has_time_shape,
    id_to_bigint,
    once,
    to_event_ts,
    trim_all,
)
from trolley.schema import TOPIC, WIRE_SCHEMA
from trolley.session import hadoop_path


def encode(events: DataFrame) -> DataFrame:
    """All columns as one JSON object per row, NULLs written out."""
    return events.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def _event_columns() -> dict[str, tuple[str, Column]]:
    """The columns of an event, but for ``event_ms``: the field each is read from, and how."""
    raw = {f: F.col(f"_event.{f}") for f in WIRE_SCHEMA.names}
    return {
        "event_time": ("event_time", raw["event_time"]),
        "event_type": ("event_type", raw["event_type"]),
        "product_id": ("product_id", raw["product_id"]),
        "category_id": ("category_id", raw["category_id"].try_cast("bigint")),
        # A bare NaN or Infinity comes out of the JSON reader in quotes.
        "price": ("price", F.btrim(raw["price"], F.lit('"')).try_cast("double")),
        "user_id": ("user_id", id_to_bigint(raw["user_id"])),
        "user_session": ("user_session", raw["user_session"]),
        "event_ts": ("event_time", to_event_ts(raw["event_time"])),
        "time_ok": ("event_time", has_time_shape(raw["event_time"])),
    }


def parse(lines: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Parse ``value`` once; ``problem`` tells why a line is no event, else it is NULL.

    ``columns`` are those wanted of an event (all, by default; ``jobs.COLUMNS`` has what each live job
    needs): fields that none of them is made of are skipped over. Whether a line is broken does not
    depend on them. A column named ``timestamp`` (the topic's own) becomes the arrival time,
    ``offset`` the order of arrival.
    """
    known = _event_columns()
    columns = columns or (*known, "event_ms")
    wanted = {c: known[c] for c in dict.fromkeys("event_ts" if c == "event_ms" else c for c in columns)}
    fields = {field for field, _ in wanted.values()} | {"_corrupt"}
    schema = T.StructType([f for f in WIRE_SCHEMA if f.name in fields])
    event = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    arrived = epoch_ms(F.col("timestamp")) if "timestamp" in lines.columns else F.lit(None).cast("bigint")
    order = F.col("offset") if "offset" in lines.columns else F.lit(None).cast("bigint")
    is_object = trim_all(F.col("value")).startswith("{")
    parsed = lines.select(
        "value",
        arrived.alias("arrival_ms"),
        order.alias("ordinal"),
        once([event.alias("_event"), F.coalesce(is_object, F.lit(False)).alias("_is_object")]),
    )
    problem = F.when(~F.col("_is_object"), "not_an_object").when(
        F.col("_event").isNull() | F.col("_event._corrupt").isNotNull(), "malformed_json"
    )
    own = [column.alias(name) for name, (_, column) in wanted.items()]
    events = parsed.select("value", problem.alias("problem"), *own, "arrival_ms", "ordinal")
    return events.withColumn("event_ms", epoch_ms(F.col("event_ts"))) if "event_ms" in columns else events


def _lacks(needs: tuple[str, ...]):
    reason = F.col("problem")
    for name in needs:
        reason = F.coalesce(reason, F.when(F.col(name).isNull(), f"missing_{name}"))
    return reason


def accepted(parsed: DataFrame, needs: tuple[str, ...] = ()) -> DataFrame:
    """Events that parsed and have every column in ``needs``."""
    return parsed.where(_lacks(needs).isNull()).drop("problem", "value")


def rejects(parsed: DataFrame, needs: tuple[str, ...] = ()) -> DataFrame:
    """The other lines, kept as text with a reason."""
    return parsed.select("value", _lacks(needs).alias("reason")).where(F.col("reason").isNotNull())


def topic_options(servers: str, topic: str = TOPIC, group: str | None = None) -> dict[str, str]:
    """Reader options: all of the topic from its earliest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    return options | ({"kafka.group.id": group} if group else {})


def _as_lines(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("value"), "timestamp", "offset")


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, group: str | None = None) -> DataFrame:
    """The whole topic as a batch (needs the connector package on the cluster)."""
    return _as_lines(spark.read.format("kafka").options(**topic_options(servers, topic, group)).load())


def read_topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    group: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """The topic as a stream; ``max_per_trigger`` bounds the rows taken per micro-batch."""
    options = topic_options(servers, topic, group)
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return _as_lines(spark.readStream.format("kafka").options(**options).load())


def write_topic(lines: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send ``value`` unkeyed (needs the connector package on the cluster)."""
    lines.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path)


def read_lines_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("recursiveFileLookup", True).text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("append").text(path)


def write_lines_once(lines: DataFrame, path: str) -> None:
    """Write the lines to a folder of their own, unless it is there and complete."""
    done, files = hadoop_path(lines.sparkSession, f"{path}/_SUCCESS")
    if not files.exists(done):
        lines.select("value").write.mode("overwrite").text(path)
