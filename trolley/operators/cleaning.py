"""Row cleaning: convert ids and price, trim the time, set bad rows aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.text import double_to_bigint, once, to_double, trim_all
from trolley.schema import REPLAY_STEP_MS
from trolley.session import cut

CONVERTED = ("user_id", "category_id", "price", "event_time")
SOURCE_COLUMNS = ("_short", "_file", "_block")

# A split table of more bytes is joined by shuffle instead of broadcast.
MAX_BROADCAST_BYTES = 32 << 20
# What a split has besides its path: three numbers, and room for the hash table's own needs.
SPLIT_BYTES = 100


def _checked(raw: DataFrame) -> DataFrame:
    """The raw columns plus the converted ones (``_c_*``) and ``reason`` (NULL if the row is good).

    Reasons follow the order of conversion; the first failure names the row.
    """
    have = {c: F.col(c) if c in raw.columns else F.lit(None).cast("string") for c in CONVERTED}
    numbers = raw.select(
        "*",
        once(
            [
                to_double(have["user_id"]).alias("_d_user_id"),
                to_double(have["category_id"]).alias("_d_category_id"),
                to_double(have["price"]).alias("_c_price"),
                trim_all(have["event_time"]).alias("_c_event_time"),
            ]
        ),
    )

    def bad_int(name: str):
        number = F.col(f"_d_{name}")
        finite = ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
        return (
            F.when(number.isNull() | ~finite, f"bad_{name}")
            .when(double_to_bigint(number).isNull(), "out_of_range")
        )

    reason = F.coalesce(
        bad_int("user_id"),
        bad_int("category_id"),
        F.when(F.col("_c_price").isNull(), "bad_price"),
        F.when(F.col("_c_event_time").isNull(), "missing_event_time"),
    )
    return numbers.select(
        *[F.col(c) for c in raw.columns],
        double_to_bigint(F.col("_d_user_id")).alias("_c_user_id"),
        double_to_bigint(F.col("_d_category_id")).alias("_c_category_id"),
        "_c_price",
        "_c_event_time",
        reason.alias("reason"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """Good rows, with the four columns converted and every other column as it was."""
    converted = {c: F.col(f"_c_{c}") for c in CONVERTED}
    return (
        _checked(raw)
        .where(F.col("reason").isNull())
        .select(*[converted[c].alias(c) if c in converted else F.col(c) for c in raw.columns])
    )


def rejected(raw: DataFrame) -> DataFrame:
    """Bad rows as read, with a reason."""
    return _checked(raw).where(F.col("reason").isNotNull()).select(*raw.columns, "reason")


def payload(cleaned: DataFrame) -> DataFrame:
    """Only the columns that go on the wire."""
    return cleaned.drop(*SOURCE_COLUMNS)


def number_rows(cleaned: DataFrame) -> DataFrame:
    """Add ``ordinal`` (dense, from 0, in file order) and ``arrival_ms`` on the replay clock.

    Only accepted rows are counted, as only they take up the producer's time. Rows are numbered
    inside each input split as they are read, and a table with one line per split gives each
    split its offset, so no shuffle moves the rows. The numbered rows are written once before
    the offsets are taken: a second scan might be split differently.
    """
    rows = cut(cleaned.withColumn("_row", F.monotonically_increasing_id()))
    splits = rows.groupBy("_file", "_block").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    # Splits are added up within their file, and one line per file across the files.
    inside = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_all")).select(
        "_file", F.coalesce(F.sum("_all").over(across), F.lit(0)).alias("_earlier")
    )
    within = F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    offsets = (
        splits.withColumn("_within", within)
        .join(files, "_file")
        .select("_file", "_block", (F.col("_earlier") + F.col("_within") - F.col("_first")).alias("_shift"))
    )
    held = splits.agg(F.sum(F.octet_length("_file") + SPLIT_BYTES)).first()[0] or 0
    if held <= MAX_BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    ordinal = F.col("_row") + F.col("_shift")
    return (
        rows.join(offsets, ["_file", "_block"])
        .withColumn("ordinal", ordinal)
        .withColumn("arrival_ms", ordinal * REPLAY_STEP_MS)
        .drop("_row", "_shift")
    )
