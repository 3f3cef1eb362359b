"""Helpers shared by the operators: tables, written intermediates, gapless numbers, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.session import own_dir

#: ASCII white space: the bytes 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: The id that documents without one share; it comes after all others.
NO_ID = (1 << 63) - 1
#: Upper-case ASCII and its lower case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the application's folder that all executors share; ``session.clean_up`` deletes it."""
    return f"{own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder, and read back: lineage ends there, and a lost
    executor costs nothing."""
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the path, so that the table can be removed when a newer one replaces it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Written tables that only serve to make another: removed when the block ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        out, path = stored_at(df, label)
        self.paths.append(path)
        return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that a newer one has replaced."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def numbered(df: DataFrame, within: list[str], spread: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 within each value of ``within``, ordered by (``spread``, ``order``).

    ``spread`` is a deterministic key that cuts every group into slices of bounded size: a window
    numbers inside each slice, and the slices' counts (one row each) are added up before it.
    """
    own = df.withColumn("_spread", spread)
    slices = own.groupBy(*within, "_spread").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_spread").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*within, "_spread", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*within, "_spread").orderBy(*order)
    ranked = own.withColumn("_inside", F.row_number().over(inside).cast("long") - 1)
    keys = [*within, "_spread"]
    return (
        ranked.join(offsets.withColumnsRenamed({k: f"_o{k}" for k in keys}),
                    on=[F.col(k).eqNullSafe(F.col(f"_o{k}")) for k in keys])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_spread", "_inside", "_before", *(f"_o{k}" for k in keys))
    )
