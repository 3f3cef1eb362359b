"""Result tables: one folder per table, one sub-folder per micro-batch that has rows.

Writing a micro-batch again replaces its own folder only, so a restart never counts twice. Tables
that a running total keeps up to date hold several versions of a key; ``RESULT_KEYS`` says which
columns are the key, and which order its versions before the batch does. Tables in ``RESULT_SUMS``
hold counts, of which each micro-batch adds its own.

Beside a running job ``compact`` folds older micro-batches into sorted runs, and runs into larger runs.
A manifest names the runs that hold a table now, so readers change over at once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.schema import RESULT_KEYS, RESULT_ORDER, RESULT_SCHEMAS, RESULT_SUMS
from trolley.session import hadoop_path
from trolley.sources import manifest
from trolley.sources.manifest import Manifest, Run

#: Micro-batches folded at least, and runs of a tier merged.
FANOUT = 10
#: Seconds for which replaced folders stay, for readers that have planned with them.
GRACE = 3600.0
RUNS, INDEX = "_runs", "_index"


def table_path(root: str, name: str) -> str:
    return f"{root}/{name}"


def _schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(RESULT_SCHEMAS[name])


def _stored_schema(name: str) -> T.StructType:
    return _schema(name).add("batch_id", T.LongType())


def _write(rows: DataFrame, batch_id: int, root: str, name: str) -> None:
    (
        rows.select(*_schema(name).names, F.lit(batch_id).cast("bigint").alias("batch_id"))
        # As many files as the rows need, not one per shuffle partition.
        .hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(table_path(root, name))
    )


def batch_writer(
    root: str,
    name: str,
    derived: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for the table, and for tables worked out from the same rows.

    With ``compact_every`` the tables are compacted after so many micro-batches, between two of them;
    without, any other process may do it while the job runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if derived:
            batch.persist()
        try:
            _write(batch, batch_id, root, name)
            for other, reduce in (derived or {}).items():
                _write(reduce(batch), batch_id, root, other)
        finally:
            if derived:
                batch.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            for table in (name, *(derived or ())):
                compact(batch.sparkSession, root, table, min(compact_every, FANOUT))

    return write


def read_batches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows the table holds, with the ``batch_id`` they are from. Of a compacted table the versions
    that a later one has replaced are gone."""
    table = table_path(root, name)
    return _read(spark, name, table, manifest.current(spark, table))


def _recent(spark: SparkSession, name: str, table: str, upto: int) -> DataFrame:
    """Rows of the micro-batches after ``upto``. Of a compacted table only their folders are named to the
    reader: others may be deleted while it looks through the table."""
    reader = spark.read.schema(_stored_schema(name))
    if upto < 0:
        return reader.parquet(table)
    later = [f"{table}/batch_id={b}" for b in batches_of(spark, table) if b > upto]
    if not later:
        return spark.createDataFrame([], _stored_schema(name))
    return reader.option("basePath", table).parquet(*later)


def _read(spark: SparkSession, name: str, table: str, now: Manifest) -> DataFrame:
    rows = _recent(spark, name, table, now.upto)
    if not now.runs:
        return rows
    runs = spark.read.schema(_stored_schema(name)).parquet(*(f"{table}/{RUNS}/{run.name}" for run in now.runs))
    return runs.unionByName(rows)


def read_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of a table that is only added to."""
    return read_batches(spark, root, name).drop("batch_id")


def newest(rows: DataFrame, name: str, keep_batch: bool = False) -> DataFrame:
    """The newest version of each key of a table kept up to date. Filters on a key reach the scan."""
    keys, by = RESULT_KEYS[name]
    values = [c for c in _schema(name).names if c not in keys] + ["batch_id"] * keep_batch
    last = F.max_by(F.struct(*values), F.struct(*by, "batch_id")).alias("newest")
    return rows.groupBy(*keys).agg(last).select(*keys, "newest.*")


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest row per key of a table kept up to date."""
    return newest(read_batches(spark, root, name), name)


def totals(rows: DataFrame, name: str, keep_batch: bool = False) -> DataFrame:
    """The counts of each key of a table of counts."""
    keys, count = RESULT_SUMS[name]
    batch = [F.max("batch_id").alias("batch_id")] * keep_batch
    return rows.groupBy(*keys).agg(F.sum(count).cast("bigint").alias(count), *batch)


def read_totals(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row per key of a table of counts."""
    return totals(read_batches(spark, root, name), name)


def _folded(rows: DataFrame, name: str) -> DataFrame:
    """What the rows of several micro-batches come down to, with the newest ``batch_id`` of each."""
    if name in RESULT_KEYS:
        return newest(rows, name, keep_batch=True)
    return totals(rows, name, keep_batch=True) if name in RESULT_SUMS else rows


def _ordered_by(name: str) -> T.StructField:
    schema = _schema(name)
    return schema[RESULT_ORDER.get(name, schema.names[0])]


def lookup(spark: SparkSession, root: str, name: str, values: list) -> DataFrame:
    """The table's rows with one of a few ``values`` in its first column (or that of ``RESULT_ORDER``); the
    newest versions, if it is kept up to date, and the sums, if it has counts.

    Opens the micro-batches not yet compacted, and of each run the files whose range holds a value: a
    number that grows with the logarithm of the micro-batches ever written, if they are compacted.
    """
    column = F.col(_ordered_by(name).name)
    return _from_files(spark, root, name, column.isin(values), [(v, v) for v in values])


def lookup_range(spark: SparkSession, root: str, name: str, low, high) -> DataFrame:
    """The same for values from ``low`` to ``high``, both included."""
    return _from_files(spark, root, name, F.col(_ordered_by(name).name).between(low, high), [(low, high)])


def _from_files(spark: SparkSession, root: str, name: str, here: Column, ranges: list[tuple]) -> DataFrame:
    table, schema = table_path(root, name), _stored_schema(name)
    now = manifest.current(spark, table)
    rows = _recent(spark, name, table, now.upto).where(here)
    files = _files(spark, name, table, now, ranges) if now.runs and ranges else []
    if files:
        rows = spark.read.schema(schema).parquet(*files).where(here).unionByName(rows)
    return _folded(rows, name).drop("batch_id").select(*_schema(name).names)


def _files(spark: SparkSession, name: str, table: str, now: Manifest, ranges: list[tuple]) -> list[str]:
    kind = _ordered_by(name).dataType
    index = T.StructType([T.StructField("run", T.StringType()), T.StructField("file", T.StringType())])
    index = index.add("low", kind).add("high", kind)
    holds = F.lit(False)
    for low, high in ranges:
        holds = holds | ((F.col("low") <= F.lit(high).cast(kind)) & (F.col("high") >= F.lit(low).cast(kind)))
    folders = [f"{table}/{RUNS}/{run.name}/{INDEX}" for run in now.runs]
    found = spark.read.schema(index).parquet(*folders).where(holds).select("run", "file").collect()
    return [f"{table}/{RUNS}/{r.run}/{r.file}" for r in found]


def reset(spark: SparkSession, root: str, names: tuple[str, ...] = tuple(RESULT_SCHEMAS)) -> None:
    """Empty the tables, keeping their schemas.

    Stop the queries first and give them a fresh checkpoint folder afterwards: an old one would
    go on with old totals.
    """
    for name in names:
        path, files = hadoop_path(spark, f"{table_path(root, name)}/{manifest.FOLDER}")
        files.delete(path, True)  # First: no manifest may name runs that are gone.
        empty = spark.createDataFrame([], _stored_schema(name))
        (
            empty.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("batch_id")
            .parquet(table_path(root, name))
        )


def batches_of(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the micro-batches that have a folder, ascending."""
    named = [n for n, _ in manifest.children(spark, table) if n.startswith("batch_id=")]
    return sorted(int(n.removeprefix("batch_id=")) for n in named)


def compact(
    spark: SparkSession,
    root: str,
    name: str,
    fanout: int = FANOUT,
    grace: float = GRACE,
    expired: Column | None = None,
) -> bool:
    """Fold the micro-batches written since the last time into a run; False if there are fewer than
    ``fanout``, or if another process was faster.

    May run beside the job that writes the table and beside any reader. The newest micro-batch is left
    alone, since a restart of the job may write it again. ``fanout`` runs of one tier become one of the
    next (two at least), so a row is rewritten once per tier. Of a table kept up to date a run holds the newest version
    of each key, of counts their sums; a run is sorted by key (else by the first column), in files of about equal size, and an
    index gives the range of each file. Folders that were replaced stay for ``grace`` seconds. Rows for
    which ``expired`` holds are left out; a read that skips them as well is the same before and after.
    """
    table = table_path(root, name)
    now = manifest.current(spark, table)
    ready = [b for b in batches_of(spark, table) if b > now.upto][:-1]
    if len(ready) < fanout:
        _sweep(spark, table, grace)
        return False
    tier, merged = 0, 0
    while True:
        same = [r for r in now.runs if r.tier == tier]
        if len(same) + 1 < max(2, fanout):
            break
        tier, merged = tier + 1, merged + len(same)
    kept, old = now.runs[: len(now.runs) - merged], now.runs[len(now.runs) - merged :]
    parts = Manifest(now.version, now.upto, old)
    rows = _read(spark, name, table, parts).where(F.col("batch_id") <= ready[-1])
    if expired is not None:
        rows = rows.where(~F.coalesce(expired, F.lit(False)))
    first = old[0].first if old else ready[0]
    run = Run(f"{first}-{ready[-1]}-{uuid.uuid4().hex}", tier, first, ready[-1])
    _write_run(rows, name, f"{table}/{RUNS}", run.name)
    done = manifest.publish(spark, table, Manifest(now.version + 1, ready[-1], (*kept, run)), run.name)
    _sweep(spark, table, grace)
    return done


def _write_run(rows: DataFrame, name: str, runs: str, run: str) -> None:
    spark, schema, first = rows.sparkSession, _stored_schema(name), _ordered_by(name).name
    keys = RESULT_KEYS.get(name, RESULT_SUMS.get(name, ((),)))[0]
    order = list(dict.fromkeys([first, *keys]))
    folded = _folded(rows, name).select(*schema.names)
    folded.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{runs}/{run}")
    written = spark.read.schema(schema).parquet(f"{runs}/{run}").select(first, F.col("_metadata.file_name").alias("file"))
    ranges = written.groupBy("file").agg(F.min(first).alias("low"), F.max(first).alias("high"))
    # One file, by a shuffle of these few rows: a coalesce would put the whole aggregate, and the memory
    # of each of its partitions, into that one task.
    ranges.select(F.lit(run).alias("run"), "file", "low", "high").repartition(1).write.parquet(f"{runs}/{run}/{INDEX}")


def _sweep(spark: SparkSession, table: str, grace: float) -> None:
    """Delete what only manifests name that were replaced more than ``grace`` seconds ago."""
    found, until = manifest.versions(spark, table), time.time() - grace
    valid = [(v, at) for v, at in found if at <= until]
    if not valid:
        return
    # The newest of the old ones was still valid when the grace began; it and all later ones count.
    still = [manifest.load(spark, table, v) for v, _ in found if v >= valid[-1][0]]
    if None in still:
        return  # Another process is sweeping.
    named = {run.name for m in still for run in m.runs}

    def delete(child: str) -> None:
        path, files = hadoop_path(spark, f"{table}/{child}")
        files.delete(path, True)

    for name, at in manifest.children(spark, f"{table}/{RUNS}"):
        if name not in named and at <= until:
            delete(f"{RUNS}/{name}")
    for batch in batches_of(spark, table):
        if batch <= still[0].upto:
            delete(f"batch_id={batch}")
    for version, _ in found:
        if version < still[0].version:
            delete(f"{manifest.FOLDER}/{version}.json")
