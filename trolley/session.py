"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONFIGURED = "spark.trolley.configured"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time options every job needs, once per session: UTC clock, AQE, RocksDB state.

    What the caller sets after that stays. Partition counts and memory are up to whoever owns the
    cluster.
    """
    if spark.conf.get(CONFIGURED, None):
        return spark
    spark.conf.set(CONFIGURED, "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    # A commit uploads the changes of a micro-batch, not the whole state.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def local(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trolley")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A folder all executors can reach, under the one named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it gets a fresh temporary folder.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            named = tempfile.mkdtemp(prefix="trolley-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the written copy (lineage ends there).

    The copy stays until ``clean_up``.
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application has written to its folder; nothing may read it any more."""
    path, files = hadoop_path(spark, own_dir(spark))
    files.delete(path, True)


def own_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_dir(spark)}/cut-{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, name: str):
    """A path, and the file system it lies in, wherever that is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
