"""Session settings the package relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime settings that every job needs; all of them may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # transformWithState keeps its state in this store only.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("runloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # The test tables are small: keep all cores busy after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A private folder is made only where the session names none, which is the case in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(
            spark.conf.get(CHECKPOINT_CONF, None)
            or context.getConf().get(CHECKPOINT_CONF)
            or tempfile.mkdtemp(prefix="spark-")
        )
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder.

    The rows are frozen on shared storage, so a lost executor re-reads them instead
    of recomputing a non-deterministic stage.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
