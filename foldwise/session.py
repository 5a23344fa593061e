"""Session helpers: a local session for tests and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench; on a cluster pass your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foldwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOLDWISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a local session names none (tests) a scratch folder is created; a
    cluster without the setting raises, since executors do not share /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="foldwise-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


MIN_ROWS_PER_PARTITION = 10_000


def cut_lineage(df: DataFrame, spread: bool = False) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    Every later pass reads the checkpoint with its partitioning.  A table from
    a scan of one parquet row group, or one coalesced by AQE, can land in a
    single partition, and then every pass runs as one task.  ``spread`` is for
    the tables many passes re-scan (fold-tagged frames, OOF tables): when such
    a table has fewer partitions than the cluster has cores and enough rows to
    fill more, it is redistributed round-robin and checkpointed again.  A large
    table always has more partitions than that, so at scale the second write
    never happens; on small inputs it is cheap."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ck = df.checkpoint(eager=True)
    if not spread:
        return ck
    cores = spark.sparkContext.defaultParallelism
    have = ck.rdd.getNumPartitions()
    if have >= cores:
        return ck
    want = min(cores, ck.count() // MIN_ROWS_PER_PARTITION)
    if want <= have:
        return ck
    return ck.repartition(want).checkpoint(eager=True)
