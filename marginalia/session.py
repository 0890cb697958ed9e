"""Session helpers: settings every job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plan quality; deployment sizes (executors,
# memory, shuffle partitions) stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", name: str = "marginalia") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy stages enough tasks when a scan comes in too few pieces.

    A large table already arrives in more splits than there are cores and is
    returned as it is; only a small one pays for the exchange. Meant for plain
    scans, whose partition count is known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of our own;
    on a cluster a missing setting is an error, because a machine-local folder
    is lost together with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
            folder = tempfile.mkdtemp(prefix="marginalia-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
