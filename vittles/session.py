"""Session helpers.

The library never creates a cluster session on its own: jobs receive a
``SparkSession``.  ``local_session`` exists for tests, the bench and the
driver smoke check.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vittles")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only where it is unset (tests, local runs) a temporary one is made.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="vittles-ckpt-"))
    return sc.getCheckpointDir()


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS = 64 << 20, 1_000_000


def broadcast_if_small(df, max_bytes: int = BROADCAST_MAX_BYTES, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast a dimension only after measuring its rows and bytes (as JSON);
    the measure stops past the bound on rows.  Above a bound it stays a shuffle
    join, which AQE may still turn into a broadcast from runtime sizes."""
    from pyspark.sql import functions as F

    some = df.limit(max_rows + 1)
    rows, size = some.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def cut_lineage(df):
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (survives
    executor loss, truncates the plan)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_finished(spark):
    """Collect the driver's garbage now, after a cut: Spark removes the shuffle files of frames
    that nothing refers to any more (else it may wait for the next half hour)."""
    spark.sparkContext._jvm.System.gc()
