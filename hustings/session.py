"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # The optimizer re-plans from real shuffle sizes: it coalesces small
    # partitions, splits skewed ones and turns a join into a broadcast join only
    # once the measured side is below spark.sql.autoBroadcastJoinThreshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the Python line of every Column slows down the building of wide plans.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "hustings") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_machine(master: str) -> bool:
    """Whether driver and executors are one process: ``local``, ``local[8]``, ``local[*, 3]``."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the cluster's shared folder.

    ``spark.checkpoint.dir`` names the shared folder. Where it is unset, the warehouse takes
    its place if it is one that all machines see: a local folder will do only where
    everything runs on one machine, and is refused elsewhere.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        scheme = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
        if scheme == "file" and not one_machine(spark.sparkContext.master):
            raise ValueError(
                f"spark.checkpoint.dir is unset and the warehouse {base} is a folder of one machine; "
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
    return f"{base.rstrip('/')}/hustings-scratch/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one intermediate table."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application, once its results are read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage: what follows plans against a small Parquet table, and a
    lost executor costs a re-read instead of the whole computation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
