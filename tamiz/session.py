"""Local session for tests and benchmarks, and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "tamiz") -> SparkSession:
    """A local[N] session with a scratch folder of its own; on a cluster the caller brings the session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file:///tmp/{name}-scratch")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``, or the context's checkpoint folder,
    else a folder below the warehouse, which every executor must reach anyway."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The result no longer depends on its inputs, keeps columnar pruning, and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
