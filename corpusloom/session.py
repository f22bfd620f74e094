"""Session-level helpers: the shared checkpoint folder and lineage cuts.

Iterative jobs (BPE rounds, stepwise generation) cut lineage with Parquet tables
in the folder the cluster names in ``spark.checkpoint.dir``.  We only read that setting; a folder is set here only
when none is configured (local tests and benches), never a machine-local
folder on a real cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if spark.sparkContext.master.startswith("local"):
            conf = fallback or tempfile.mkdtemp(prefix="corpusloom-ckpt-")
        else:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage: a Parquet table written
    under the shared checkpoint folder and read back.

    Survives executor loss (the files are in the shared folder), and unlike an
    RDD checkpoint the read-back relation carries its real size, so later joins
    are planned (and broadcast by AQE) from measured statistics instead of an
    unknown size that compounds across iterations.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpusloom") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSLOOM_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
