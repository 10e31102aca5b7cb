"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def local_session(cpus: int | str = "*", app: str = "wayword", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own: on a cluster a machine-local
    folder would be lost with the machine, so there the setting is required.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wayword-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/wayword/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage, survives the loss of any executor, and gives Catalyst the true size.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``materialise``, with the number of rows, which are counted while they are written."""
    seen = Observation()
    table = materialise(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return table, seen.get["rows"]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ours in the shared folder that nothing reads any more."""
    if "/wayword/" not in path:
        raise ValueError(f"{path} is no scratch table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
