"""Session helpers: local sessions for tests and bench, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "touchline", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a master whose tasks
    run in the driver's process may fall back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="touchline-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared folder."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` out once, so that later steps see the same rows in the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """A Parquet table under the shared folder with the rows of ``df``.

    Unlike a checkpoint it is columnar, prunes columns and row groups, and has a
    size, so that small tables are broadcast without a hint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
