"""Session, tables and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "rollbook", cores: str = "*", **conf: str) -> SparkSession:
    """Local session with the settings the operators expect; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: ``spark.checkpoint.dir`` of the session.

    Only where neither that nor a checkpoint folder is set (a local test) a
    temporary folder of this machine is chosen.
    """
    context = spark.sparkContext
    set_already = context.getCheckpointDir()
    if set_already:
        return set_already
    wanted = context.getConf().get("spark.checkpoint.dir")
    if not wanted:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        wanted = tempfile.mkdtemp(prefix=f"rollbook-{os.getpid()}-")
    context.setCheckpointDir(wanted)
    return wanted


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spaced(df: DataFrame) -> DataFrame:
    """Distinct rows dealt out to all shuffle partitions: small ones are not merged into one task before slow Python work."""
    return df.repartition(shuffle_width(df.sparkSession), *df.columns)


def big(df: DataFrame) -> DataFrame:
    """Marks a side of a join that grows with the data: it is never broadcast on an estimate.

    Estimates of exploded or Python-made columns come from the files behind them
    and can be far too small; a sort-merge join spills and splits skewed keys.
    """
    return df.hint("merge")
