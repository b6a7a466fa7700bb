"""Session, tables and lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8, name: str = "inkwarp") -> SparkSession:
    """A session for tests and the bench. On a cluster the session comes from outside."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table as read, over all cores where its files make fewer parts than half of them; for stages that compute much a row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def settle(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared checkpoint folder, its lineage cut.

    The folder is the session's spark.checkpoint.dir; only where that is unset, as in tests on
    one machine, a temporary one is made, which goes with the process.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        where = context.getConf().get("spark.checkpoint.dir")
        if not where:
            if not context.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="inkwarp-")
            atexit.register(shutil.rmtree, where, True)
        context.setCheckpointDir(where)
    return df.checkpoint()


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has been counted to have at most so many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: An identifier of the new (2403.61234) or the old (quant-ph/9733123) kind.
PAPER = r"(\d{4}\.\d{4,5}|[a-z][a-z\-]*(?:\.[a-z]{2})?/\d{7})"


def paper(arxiv_id: Column) -> Column:
    """The bare number in lower case, without prefix, version or file ending; NULL for NULL or blank.

    What holds no such number comes out trimmed and in lower case.
    """
    low = F.lower(F.trim(F.regexp_replace(arxiv_id, r"[\s\p{Z}]+", " ")))
    found = F.regexp_extract(low, PAPER, 1)
    return F.when(found != "", found).when(low != "", low)


__all__ = ["local_session", "paper", "settle", "small_side", "spread", "table"]
