"""Session construction for local runs, tests and benches."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Rows of a reference table, such as a run's samples, that may go to every task.
MOST_SMALL = 100_000


def small(df: DataFrame, most: int = MOST_SMALL) -> DataFrame:
    """df to be broadcast, once its rows have been counted; more of them than `most` are an error."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows in a table that goes to every task")
    return F.broadcast(df)


#: Rows that one task of a shuffle sorts or counts, and the least that are worth a task.
ROWS_A_TASK, LEAST_ROWS = 1 << 18, 1 << 14


def tasks_for(rows: DataFrame, by: int = 1) -> int:
    """Tasks for a shuffle of `by` rows to each of rows, which are counted: more rows are more tasks, none is larger.

    Left to itself, a shuffle grows its tasks up to a size in compressed bytes, and rows of
    a few long numbers are many times that in memory.
    """
    n = by * rows.count()
    return max(1, -(-n // ROWS_A_TASK), min(rows.sparkSession.sparkContext.defaultParallelism, n // LEAST_ROWS))


def dealt(df: DataFrame, tasks: int | None, *by: str) -> DataFrame:
    """df dealt out by columns to so many tasks; as it is without a number."""
    return df if tasks is None else df.repartition(tasks, *by)


def durable(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder that the cluster names in spark.checkpoint.dir, for results that several steps read.

    Only a local session without that setting gets a folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def local_session(app: str = "strandweave", cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local[N] session with the settings the engine is tested under.

    On a cluster, use the cluster's own session: nothing in the library
    depends on these settings except the UTC time zone.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRANDWEAVE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
