"""Incremental runs over append-only tables.

There is no event-time logic to reproduce: runs append snapshots and skip keys that are done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from posledger.operators.screening import pending
from posledger.schemas import conform
from posledger.sources.listings import append_snapshot
from posledger.sources.tables import read_or_empty, write_table


def log_membership(members: DataFrame, table: str, day=None) -> None:
    """Append today's membership to the snapshot log, partitioned by day."""
    write_table(append_snapshot(members, day), table, "append", ["snapshot_date"])


def run_pending(spark: SparkSession, keys: DataFrame, table: str, schema, on: Sequence[str],
                work: Callable[[DataFrame], DataFrame], required: Sequence[str] = ()) -> DataFrame:
    """Apply ``work`` to the keys without a finished row and append its rows.

    A run that is repeated after a failure only does what is missing.
    """
    done = read_or_empty(spark, table, schema)
    fresh = conform(work(pending(keys, done, on, required)), schema)
    write_table(fresh, table, "append")
    return read_or_empty(spark, table, schema)


def finished_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows of all finished runs; what an unfinished run has written is never read."""
    try:
        runs = spark.read.parquet(f"{folder}/runs").select("run").distinct()
        rows = spark.read.schema(f"{schema.toDDL()}, run string").parquet(f"{folder}/rows")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.join(runs, "run", "left_semi").select(*schema.fieldNames())


def run_once(spark: SparkSession, keys: DataFrame, folder: str, schema, on: Sequence[str], run: str,
             work: Callable[[DataFrame], DataFrame], required: Sequence[str] = ()) -> DataFrame:
    """Apply ``work`` to the keys without a finished row, as run ``run``; safe to repeat at any point.

    A run's rows are written under its name and count once the run is entered in the list of finished ones, which is
    the last thing it does. Repeating a run that died replaces what it had written; repeating a finished one does nothing.
    """
    done = finished_rows(spark, folder, schema)
    entered = spark.createDataFrame([(run,)], "run string")
    try:
        finished = not spark.read.parquet(f"{folder}/runs").where(F.col("run") == run).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        finished = False
    if not finished:
        conform(work(pending(keys, done, on, required)), schema).write.mode("overwrite").parquet(f"{folder}/rows/run={run}")
        entered.coalesce(1).write.mode("append").parquet(f"{folder}/runs")
    return finished_rows(spark, folder, schema)
