"""Table reading and writing: read-or-empty, append, replace by key, upsert, staged results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from posledger.schemas import conform


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The catalog table if it exists, else an empty frame of the same shape."""
    if spark.catalog.tableExists(name):
        return conform(spark.read.table(name), schema)
    return spark.createDataFrame([], schema)


def read_parent(spark: SparkSession, name: str, parent: str, schema: T.StructType) -> DataFrame:
    """One parent's slice; the filter prunes partitions of tables partitioned by parent."""
    return read_or_empty(spark, name, schema).where(F.col("parent_ticker") == parent)


def write_table(df: DataFrame, name: str, mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    """Append rows to, or replace, a managed parquet table."""
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def replace_by_key(df: DataFrame, path: str, key: str) -> None:
    """Replace the partitions of the keys present in ``df`` and keep all others."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(key).parquet(path)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row per key, by the values of ``order`` (nulls are oldest); any of the rows that tie."""
    return _first(df, keys, F.struct(*order).desc())


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _first(df, keys, F.struct(*order).asc())


def _first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """First row per key. Every task passes on one row per key, so a hot key stays small in the shuffle."""
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_nr", nr).where(F.col("_nr") == 1).select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] = ()) -> DataFrame:
    """Rows of ``updates`` replace those of ``target`` per key; the last update wins."""
    old = target.withColumn("_new", F.lit(0))
    new = updates.withColumn("_new", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    body = F.struct(*[c for c in target.columns if c not in keys])
    rank = F.struct(F.col("_new"), *order)
    return both.groupBy(*keys).agg(F.max_by(body, rank).alias("_r")).select(*keys, "_r.*").select(*target.columns)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table that ``upsert_buckets`` can change in part: one partition per bucket of its keys."""
    rows = df.withColumn("bucket", bucket_of(keys, buckets))
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def upsert_buckets(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], buckets: int,
                   order: Sequence[str | Column] = ()) -> None:
    """Replace or add the rows of ``updates`` by key, reading and rewriting the buckets they fall in only.

    The new content of those buckets is written to the shared folder first, so a run that is lost while it replaces
    them can be repeated: it gives the same rows again.
    """
    new = updates.withColumn("bucket", bucket_of(keys, buckets))
    touched = stage(new.select("bucket").distinct(), "touched-buckets")
    old = spark.read.parquet(path).join(touched, "bucket", "left_semi")
    merged = stage(upsert(old, new, [*keys, "bucket"], order), "upserted-buckets")
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table whose files are of several generations, in the newest shape.

    Columns that a file does not have yet are typed NULL, columns that the schema dropped are not read.
    """
    return spark.read.schema(schema).parquet(path)


def read_jsonl_latest(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                      keys: Sequence[str], dates: Sequence[str] = ()) -> DataFrame:
    """Worker JSON lines: absent columns are NULL, dates keep ten characters, the last file wins."""
    loose = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in schema.fields])
    raw = spark.read.schema(loose).json(paths)
    cut = {d: F.substring(d, 1, 10).try_cast("date") for d in dates}
    rows = raw.select("*", F.col("_metadata.file_name").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block")).withColumns(cut)
    rows = rows.withColumn("_line", F.monotonically_increasing_id())
    latest = latest_per_key(rows, list(keys), ["_file", "_block", "_line"])
    return conform(latest, schema)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; staged tables must be visible to every executor."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several branches read, so its inputs are scanned once.

    The result is an ordinary table in the shared folder: it survives lost executors, cuts the
    lineage, and its real size lets the optimizer decide about broadcasting it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

