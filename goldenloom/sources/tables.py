"""Catalog tables: managed or external, partitioned, bucketed on computed keys, with statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.functions.keys import norm


def save(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = (), buckets: int = 0, path: str | None = None) -> DataFrame:
    """df as the catalog table `name` (replaced if it is there), with the catalog's statistics of its size; an external
    one if `path` is given. Rows of a bucket are together and sorted in a file for each writing task at most: they are dealt by
    the bucket columns first."""
    writer = df
    if bucket_by:
        writer = df.repartition(buckets, *bucket_by)
    out = writer.write.mode("overwrite").format("parquet")
    if partition_by:
        out = out.partitionBy(*partition_by)
    if bucket_by:
        out = out.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        out = out.option("path", path)
    out.saveAsTable(name)
    measure(df.sparkSession, name)
    return df.sparkSession.table(name)


def save_by_key(df: DataFrame, name: str, key: str | Column, buckets: int, path: str | None = None, out: str = "norm_key") -> DataFrame:
    """df with its normalised key as a column, bucketed by it: tables of the same number of buckets join on normalised
    keys without a shuffle of either."""
    return save(df.withColumn(out, norm(key)), name, bucket_by=(out,), buckets=buckets, path=path)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replaces only those partitions of the table that df has rows of; columns go by name."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
    measure(spark, name)


def overwrite_partition(df: DataFrame, name: str, **run: str) -> None:
    """Replaces the one partition of the given values, also if df has no rows; df has the other columns."""
    spark = df.sparkSession
    rest = [c for c in spark.table(name).columns if c not in run]
    values = ", ".join(f"{k} = '{v}'" for k, v in run.items())
    df.select(*rest).createOrReplaceTempView("_goldenloom_new_rows")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({values}) SELECT * FROM _goldenloom_new_rows")
    spark.catalog.dropTempView("_goldenloom_new_rows")
    measure(spark, name)


def measure(spark: SparkSession, name: str) -> None:
    """Gives the catalog the table's size, which joins plan by; files are counted, not read."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")


def size_in_bytes(spark: SparkSession, name: str) -> int:
    """The table's size by the catalog's statistics; -1 without."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Statistics").select("data_type").collect()
    return int(rows[0][0].split(" bytes")[0]) if rows else -1
