"""Shared helpers: tables in the cluster's shared folder, and row keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until df has no such column (case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def named(*names: str) -> list[Column]:
    """Columns of exactly these names, dots and all."""
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the context's checkpoint folder; where both are unset, a new local
    one, but only on a local master: on a cluster each executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="goldenloom-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/goldenloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables. Results read them until they are written: call it after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: the lineage is cut, lost executors cost
    nothing, and later joins know its true size, so Spark broadcasts it only when that is small. The shuffles that made it
    go once it is written; else their files would stay until the driver happens to collect its garbage."""
    path = new_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_heavy(left: DataFrame, right: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Inner join of left with right(key, n, ...), whose keys differ and whose n is the number of left's rows of the key.
    Keys with more than 1 / share of left's rows, which are fewer than `share` keys whatever the input, are broadcast, so that
    their rows stay where they are; the others, of which none is large, meet by shuffle. left is read twice: a table."""
    total = left.count()
    heavy = right.where(F.col("n") * share > total).drop("n")
    light = right.where(F.col("n") * share <= total).drop("n")
    if heavy.isEmpty():
        return left.join(light, key)
    spared = left.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return left.join(F.broadcast(heavy), key).unionByName(spared.join(light, key))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z, other characters as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on columns of the same names; left's keys stay. Sides may come from one frame."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    return left.join(renamed, on, how).drop(*(f"__right_{k}" for k in keys))
