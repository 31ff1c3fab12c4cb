"""History and load operators: stitching, slowly changing dimensions, change capture, golden ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.functions.keys import norm

OPEN_END = "9999-12-31 00:00:00"


def _keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.concat_ws("|", *(F.coalesce(norm(F.col(k).cast("string")), F.lit("0")) for k in keys)))


def scd1_stitch(current: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """The current rows, and those of history whose normalised key (null as 0) isn't current."""
    now = _keys(current, keys, "_k").select("_k").distinct()
    return current.unionByName(_keys(history, keys, "_k").join(now, "_k", "left_anti").drop("_k")).distinct()


def scd2(df: DataFrame, keys: list[str], start: str) -> DataFrame:
    """end_ts and active_flag from the next row's start."""
    nxt = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return df.withColumn("end_ts", F.coalesce(nxt.cast("timestamp"), F.lit(OPEN_END).cast("timestamp"))).withColumn("active_flag", F.when(nxt.isNull(), "Y").otherwise("N"))


def delete_ids(df: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    return df.join(deleted.select(key).distinct(), key, "left_anti")


def cdc_merge(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One full join on the key: change is new, updated, unchanged or gone (active N, old values)."""
    h = lambda: F.sha2(F.concat_ws("|", *(F.coalesce(F.col(v).cast("string"), F.lit("\x00")) for v in values)), 256)
    o = old.select(*keys, F.struct(*values).alias("_o"), h().alias("_ho"))
    n = new.select(*keys, F.struct(*values).alias("_n"), h().alias("_hn"))
    j = o.join(n, keys, "full")
    change = F.when(F.col("_ho").isNull(), "new").when(F.col("_hn").isNull(), "gone").when(F.col("_ho") == F.col("_hn"), "unchanged").otherwise("updated")
    return j.select(*keys, *(F.coalesce(F.col("_n")[v], F.when(F.col("_hn").isNull(), F.col("_o")[v])).alias(v) for v in values), change.alias("change"), F.when(F.col("_hn").isNull(), "N").otherwise("Y").alias("active"))


def golden_ids(previous: DataFrame, clusters: DataFrame, prefix: str) -> DataFrame:
    """clusters(hash_uid, cluster_id) to (hash_uid, golden_id). A cluster keeps the previous id that covers most
    of its hashes (ties: the smaller); an id that several clusters would keep stays with the one that
    covers it most (ties: the smaller cluster id); the others get new numbers after the highest."""
    number = F.regexp_extract("golden_id", r"_(\d+)$", 1).cast("long")
    seen = clusters.join(previous, "hash_uid").groupBy("cluster_id", "golden_id").agg(F.count_distinct("hash_uid").alias("n")).withColumn("num", number)
    best = seen.groupBy("cluster_id").agg(F.min_by(F.struct("golden_id", "n", "num"), F.struct((-F.col("n")).alias("n"), F.col("num"))).alias("b")).select("cluster_id", "b.*")
    won = best.groupBy("golden_id").agg(F.min_by("cluster_id", F.struct((-F.col("n")).alias("n"), F.col("cluster_id"))).alias("cluster_id"))
    rest = clusters.select("cluster_id").distinct().join(won, "cluster_id", "left_anti")
    from goldenloom.operators.windows import ordered_ids

    top = previous.agg(F.coalesce(F.max(number), F.lit(0)).alias("top"))
    new = ordered_ids(rest, "cluster_id", "k").crossJoin(F.broadcast(top)).select("cluster_id", F.concat(F.lit(prefix), (F.col("k") + F.col("top")).cast("string")).alias("golden_id"))  # top is one row
    return clusters.join(won.select("cluster_id", "golden_id").unionByName(new), "cluster_id").select("hash_uid", "golden_id")
