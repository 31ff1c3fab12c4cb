"""Ranking and golden-record operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.functions.keys import join_same
from goldenloom.sources import files


def top1(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first by `order` (which should end in a unique column)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def numbered(df: DataFrame, out: str, *order: str | Column, first: int = 0) -> DataFrame:
    """df with its rows' places in the whole order, `out`, from `first`; no task holds more than a range of rows. The
    ranges are written once: their borders are sampled anew by each run, so places and counts must come from the
    same one. Ties of `order` are placed as they come; a value that many rows share is in one range."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(out, F.monotonically_increasing_id())
    laid = files.stored(laid)  # the id is the range's number, shifted, and the place inside
    within = F.col(out).bitwiseAND(F.lit((1 << 33) - 1))
    counts = laid.groupBy(F.shiftright(out, 33).alias("_p")).agg((F.max(within) + 1).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_p", before.alias("_o"))  # a row per range
    return laid.withColumn("_p", F.shiftright(out, 33)).join(F.broadcast(offsets), "_p").withColumn(out, within + F.col("_o") + first).drop("_p", "_o")


def ordered_ids(df: DataFrame, column: str, out: str, first: int = 1) -> DataFrame:
    """df with consecutive integers by the order of the column's distinct values; rows without a value get none."""
    values = numbered(df.select(column).where(F.col(column).isNotNull()).distinct(), out, column, first=first)
    return df.join(values, column, "left")


def cumulated(counted: DataFrame, keys: list[str], value: str, n: str, out: str, descending: bool = False) -> DataFrame:
    """counted: one row per key and value, with a count n. Adds the sum of n over the key's earlier values. Rows are dealt by
    ranges of key and value, so that one huge group is as many tasks as its size needs; of each range only a
    sum per key meets the others'."""
    order = F.desc(value) if descending else F.asc(value)
    laid = files.stored(counted.repartitionByRange(*keys, order).withColumn("_p", F.spark_partition_id()))
    earlier = Window.partitionBy("_p", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy("_p", *keys).agg(F.sum(n).alias("_s"))
    ranges = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_p", *keys, F.coalesce(F.sum("_s").over(ranges), F.lit(0)).alias("_o"))
    return join_same(laid.withColumn(out, F.coalesce(F.sum(n).over(earlier), F.lit(0))), offsets, ["_p", *keys], "inner").withColumn(out, F.col(out) + F.col("_o")).drop("_p", "_o")


def rank_norm(df: DataFrame, keys: list[str], value: str, out: str, higher_is_better: bool = True) -> DataFrame:
    """(rank - 1) / (highest rank - 1) of the value inside its group, 0 for the worst and 1 for the best; a group
    with one rank gives 0 if its value is zero, else 1; null values give null; a null key is a group. A rank is one more
    than the group's rows with values before, which are counted by value first: see cumulated()."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranks = cumulated(counted, keys, value, "_n", "_r", descending=not higher_is_better).drop("_n")
    best = ranks.groupBy(*keys).agg(F.max("_r").alias("_m"))
    lone = F.when(F.col(value) == 0, 0.0).otherwise(1.0)
    score = F.when(F.col("_m") == 0, lone).otherwise(F.col("_r") / F.col("_m"))
    scored = join_same(ranks, best, keys, "inner").select(*keys, value, score.alias(out))
    return join_same(df, scored, [*keys, value], "left")


def median_of(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """(keys, out): the exact median of the group's values, null if it has none. Values are counted first and cut
    where the running count passes the middle, so that no task sorts or holds a group."""
    groups = df.groupBy(*keys).agg(F.count(value).alias("_t"))
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    places = join_same(cumulated(counted, keys, value, "_n", "_b"), groups, keys, "inner")
    lower, upper = F.floor((F.col("_t") - 1) / 2), F.floor(F.col("_t") / 2)
    holds = lambda place: (F.col("_b") <= place) & (place < F.col("_b") + F.col("_n"))
    middle = places.where(holds(lower) | holds(upper)).groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(out))
    return join_same(groups.select(*keys), middle, keys, "left") if keys else groups.select().crossJoin(F.broadcast(middle))  # one row each


def golden_record(df: DataFrame, keys: list[str], columns: list[str], *order: str) -> DataFrame:
    """For each column on its own the first non-null value by `order`: an aggregate, not a running list."""
    place = F.struct(*order)
    return df.groupBy(*keys).agg(*(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns))


def mode_per_key(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The most frequent value per key, ties to the smallest."""
    counted = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(column, F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias(column))
