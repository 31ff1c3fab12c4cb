"""Rates, durations, clamps, entropy, decay, and the configured metric engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.functions.keys import join_same

DAYS_PER_MONTH = 30.4


def share(part: Column, whole: Column) -> Column:
    """part / whole; null if either is null or whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def months(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(DAYS_PER_MONTH)


def rate(treated: Column, duration: Column) -> Column:
    """treated / duration; 0 if none was treated; null without a duration."""
    return F.when(treated == 0, F.lit(0.0)).otherwise(F.try_divide(treated.cast("double"), duration))


def clamp(c: Column, high: float | None = None) -> Column:
    """Below 0 to 0, above `high` to `high`; null stays."""
    top = F.when(c > high, F.lit(high)).otherwise(c) if high is not None else c
    return F.when(c < 0, F.lit(0.0)).otherwise(top)


def entropy(parts: list[Column], base: float, smooth: float = 0.0) -> Column:
    """Sum of p log(1/p) over the parts' shares of their sum, in the given base; zeros count nothing; null if
    the sum is 0."""
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    terms = []
    for p in parts:
        s = F.try_divide(F.coalesce(p, F.lit(0.0)), total) + F.lit(smooth)
        terms.append(F.when(s > 0, -s * F.ln(s)).otherwise(0.0))
    return F.when(total > 0, F.greatest(F.lit(0.0), sum(terms, F.lit(0.0)) / F.ln(F.lit(base))))


def largest(parts: dict[str, Column]) -> Column:
    """The name of the largest part, ties by the order given."""
    ranked = F.array(*(F.struct(F.coalesce(v, F.lit(0.0)).alias("v"), F.lit(-k).alias("k"), F.lit(n).alias("n")) for k, (n, v) in enumerate(parts.items())))
    return F.array_max(ranked)["n"]


def decayed(df: DataFrame, keys: list[str], time: str, value: str, out: str, k: float = 0.912) -> DataFrame:
    """b_i = v_i + b_(i-1) exp(-k (t_i - t_(i-1))) for any span of time. Times fall into blocks short enough for the
    closed form over offsets from the block's start; a block's last burden is carried into the later ones by a
    fold over the group's few blocks, so a group is never one window or one row. Rows of equal times each have the burden
    of all of them; a row without a time has none and adds none; a null value adds nothing; null keys are a group."""
    length = 300.0 / k
    block = df.withColumn("_m", F.floor(F.col(time) / F.lit(length)))
    offset = F.exp(F.lit(k) * (F.col(time) - F.col("_m") * F.lit(length)))
    ends = block.where("_m is not null").groupBy(*keys, "_m").agg(F.max(time).alias("t"), F.coalesce(F.sum(F.col(value) * offset), F.lit(0.0)).alias("s"))
    ends = ends.withColumn("b", F.col("s") * F.exp(-F.lit(k) * (F.col("t") - F.col("_m") * F.lit(length))))
    step = f"struct(x.b + a.b * exp(-{k}D * (x.t - coalesce(a.t, x.t))) as b, cast(x.t as double) as t, concat(a.v, array(struct(x.m as m, a.b as b, a.t as t))) as v)"
    start = "struct(0D as b, cast(null as double) as t, cast(array() as array<struct<m:bigint,b:double,t:double>>) as v)"
    folded = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_m").alias("m"), F.col("t").cast("double").alias("t"), "b"))).alias("x"))
    carried = folded.select(*keys, F.explode(F.expr(f"aggregate(x, {start}, (a, x) -> {step}, a -> a.v)")).alias("c")).select(*keys, F.col("c.m").alias("_m"), F.col("c.b").alias("_b"), F.col("c.t").alias("_t"))
    w = Window.partitionBy(*keys, "_m").orderBy(time)  # up to the last row of an equal time
    local = F.coalesce(F.sum(F.col(value) * offset).over(w), F.lit(0.0)) / offset
    carry = F.coalesce(F.col("_b") * F.exp(-F.lit(k) * (F.col(time) - F.col("_t"))), F.lit(0.0))
    return join_same(block.withColumn(out, local), carried, [*keys, "_m"], "left").withColumn(out, F.when(F.col("_m").isNotNull(), F.col(out) + carry)).drop("_m", "_b", "_t")


def started(initiated: Column, treated: Column, delta: int = 14) -> Column:
    """The first visit's date, or that of the first treatment less `delta` days."""
    return F.coalesce(F.to_date(initiated), F.date_sub(F.to_date(treated), delta))


def elapsed(initiated: Column, treated: Column, planned_end: Column, today: Column, delta: int = 14) -> Column:
    """The share of the planned time that is over; null without a start or a planned end, or if the plan has no days."""
    start = started(initiated, treated, delta)
    return share(F.datediff(start, today), F.datediff(start, F.to_date(planned_end)))


def recruitment_months(status: Column, start: Column, end: Column, today: Column, done: Column, over: Column, ongoing: tuple[str, ...], completed: tuple[str, ...]) -> Column:
    """From start to end for ongoing and completed sites. An ongoing one without an end counts to today if more
    than half of its subjects came, or fewer and more than half of the time is over; exactly half gives null."""
    plain = F.lower(F.trim(status))
    open_ = end.isNull() & ((done > 0.5) | ((done < 0.5) & (over > 0.5)))
    return F.when(plain.isin(*ongoing), F.when(open_, months(start, today)).otherwise(months(start, end))).when(plain.isin(*completed), months(start, end))


def screen_failures(status: Column, failed: Column, screened: Column, actual_end: Column, ongoing: tuple[str, ...], completed: tuple[str, ...]) -> Column:
    """failed / screened in percent, for completed sites and for ongoing ones with an actual end date."""
    plain = F.lower(F.trim(status))
    return F.when((plain.isin(*ongoing) & actual_end.isNotNull()) | plain.isin(*completed), share(failed, screened) * 100)


@dataclass(frozen=True)
class Metric:
    """logic: SQL aggregate; filters: SQL predicate."""

    alias: str
    logic: str
    filters: str = "true"


def metrics(source: DataFrame, grain: list[str], rows: list[Metric]) -> DataFrame:
    """All metrics of one source and grain in a single aggregate: a metric's filter goes into its aggregate, so
    nothing is scanned or joined once a metric."""
    return source.groupBy(*grain).agg(*(F.expr(f"{m.logic} FILTER (WHERE {m.filters})").alias(m.alias) for m in rows))


@dataclass(frozen=True)
class ConfiguredMetric:
    """A row of a metric configuration: metric `alias` of a grain, from one source. Rows of one alias and
    several sources are coalesced in their order."""

    grain: tuple[str, ...]
    alias: str
    source: str
    logic: str
    filters: str = "true"


def configured(sources: dict[str, DataFrame], rows: list[ConfiguredMetric]) -> dict[tuple[str, ...], DataFrame]:
    """By grain, a frame of its keys and all its metrics. Each source is aggregated once a grain; the sources'
    rows are united and the first value that is not null, in the order of the configuration, is taken by one
    more aggregate, so that no metric costs a join."""
    out = {}
    for grain in dict.fromkeys(r.grain for r in rows):
        own = [r for r in rows if r.grain == grain]
        names, parts = list(dict.fromkeys(r.alias for r in own)), []
        for source in dict.fromkeys(r.source for r in own):
            of = {r.alias: (own.index(r), r) for r in own if r.source == source}
            made = metrics(sources[source], list(grain), [Metric(a, r.logic, r.filters) for a, (_, r) in of.items()])
            value = lambda n: F.struct(F.lit(of[n][0]).alias("at"), F.col(n).cast("double").alias("v")) if n in of else F.lit(None).cast("struct<at:int,v:double>")  # noqa: B023, E731
            parts.append(made.select(*grain, *(F.when(F.col(n).isNotNull() if n in of else F.lit(False), value(n)).alias(n) for n in names)))
        united = parts[0]
        for p in parts[1:]:
            united = united.unionByName(p)
        out[grain] = united.groupBy(*grain).agg(*(F.min(n)["v"].alias(n) for n in names))
    return out
