"""Rules run in dependency order, checks run side by side, and their results published, withdrawn and traced."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CriticalFailure(RuntimeError):
    """All critical checks that failed, in one message."""


@dataclass(frozen=True)
class Rule:
    """run(spark, inputs by name) gives the frame that is published under the rule's name."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    active: bool = True


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    message: str = ""
    count: int = 0


@dataclass
class Lineage:
    triplets: list[tuple[str, str, str]] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.triplets, "subject string, predicate string, object string")


def cycle_chain(runs: DataFrame, processes: list[str]) -> DataFrame:
    """runs(process, cycle, depends) to a column for each process: the cycles of the first one, and for each the
    cycle that it depends on, through the whole chain; null where one is missing."""
    of = lambda p: runs.where(F.col("process") == p).select(F.col("cycle").alias(p), F.col("depends").alias(f"_{p}"))
    out = of(processes[0])
    for before, p in zip(processes, processes[1:]):
        out = out.join(of(p), F.col(f"_{before}") == F.col(p), "left")
    return out.select(*processes)


def in_order(rules: Iterable[Rule]) -> list[Rule]:
    """Each rule after those it needs; a circle raises."""
    left, done, out = {r.name: r for r in rules if r.active}, set(), []
    while left:
        ready = sorted(n for n, r in left.items() if not (set(r.needs) & left.keys()) - done)
        if not ready:
            raise ValueError(f"rules need each other: {sorted(left)}")
        for n in ready:
            out.append(left.pop(n))
            done.add(n)
    return out


def resolve_inputs(needs: dict[str, str], batches: dict[str, list[str]], overrides: dict[str, str] | None = None) -> dict[str, list[str]]:
    """The batches of each dataset: all of them for 'full', the last for 'latest', or the override's one."""
    found = {}
    for name, mode in needs.items():
        have, wanted = sorted(batches.get(name, [])), (overrides or {}).get(name)
        if mode not in ("full", "latest"):
            raise ValueError(f"{name}: {mode} is neither full nor latest")
        if wanted is not None and wanted not in have:
            raise ValueError(f"{name} has no batch {wanted}")
        found[name] = [wanted] if wanted is not None else have if mode == "full" else have[-1:]
        if not found[name]:
            raise ValueError(f"{name} has no batch")
    return found


def run_rules(spark: SparkSession, rules: Iterable[Rule], root: str, batch: str, sources: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], Lineage]:
    """Runs the rules, publishes each result under root/name and reads it again, so that a lost executor costs
    no earlier rule. The lineage names what each rule used and the batch that made it."""
    made, lineage = dict(sources), Lineage()
    for r in in_order(rules):
        missing = [n for n in r.needs if n not in made]
        if missing:
            raise ValueError(f"{r.name} needs {missing}")
        publish(r.run(spark, {n: made[n] for n in r.needs}), f"{root}/{r.name}", batch)
        made[r.name] = batches_of(spark, f"{root}/{r.name}", [batch])
        lineage.triplets += [(r.name, "uses", n) for n in r.needs] + [(r.name, "made_in", batch)]
    return made, lineage


def publish(df: DataFrame, path: str, batch: str, latest: bool = False) -> None:
    """As a partition of the batch, which replaces that partition only; `latest` replaces the whole table."""
    out = df.withColumn("batch_id", F.lit(batch)).write.mode("overwrite").partitionBy("batch_id")
    out.option("partitionOverwriteMode", "static" if latest else "dynamic").parquet(path)


def batches_of(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    """Only the batches' partitions are listed and read. Their ids stay the strings they are: partition
    discovery would read 002 as 2."""
    parts = [spark.read.parquet(f"{path}/batch_id={b}").withColumn("batch_id", F.lit(b)) for b in batches]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def withdraw(spark: SparkSession, path: str, batch: str, away: str) -> bool:
    """Moves a batch's partition to the same place under `away`, without reading it. restore() is the same with
    the paths exchanged. False if there is no such partition."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    make = jvm.org.apache.hadoop.fs.Path
    source, target = make(f"{path}/batch_id={batch}"), make(f"{away}/batch_id={batch}")
    fs = source.getFileSystem(conf)
    if not fs.exists(source):
        return False
    if fs.exists(target):
        raise FileExistsError(str(target))
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{source} can't be moved")
    return True


def restore(spark: SparkSession, path: str, batch: str, away: str) -> bool:
    return withdraw(spark, away, batch, path)


def check_all(checks: dict[str, tuple[str, Callable[[], int]]], threads: int = 4) -> list[Outcome]:
    """checks: name to (criticality, function that counts errors). All of them run, `threads` at a time; then
    any failed critical one raises with all their names."""

    def one(item: tuple[str, tuple[str, Callable[[], int]]]) -> Outcome:
        name, (_, count) = item
        try:
            n = count()
        except Exception as e:  # noqa: BLE001 - a check that can't run has failed
            return Outcome(name, "ERROR", str(e))
        return Outcome(name, "FAILED" if n else "PASSED", f"{n} rows" if n else "", n)

    with ThreadPoolExecutor(threads) as pool:
        done = list(pool.map(one, checks.items()))
    critical = [o for o in done if o.status != "PASSED" and checks[o.name][0] == "C"]
    if critical:
        raise CriticalFailure("; ".join(f"{o.name}: {o.message}" for o in critical))
    return done
