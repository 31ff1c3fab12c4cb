"""Data-quality engine: all row checks in one pass, errors as an exploded array of structs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Declared format to pattern; other formats are read as the default one.
DATE_PATTERNS = {
    "%Y-%m-%dT%H:%M:%S+0000": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+\d{4}$",
    "%Y": r"^\d{4}$",
    "%Y-%m-%dT%H:%M:%S.%f+0000": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}\+\d{4}$",
    "MM/DD/YYYY": r"^\d{2}/\d{2}/\d{4}$",
    "YYYY-MM-DD HH24:MI:SS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}$",
    "%Y-%m-%dT%H:%M:%S.%fZ": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z?$",
}
DEFAULT_DATE = "MM/DD/YYYY"
KINDS = ("null", "length", "date", "integer", "decimal", "domain", "unique")


@dataclass(frozen=True)
class Check:
    """kind: null, length, date, integer, decimal, domain or unique; param as the kind needs it; scope: SQL
    predicate of the rows it looks at; criticality 'C' or 'NC'."""

    qc_id: int
    kind: str
    column: str
    param: str = ""
    scope: str = "true"
    criticality: str = "NC"


def _fails(check: Check) -> Column:
    c = F.col(check.column.split(",")[-1].strip()).cast("string")
    if check.kind == "null":
        return c.isNull()
    if check.kind == "length":
        m = re.fullmatch(r"\s*(>=|<=|>|<|=|!)\s*(\d+)\s*", check.param)
        if not m:
            return F.lit(True)
        n, size = int(m[2]), F.length(c)
        good = {">=": size >= n, "<=": size <= n, ">": size > n, "<": size < n, "=": size == n, "!": size != n}[m[1]]
        return ~F.coalesce(good, F.lit(False))
    if check.kind == "unique":
        keys = [k.strip() for k in check.column.split(",")]
        return F.count("*").over(Window.partitionBy(*keys)) > 1
    if check.kind == "domain":
        return c.isNotNull() & ~c.isin(*re.findall(r"'([^']*)'", check.param))
    if check.kind not in KINDS:
        raise ValueError(f"unknown check {check.kind!r}")
    pattern = {"integer": r"^-?\d+$", "decimal": r"^-?\d*[.]?\d+$"}.get(check.kind) or DATE_PATTERNS.get(check.param, DATE_PATTERNS[DEFAULT_DATE])
    return c.isNotNull() & ~c.rlike(pattern)


def _value(check: Check) -> Column:
    """The checked value; of several columns all, parted by |, with nulls told apart from empty values."""
    columns = [F.col(k.strip()).cast("string") for k in check.column.split(",")]
    if len(columns) == 1:
        return columns[0]
    return F.concat_ws("|", *(F.coalesce(F.regexp_replace(c, r"([|\\])", r"\\$1"), F.lit("\\N")) for c in columns))


def errors(df: DataFrame, row_id: str, checks: list[Check]) -> DataFrame:
    """(row_id, qc_id, kind, column_name, error_value, criticality), a row per failed check; a kind that is not
    known raises. The value of a check over several columns is the whole key."""
    found = [
        F.when(F.expr(k.scope) & _fails(k), F.struct(F.lit(k.qc_id).alias("qc_id"), F.lit(k.kind).alias("kind"), F.lit(k.column).alias("column_name"), _value(k).alias("error_value"), F.lit(k.criticality).alias("criticality")))
        for k in checks
    ]
    if not found:
        return df.select(F.col(row_id).alias("row_id"), F.lit(0).alias("qc_id"), *(F.lit("").alias(n) for n in ("kind", "column_name", "error_value", "criticality"))).where("false")
    return df.select(F.col(row_id).alias("row_id"), F.array_compact(F.array(*found)).alias("e")).select("row_id", F.explode("e").alias("e")).select("row_id", "e.*")


def summary(df: DataFrame, failed: DataFrame, checks: list[Check]) -> DataFrame:
    """(qc_id, error_count, failure_percentage) for all checks, those without errors too."""
    total = df.agg(F.count("*").alias("total"))
    every = df.sparkSession.createDataFrame([(k.qc_id,) for k in checks], "qc_id int")
    counted = every.join(failed.groupBy("qc_id").agg(F.count("*").alias("n")), "qc_id", "left")
    return counted.crossJoin(F.broadcast(total)).select("qc_id", F.coalesce("n", F.lit(0)).alias("error_count"), F.coalesce(F.round(F.try_divide(F.coalesce("n", F.lit(0)) * 100.0, F.col("total")), 4), F.lit(0.0)).alias("failure_percentage"))


def survivors(failed: DataFrame, unique_id: int) -> DataFrame:
    """The errors less those of the row that a duplicate group keeps: of the rows with its whole key and without
    another critical error the one with the highest id."""
    other = failed.where((F.col("qc_id") != unique_id) & (F.col("criticality") == "C")).select("row_id").distinct()
    kept = failed.where(F.col("qc_id") == unique_id).join(other, "row_id", "left_anti").groupBy("error_value").agg(F.max("row_id").alias("row_id"))
    return failed.join(kept.select("row_id", F.lit(unique_id).alias("qc_id")), ["row_id", "qc_id"], "left_anti")


def passed(df: DataFrame, row_id: str, failed: DataFrame) -> DataFrame:
    """Rows without a critical error."""
    bad = failed.where("criticality = 'C'").select(F.col("row_id").alias(row_id)).distinct()
    return df.join(bad, row_id, "left_anti")


def standardise(df: DataFrame, steps: list[tuple[str, str, str]]) -> DataFrame:
    """(column, step, param) applied in order: blank, trim, upper, lower, lpad, rpad, substring, replace, zip,
    date. Blank results are null, except that zip leaves them."""
    for column, step, param in steps:
        c = F.col(column).cast("string")
        a, _, b = param.partition(",")
        made = {
            "blank": lambda: c, "trim": lambda: F.trim(c), "upper": lambda: F.upper(c), "lower": lambda: F.lower(c), "lpad": lambda: F.lpad(c, int(a), b), "rpad": lambda: F.rpad(c, int(a), b),  # noqa: B023
            "substring": lambda: F.substring(c, int(a), int(b)), "replace": lambda: F.regexp_replace(c, a, b), "zip": lambda: F.substring_index(c, "-", 1),  # noqa: B023
            "date": lambda: F.date_format(F.try_to_timestamp(F.when(F.length(c) == 4, F.concat(c, F.lit("-01-01"))).when(F.length(c) == 7, F.concat(c, F.lit("-01"))).otherwise(c), F.lit(a)), "yyyy-MM-dd"),  # noqa: B023
        }[step]()
        df = df.withColumn(column, made if step == "zip" else F.nullif(made, F.lit("")))
    return df


def mapping_qc(spark: SparkSession, rules: list[tuple[str, str]], frames: dict[str, DataFrame]) -> DataFrame:
    """rules: (name, SQL with {frame} names) to (name, sql, problems, status): how many rows each query finds; any
    is a failure. All queries are one plan."""
    out = None
    for name, sql in rules:
        used = {k: v for k, v in frames.items() if "{" + k + "}" in sql}
        n = spark.sql(sql, **used).agg(F.count("*").alias("problems"))
        row = n.select(F.lit(name).alias("name"), F.lit(sql).alias("sql"), "problems", F.when(F.col("problems") > 0, "FAIL").otherwise("PASS").alias("status"))
        out = row if out is None else out.union(row)
    return out
