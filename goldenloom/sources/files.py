"""File sources and sinks: CSV, JSON, XML, Parquet, all-string landing and typed conversion."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPORAL = ("date", "timestamp")


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder, or the context's checkpoint folder; a local one where neither is
    set, but only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = folder.get() if folder.isDefined() else None
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="goldenloom-"))  # one for all of this session's files
        base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/goldenloom-files/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> None:
    """Deletes the files of this application in the shared folder. Results read them until they are written: call it after
    that; catalog tables saved there lose their rows too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark)).getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: what is drawn anew by each run (borders of ranges, row numbers)
    is fixed from here on, and lost executors cost nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def through_csv(df: DataFrame, sep: str = "|", multi_line: bool = False) -> DataFrame:
    """Written as CSV with a header and read with the same schema. Files are read in parts unless values may hold line
    ends (multi_line), which takes one task a file."""
    path = scratch(df.sparkSession)
    options = {"header": True, "sep": sep, "escape": '"'}
    df.write.options(**options).csv(path)
    return df.sparkSession.read.schema(df.schema).options(**options, multiLine=multi_line).csv(path)


def through_partitions(df: DataFrame, *keys: str) -> DataFrame:
    """Written with dynamic partition overwrite and read again."""
    path = scratch(df.sparkSession)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return df.sparkSession.read.parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """One CSV file, all values quoted. The rows are made in parallel first; a single task only copies them."""
    made = scratch(df.sparkSession)
    df.write.parquet(made)
    df.sparkSession.read.schema(df.schema).parquet(made).coalesce(1).write.mode("overwrite").options(sep=sep, header=header, quoteAll=True).csv(path)


def newer_than(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Rows of the source above the loaded maximum of the check column; all of them if nothing is loaded."""
    top = loaded.agg(F.max(column).alias("_top"))
    return source.crossJoin(F.broadcast(top)).where(F.col("_top").isNull() | (F.col(column) > F.col("_top"))).drop("_top")  # one row


def read_runs(spark: SparkSession, path: str, **run: str) -> DataFrame:
    """The rows of the given run partitions only (pt_data_dt="...", pt_cycle_id="..."), from partition pruning."""
    df = spark.read.option("inferSchema", False).parquet(path)
    for column, value in run.items():
        df = df.where(F.col(column).cast("string") == value)
    return df


def land(spark: SparkSession, source: str, target: str, kind: str = "csv", sep: str = ",", header: bool | list[str] = True, mb: int = 128, multi_line: bool = False) -> DataFrame:
    """CSV or Parquet landed as Parquet with all columns as strings, in files of about `mb` MB. header: whether the
    file has one, or the column names of a file without; without either columns are called col1, col2 and so on. A file is read in
    parts by many tasks unless its values may hold line ends (multi_line)."""
    if kind == "parquet":
        df = spark.read.parquet(source)
    else:
        df = spark.read.options(sep=sep, header=header is True, escape='"', multiLine=multi_line, inferSchema=False).csv(source)
        if header is not True:
            df = df.toDF(*(header or [f"col{k + 1}" for k in range(len(df.columns))]))
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    all_string(df).repartition(max(1, -(-size // (mb << 20)))).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def counts_by_file(df: DataFrame) -> DataFrame:
    """(file, n) for the rows of a file source."""
    return df.groupBy(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file")).agg(F.count("*").alias("n"))


def doubles_to_int(df: DataFrame) -> DataFrame:
    """Every double column as int, by the schema; values that don't fit are null."""
    return df.select(*(F.col(f"`{n}`").try_cast("int").alias(n) if kind == "double" else F.col(f"`{n}`") for n, kind in df.dtypes))


def all_string(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def convert(df: DataFrame, metadata: list[tuple[str, str, str | None]]) -> DataFrame:
    """(column, type, format) by column; values that don't convert are null."""
    made = []
    for column, kind, pattern in metadata:
        c = F.col(column)
        if kind in TEMPORAL and pattern:
            made.append(F.try_to_timestamp(c, F.lit(pattern)).cast(kind).alias(column))
        else:
            made.append(c.try_cast(kind).alias(column))
    return df.select(*made)


def read_json(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """Multi-line JSON; the schema of a sample file is enforced on all."""
    reader = spark.read.option("multiLine", True)
    return reader.schema(reader.json(sample).schema).json(path) if sample else reader.json(path)


def read_xml(spark: SparkSession, paths: list[str], row_tag: str) -> DataFrame:
    return spark.read.option("rowTag", row_tag).format("xml").load(paths)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def plain_name(c: Column) -> Column:
    """A column name as headers are compared: letters and digits only, case aside."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def same_header(found: list[str], expected: list[str]) -> bool:
    """Equal in order, letters and digits only, case aside."""
    plain = lambda names: [re.sub(r"[^a-z0-9]", "", n.lower()) for n in names]
    return plain(found) == plain(expected)


def check_files(spark: SparkSession, path: str, expected: list[str], sep: str = ",") -> DataFrame:
    """(file, header, same_header, n_rows, n_bad) of the delimited files under `path`: whether the first line has the
    expected names in order, and how many of the other lines have another number of fields; quoted values may hold the
    delimiter, not a line end. Lines are read in parts, so a file of any size is many tasks; empty files have no row."""
    fields = F.size(F.split(F.regexp_replace("value", '"([^"]|"")*"', ""), re.escape(sep)))
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("place"), "value", fields.alias("fields"))
    whole = lines.groupBy("path").agg(F.min_by("value", "place").alias("header"), F.count("*").alias("lines"), F.count_if(F.col("fields") != len(expected)).alias("bad"), F.min_by("fields", "place").alias("named"))
    names = F.transform(F.split("header", re.escape(sep)), plain_name)
    wanted = F.array(*(plain_name(F.lit(n)) for n in expected))
    return whole.select(
        F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"), "header", (names == wanted).alias("same_header"), (F.col("lines") - 1).alias("n_rows"),
        (F.col("bad") - F.when(F.col("named") != len(expected), 1).otherwise(0)).alias("n_bad"))


def name_rule(pattern: str) -> str:
    """The regular expression of a file-name pattern with YYYY, MM, DD, HH, SS and *."""
    rule = re.escape(pattern)
    for mark, digits in (("YYYY", 4), ("MM", 2), ("DD", 2), ("HH", 2), ("SS", 2)):
        rule = rule.replace(mark, rf"[0-9]{{{digits}}}")
    return rule.replace(r"\*", ".*")


def file_name_matches(name: str, pattern: str) -> bool:
    """A pattern against a whole file name."""
    return re.fullmatch(name_rule(pattern), name) is not None


def name_matches(name: Column, pattern: str) -> Column:
    """As file_name_matches(), for a column of names."""
    return name.rlike(f"^(?s:{name_rule(pattern)})\\z")


def render(template: str, values: dict[str, str]) -> str:
    """$$name by its value; a name that is left over is an error."""
    out = re.sub(r"\$\$(\w+)", lambda m: str(values[m[1]]) if m[1] in values else m[0], template)
    if "$$" in out:
        raise ValueError(f"unresolved parameter in {out!r}")
    return out


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|[\s/]+", "_", name).lower()
