"""Databases over JDBC: parallel reads by ranges of a column, pushed filters, and loads of what is new.

Derby, which Spark brings, has no server: one process at a time may write to its files. On a cluster that is the
driver, which imports what the executors have staged; they read an archive of the database, which any number may open."""

from __future__ import annotations

import os
import re
import zipfile
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.sources import files

# How each platform's addresses begin, and its driver class.
PLATFORMS = {
    "oracle": ("jdbc:oracle:thin:@//{host}:{port}/{name}", "oracle.jdbc.OracleDriver"),
    "mysql": ("jdbc:mysql://{host}:{port}/{name}", "com.mysql.cj.jdbc.Driver"),
    "teradata": ("jdbc:teradata://{host}/DATABASE={name},DBS_PORT={port}", "com.teradata.jdbc.TeraDriver"),
    "derby": ("jdbc:derby:memory:{name};create=true", "org.apache.derby.jdbc.EmbeddedDriver"),
    "derby_files": ("jdbc:derby:directory:{name};create=true", "org.apache.derby.jdbc.EmbeddedDriver"),
    "derby_archive": ("jdbc:derby:jar:({name})db", "org.apache.derby.jdbc.EmbeddedDriver"),
}


def address(platform: str, name: str, host: str = "", port: int = 0) -> dict[str, str]:
    """The options url and driver of a platform; others raise."""
    if platform not in PLATFORMS:
        raise ValueError(f"unknown platform {platform!r}; known are {', '.join(PLATFORMS)}")
    url, driver = PLATFORMS[platform]
    return {"url": url.format(host=host, port=port, name=name), "driver": driver}


def read_query(spark: SparkSession, at: dict[str, str], query: str, **options: str) -> DataFrame:
    """A query's rows, by one task; filters and columns asked of the result are pushed into the database."""
    return spark.read.format("jdbc").options(**at, dbtable=f"({query}) q", **options).load()


def _ranges(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """Whole numbers from low to high in up to `parts` ranges (end exclusive) of even length."""
    step = max(1, -(-(high - low + 1) // parts))
    return [(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]


def read_parts(spark: SparkSession, at: dict[str, str], query: str, column: str, parts: int, **options: str) -> DataFrame:
    """A query's rows by tasks of a range each of a whole-number column, which the database filters itself. The
    bounds are its own minimum and maximum, read first; rows without a value are a part of their own, so none is lost.
    Ranges are of even length: choose a column that is evenly spread, as a key is."""
    low, high, none = read_query(spark, at, f"SELECT min({column}) AS lo, max({column}) AS hi, sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) AS n FROM ({query}) b", **options).first()
    where = [] if low is None else [f"{column} >= {a} AND {column} < {b}" for a, b in _ranges(int(low), int(high), parts)]
    if none or not where:
        where.append(f"{column} IS NULL")
    return spark.read.jdbc(at["url"], f"({query}) q", predicates=where, properties={"driver": at["driver"], **options})


def load_new(spark: SparkSession, at: dict[str, str], query: str, column: str, target: str, parts: int = 8, **options: str) -> DataFrame:
    """Appends to the Parquet table `target` what the query has above the greatest loaded value of the check column
    (all, if nothing is loaded), and returns what was loaded. The watermark is the target's own maximum, which Parquet
    statistics give and no failed load can move; the database filters by it. Rows without a check value never load."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    loaded = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    top = spark.read.parquet(target).agg(F.max(column)).first()[0] if loaded else None
    wanted = f"SELECT * FROM ({query}) s WHERE {column} IS NOT NULL" + (f" AND {column} > {int(top)}" if top is not None else "")
    new = read_parts(spark, at, wanted, column, parts, **options)
    before = set(spark.read.parquet(target).inputFiles()) if loaded else set()
    new.write.mode("append").parquet(target)
    added = sorted(set(spark.read.parquet(target).inputFiles()) - before)
    return spark.read.schema(new.schema).parquet(*added) if added else new.limit(0)


def write_table(df: DataFrame, at: dict[str, str], table: str, types: str | None = None, parts: int = 8, mode: str = "overwrite") -> None:
    """df as a database table, by at most `parts` connections at once; types: the database's column types. Derby in files
    takes no connections of executors: they stage the rows in `parts` files, which it imports one after the other."""
    options = {"createTableColumnTypes": types} if types else {}
    if _folder(at):
        df.limit(0).write.format("jdbc").options(**at, dbtable=table, **options).mode(mode).save()  # the table; no task
        return _import(df, at, table, parts)
    df.coalesce(parts).write.format("jdbc").options(**at, dbtable=table, batchsize="5000", **options).mode(mode).save()


def _folder(at: dict[str, str]) -> str | None:
    """Where Derby's files are, if it is in files."""
    found = re.match("jdbc:derby:directory:([^;]+)", at["url"])
    return found[1] if found else None


def _call(spark: SparkSession, url: str, statement: str | None = None) -> None:
    """A statement, if any, by a connection of the driver's process to Derby."""
    connection = spark._jvm.org.apache.derby.jdbc.EmbeddedDriver().connect(url, spark._jvm.java.util.Properties())
    try:
        if statement:
            connection.createStatement().execute(statement)
    finally:
        connection.close()


def _local(path: str) -> str:
    """A path of the shared folder as Derby opens it, which knows no other stores."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"Derby needs a shared folder that is mounted (file:), not {path}")
    return unquote(parts.path)


def _import(df: DataFrame, at: dict[str, str], table: str, parts: int) -> None:
    """Appends df to a table of Derby in files. All values are quoted, and nulls are the fields without quotes."""
    staged = files.scratch(df.sparkSession)
    fields = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(f"`{n}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for n in df.columns]
    df.select(F.concat_ws(",", *fields)).coalesce(parts).write.text(staged)
    schema, _, name = (x if x.startswith('"') else x.upper() for x in table.rpartition("."))
    text = lambda x: "'" + x.replace("'", "''") + "'" if x else "null"
    into = f"{text(schema.strip(chr(34)))}, {text(name.strip(chr(34)))}, {text(','.join(df.columns))}"
    for part in sorted(x for x in os.listdir(_local(staged)) if x.startswith("part-")):
        _call(df.sparkSession, at["url"], f"CALL SYSCS_UTIL.SYSCS_IMPORT_DATA({into}, null, {text(f'{_local(staged)}/{part}')}, ',', '\"', 'UTF-8', 0)")


def files_database(spark: SparkSession) -> dict[str, str]:
    """A new Derby database in the shared folder, which the driver alone may open."""
    return address("derby_files", _local(files.scratch(spark)))


def archived(spark: SparkSession, at: dict[str, str]) -> dict[str, str]:
    """The address of an archive of a Derby database in files as it is now, which all processes may read at once. It is
    closed for that, so that nothing needs to be recovered, and packed without compression, so that pages are read where they are."""
    folder = _folder(at)
    try:
        _call(spark, f"jdbc:derby:directory:{folder};shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # how Derby says that a database was closed
            raise
    path = _local(files.scratch(spark)) + ".jar"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for top, _, names in os.walk(folder):
            for full in [top, *(os.path.join(top, n) for n in sorted(names))]:
                z.write(full, os.path.normpath(os.path.join("db", os.path.relpath(full, folder))))
    return address("derby_archive", path)


def unload(spark: SparkSession, at: dict[str, str], query: str, column: str, path: str, values: dict[str, str], parts: int = 8, **run: str) -> DataFrame:
    """A query's rows, with its $$names by their values, as Parquet under `path` in the partition of the run
    (pt_data_dt="...", pt_cycle_id="..."), which is replaced; other runs stay. Read and written by ranges of the column."""
    rows = read_parts(spark, at, files.render(query, values), column, parts)
    folder = "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in run.items())])
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def copy_into(spark: SparkSession, path: str, at: dict[str, str], table: str, types: str | None = None, parts: int = 8, mode: str = "overwrite", **run: str) -> int:
    """The rows of one run under `path` into a database table; how many there were. Names go as the database has unquoted ones."""
    rows = files.read_runs(spark, path, **run).drop(*run)
    write_table(rows.toDF(*(c.upper() for c in rows.columns)), at, table, types, parts, mode)
    return rows.count()
