"""Running, publishing and tracing: queries over the rule runner and the file functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.operators import runner
from goldenloom.plans.registry import Tables, query
from goldenloom.sources import files

c = F.col


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def xml_roundtrip(t: Tables) -> DataFrame:
    path = files.scratch(t.spark)
    t.nation.select("n_nationkey", "n_name", "n_regionkey").write.format("xml").options(rowTag="nation", rootTag="nations").save(path)
    return files.read_xml(t.spark, [path], "nation").select(c("n_nationkey").cast("int").alias("n_nationkey"), "n_name", c("n_regionkey").cast("int").alias("n_regionkey"))


@query("SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def csv_export(t: Tables) -> DataFrame:
    """Exported as a single file and read again."""
    path = files.scratch(t.spark)
    files.export_csv(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")), path)
    return t.spark.read.option("header", True).schema("o_custkey bigint, n bigint, total double").csv(path)


@query("""SELECT 'customer' AS file, true AS same_header, count(*) AS n_rows, 0 AS n_bad FROM customer UNION ALL SELECT 'supplier', false, count(*), 0 FROM supplier
UNION ALL SELECT 'nation', false, count(*), count(*) FROM nation UNION ALL SELECT 'orders', true, count(*), count(*) FILTER (o_orderstatus = 'F') FROM orders""")
def header_check(t: Tables) -> DataFrame:
    """Files written from the tables, against the header that customers' files have: other names, a field less, and lines
    with a field more."""
    base, names = files.scratch(t.spark), ["c_custkey", "c_name", "c_nationkey"]
    put = lambda df, name: df.coalesce(1).write.csv(f"{base}/{name}", header=True, sep="|", quote="")
    put(t.customer.select(c("c_custkey").alias("C Cust-Key"), c("c_name").alias("C_NAME"), "c_nationkey"), "customer")
    put(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), "supplier")
    put(t.nation.select("n_nationkey", "n_name"), "nation")
    key = F.when(c("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit("|x"))).otherwise(c("o_orderpriority"))
    put(t.orders.select(c("o_custkey").alias("c_custkey"), key.alias("c_name"), c("o_orderkey").alias("c_nationkey")), "orders")
    return files.check_files(t.spark, base, names, "|").select(F.regexp_extract("file", "^([^/]+)", 1).alias("file"), "same_header", "n_rows", "n_bad")


_NAMED = "CASE o_orderstatus WHEN 'F' THEN 'sites_' || {day} || '.csv' WHEN 'O' THEN 'trials_' || {dashed} || '_' || o_orderpriority || '.csv' ELSE 'sites_' || {day} || '.csv.bak' END"


@query(f"""WITH n AS (SELECT o_orderkey, {_NAMED.format(day="strftime(o_orderdate, '%Y%m%d')", dashed="strftime(o_orderdate, '%m-%d-%Y')")} AS name FROM orders)
SELECT o_orderkey, name, regexp_full_match(name, 'sites_[0-9]{{8}}[.]csv') AS sites, regexp_full_match(name, 'trials_[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}.*[.]csv') AS trials FROM n""")
def file_name_check(t: Tables) -> DataFrame:
    """Names of files, one for each order, against two patterns."""
    named = t.orders.select("o_orderkey", F.expr(_NAMED.format(day="date_format(o_orderdate, 'yyyyMMdd')", dashed="date_format(o_orderdate, 'MM-dd-yyyy')")).alias("name"))
    return named.withColumns({"sites": files.name_matches(c("name"), "sites_YYYYMMDD.csv"), "trials": files.name_matches(c("name"), "trials_MM-DD-YYYY*.csv")})


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus <> 'P' GROUP BY 1")
def render_params(t: Tables) -> DataFrame:
    """SQL from a template with named parameters."""
    template = "SELECT $$column, count(*) AS n FROM {orders} WHERE o_orderdate >= timestamp'$$from' AND $$column <> '$$not' GROUP BY 1"
    return t.sql(files.render(template, {"column": "o_orderstatus", "from": "1997-01-01", "not": "P"}), "orders")


def _published(t: Tables, path: str) -> None:
    for year in (1996, 1997, 1998):
        runner.publish(t.orders.where(F.year("o_orderdate") == year).select("o_orderkey"), path, str(year))


@query("SELECT 'full' AS mode, CAST(year(o_orderdate) AS VARCHAR) AS batch_id, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 2 UNION ALL SELECT 'latest', '1998', count(*) FROM orders WHERE year(o_orderdate) = 1998 UNION ALL SELECT 'override', '1997', count(*) FROM orders WHERE year(o_orderdate) = 1997")
def publish_full_latest(t: Tables) -> DataFrame:
    """Three batches published; read whole, the latest only, and a named one."""
    path = files.scratch(t.spark)
    _published(t, path)
    have, out = {"orders": ["1996", "1997", "1998"]}, None
    for mode, needs, named in (("full", "full", None), ("latest", "latest", None), ("override", "latest", {"orders": "1997"})):
        found = runner.resolve_inputs({"orders": needs}, have, named)["orders"]
        part = runner.batches_of(t.spark, path, found).groupBy("batch_id").agg(F.count("*").alias("n")).select(F.lit(mode).alias("mode"), "batch_id", "n")
        out = part if out is None else out.union(part)
    return out


@query("SELECT 'withdrawn' AS state, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1998) UNION ALL SELECT 'restored', count(*) FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def withdraw_restore(t: Tables) -> DataFrame:
    """A batch is moved away and back again; the counts of what is read meanwhile and after are written down."""
    base = files.scratch(t.spark)
    path, away = f"{base}/orders", f"{base}/away"
    _published(t, path)
    runner.withdraw(t.spark, path, "1997", away)
    runner.publish(t.spark.read.parquet(path).agg(F.lit("withdrawn").alias("state"), F.count("*").alias("n")), f"{base}/told", "1")
    runner.restore(t.spark, path, "1997", away)
    runner.publish(t.spark.read.parquet(path).agg(F.lit("restored").alias("state"), F.count("*").alias("n")), f"{base}/told", "2")
    return t.spark.read.parquet(f"{base}/told").select("state", "n")


def _rules(t: Tables):
    spent = runner.Rule("spent", lambda s, x: x["orders"].groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total")), ("orders",))
    best = runner.Rule("best", lambda s, x: x["spent"].join(x["customer"], c("o_custkey") == c("c_custkey")).groupBy("c_nationkey").agg(F.max("total").alias("best")), ("spent", "customer"))
    off = runner.Rule("off", lambda s, x: x["orders"], ("orders",), active=False)
    return runner.run_rules(t.spark, [best, off, spent], files.scratch(t.spark), "b1", {"orders": t.orders, "customer": t.customer})


@query("SELECT c_nationkey, max(total) AS best FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def rule_run(t: Tables) -> DataFrame:
    """Rules in the order of their needs; each result is published and read again."""
    return _rules(t)[0]["best"].select("c_nationkey", "best")


@query("SELECT * FROM (VALUES ('spent', 'uses', 'orders'), ('spent', 'made_in', 'b1'), ('best', 'uses', 'spent'), ('best', 'uses', 'customer'), ('best', 'made_in', 'b1')) v(subject, predicate, object)")
def lineage_triplets(t: Tables) -> DataFrame:
    return _rules(t)[1].frame(t.spark)


@query("SELECT 'debtors' AS name, CASE WHEN count(*) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, count(*) AS n FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'nations', CASE WHEN count(*) > 0 THEN 'FAILED' ELSE 'PASSED' END, count(*) FROM nation WHERE n_name IS NULL UNION ALL SELECT 'broken', 'ERROR', 0")
def qc_fanout(t: Tables) -> DataFrame:
    """Checks side by side; one can't run, which is told like a failure."""
    checks = {"debtors": ("NC", lambda: t.customer.where("c_acctbal < 0").count()), "nations": ("C", lambda: t.nation.where("n_name is null").count()), "broken": ("NC", lambda: t.nation.where("no_such_column > 0").count())}
    return t.spark.createDataFrame([(o.name, o.status, o.count) for o in runner.check_all(checks)], "name string, status string, n bigint")


@query("SELECT o_orderkey AS fact, c_custkey AS dimension, n_nationkey AS source FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey")
def cycle_lineage(t: Tables) -> DataFrame:
    """Cycles of three processes, each with the value of the cycle that it depends on."""
    runs = (
        t.orders.select(F.lit("fact").alias("process"), c("o_orderkey").cast("bigint").alias("cycle"), c("o_custkey").cast("bigint").alias("depends"))
        .union(t.customer.where("c_acctbal > 0").select(F.lit("dimension"), c("c_custkey").cast("bigint"), c("c_nationkey").cast("bigint")))
        .union(t.nation.where("n_regionkey <> 2").select(F.lit("source"), c("n_nationkey").cast("bigint"), F.lit(None).cast("bigint"))))
    return runner.cycle_chain(runs, ["fact", "dimension", "source"])
