"""Scans, predicates, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.functions import multi
from goldenloom.functions.keys import null_if_in, norm
from goldenloom.operators import resolve, similarity, windows
from goldenloom.plans.registry import Tables, query
from goldenloom.sources import files

c = F.col


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def scan_parquet(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT p_partkey, p_name, p_size FROM part")
def csv_roundtrip(t: Tables) -> DataFrame:
    return files.through_csv(t.part.select("p_partkey", "p_name", "p_size"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def sink_partitioned(t: Tables) -> DataFrame:
    return files.through_partitions(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def json_extract(t: Tables) -> DataFrame:
    """Written as files of one JSON array over many lines, and read with the schema of one of them."""
    path = files.scratch(t.spark)
    event = F.struct("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    arrays = t.events.groupBy(F.floor(c("event_id") / 1000)).agg(F.to_json(F.collect_list(event), {"pretty": "true"}).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    sample = t.spark.read.text(path).select(c("_metadata.file_path").alias("f")).agg(F.min("f")).first()[0]
    return files.read_json(t.spark, path, sample).select("event_id", c("props.k").alias("k"), "event_type")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND year(o_orderdate) = 1997")
def scan_run_partition(t: Tables) -> DataFrame:
    path = files.scratch(t.spark)
    t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("pt_data_dt"), c("o_orderstatus").alias("pt_cycle_id")).write.partitionBy("pt_data_dt", "pt_cycle_id").parquet(path)
    return files.read_runs(t.spark, path, pt_data_dt="1997", pt_cycle_id="O").select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')")
def incremental_append(t: Tables) -> DataFrame:
    loaded = t.orders.where("o_orderdate < timestamp'1996-01-01'")
    return files.newer_than(t.orders, loaded, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, 'named' AS kind FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), 'headed' FROM supplier UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), 'parquet' FROM nation UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name, NULL, 'bare' FROM region")
def landing_all_string(t: Tables) -> DataFrame:
    """CSV with a header, with given names and with neither, and Parquet, landed as strings."""
    names, base = ["id", "name", "nation"], files.scratch(t.spark)
    t.customer.select("c_custkey", "c_name", "c_nationkey").write.csv(f"{base}/a", sep="|")
    t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_nationkey").alias("nation")).write.csv(f"{base}/b", header=True)
    t.nation.select(c("n_nationkey").alias("id"), c("n_name").alias("name"), c("n_regionkey").alias("nation")).write.parquet(f"{base}/c")
    t.region.select("r_regionkey", "r_name").write.csv(f"{base}/d")
    land = lambda k, **how: files.land(t.spark, f"{base}/{k}", f"{base}/{k}-landed", **how)
    bare = land("d", header=False).select(c("col1").alias("id"), c("col2").alias("name"), F.lit(None).cast("string").alias("nation"))
    parts = {"named": land("a", sep="|", header=names), "headed": land("b"), "parquet": land("c", kind="parquet"), "bare": bare}
    made = [df.select(*names, F.lit(k).alias("kind")) for k, df in parts.items()]
    return made[0].union(made[1]).union(made[2]).union(made[3])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) END AS day, o_totalprice AS price, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS customer FROM orders")
def schema_convert(t: Tables) -> DataFrame:
    """Typed from strings: dates of one format among others, numbers among words."""
    landed = t.orders.select(
        c("o_orderkey").cast("string").alias("o_orderkey"), F.when(c("o_orderkey") % 3 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy.MM")).alias("day"),
        c("o_totalprice").cast("string").alias("price"), F.when(c("o_orderkey") % 5 > 0, c("o_custkey").cast("string")).otherwise("n/a").alias("customer"))
    return files.convert(landed, [("o_orderkey", "bigint", None), ("day", "date", "dd/MM/yyyy"), ("price", "double", None), ("customer", "bigint", None)])


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def count_by_partition(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT t || '.parquet' AS file, n FROM (SELECT 'nation' AS t, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region)")
def count_by_file(t: Tables) -> DataFrame:
    """Record counts of files; of a table in several part files their sum."""
    of = lambda n: files.counts_by_file(getattr(t, n)).agg(F.sum("n").alias("n")).select(F.lit(f"{n}.parquet").alias("file"), "n")
    return of("nation").union(of("orders")).union(of("region"))


@query("SELECT p_partkey, p_size, CAST(p_retailprice AS INTEGER) AS p_retailprice FROM (SELECT p_partkey, p_size, trunc(p_retailprice) AS p_retailprice FROM part)")
def double_to_int(t: Tables) -> DataFrame:
    camel = t.part.select(c("p_partkey").alias("pPartkey"), c("p_size").alias("pSize"), c("p_retailprice").alias("pRetailprice"))
    return files.doubles_to_int(camel.toDF(*(files.snake_case(n) for n in camel.columns)))


@query("SELECT o_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey) AS parts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def flatten_nested(t: Tables) -> DataFrame:
    nested = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    flat = nested.select(c("l_orderkey").alias("o_orderkey"), F.array_join(F.transform("lines", lambda x: x["l_partkey"].cast("string")), "|").alias("parts"))
    return t.orders.select("o_orderkey").join(flat, "o_orderkey")


@query("SELECT n_name, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1")
def linktable_rollup(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).groupBy("n_name").agg(multi.string_set(c("c_mktsegment")).alias("segments"))


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey AND lower(trim('  ' || n_name)) = lower(n_name)")
def norm_key_join(t: Tables) -> DataFrame:
    padded = t.nation.select("n_nationkey", F.concat(F.lit("  "), F.upper("n_name")).alias("raw"))
    named = padded.join(t.nation.select("n_name"), norm("raw") == norm("n_name")).select("n_nationkey", "n_name")
    return t.supplier.join(named, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_name")


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE event_type END AS kind FROM events")
def null_normalise(t: Tables) -> DataFrame:
    raw = F.when(c("event_type") == "click", " N/A ").when(c("event_type") == "view", "NULL").otherwise(c("event_type"))
    return t.events.select("event_id", null_if_in(raw).alias("kind"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P')")
def status_class_filter(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame([("f", "done"), ("o", "ongoing"), ("p", "ongoing")], "raw string, class string")
    return t.orders.join(F.broadcast(mapping.where("class = 'ongoing'")), norm("o_orderstatus") == c("raw"), "left_semi").select("o_orderkey")  # three rows


@query("SELECT p_partkey FROM part WHERE (p_type LIKE '%BRASS%' OR p_type LIKE '%STEEL') AND p_name NOT LIKE '%a' AND regexp_matches(p_brand, '[1-3]')")
def like_chain(t: Tables) -> DataFrame:
    return t.part.where((c("p_type").like("%BRASS%") | c("p_type").like("%STEEL")) & ~c("p_name").like("%a") & c("p_brand").rlike("[1-3]")).select("p_partkey")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_align(t: Tables) -> DataFrame:
    a = t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name")), allowMissingColumns=True)


@query("SELECT r_regionkey AS regionkey, r_name AS name FROM region")
def rename_dynamic(t: Tables) -> DataFrame:
    return t.region.toDF(*(x.removeprefix("r_") for x in t.region.columns))


@query("SELECT l.doc_id, coalesce(d.lang, 'none') AS lang FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id AND d.lang = 'en'")
def fillna_subset(t: Tables) -> DataFrame:
    return t.labels.select("doc_id").join(t.documents.where("lang = 'en'").select("doc_id", "lang"), "doc_id", "left").fillna("none", subset=["lang"])


@query("SELECT p_partkey, concat_ws('|', CASE WHEN p_type LIKE '%BRASS%' THEN 'brass' END, CASE WHEN p_size > 25 THEN 'large' END) AS tags FROM part")
def label_tag(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.concat_ws("|", F.when(c("p_type").contains("BRASS"), "brass"), F.when(c("p_size") > 25, "large")).alias("tags"))


@query("SELECT c_custkey FROM customer WHERE c_nationkey <> 3 AND c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def include_exclude(t: Tables) -> DataFrame:
    base = t.customer.where("c_nationkey <> 3").select("c_custkey")
    include = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return base.join(include, "c_custkey", "left_anti").union(include)


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def join_left_chain(t: Tables) -> DataFrame:
    j = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"), "left").join(t.nation, c("c_nationkey") == c("n_nationkey"), "left")
    return j.join(t.region, c("n_regionkey") == c("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT coalesce(c_nationkey, s_nationkey) AS k, nc, ns FROM (SELECT c_nationkey, count(*) AS nc FROM customer WHERE c_nationkey > 5 GROUP BY 1) FULL JOIN (SELECT s_nationkey, count(*) AS ns FROM supplier WHERE s_nationkey < 20 GROUP BY 1) ON c_nationkey = s_nationkey")
def join_full(t: Tables) -> DataFrame:
    a = t.customer.where("c_nationkey > 5").groupBy(c("c_nationkey").alias("k")).agg(F.count("*").alias("nc"))
    return a.join(t.supplier.where("s_nationkey < 20").groupBy(c("s_nationkey").alias("k")).agg(F.count("*").alias("ns")), "k", "full")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, c("o_custkey") == c("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT p_partkey FROM part LEFT JOIN lineitem ON p_partkey = l_partkey WHERE l_partkey IS NULL")
def join_left_null(t: Tables) -> DataFrame:
    return t.part.join(t.lineitem, c("l_partkey") == c("p_partkey"), "left_anti").select("p_partkey")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def not_in_subquery(t: Tables) -> DataFrame:
    return t.sql("SELECT s_suppkey FROM {supplier} WHERE s_nationkey NOT IN (SELECT c_nationkey FROM {customer} WHERE c_acctbal > 9000)", "supplier", "customer")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def join_semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 100000"), c("o_custkey") == c("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT s_suppkey, s_suppkey + (SELECT max(c_custkey) FROM customer) AS new_id FROM supplier")
def cross_scalar(t: Tables) -> DataFrame:
    top = t.customer.agg(F.max("c_custkey").alias("m"))
    return t.supplier.crossJoin(F.broadcast(top)).select("s_suppkey", (c("s_suppkey") + c("m")).alias("new_id"))  # one row


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND floor(a.s_acctbal / 100) = floor(b.s_acctbal / 100) WHERE a.s_suppkey < b.s_suppkey")
def self_join_theta(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_nationkey", F.floor(c("s_acctbal") / 100).alias("band"))
    return similarity.tiled(s, "s_suppkey", ["s_nationkey", "band"]).select(c("left").alias("a"), c("right").alias("b"))


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1 AND count(DISTINCT l_returnflag) = 1")
def conflict_detect(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("s"), F.count_distinct("l_returnflag").alias("f"))
    return g.where("s > 1 and f = 1").select("l_orderkey")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b, round(jaro_similarity(a.p_name, b.p_name), 6) AS score FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE jaro_similarity(a.p_name, b.p_name) > 0.6")
def fuzzy_join(t: Tables) -> DataFrame:
    found = similarity.fuzzy_pairs(t.part, "p_partkey", "p_name", ["p_brand", "p_size"], 0.6)
    return found.select(c("left").alias("a"), c("right").alias("b"), F.round("score", 6).alias("score"))


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def broadcast_join(t: Tables) -> DataFrame:
    return t.customer.join(t.nation.where("n_regionkey = 1"), c("c_nationkey") == c("n_nationkey")).select("c_custkey", "n_name")


@query("WITH g AS (SELECT l_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey) AS p, list(CAST(l_suppkey AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey) AS s FROM lineitem GROUP BY 1), z AS (SELECT l_orderkey, unnest(list_zip(p, s[2:])) AS z FROM g WHERE len(p) > 1) SELECT l_orderkey, z[1] AS part, z[2] AS supp FROM z WHERE z[2] IS NOT NULL")
def positional_zip(t: Tables) -> DataFrame:
    order = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    g = t.lineitem.groupBy("l_orderkey").agg(order.alias("v")).where(F.size("v") > 1)
    joined = lambda a, n: F.array_join(F.transform(a, lambda x: x[n].cast("string")), "|")
    wide = g.select("l_orderkey", joined(c("v"), "l_partkey").alias("parts"), joined(F.slice("v", 2, F.size("v")), "l_suppkey").alias("supps"))
    return multi.zip_lists(wide, {"parts": "part", "supps": "supp"})


@query("SELECT r_name, a.u AS first, b.u AS second FROM region, unnest(string_split(r_name, 'A')) AS a(u), unnest(string_split(r_name, 'E')) AS b(u)")
def cartesian_explode(t: Tables) -> DataFrame:
    return t.region.select("r_name", F.explode_outer(F.split("r_name", "A")).alias("first")).select("r_name", "first", F.explode_outer(F.split("r_name", "E")).alias("second"))


@query("SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word FROM part")
def explode_split(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode_outer(F.split("p_type", " ")).alias("word"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_snapshot(t: Tables) -> DataFrame:
    return windows.top1(t.events, ["user_id"], c("ts").desc(), c("event_id").desc()).select("user_id", "event_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
def max_partition_filter(t: Tables) -> DataFrame:
    return t.sql("SELECT o_orderkey FROM {orders} WHERE to_date(o_orderdate) = (SELECT to_date(max(o_orderdate)) FROM {orders})", "orders")


@query("SELECT c_custkey, count(o_orderkey) AS orders, round(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0), 2) AS filled FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def metric_join(t: Tables) -> DataFrame:
    m = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.sum(F.when(c("o_orderstatus") == "F", c("o_totalprice"))).alias("filled"))
    return t.customer.select("c_custkey").join(m, "c_custkey", "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.round(F.coalesce("filled", F.lit(0.0)), 2).alias("filled"))


@query("SELECT DISTINCT c_nationkey AS buyer, s_nationkey AS seller FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey")
def relation_build(t: Tables) -> DataFrame:
    pairs = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select("o_custkey", "l_suppkey").distinct()
    return pairs.join(t.customer, c("o_custkey") == c("c_custkey")).join(t.supplier, c("l_suppkey") == c("s_suppkey")).select(c("c_nationkey").alias("buyer"), c("s_nationkey").alias("seller")).distinct()


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'ours' WHEN p_size > 40 THEN 'large' ELSE p_brand END AS brand FROM part")
def mapping_override(t: Tables) -> DataFrame:
    master = t.spark.createDataFrame([("Brand#11", "ours")], "raw string, master string")
    current = t.part.where("p_size > 40").select("p_partkey", F.lit("large").alias("current"))
    j = t.part.join(F.broadcast(master), c("p_brand") == c("raw"), "left").join(current, "p_partkey", "left")  # one row
    return j.select("p_partkey", F.coalesce("master", "current", "p_brand").alias("brand"))


@query("SELECT year(o_orderdate) AS y, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2")
def group_by_expr(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("y"), c("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps FROM lineitem GROUP BY 1")
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("supps"))


@query("SELECT c_nationkey, round(sum(c_acctbal), 2) AS total, min(c_acctbal) AS low, max(c_name) AS pick FROM customer GROUP BY 1")
def sum_min_max(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("total"), F.min("c_acctbal").alias("low"), F.max("c_name").alias("pick"))


@query("SELECT l_returnflag, median(l_quantity) AS m FROM lineitem GROUP BY 1")
def median_group(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_quantity").alias("m"))


@query("SELECT c_nationkey, string_agg(DISTINCT trim(c_mktsegment), '|' ORDER BY trim(c_mktsegment)) AS s FROM customer GROUP BY 1")
def string_set_agg(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_nationkey").agg(multi.string_set(c("c_mktsegment")).alias("s"))


@query("SELECT s_nationkey, string_agg(s_name, ';' ORDER BY s_name) AS s FROM supplier GROUP BY 1")
def string_list_agg(t: Tables) -> DataFrame:
    return t.supplier.groupBy("s_nationkey").agg(multi.string_list(c("s_name"), ";").alias("s"))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT l_returnflag) > 1")
def having_multi(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_distinct("l_returnflag").alias("f")).where("n > 1 and f > 1").drop("f")


@query("SELECT l_linestatus, round(100 * sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS share_a, round(100 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS share_r FROM lineitem GROUP BY 1")
def conditional_share(t: Tables) -> DataFrame:
    part = lambda f: F.round(100 * F.sum(F.when(c("l_returnflag") == f, c("l_quantity")).otherwise(0)) / F.sum("l_quantity"), 6)
    return t.lineitem.groupBy("l_linestatus").agg(part("A").alias("share_a"), part("R").alias("share_r"))


@query("SELECT o_custkey, CAST(min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS f, CAST(min(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS DATE) AS o FROM orders GROUP BY 1")
def pivot_first(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O"]).agg(F.to_date(F.min("o_orderdate"))).withColumnsRenamed({"F": "f", "O": "o"})


@query("SELECT o_custkey, CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'Yes' ELSE '' END AS f, CASE WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN 'Yes' ELSE '' END AS o FROM orders GROUP BY 1")
def crosstab_flags(t: Tables) -> DataFrame:
    p = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O"]).agg(F.count(F.lit(1)))
    return p.select("o_custkey", *(F.when(c(x) > 0, "Yes").otherwise("").alias(x.lower()) for x in ("F", "O")))


@query("SELECT l_suppkey, round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 6) AS r FROM lineitem GROUP BY 1")
def ratio_metric(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.try_divide(F.sum("l_extendedprice"), F.sum("l_quantity")), 6).alias("r"))


@query("SELECT l_suppkey, CASE WHEN sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 0 THEN NULL ELSE round(sum(l_tax) / sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) END AS r FROM lineitem GROUP BY 1")
def guarded_ratio(t: Tables) -> DataFrame:
    n = F.sum(F.when(c("l_returnflag") == "R", 1).otherwise(0))
    return t.lineitem.groupBy("l_suppkey").agg(F.when(n == 0, None).otherwise(F.round(F.try_divide(F.sum("l_tax"), n), 6)).alias("r"))


@query("SELECT o_custkey, min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent, min(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low FROM orders GROUP BY 1")
def metric_collapse(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.when(c("o_orderpriority") == "1-URGENT", c("o_totalprice")).alias("urgent"), F.when(c("o_orderpriority") == "5-LOW", c("o_totalprice")).alias("low"))
    return rows.groupBy("o_custkey").agg(F.min("urgent").alias("urgent"), F.min("low").alias("low"))


@query("SELECT p_partkey, concat_ws('|', CASE WHEN p_size < 10 THEN 'small' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END) AS flags FROM part")
def unpivot_flags(t: Tables) -> DataFrame:
    flags = t.part.select("p_partkey", F.when(c("p_size") < 10, "Yes").alias("small"), F.when(c("p_retailprice") > 1500, "Yes").alias("dear"))
    return flags.select("p_partkey", F.concat_ws("|", *(F.when(c(x) == "Yes", x) for x in ("small", "dear"))).alias("flags"))


@query("SELECT o_orderstatus, sum(m) AS s, median(m) AS mm FROM (SELECT o_orderstatus, o_custkey, median(o_totalprice) AS m FROM orders GROUP BY 1, 2) GROUP BY 1".replace("sum(m)", "round(sum(m), 2)"))
def two_level_agg(t: Tables) -> DataFrame:
    inner = t.orders.groupBy("o_orderstatus", "o_custkey").agg(F.median("o_totalprice").alias("m"))
    return inner.groupBy("o_orderstatus").agg(F.round(F.sum("m"), 2).alias("s"), F.median("m").alias("mm"))


@query("SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS first_dt, CAST(max(l_shipdate) AS DATE) AS last_dt FROM lineitem GROUP BY 1")
def date_rollup(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.to_date(F.min("l_shipdate")).alias("first_dt"), F.to_date(F.max("l_shipdate")).alias("last_dt"))


@query("SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1")
def top1_per_key(t: Tables) -> DataFrame:
    return windows.top1(t.customer, ["c_nationkey"], c("c_acctbal").desc(), c("c_custkey")).select("c_nationkey", "c_custkey")


@query("SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END DESC NULLS LAST, c_custkey) = 1")
def top1_nulls_last(t: Tables) -> DataFrame:
    return windows.top1(t.customer, ["c_nationkey"], F.when(c("c_acctbal") > 0, c("c_acctbal")).desc_nulls_last(), c("c_custkey")).select("c_nationkey", "c_custkey")


@query("SELECT p_brand, p_partkey FROM part QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) = 1")
def rank_ties(t: Tables) -> DataFrame:
    return t.part.withColumn("r", F.rank().over(Window.partitionBy("p_brand").orderBy(F.desc("p_size")))).where("r = 1").select("p_brand", "p_partkey")


@query("SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) AS uid FROM part")
def dense_rank_uid(t: Tables) -> DataFrame:
    return windows.ordered_ids(t.part.select("p_partkey", "p_type"), "p_type", "uid").select("p_partkey", "uid")


@query("SELECT s_suppkey, 'sup_' || CAST(1000 + row_number() OVER (ORDER BY sha256(s_name || '|' || CAST(s_suppkey AS VARCHAR))) AS VARCHAR) AS id FROM supplier")
def surrogate_id(t: Tables) -> DataFrame:
    h = t.supplier.select("s_suppkey", F.sha2(F.concat_ws("|", "s_name", c("s_suppkey").cast("string")), 256).alias("h"))
    return windows.ordered_ids(h, "h", "n", 1001).select("s_suppkey", F.concat(F.lit("sup_"), c("n").cast("string")).alias("id"))


@query("SELECT DISTINCT p_brand, p_type, p_brand || '_' || CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_type) AS VARCHAR) AS sub_id FROM part")
def sub_id(t: Tables) -> DataFrame:
    d = t.part.select("p_brand", "p_type").distinct()
    return d.withColumn("sub_id", F.concat_ws("_", "p_brand", F.dense_rank().over(Window.partitionBy("p_brand").orderBy("p_type")).cast("string")))


@query("SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_size, p_type) > 1 AS dup FROM part")
def dup_flag(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", (F.count("*").over(Window.partitionBy("p_brand", "p_size", "p_type")) > 1).alias("dup"))


@query("SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1")
def mode_per_key(t: Tables) -> DataFrame:
    return windows.mode_per_key(t.orders, ["o_custkey"], "o_orderpriority")


@query("SELECT DISTINCT year(o_orderdate) AS y, 'run_' || CAST(dense_rank() OVER (ORDER BY year(o_orderdate) DESC) AS VARCHAR) AS label FROM orders")
def run_label(t: Tables) -> DataFrame:
    y = t.orders.select(F.year("o_orderdate").cast("bigint").alias("y")).distinct()
    return y.select("y", F.concat(F.lit("run_"), F.dense_rank().over(Window.orderBy(F.desc("y"))).cast("string")).alias("label"))  # a row per year


@query("SELECT o_orderkey, o_totalprice FROM orders")
def order_by(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("SELECT * FROM region LIMIT 0")
def schema_only(t: Tables) -> DataFrame:
    return t.region.limit(0)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT s_suppkey, NULL, NULL, s_acctbal FROM supplier")
def schema_clone(t: Tables) -> DataFrame:
    """An empty clone of a table's schema takes rows of the table and of another one, which lacks some of its columns."""
    clone = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").limit(0)
    other = t.supplier.select(c("s_suppkey").alias("o_orderkey"), c("s_acctbal").alias("o_totalprice"))
    return clone.unionByName(t.orders.where("o_orderstatus = 'F'").select(*clone.columns)).unionByName(other, allowMissingColumns=True)


@query("SELECT event_type, max(event_id) AS last_id FROM events WHERE value > 0 GROUP BY 1")
def latest_cycle(t: Tables) -> DataFrame:
    return t.events.where("value > 0").groupBy("event_type").agg(F.max_by("event_id", "event_id").alias("last_id"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return t.customer.select(c("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t: Tables) -> DataFrame:
    return t.customer.select(c("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey"))


@query("SELECT o_custkey AS k FROM orders EXCEPT (SELECT o_custkey FROM orders WHERE o_totalprice > 200000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def minus(t: Tables) -> DataFrame:
    right = t.orders.where("o_totalprice > 200000").select("o_custkey").union(t.customer.where("c_acctbal < 0").select("c_custkey"))
    return t.orders.select(c("o_custkey").alias("k")).subtract(right)


@query("SELECT DISTINCT p_type AS raw, p_brand AS std FROM part UNION SELECT p_brand, p_brand FROM part")
def mapping_closure(t: Tables) -> DataFrame:
    m = t.part.select(c("p_type").alias("raw"), c("p_brand").alias("std"))
    return m.union(m.select("std", "std")).distinct()
