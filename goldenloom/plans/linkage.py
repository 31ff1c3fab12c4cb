"""Similar values, learned matches, hot groups, databases and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.operators import mapping, matching, nearest, resolve, similarity, windows
from goldenloom.plans.registry import Tables, query
from goldenloom.sources import databases, files, tables, workbooks

c = F.col

# Hosts as names, with the path of each host's first page as its address.
_HOSTS = r"""h AS (SELECT regexp_extract(url, '://([^/?#]+)', 1) AS host, min_by(coalesce(regexp_extract(url, '://[^/?#]+([^?#]*)', 1), ''), page_id) AS path FROM pages GROUP BY 1),
v AS (SELECT *, list_filter(string_split(regexp_replace(lower(host), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w, list_filter(string_split(regexp_replace(lower(path), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS p FROM h WHERE host <> '')"""
_SIM = "(greatest(length({a}), length({b})) - levenshtein({a}, {b})) / greatest(length({a}), length({b}))"


def _sets(a: str, b: str) -> str:
    """The best of the shared words, and these with the rest of either side; a, b: lists of words."""
    text = lambda *xs: "trim(concat_ws(' ', " + ", ".join(f"nullif(array_to_string(list_sort({x}), ' '), '')" for x in xs) + "))"
    both = f"list_distinct(list_intersect({a}, {b}))"
    rest = lambda x, y: f"list_distinct(list_filter({x}, lambda z: NOT list_contains({y}, z)))"
    left, right, base = text(both, rest(a, b)), text(both, rest(b, a)), text(both)
    pairs = [_SIM.format(a=x, b=y) for x, y in ((left, right), (base, left), (base, right))]
    return f"CASE WHEN len({both}) > 0 THEN greatest({', '.join(pairs)}) ELSE coalesce({pairs[0]}, 0) END"


@query(f"""WITH {_HOSTS}, s AS (SELECT a.host AS "left", b.host AS "right", greatest({_SIM.format(a='lower(a.host)', b='lower(b.host)')},
  0.95 * {_SIM.format(a="array_to_string(list_sort(a.w), ' ')", b="array_to_string(list_sort(b.w), ' ')")}, 0.95 * ({_sets('a.w', 'b.w')})) AS score, {_sets('a.p', 'b.p')} AS place FROM v a JOIN v b ON a.host < b.host)
SELECT "left", "right", round(score, 6) AS name_score, CASE WHEN place >= 0.5 THEN 1.0 ELSE round(place, 6) END AS address_score FROM s WHERE score >= 0.85 - 1e-12""")
def similar_names(t: Tables) -> DataFrame:
    host, path = F.regexp_extract("url", "://([^/?#]+)", 1), F.regexp_extract("url", "://[^/?#]+([^?#]*)", 1)
    hosts = t.pages.select("page_id", host.alias("host"), path.alias("path")).where("host <> ''").groupBy("host").agg(F.min_by("path", "page_id").alias("path"))
    found = similarity.similar_names(hosts, "host", 0.85)
    both = found.join(hosts.select(c("host").alias("left"), c("path").alias("a")), "left").join(hosts.select(c("host").alias("right"), c("path").alias("b")), "right")
    return both.select("left", "right", F.round("score", 6).alias("name_score"), F.round(resolve.address_score(c("a"), c("b")), 6).alias("address_score"))


@query(f"WITH {_HOSTS} SELECT a.host AS \"left\", b.host AS \"right\", round({_SIM.format(a='a.host', b='b.host')}, 6) AS score FROM v a JOIN v b ON a.host < b.host WHERE {_SIM.format(a='a.host', b='b.host')} >= 0.8 - 1e-12")
def similar_texts(t: Tables) -> DataFrame:
    found = similarity.similar_texts(t.pages.select(F.regexp_extract("url", "://([^/?#]+)", 1).alias("host")), "host", 0.8)
    return found.select("left", "right", F.round("score", 6).alias("score"))


@query("WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS i FROM part) SELECT a.p_partkey AS \"left\", b.p_partkey AS \"right\" FROM p a JOIN p b ON b.i > a.i AND b.i < a.i + 4")
def sorted_neighbours(t: Tables) -> DataFrame:
    return similarity.sorted_neighbours(t.part, "p_partkey", ["p_name"], 4)


_SETS = "list_distinct(list_filter(list_transform(string_split(lower({x}), ' '), lambda w: trim(w)), lambda w: w <> ''))"


@query(f"""WITH s AS (SELECT a.p_partkey AS l, b.p_partkey AS r, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey),
m AS (SELECT *, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS short, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS long FROM s)
SELECT l AS "left", r AS "right", round(len(list_intersect({_SETS.format(x='x')}, {_SETS.format(x='y')})) / len(list_distinct(list_concat({_SETS.format(x='x')}, {_SETS.format(x='y')}))), 6) AS as_sets,
round((greatest(length(x), length(y)) - levenshtein(x, y)) / greatest(length(x), length(y)), 6) AS as_short,
round(1 - list_min(list_transform(range(1, length(long) - length(short) + 2), lambda i: levenshtein(short, substr(long, i, length(short))))) / length(short), 6) AS as_part FROM m""")
def pair_comparators(t: Tables) -> DataFrame:
    """Set, short-string and partial comparisons of names in a block."""
    ratios = lambda a, b: {"as_sets": similarity.set_similarity(a, b, " "), "as_short": similarity.short_string(a, b), "as_part": similarity.partial_ratio(a, b)}
    return similarity.scored_pairs(t.part, "p_partkey", ["p_brand", "p_type"], "p_name", lambda a, b: {n: F.round(x, 6) for n, x in ratios(a, b).items()})


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT a.vec_id AS q, b.vec_id AS i, round(list_cosine_similarity(a.v, b.v), 9) AS score FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id) SELECT q, i, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, i) <= 5")
def nearest_items(t: Tables) -> DataFrame:
    """The five nearest of all rows, for the rows whose id is divisible by 50."""
    items = t.embeddings.select(c("vec_id").alias("i"), c("embedding").alias("w"))
    asked = items.where("i % 50 = 0").select(c("i").alias("q"), c("w").alias("v"))
    return nearest.nearest(asked, items, 5).withColumn("score", F.round("score", 6))


_PREP = "' ' || upper(substr({x}, 1, 1)) || substr({x}, 2) || ' '"
_RAW = f"SELECT DISTINCT host AS raw, {_PREP.format(x="regexp_replace(lower(host), '[.]', '', 'g')")} AS t FROM h WHERE host <> ''"
_STD = f"SELECT DISTINCT std, {_PREP.format(x="regexp_replace(lower(std), '[.]', '', 'g')")} AS t FROM (SELECT regexp_replace(host, '^(m|www)[.]', '') AS std FROM h WHERE host <> '')"
_GRAMS = "SELECT {x}, unnest([substr(t, i, 3) FOR i IN range(1, length(t) - 1)]) AS g FROM {d}"


@query(f"""WITH h AS (SELECT DISTINCT regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages), s AS ({_STD}), r AS ({_RAW}), v AS ({_GRAMS.format(x='std', d='s')}), q AS ({_GRAMS.format(x='raw', d='r')}),
i AS (SELECT g, ln(((SELECT count(*) FROM s) + 1) / (count(DISTINCT std) + 1)) + 1 AS idf FROM v GROUP BY 1), b AS (SELECT std, g, count(*) * any_value(idf) AS w FROM v JOIN i USING (g) GROUP BY 1, 2),
a AS (SELECT raw, g, count(*) * any_value(idf) AS w FROM q JOIN i USING (g) GROUP BY 1, 2), nb AS (SELECT std, sqrt(sum(w * w)) AS n FROM b GROUP BY 1), na AS (SELECT raw, sqrt(sum(w * w)) AS n FROM a GROUP BY 1),
p AS (SELECT raw, std, sum(a.w * b.w) / any_value(na.n) / any_value(nb.n) AS score FROM a JOIN b USING (g) JOIN na USING (raw) JOIN nb USING (std) GROUP BY 1, 2)
SELECT raw, std, round(score, 5) AS score FROM p WHERE score >= 0.8 QUALIFY row_number() OVER (PARTITION BY raw ORDER BY round(score, 9) DESC, std) = 1""")
def prepared_top1(t: Tables) -> DataFrame:
    """Hosts against hosts without their first label m or www, by the grams of prepared text."""
    hosts = t.pages.select(F.regexp_extract("url", "://([^/?#]+)", 1).alias("raw")).where("raw <> ''").distinct()
    std = hosts.select(F.regexp_replace("raw", "^(m|www)[.]", "").alias("std")).distinct()
    return mapping.tfidf_top1(hosts, std, 0.8, prepare=mapping.gram_text).withColumn("score", F.round("score", 5))


def entities(t: Tables) -> DataFrame:
    """(id, name, phone, city): each customer twice, under made-up names; the second entry, of odd id, has a letter missing,
    its words swapped or a letter more, and some have no phone or a wrong digit."""
    key = c("c_custkey").cast("string")
    letters = lambda salt: F.translate(F.md5(F.concat(key, F.lit(salt))), "0123456789abcdef", "aeioubdfgklmnprs")
    digits = F.substring(F.translate(F.md5(F.concat(key, F.lit("phone"))), "abcdef", "012345"), 1, 9)
    first, last, k = F.substring(letters("first"), 1, 6), F.substring(letters("last"), 1, 8), c("c_custkey")
    base = t.customer.select(k, first.alias("first"), last.alias("last"), digits.alias("phone"), c("c_nationkey").cast("string").alias("city"))
    other = F.when(k % 3 == 0, F.concat(F.substring("first", 1, 2), F.substring("first", 4, 9), F.lit(" "), "last")).when(k % 3 == 1, F.concat("last", F.lit(" "), "first")).otherwise(F.concat("first", F.lit(" "), "last", F.lit("x")))
    phone = F.when(k % 4 != 1, F.when(k % 5 == 2, F.concat(F.lit("9"), F.substring("phone", 2, 8))).otherwise(c("phone")))
    one = base.select((k * 2).alias("id"), F.concat("first", F.lit(" "), "last").alias("name"), "phone", "city")
    return one.union(base.select(k * 2 + 1, other, phone, "city"))


def learned_pairs(t: Tables) -> tuple[DataFrame, matching.Model]:
    rows = files.stored(entities(t))
    by_name = similarity.with_values(similarity.similar_names(rows, "name", 0.8), rows, "id", "name").select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"))
    near = [similarity.sorted_neighbours(rows.where(f"{x} is not null"), "id", [x], 4).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")) for x in ("name", "phone")]
    pairs = by_name.union(near[0]).union(near[1]).distinct()
    side = lambda n: rows.select(c("id").alias(n), *(c(x).alias(f"{x}_{n}") for x in ("name", "phone", "city")))
    both = pairs.join(side("left"), "left").join(side("right"), "right")
    return matching.match(files.stored(both), [
        matching.Comparison("name", resolve.name_score(c("name_left"), c("name_right")), (0.7, 0.85)),
        matching.Comparison("phone", similarity.short_string(c("phone_left"), c("phone_right")), (0.8, 1.0)),
        matching.Comparison("city", F.when(c("city_left").isNotNull() & c("city_right").isNotNull(), (c("city_left") == c("city_right")).cast("double")), (1.0,)),
    ], recall_weight=0.7)


@query("SELECT c_custkey * 2 AS \"left\", c_custkey * 2 + 1 AS \"right\" FROM customer")
def learned_matches(t: Tables) -> DataFrame:
    """The pairs that the model, learned from the pairs alone, accepts; the SQL has the pairs that were made alike."""
    return learned_pairs(t)[0].select("left", "right")


@query("SELECT 'all' AS g, median(l_quantity * 100 + l_linenumber) AS m, median(l_extendedprice) AS p FROM lineitem UNION ALL SELECT l_returnflag, median(l_quantity * 100 + l_linenumber), median(l_extendedprice) FROM lineitem GROUP BY 1")
def median_hot_group(t: Tables) -> DataFrame:
    """Exact medians, among them that of one group of all rows."""
    rows = t.lineitem.select(F.explode(F.array(F.lit("all"), "l_returnflag")).alias("g"), (c("l_quantity") * 100 + c("l_linenumber")).alias("q"), "l_extendedprice")
    return windows.median_of(rows, ["g"], "q", "m").join(windows.median_of(rows, ["g"], "l_extendedprice", "p"), "g")


@query("SELECT l_orderkey, l_linenumber, l_partkey, round((r - 1) / (max(r) OVER () - 1), 9) AS score FROM (SELECT *, rank() OVER (ORDER BY l_extendedprice) AS r FROM lineitem)")
def rank_norm_hot_group(t: Tables) -> DataFrame:
    """Ranks of all rows as one group."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.lit(1).alias("g"))
    return windows.rank_norm(rows, ["g"], "l_extendedprice", "score").select("l_orderkey", "l_linenumber", "l_partkey", F.round("score", 9).alias("score"))


_ORDERS = "O_ORDERKEY BIGINT, O_CUSTKEY BIGINT, O_ORDERSTATUS VARCHAR(8), O_TOTALPRICE DOUBLE, O_ORDERPRIORITY VARCHAR(32)"


def database(t: Tables) -> dict[str, str]:
    """A database in the shared folder, with the table orders; a real one stands on its own host."""
    at = databases.files_database(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    databases.write_table(rows.toDF(*(x.upper() for x in rows.columns)), at, "ORDERS", _ORDERS)  # as unquoted names are
    return at


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def jdbc_parts(t: Tables) -> DataFrame:
    at = databases.archived(t.spark, database(t))
    return databases.read_parts(t.spark, at, "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders", "o_orderkey", 6).where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_totalprice < 30000)")
def jdbc_incremental(t: Tables) -> DataFrame:
    """A second load takes what lies above the first one's greatest key."""
    at, target = databases.archived(t.spark, database(t)), files.scratch(t.spark)
    wanted = "SELECT o_orderkey, o_totalprice FROM orders"
    databases.load_new(t.spark, at, f"{wanted} WHERE o_totalprice < 30000", "o_orderkey", target)
    return databases.load_new(t.spark, at, wanted, "o_orderkey", target).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'")
def warehouse_unload(t: Tables) -> DataFrame:
    """Two runs are unloaded, the later one twice, and copied into another table."""
    at, path = database(t), files.scratch(t.spark)
    source = databases.archived(t.spark, at)
    rows = "SELECT O_ORDERKEY, O_TOTALPRICE FROM ORDERS WHERE O_ORDERPRIORITY = '$$priority'"
    for day, priority in (("2024-01-01", "1-URGENT"), ("2024-01-02", "3-MEDIUM"), ("2024-01-02", "2-HIGH")):
        databases.unload(t.spark, source, rows, "O_ORDERKEY", path, {"priority": priority}, pt_data_dt=day)
    databases.copy_into(t.spark, path, at, "HIGH_ORDERS", "O_ORDERKEY BIGINT, O_TOTALPRICE DOUBLE", pt_data_dt="2024-01-02")
    return databases.read_parts(t.spark, databases.archived(t.spark, at), "SELECT * FROM HIGH_ORDERS", "O_ORDERKEY", 4).select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON lower(trim(replace(c_name, 'Customer', 'Firm'))) = lower(trim(replace(s_name, 'Supplier', 'firm')))")
def bucketed_join(t: Tables) -> DataFrame:
    """Two tables bucketed by their normalised names; the join needs no shuffle."""
    base = files.scratch(t.spark)
    tag = base.rsplit("/", 1)[-1]
    a = tables.save_by_key(t.customer.select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit(" Firm")).alias("name")), f"gl_customer_{tag}", c("name"), 8, f"{base}/c")
    b = tables.save_by_key(t.supplier.select("s_suppkey", F.replace("s_name", F.lit("Supplier"), F.lit("FIRM")).alias("name")), f"gl_supplier_{tag}", c("name"), 8, f"{base}/s")
    return a.hint("merge").join(b, "norm_key").select("c_custkey", "s_suppkey")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS price, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def catalog_overwrite(t: Tables) -> DataFrame:
    """Of a partitioned catalog table one partition is replaced by its new rows, one is emptied, one stays."""
    base = files.scratch(t.spark)
    name = f"gl_orders_{base.rsplit('/', 1)[-1]}"
    rows = t.orders.select("o_orderkey", c("o_totalprice").alias("price"), c("o_orderstatus").alias("status"))
    tables.save(rows, name, partition_by=("status",), path=base)
    tables.overwrite_partitions(rows.where("status = 'F'").withColumn("price", c("price") + 1), name)
    tables.overwrite_partition(rows.limit(0).drop("status"), name, status="P")
    return t.spark.table(name)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_nationkey > 12 THEN s_name || ' <&> ' || chr(10) || ' ' END AS note, round(s_acctbal, 2) AS s_acctbal FROM supplier")
def workbook_roundtrip(t: Tables) -> DataFrame:
    path = f"{files.scratch(t.spark)}/suppliers.xlsx"
    note = F.when(c("s_nationkey") > 12, F.concat("s_name", F.lit(" <&> \n ")))
    workbooks.write_workbook(t.supplier.select("s_suppkey", note.alias("note"), "s_acctbal"), path)
    return workbooks.read_workbook(t.spark, path).withColumn("s_acctbal", F.round(c("s_acctbal").cast("double"), 2))
