"""Quality checks, history, entity resolution, mapping and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.functions import keys, multi
from goldenloom.operators import checks, history, mapping, metrics, nearest, resolve, similarity, windows
from goldenloom.operators.checks import Check
from goldenloom.plans.registry import Tables, query
from goldenloom.sources import files

c = F.col

# Metrics

RATES = "SELECT s_nationkey, l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) AS shipped FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"


def _rates(t: Tables) -> DataFrame:
    g = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).groupBy("s_nationkey", "l_suppkey")
    return g.agg(F.count_if(c("l_returnflag") == "R").alias("returned"), F.count("*").alias("shipped"))


@query(f"WITH r AS ({RATES}), x AS (SELECT *, least(100, 100.0 * returned / nullif(shipped, 0)) AS rate FROM r), k AS (SELECT *, rank() OVER (PARTITION BY s_nationkey ORDER BY rate DESC) AS rk FROM x), m AS (SELECT *, max(rk) OVER (PARTITION BY s_nationkey) AS mx FROM k) SELECT s_nationkey, l_suppkey, round(rate, 6) AS rate, round(CASE WHEN mx = 1 THEN CASE WHEN rate = 0 THEN 0 ELSE 1 END ELSE (rk - 1) / (mx - 1) END, 6) AS score FROM m")
def rank_norm(t: Tables) -> DataFrame:
    rated = _rates(t).withColumn("rate", metrics.clamp(metrics.share(c("returned"), c("shipped")) * 100, 100.0))
    return windows.rank_norm(rated, ["s_nationkey"], "rate", "score", higher_is_better=False).select("s_nationkey", "l_suppkey", F.round("rate", 6).alias("rate"), F.round("score", 6).alias("score"))


@query(f"SELECT l_suppkey, round(returned / nullif(shipped - 5, 0), 6) AS pct FROM ({RATES})")
def kpi_pct_randomized(t: Tables) -> DataFrame:
    return _rates(t).select("l_suppkey", F.round(metrics.share(c("returned"), c("shipped") - 5), 6).alias("pct"))


TODAY = "1999-06-30"
ONGOING, COMPLETED = ("o", "ongoing"), ("f", "completed")
# A customer as a site: dates of the orders by priority stand for its milestones, and orders for its subjects.
_SITES = (
    "SELECT o_custkey, min_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status, CAST(min(o_orderdate) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 250000) AS DATE) AS initiated, "
    "CAST(min(o_orderdate) FILTER (o_orderpriority = '2-HIGH') AS DATE) AS treated, CAST(max(o_orderdate) FILTER (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F') AS DATE) AS last_treated, "
    "CAST(max(o_orderdate) FILTER (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' AND o_totalprice > 250000) AS DATE) AS country_end, CAST(max(o_orderdate) AS DATE) AS planned_end, "
    "count(*) FILTER (o_orderstatus = 'F') AS actual, count(*) FILTER (o_totalprice > 200000) AS planned, count(*) FILTER (o_orderstatus = 'P') AS dropped, count(*) FILTER (o_orderstatus <> 'O') AS screened FROM orders GROUP BY 1"
).replace("min_by(o_orderstatus, (o_orderdate, o_orderkey))", "(list(o_orderstatus ORDER BY o_orderdate, o_orderkey))[1]")
_SITES2 = f"SELECT *, coalesce(initiated, treated - 14) AS start, coalesce(last_treated, country_end) AS finish, actual / nullif(planned, 0) AS done FROM ({_SITES})"
_OVER = f"datediff('day', start, DATE '{TODAY}') / nullif(datediff('day', start, planned_end), 0)"


def _sites(t: Tables) -> DataFrame:
    day = lambda which, rule: which(F.when(F.expr(rule), c("o_orderdate"))).cast("date")
    s = t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"), day(F.min, "o_orderpriority = '1-URGENT' and o_totalprice > 250000").alias("initiated"), day(F.min, "o_orderpriority = '2-HIGH'").alias("treated"),
        day(F.max, "o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F'").alias("last_treated"), day(F.max, "o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' and o_totalprice > 250000").alias("country_end"), F.max("o_orderdate").cast("date").alias("planned_end"),
        F.count_if(c("o_orderstatus") == "F").alias("actual"), F.count_if(c("o_totalprice") > 200000).alias("planned"), F.count_if(c("o_orderstatus") == "P").alias("dropped"), F.count_if(c("o_orderstatus") != "O").alias("screened"))
    today = F.lit(TODAY).cast("date")
    return s.withColumns({
        "start": metrics.started(c("initiated"), c("treated")), "finish": F.coalesce("last_treated", "country_end"), "done": metrics.share(c("actual"), c("planned")), "today": today,
        "over": metrics.elapsed(c("initiated"), c("treated"), c("planned_end"), today)})


@query(f"SELECT o_custkey, round({_OVER}, 6) AS elapsed FROM ({_SITES2})")
def kpi_elapsed(t: Tables) -> DataFrame:
    return _sites(t).select("o_custkey", F.round("over", 6).alias("elapsed"))


@query(f"SELECT o_custkey, status, round(CASE WHEN status = 'O' AND finish IS NULL AND (done > 0.5 OR (done < 0.5 AND {_OVER} > 0.5)) THEN datediff('day', start, DATE '{TODAY}') / 30.4 WHEN status IN ('O', 'F') THEN datediff('day', start, finish) / 30.4 END, 6) AS months FROM ({_SITES2})")
def kpi_duration(t: Tables) -> DataFrame:
    made = metrics.recruitment_months(c("status"), c("start"), c("finish"), c("today"), c("done"), c("over"), ONGOING, COMPLETED)
    return _sites(t).select("o_custkey", "status", F.round(made, 6).alias("months"))


@query("WITH g AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS n, datediff('day', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE)) / 30.4 AS d FROM lineitem GROUP BY 1) SELECT l_suppkey, round(CASE WHEN n = 0 THEN 0 ELSE n / nullif(d, 0) END, 6) AS rate FROM g")
def kpi_rand_rate(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_suppkey").agg(F.count_if(c("l_returnflag") == "A").alias("n"), metrics.months(F.min("l_shipdate"), F.max("l_shipdate")).alias("d"))
    return g.select("l_suppkey", F.round(metrics.rate(c("n"), c("d")), 6).alias("rate"))


@query("WITH g AS (SELECT o_custkey, min(o_orderdate) FILTER (o_orderstatus = 'O') AS a, min(o_orderdate) FILTER (o_orderstatus = 'F') AS b, max(o_orderdate) AS z FROM orders GROUP BY 1) SELECT o_custkey, round(datediff('day', CAST(least(a, b) AS DATE), CAST(z AS DATE)) / 30.4, 6) AS months FROM g")
def kpi_duration_ir(t: Tables) -> DataFrame:
    when = lambda s: F.min(F.when(c("o_orderstatus") == s, c("o_orderdate")))
    g = t.orders.groupBy("o_custkey").agg(when("O").alias("a"), when("F").alias("b"), F.max("o_orderdate").alias("z"))
    return g.select("o_custkey", F.round(metrics.months(F.to_date(F.least("a", "b")), F.to_date("z")), 6).alias("months"))


@query(f"SELECT o_custkey, round(CASE WHEN status = 'F' OR (status = 'O' AND last_treated IS NOT NULL) THEN 100.0 * dropped / nullif(screened, 0) END, 6) AS sfr, round(CASE WHEN status = 'F' OR (status = 'O' AND last_treated IS NOT NULL) THEN 100.0 * (screened - actual) / nullif(screened, 0) END, 6) AS ir_sfr FROM ({_SITES2})")
def kpi_sfr(t: Tables) -> DataFrame:
    failed = lambda n: F.round(metrics.screen_failures(c("status"), n, c("screened"), c("last_treated"), ONGOING, COMPLETED), 6)
    return _sites(t).select("o_custkey", failed(c("dropped")).alias("sfr"), failed(c("screened") - c("actual")).alias("ir_sfr"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 5000 THEN 5000 ELSE c_acctbal END AS v FROM customer")
def kpi_clamp(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", metrics.clamp(c("c_acctbal"), 5000.0).alias("v"))


_PARTS = "SELECT c_nationkey, " + ", ".join(f"CAST(count(*) FILTER (c_mktsegment = '{s}') AS DOUBLE) AS {s.lower()}" for s in ("BUILDING", "MACHINERY", "HOUSEHOLD")) + " FROM customer GROUP BY 1"


def _parts(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_nationkey").agg(*(F.count_if(c("c_mktsegment") == s).cast("double").alias(s.lower()) for s in ("BUILDING", "MACHINERY", "HOUSEHOLD")))


@query(f"WITH p AS ({_PARTS}), s AS (SELECT *, nullif(building + machinery + household, 0) AS t FROM p) SELECT c_nationkey, round((CASE WHEN building > 0 THEN -building / t * ln(building / t) ELSE 0 END + CASE WHEN machinery > 0 THEN -machinery / t * ln(machinery / t) ELSE 0 END + CASE WHEN household > 0 THEN -household / t * ln(household / t) ELSE 0 END) / ln(3), 6) AS h, CASE WHEN machinery >= building AND machinery >= household THEN 'machinery' WHEN building >= household THEN 'building' ELSE 'household' END AS top FROM s WHERE t IS NOT NULL")
def entropy(t: Tables) -> DataFrame:
    p = _parts(t).where("building + machinery + household > 0")
    names = ("machinery", "building", "household")
    return p.select("c_nationkey", F.round(metrics.entropy([c(n) for n in names], 3), 6).alias("h"), metrics.largest({n: c(n) for n in names}).alias("top"))


@query(f"WITH p AS ({_PARTS}), s AS (SELECT *, building + machinery + household AS t FROM p) SELECT c_nationkey, round(greatest(0, -((building / t + 1e-10) * ln(building / t + 1e-10) + (machinery / t + 1e-10) * ln(machinery / t + 1e-10) + (household / t + 1e-10) * ln(household / t + 1e-10)) / ln(5)), 5) AS h FROM s WHERE t > 0")
def entropy_norm(t: Tables) -> DataFrame:
    return _parts(t).where("building + machinery + household > 0").select("c_nationkey", F.round(metrics.entropy([c("building"), c("machinery"), c("household")], 5, 1e-10), 5).alias("h"))


_VISITS = "SELECT l_suppkey, rn, q, sum(gap) OVER (PARTITION BY l_suppkey ORDER BY rn) AS d FROM (SELECT l_suppkey, l_quantity AS q, row_number() OVER w AS rn, CASE WHEN row_number() OVER w % 11 = 0 THEN 401 ELSE 3 END AS gap FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity))"


@query(f"WITH RECURSIVE e AS MATERIALIZED ({_VISITS}), b AS (SELECT l_suppkey, rn, q AS burden, d FROM e WHERE rn = 1 UNION ALL SELECT e.l_suppkey, e.rn, e.q + b.burden * exp(-0.912 * (e.d - b.d)), e.d FROM b JOIN e ON e.l_suppkey = b.l_suppkey AND e.rn = b.rn + 1) SELECT l_suppkey, rn, CAST(d AS BIGINT) AS d, round(burden, 5) AS burden FROM b")
def decay_recurrence(t: Tables) -> DataFrame:
    """Visits of a supplier, three days apart and sometimes 401: over thousands of days."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    visits = t.lineitem.select("l_suppkey", "l_quantity", F.row_number().over(w).cast("bigint").alias("rn"))
    visits = visits.withColumn("d", F.sum(F.when(c("rn") % 11 == 0, 401).otherwise(3)).over(Window.partitionBy("l_suppkey").orderBy("rn")))
    return metrics.decayed(visits, ["l_suppkey"], "d", "l_quantity", "burden").select("l_suppkey", "rn", "d", F.round("burden", 5).alias("burden"))


CONFIGURED = [
    metrics.ConfiguredMetric(("nation",), "volume", "shipped", "sum(amount)", "flag = 'R'"), metrics.ConfiguredMetric(("nation",), "volume", "ordered", "sum(amount)"),
    metrics.ConfiguredMetric(("nation",), "top", "ordered", "max(amount)", "flag = 'F'"), metrics.ConfiguredMetric(("nation", "flag"), "n", "shipped", "count(*)", "amount > 30000"), metrics.ConfiguredMetric(("nation", "flag"), "n", "ordered", "count(*)"),
]
_SOURCES = "s AS (SELECT s_nationkey AS nation, l_returnflag AS flag, l_extendedprice AS amount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey), o AS (SELECT c_nationkey AS nation, o_orderstatus AS flag, o_totalprice AS amount FROM orders JOIN customer ON o_custkey = c_custkey)"


@query(f"WITH {_SOURCES}, x AS (SELECT nation, sum(amount) FILTER (flag = 'R') AS volume FROM s GROUP BY 1), y AS (SELECT nation, sum(amount) AS volume, max(amount) FILTER (flag = 'F') AS top FROM o GROUP BY 1), z AS (SELECT nation, flag, count(*) FILTER (amount > 30000) AS n FROM s GROUP BY 1, 2), q AS (SELECT nation, flag, count(*) AS n FROM o GROUP BY 1, 2) SELECT nation, NULL AS flag, round(coalesce(x.volume, y.volume), 2) AS volume, top, NULL AS n FROM x FULL JOIN y USING (nation) UNION ALL SELECT nation, flag, NULL, NULL, CAST(coalesce(z.n, q.n) AS DOUBLE) FROM z FULL JOIN q USING (nation, flag)")
def metric_engine(t: Tables) -> DataFrame:
    """Configured metrics of two sources at two grains."""
    shipped = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).select(c("s_nationkey").alias("nation"), c("l_returnflag").alias("flag"), c("l_extendedprice").alias("amount"))
    ordered = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(c("c_nationkey").alias("nation"), c("o_orderstatus").alias("flag"), c("o_totalprice").alias("amount"))
    made = metrics.configured({"shipped": shipped, "ordered": ordered}, CONFIGURED)
    a = made["nation",].select("nation", F.lit(None).cast("string").alias("flag"), F.round("volume", 2).alias("volume"), "top", F.lit(None).cast("double").alias("n"))
    return a.union(made["nation", "flag"].select("nation", "flag", F.lit(None).cast("double"), F.lit(None).cast("double"), "n"))


# Quality checks

CHECKS = [
    Check(1, "null", "note", criticality="C"), Check(2, "length", "o_orderpriority", "<= 8"), Check(3, "date", "o_orderdate", "yyyy-MM-dd"), Check(4, "integer", "o_totalprice"), Check(5, "decimal", "o_totalprice"),
    Check(6, "domain", "o_orderstatus", "'F','O'", criticality="C"), Check(7, "unique", "o_custkey,o_orderpriority", criticality="C"), Check(8, "null", "note", scope="o_orderstatus = 'P'"),
]
_O = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'x' END AS note, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS d FROM orders)"
_ERR = " UNION ALL ".join(
    f"SELECT o_orderkey AS row_id, {k} AS qc_id, {v} AS error_value, '{x}' AS criticality FROM {_O} WHERE {w}"
    for k, v, x, w in ((1, "note", "C", "note IS NULL"), (2, "o_orderpriority", "NC", "length(o_orderpriority) > 8"), (6, "o_orderstatus", "C", "o_orderstatus NOT IN ('F', 'O')"), (7, "o_custkey || '|' || o_orderpriority", "C", "d > 1"), (8, "note", "NC", "note IS NULL AND o_orderstatus = 'P'"))
)


def _orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("note", F.when(c("o_orderkey") % 7 != 0, "x")).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def _errors(t: Tables) -> DataFrame:
    return checks.errors(_orders(t), "o_orderkey", [k for k in CHECKS if k.qc_id not in (3, 4, 5)])


@query(_ERR)
def dqm_errors(t: Tables) -> DataFrame:
    return _errors(t).select("row_id", "qc_id", "error_value", "criticality")


@query(f"SELECT q AS qc_id, coalesce(n, 0) AS error_count, round(coalesce(n, 0) * 100.0 / (SELECT count(*) FROM orders), 4) AS failure_percentage FROM (SELECT unnest([1, 2, 6, 7, 8]) AS q) LEFT JOIN (SELECT qc_id, count(*) AS n FROM ({_ERR}) GROUP BY 1) ON q = qc_id")
def dqm_summary(t: Tables) -> DataFrame:
    return checks.summary(_orders(t), _errors(t), [k for k in CHECKS if k.qc_id not in (3, 4, 5)])


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT row_id FROM ({_ERR}) WHERE criticality = 'C')")
def dqm_filter(t: Tables) -> DataFrame:
    return checks.passed(_orders(t), "o_orderkey", _errors(t)).select("o_orderkey")


@query(f"WITH o AS MATERIALIZED {_O}, bad AS (SELECT o_orderkey FROM o WHERE note IS NULL OR o_orderstatus NOT IN ('F', 'O')), k AS (SELECT max(o_orderkey) AS o_orderkey FROM o ANTI JOIN bad USING (o_orderkey) WHERE d > 1 GROUP BY o_custkey, o_orderpriority), e AS ({_ERR}) SELECT row_id, qc_id FROM e WHERE qc_id <> 7 UNION ALL SELECT o_orderkey, 7 FROM (SELECT o_orderkey FROM o WHERE d > 1) ANTI JOIN k USING (o_orderkey)")
def dqm_unique_survivor(t: Tables) -> DataFrame:
    return checks.survivors(_errors(t), 7).select("row_id", "qc_id")


def _one(name: str, sql: str, check: Check, frame=_orders, row: str = "o_orderkey"):
    def f(t: Tables) -> DataFrame:
        return checks.errors(frame(t), row, [check]).select("row_id")

    f.__name__ = name
    return query(sql)(f)


dqm_null = _one("dqm_null", "SELECT o_orderkey AS row_id FROM orders WHERE o_orderkey % 7 = 0", CHECKS[0])
dqm_length = _one("dqm_length", "SELECT o_orderkey AS row_id FROM orders WHERE length(o_orderpriority) > 8", CHECKS[1])
_MIXED = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN 'x' || strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN CAST(o_custkey AS VARCHAR) WHEN 4 THEN CAST(-o_custkey AS VARCHAR) || '.50' END AS v FROM orders"


def _mixed(t: Tables) -> DataFrame:
    made = "case o_orderkey % 6 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'MM/dd/yyyy') when 2 then concat('x', date_format(o_orderdate, 'yyyy-MM-dd')) when 3 then cast(o_custkey as string) when 4 then concat(-o_custkey, '.50') end"
    return t.orders.select("o_orderkey", F.expr(made).alias("v"))


dqm_date = _one("dqm_date", f"SELECT o_orderkey AS row_id FROM ({_MIXED}) WHERE NOT regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')", Check(3, "date", "v", "YYYY-MM-DD"), _mixed)
dqm_date_default = _one("dqm_date_default", f"SELECT o_orderkey AS row_id FROM ({_MIXED}) WHERE NOT regexp_full_match(v, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')", Check(3, "date", "v", "another format"), _mixed)
dqm_integer = _one("dqm_integer", f"SELECT o_orderkey AS row_id FROM ({_MIXED}) WHERE NOT regexp_full_match(v, '-?[0-9]+')", Check(4, "integer", "v"), _mixed)
dqm_decimal = _one("dqm_decimal", f"SELECT o_orderkey AS row_id FROM ({_MIXED}) WHERE NOT regexp_full_match(v, '-?[0-9]*[.]?[0-9]+')", Check(5, "decimal", "v"), _mixed)
dqm_domain = _one("dqm_domain", "SELECT o_orderkey AS row_id FROM orders WHERE o_orderstatus NOT IN ('F', 'O')", CHECKS[5])
dqm_unique = _one("dqm_unique", "SELECT o_orderkey AS row_id FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1", CHECKS[6])


@query("SELECT o_orderkey AS row_id FROM orders WHERE o_totalprice > 200000")
def dqm_custom(t: Tables) -> DataFrame:
    return t.sql("SELECT o_orderkey AS row_id FROM {orders} WHERE o_totalprice > 200000", "orders")


@query("SELECT count(*) AS errors, CASE WHEN count(*) > 10 THEN 'FAIL' ELSE 'PASS' END AS status FROM customer WHERE c_acctbal < 0")
def qc_threshold_count(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal < 0").agg(F.count("*").alias("errors")).withColumn("status", F.when(c("errors") > 10, "FAIL").otherwise("PASS"))


@query("WITH v AS (SELECT c_nationkey, 100.0 * count(*) FILTER (c_acctbal < 0) / count(*) AS variance FROM customer GROUP BY 1) SELECT count(*) FILTER (variance > 10) AS errors, CASE WHEN max(variance) > 10 THEN 'FAIL' ELSE 'PASS' END AS status FROM v")
def qc_threshold_percent(t: Tables) -> DataFrame:
    v = t.customer.groupBy("c_nationkey").agg((F.count_if(c("c_acctbal") < 0) * 100.0 / F.count("*")).alias("variance"))
    return v.agg(F.count_if(c("variance") > 10).alias("errors"), F.max("variance").alias("m")).select("errors", F.when(c("m") > 10, "FAIL").otherwise("PASS").alias("status"))


_RAW_ORDERS = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE ' ' || o_orderpriority || ' ' END AS a, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'none' END AS d, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) || '-' || o_orderstatus END AS z, o_orderpriority AS p, CAST(o_custkey AS VARCHAR) AS k, o_orderstatus AS s, o_orderpriority AS r FROM orders"


@query(f"SELECT o_orderkey, nullif(upper(nullif(trim(a), '')), '') AS a, CASE WHEN length(d) = 4 AND d <> 'none' THEN d || '-01-01' WHEN length(d) = 7 THEN d || '-01' WHEN d <> 'none' THEN d END AS d, string_split(z, '-')[1] AS z, lower(p) AS p, lpad(k, 8, '0') AS k, rpad(s, 4, '*') AS s, nullif(regexp_replace(substr(r, 1, 3), '[0-9]-', '', 'g'), '') AS r FROM ({_RAW_ORDERS})")
def predqm_chain(t: Tables) -> DataFrame:
    """All ten steps, in their order."""
    raw = t.orders.select(
        "o_orderkey", F.expr("if(o_orderkey % 5 = 0, '  ', concat(' ', o_orderpriority, ' ')) as a"),
        F.expr("case o_orderkey % 4 when 0 then date_format(o_orderdate, 'yyyy') when 1 then date_format(o_orderdate, 'yyyy-MM') when 2 then date_format(o_orderdate, 'yyyy-MM-dd') else 'none' end as d"),
        F.expr("if(o_orderkey % 7 = 0, '', concat(o_custkey, '-', o_orderstatus)) as z"), c("o_orderpriority").alias("p"), c("o_custkey").cast("string").alias("k"), c("o_orderstatus").alias("s"), c("o_orderpriority").alias("r"))
    steps = [("a", "blank", ""), ("a", "trim", ""), ("a", "upper", ""), ("p", "lower", ""), ("d", "date", "yyyy-MM-dd"), ("k", "lpad", "8,0"), ("s", "rpad", "4,*"), ("r", "substring", "1,3"), ("r", "replace", "[0-9]-,"), ("z", "zip", "")]
    return checks.standardise(raw, steps)


@query("SELECT 'null' AS problem, o_orderkey AS grain, count(*) AS n FROM orders WHERE o_orderkey IS NULL GROUP BY 2 UNION ALL SELECT 'duplicate', l_orderkey, count(*) FROM lineitem GROUP BY 2 HAVING count(*) > 5")
def qc_primary_grain(t: Tables) -> DataFrame:
    a = t.orders.where("o_orderkey is null").groupBy(c("o_orderkey").alias("grain")).agg(F.count("*").alias("n")).select(F.lit("null").alias("problem"), "grain", "n")
    return a.union(t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 5").select(F.lit("duplicate"), "l_orderkey", "n"))


@query("SELECT p_brand, count(DISTINCT p_type) AS types FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def qc_functional_dependency(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.count_distinct("p_type").alias("types")).where("types > 1")


@query("SELECT 'orphans' AS name, count(*) AS problems, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'several brands', count(*), CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END FROM (SELECT p_type FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1) UNION ALL SELECT 'no name', count(*), CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END FROM nation WHERE n_name IS NULL")
def mapping_qc(t: Tables) -> DataFrame:
    """Named validation queries over named tables, each with the count of the rows that it finds."""
    rules = [
        ("orphans", "SELECT o_custkey FROM {orders} LEFT ANTI JOIN {customer} ON o_custkey = c_custkey"),
        ("several brands", "SELECT p_type FROM {part} GROUP BY 1 HAVING count(DISTINCT p_brand) > 1"),
        ("no name", "SELECT n_nationkey FROM {nation} WHERE n_name IS NULL"),
    ]
    return checks.mapping_qc(t.spark, rules, {n: getattr(t, n) for n in ("orders", "customer", "part", "nation")}).drop("sql")


# History


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 UNION ALL SELECT DISTINCT o_custkey, 'old' FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def scd1_stitch(t: Tables) -> DataFrame:
    """Customers in credit are current; all who ever ordered are history."""
    current = t.customer.where("c_acctbal > 0").select("c_custkey", "c_name")
    return history.scd1_stitch(current, t.orders.select(c("o_custkey").alias("c_custkey")).distinct().withColumn("c_name", F.lit("old")), ["c_custkey"])


@query("SELECT event_id, coalesce(lead(ts) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS end_ts, CASE WHEN lead(ts) OVER w IS NULL THEN 'Y' ELSE 'N' END AS active_flag FROM (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def scd2(t: Tables) -> DataFrame:
    e = t.events.groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    return history.scd2(e, ["user_id"], "ts").select("event_id", "end_ts", "active_flag")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def delete_ids(t: Tables) -> DataFrame:
    return history.delete_ids(t.customer.select("c_custkey"), t.orders.select(c("o_custkey").alias("c_custkey")), "c_custkey")


@query("WITH o AS (SELECT c_custkey, c_name FROM customer), n AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'new name' ELSE c_name END AS c_name FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT s_suppkey + 1000000000, s_name FROM supplier) SELECT c_custkey, CASE WHEN n.c_name IS NULL THEN o.c_name ELSE n.c_name END AS c_name, CASE WHEN o.c_name IS NULL THEN 'new' WHEN n.c_name IS NULL THEN 'gone' WHEN o.c_name = n.c_name THEN 'unchanged' ELSE 'updated' END AS change, CASE WHEN n.c_name IS NULL THEN 'N' ELSE 'Y' END AS active FROM o FULL JOIN n USING (c_custkey)")
def cdc_merge(t: Tables) -> DataFrame:
    """The customers as they were, and as they are: a segment has gone, suppliers are new, the rich are renamed."""
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    new = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", F.when(c("c_acctbal") > 5000, "new name").otherwise(c("c_name")).alias("c_name"), "c_mktsegment")
    new = new.union(t.supplier.select(c("s_suppkey") + 1000000000, "s_name", F.lit("NEW")))
    return history.cdc_merge(base, new, ["c_custkey"], ["c_name", "c_mktsegment"]).drop("c_mktsegment")


@query("SELECT year(o_orderdate) AS batch, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus <> 'F') AS pending, dense_rank() OVER (ORDER BY year(o_orderdate) DESC) AS recency FROM orders GROUP BY 1")
def batch_audit(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    g = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("batch")).agg(F.count_if(c("o_orderstatus") == "F").alias("done"), F.count_if(c("o_orderstatus") != "F").alias("pending"))
    return g.withColumn("recency", F.dense_rank().over(Window.orderBy(F.desc("batch"))))  # a row per batch


_PREV = "SELECT CAST(c_custkey AS VARCHAR) AS hash_uid, 'id_' || CAST(c_custkey // 3 AS VARCHAR) AS golden_id, c_custkey // 3 AS num FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"
_CUR = "SELECT CAST(c_custkey AS VARCHAR) AS hash_uid, c_custkey // 4 AS cluster_id FROM customer"


@query(f"WITH p AS ({_PREV}), q AS ({_CUR}), s AS (SELECT cluster_id, golden_id, num, count(*) AS n FROM q JOIN p USING (hash_uid) GROUP BY 1, 2, 3), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, num) = 1), w AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY golden_id ORDER BY n DESC, cluster_id) = 1), r AS (SELECT cluster_id, 'id_' || CAST(row_number() OVER (ORDER BY cluster_id) + (SELECT max(num) FROM p) AS VARCHAR) AS golden_id FROM (SELECT DISTINCT cluster_id FROM q WHERE cluster_id NOT IN (SELECT cluster_id FROM w))) SELECT hash_uid, golden_id FROM q JOIN (SELECT cluster_id, golden_id FROM w UNION ALL SELECT * FROM r) USING (cluster_id)")
def golden_id_maintain(t: Tables) -> DataFrame:
    uid = c("c_custkey").cast("string").alias("hash_uid")
    known = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"))  # the run before knew these
    previous = t.customer.join(known, "c_custkey", "left_semi").select(uid, F.expr("'id_' || cast(c_custkey div 3 as string) as golden_id"))
    return history.golden_ids(previous, t.customer.select(uid, F.expr("c_custkey div 4 as cluster_id")), "id_")


# Entity resolution


@query("SELECT s_nationkey, arg_min(s_name, (-s_acctbal, s_suppkey)) FILTER (s_acctbal > 0) AS s_name, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1".replace("arg_min(s_name, (-s_acctbal, s_suppkey)) FILTER (s_acctbal > 0)", "(list(s_name ORDER BY -s_acctbal, s_suppkey) FILTER (s_acctbal > 0))[1]").replace("min(s_suppkey)", "(list(s_suppkey ORDER BY -s_acctbal, s_suppkey))[1]"))
def golden_record(t: Tables) -> DataFrame:
    s = t.supplier.withColumn("o", -c("s_acctbal")).withColumn("s_name", F.when(c("s_acctbal") > 0, c("s_name"))).withColumn("k", c("s_suppkey"))
    return windows.golden_record(s, ["s_nationkey"], ["s_name", "s_suppkey"], "o", "k")


@query("SELECT 'c' AS src, CAST(c_custkey AS VARCHAR) AS id, lower(trim(c_name)) AS name FROM customer UNION ALL SELECT 's', CAST(s_suppkey AS VARCHAR), lower(trim(s_name)) FROM supplier")
def conform_union(t: Tables) -> DataFrame:
    one = lambda df, src, i, n: df.select(F.lit(src).alias("src"), c(i).cast("string").alias("id"), keys.norm(n).alias("name"))
    return one(t.customer, "c", "c_custkey", "c_name").unionByName(one(t.supplier, "s", "s_suppkey", "s_name"))


_PEOPLE = "SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN ' Dr. Ana-' || c_custkey WHEN 1 THEN 'MD' WHEN 2 THEN 'City Hospital' WHEN 3 THEN '12 34' WHEN 4 THEN NULL ELSE ' José  ' || c_mktsegment END AS name, CASE WHEN c_custkey % 5 = 0 THEN 'N/A' ELSE '+1 (' || c_nationkey || ') 555' END AS phone, CASE c_custkey % 3 WHEN 0 THEN 'Ana <A' || c_nationkey || '@x.org>' WHEN 1 THEN 'b' || c_nationkey || '@x.org; c@y.org' ELSE ' ' END AS email FROM customer"
_CLEAN = f"SELECT c_custkey, CASE WHEN c_custkey % 8 = 0 THEN 'ana ' || c_custkey ELSE 'jose ' || lower(c_mktsegment) END AS name, CASE WHEN phone <> 'N/A' THEN regexp_replace(phone, '[^0-9|]', '', 'g') END AS phone, CASE c_custkey % 3 WHEN 0 THEN lower(regexp_extract(email, '<([^>]*)>', 1)) WHEN 1 THEN replace(email, '; ', '|') END AS email FROM ({_PEOPLE}) JOIN customer USING (c_custkey) WHERE c_custkey % 8 IN (0, 5, 6, 7)"


def _people(t: Tables) -> DataFrame:
    k = c("c_custkey")
    name = F.when(k % 8 == 0, F.concat(F.lit(" Dr. Ana-"), k)).when(k % 8 == 1, "MD").when(k % 8 == 2, "City Hospital").when(k % 8 == 3, "12 34").when(k % 8 > 4, F.concat(F.lit(" José  "), "c_mktsegment"))
    phone = F.when(k % 5 == 0, "N/A").otherwise(F.concat(F.lit("+1 ("), "c_nationkey", F.lit(") 555")))
    email = F.when(k % 3 == 0, F.concat(F.lit("Ana <A"), "c_nationkey", F.lit("@x.org>"))).when(k % 3 == 1, F.concat(F.lit("b"), "c_nationkey", F.lit("@x.org; c@y.org"))).otherwise(" ")
    return resolve.cleanse_person(t.customer.select("c_custkey", name.alias("name"), phone.alias("phone"), email.alias("email")), "name", "phone", "email")


@query(_CLEAN)
def er_cleanse(t: Tables) -> DataFrame:
    return _people(t)


@query(f"SELECT string_agg(DISTINCT CAST(c_custkey AS VARCHAR), ';' ORDER BY CAST(c_custkey AS VARCHAR)) AS ids, max(name) AS name, max(phone) AS phone, max(email) AS email FROM ({_CLEAN}) GROUP BY regexp_replace(name, '[^a-z]', '', 'g'), string_split(phone, '|')[1], string_split(email, '|')[1]")
def person_groups(t: Tables) -> DataFrame:
    return resolve.content_groups(_people(t).withColumn("ids", c("c_custkey").cast("string")), "name", "phone", "email", ["ids"])


@query("SELECT s_suppkey, CASE WHEN count(*) OVER (PARTITION BY floor(s_acctbal / 50)) > 1 THEN 'common_' || CAST(CAST(floor(s_acctbal / 50) AS BIGINT) AS VARCHAR) END AS common_id FROM supplier")
def common_id_cluster(t: Tables) -> DataFrame:
    return resolve.common_id(t.supplier.select("s_suppkey", F.floor(c("s_acctbal") / 50).alias("npi")), "npi", "s_suppkey").select("s_suppkey", "common_id")


@query("SELECT regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS k, p_size, count(*) AS n FROM part GROUP BY 1, 2")
def content_group(t: Tables) -> DataFrame:
    return t.part.groupBy(F.regexp_replace(F.lower("p_brand"), "[^a-z0-9]", "").alias("k"), "p_size").agg(F.count("*").alias("n"))


@query("WITH h AS (SELECT s_suppkey, sha256(lower(trim(s_name)) || '|' || CAST(s_nationkey AS VARCHAR)) AS hash_uid FROM supplier) SELECT s_suppkey, hash_uid, dense_rank() OVER (ORDER BY hash_uid) AS uid FROM h")
def uid_hash(t: Tables) -> DataFrame:
    h = t.supplier.select("s_suppkey", keys.content_hash("s_name", c("s_nationkey").cast("string")).alias("hash_uid"))
    return windows.ordered_ids(h, "hash_uid", "uid").select("s_suppkey", "hash_uid", "uid")


_PAIRS = "SELECT a.p_partkey AS l, b.p_partkey AS r, a.p_type AS ta, b.p_type AS tb FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey"


@query(f"SELECT l AS \"left\", r AS \"right\" FROM ({_PAIRS})")
def block_pairs(t: Tables) -> DataFrame:
    return similarity.tiled(t.part, "p_partkey", ["p_brand", "p_size"]).select("left", "right")


@query(f"SELECT l AS \"left\", r AS \"right\", round(len(list_intersect(string_split(ta, ' '), string_split(tb, ' '))) / len(list_distinct(list_concat(string_split(ta, ' '), string_split(tb, ' ')))), 6) AS j, round((greatest(length(ta), length(tb)) - levenshtein(ta, tb)) / greatest(length(ta), length(tb)), 6) AS s FROM ({_PAIRS})")
def pair_score(t: Tables) -> DataFrame:
    scores = lambda a, b: {"j": F.round(resolve.jaccard(F.split(a, " "), F.split(b, " ")), 6), "s": F.round(resolve.similarity(a, b), 6)}
    return similarity.scored_pairs(t.part, "p_partkey", ["p_brand", "p_size"], "p_type", scores)


@query(f"WITH RECURSIVE p AS (SELECT l, r FROM ({_PAIRS}) WHERE ta = tb), e AS (SELECT l AS a, r AS b FROM p UNION SELECT r, l FROM p), c AS (SELECT p_partkey AS id, p_partkey AS k FROM part UNION SELECT c.id, e.b FROM c JOIN e ON c.k = e.a) SELECT id, min(k) AS cluster_id FROM c GROUP BY 1")
def er_cluster(t: Tables) -> DataFrame:
    base = files.scratch(t.spark)
    links = similarity.block_links(t.part, "p_partkey", ["p_brand", "p_size"], "p_type", lambda a, b: F.round(resolve.similarity(a, b), 6), 1.0)
    return resolve.clusters(t.part.select(c("p_partkey").alias("id")), links, lambda k: f"{base}/{k}")


@query("WITH v AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size % 4 AS VARCHAR) END AS zip FROM part), w AS (SELECT *, regexp_replace(zip, '^0+', '') AS z FROM v), m AS (SELECT p_brand, z, count(*) AS n FROM w WHERE z IS NOT NULL GROUP BY 1, 2), k AS (SELECT p_brand, (list(z ORDER BY n DESC, z))[1] AS mode, count(*) AS k FROM m GROUP BY 1) SELECT p_partkey, CASE WHEN k > 1 THEN p_brand || '_' || coalesce(z, mode) ELSE p_brand END AS new_cluster FROM w LEFT JOIN k USING (p_brand)")
def rule_split_conflict(t: Tables) -> DataFrame:
    v = t.part.select("p_brand", "p_partkey", F.when(c("p_partkey") % 9 != 0, (c("p_size") % 4).cast("string")).alias("zip"))
    return resolve.split_conflicts(v, "p_brand", "zip").select("p_partkey", "new_cluster")


@query("WITH s AS (SELECT p_brand, p_partkey, p_partkey // 2 AS uid, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size / 50.0 END AS score FROM part), g AS (SELECT *, coalesce(score < 0.8, true) AS low FROM s) SELECT p_partkey, CASE WHEN low THEN p_brand || '_' || CAST(dense_rank() OVER (PARTITION BY p_brand, low ORDER BY uid) AS VARCHAR) ELSE p_brand END AS gated, CASE WHEN NOT low THEN score WHEN count(*) OVER (PARTITION BY p_brand, low, uid) > 1 THEN 0.95 END AS new_score FROM g")
def score_gate(t: Tables) -> DataFrame:
    s = t.part.select("p_brand", "p_partkey", F.expr("p_partkey div 2 as uid"), F.when(c("p_partkey") % 5 != 0, c("p_size") / 50.0).alias("score"))
    return resolve.score_gate(s, "p_brand", "uid", "score").select("p_partkey", "gated", "new_score")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY n_name, n_nationkey) = 1")
def xref_best(t: Tables) -> DataFrame:
    j = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    return windows.top1(j, ["c_custkey"], c("n_name"), c("n_nationkey")).select("c_custkey", "n_name")


@query("SELECT o_custkey, string_split(v, '_')[1] AS source, v AS source_id FROM (SELECT o_custkey, unnest(list(DISTINCT o_orderstatus || '_' || o_orderpriority)) AS v FROM orders GROUP BY 1)")
def xref_explode(t: Tables) -> DataFrame:
    merged = t.orders.groupBy("o_custkey").agg(multi.string_set(F.concat_ws("_", "o_orderstatus", "o_orderpriority"), ";").alias("ids"))
    return merged.select("o_custkey", F.explode(F.split("ids", ";")).alias("source_id")).withColumn("source", F.substring_index("source_id", "_", 1))


# Mapping


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Other' END AS std FROM orders")
def dict_map(t: Tables) -> DataFrame:
    m = t.spark.createDataFrame([("f", "Filled"), ("o", "Open")], "raw string, std string")
    return t.orders.join(F.broadcast(m), keys.norm("o_orderstatus") == c("raw"), "left").select("o_orderkey", F.coalesce("std", F.lit("Other")).alias("std"))  # two rows


_G = "SELECT {x}, unnest([substr(' ' || lower(trim({x})) || ' ', i, 3) FOR i IN range(1, length(trim({x})) + 1)]) AS g FROM ({d})"
_STD, _RAW = "SELECT DISTINCT p_type AS std FROM part WHERE p_size > 25", "SELECT DISTINCT p_type || ' X' AS raw FROM part WHERE p_size <= 25"


@query(f"WITH v AS ({_G.format(x='std', d=_STD)}), q AS ({_G.format(x='raw', d=_RAW)}), i AS (SELECT g, ln(((SELECT count(*) FROM ({_STD})) + 1) / (count(DISTINCT std) + 1)) + 1 AS idf FROM v GROUP BY 1), b AS (SELECT std, g, count(*) * any_value(idf) AS w FROM v JOIN i USING (g) GROUP BY 1, 2), a AS (SELECT raw, g, count(*) * any_value(idf) AS w FROM q JOIN i USING (g) GROUP BY 1, 2), nb AS (SELECT std, sqrt(sum(w * w)) AS n FROM b GROUP BY 1), na AS (SELECT raw, sqrt(sum(w * w)) AS n FROM a GROUP BY 1), s AS (SELECT raw, std, sum(a.w * b.w) / any_value(na.n) / any_value(nb.n) AS score FROM a JOIN b USING (g) JOIN na USING (raw) JOIN nb USING (std) GROUP BY 1, 2) SELECT raw, std, round(score, 5) AS score FROM s WHERE score >= 0.67 QUALIFY row_number() OVER (PARTITION BY raw ORDER BY round(score, 9) DESC, std) = 1")
def tfidf_cosine_top1(t: Tables) -> DataFrame:
    std = t.part.where("p_size > 25").select(c("p_type").alias("std")).distinct()
    raw = t.part.where("p_size <= 25").select(F.concat("p_type", F.lit(" X")).alias("raw")).distinct()
    return mapping.tfidf_top1(raw, std, 0.67).withColumn("score", F.round("score", 5))


@query("SELECT a.vec_id AS q, (list(b.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) DESC, b.vec_id))[1] AS i FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1")
def cosine_top1(t: Tables) -> DataFrame:
    e = t.embeddings
    queries = e.where("vec_id % 50 = 0").select(c("vec_id").alias("q"), c("embedding").alias("v"), c("label").alias("block"))
    return nearest.nearest(queries, e.select(c("vec_id").alias("i"), c("embedding").alias("w"), c("label").alias("block")), block="block").select("q", "i")


@query("SELECT p_partkey, ' ' || CASE p_partkey % 3 WHEN 0 THEN 'Zurich And ' || upper(p_name[1]) || lower(substr(split_part(p_name, ' ', 1), 2)) WHEN 1 THEN 'San Jos 12Th' ELSE 'A B C' END || ' ' AS g FROM part")
def ngram_prep(t: Tables) -> DataFrame:
    raw = F.when(c("p_partkey") % 3 == 0, F.concat(F.lit("(zurich.)  & "), F.split("p_name", " ")[0])).when(c("p_partkey") % 3 == 1, "SAN JOSÉ, 12TH").otherwise("a-b,[c]?")
    return t.part.select("p_partkey", mapping.gram_text(raw).alias("g"))


@query("SELECT p_partkey, p_size / 50.0 AS score, 'city' AS domain FROM part WHERE p_size / 50.0 >= 0.85 UNION ALL SELECT p_partkey, p_size / 50.0, 'disease' FROM part WHERE p_size / 50.0 >= 0.8 UNION ALL SELECT p_partkey, p_size / 50.0, 'sponsor' FROM part WHERE p_size / 50.0 >= 0.67")
def acceptance(t: Tables) -> DataFrame:
    s = t.part.select("p_partkey", (c("p_size") / 50.0).alias("score"))
    of = lambda d: mapping.accepted(s, d).withColumn("domain", F.lit(d))
    return of("city").union(of("disease")).union(of("sponsor"))


@query("SELECT p_partkey, array_to_string(list_sort(string_split(p_type, ' ')), '|') AS s FROM part")
def sort_tokens(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", multi.sorted_tokens(F.replace("p_type", F.lit(" "), F.lit(";"))).alias("s"))


@query("SELECT p_partkey, p_brand || '|' || p_type AS s FROM part")
def rem_dup_tokens(t: Tables) -> DataFrame:
    doubled = F.concat_ws("|", "p_brand", "p_type", F.upper("p_brand"), F.concat(F.lit("("), c("p_type"), F.lit(")")))
    return t.part.select("p_partkey", multi.distinct_tokens(doubled).alias("s"))


@query("SELECT p_partkey, array_to_string([x FOR x IN string_split(p_type, ' ') IF regexp_matches(x, 'S')], '|') AS s FROM part")
def list_regex_filter(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", multi.keep_matching(F.replace("p_type", F.lit(" "), F.lit("|")), "S").alias("s"))


@query("SELECT doc_id, regexp_matches(text, '(?i)(^|[^a-z])license([^a-z]|$)') AS license, regexp_matches(text, '(?i)(^|[^a-z])(email|mail)([^a-z]|$)') AS mail FROM documents")
def keyword_flags(t: Tables) -> DataFrame:
    word = lambda w: c("text").rlike(f"(?i)(^|[^a-z])({w})([^a-z]|$)")
    return t.documents.select("doc_id", word("license").alias("license"), word("email|mail").alias("mail"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size WHEN p_size % 3 = 1 THEN p_size + 1 ELSE p_size END AS low, CASE WHEN p_size % 3 = 0 THEN p_size + 5 WHEN p_size % 3 = 1 THEN 100 ELSE p_size END AS high FROM part")
def age_band(t: Tables) -> DataFrame:
    raw = F.expr("case p_size % 3 when 0 then concat(p_size, '-', p_size + 5) when 1 then concat(p_size, '+') else cast(p_size as string) end")
    return t.part.select("p_partkey", mapping.age_band(raw).alias("b")).select("p_partkey", "b.low", "b.high")


@query("SELECT DISTINCT p_type AS raw FROM part WHERE p_size > 10 EXCEPT SELECT p_type FROM part WHERE p_size <= 10")
def mapping_delta(t: Tables) -> DataFrame:
    known = t.part.where("p_size <= 10").select(c("p_type").alias("raw")).distinct()
    return t.part.where("p_size > 10").select(c("p_type").alias("raw")).distinct().join(known, "raw", "left_anti")


@query("SELECT p_type AS raw, CASE WHEN count(DISTINCT p_brand) > 1 THEN 'Other' ELSE min(p_brand) END AS std FROM part GROUP BY 1")
def ambiguous_to_other(t: Tables) -> DataFrame:
    return t.part.groupBy(c("p_type").alias("raw")).agg(F.when(F.count_distinct("p_brand") > 1, "Other").otherwise(F.min("p_brand")).alias("std"))


@query("SELECT n_nationkey, translate(n_name, 'AEIOU', 'ÀÉÎÕÜ') AS raw, n_name AS folded FROM nation")
def ascii_fold(t: Tables) -> DataFrame:
    raw = F.translate("n_name", "AEIOU", "ÀÉÎÕÜ")
    return t.nation.select("n_nationkey", raw.alias("raw"), keys.ascii_fold(raw).alias("folded"))
