"""Rules on clustered records, and text and name mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.operators import curation, mapping
from goldenloom.plans.registry import Tables, query

c = F.col

#: Clustered records made from customers, in SQL that both engines run.
MEMBERS = """SELECT c_custkey AS uid, concat('h', CAST(c_custkey % 400 AS STRING)) AS hash_uid, c_custkey % 60 AS cluster_id,
  concat('N', CAST(c_nationkey % 5 AS STRING)) AS first_name, c_mktsegment AS last_name, concat('src', CAST(c_custkey % 3 AS STRING)) AS source,
  CASE WHEN c_custkey % 7 < 3 THEN concat('p', CAST(c_custkey % 40 AS STRING)) END AS phone,
  CASE WHEN c_custkey % 5 < 2 THEN concat('M', CAST(c_custkey % 30 AS STRING), '@x', CAST(c_custkey % 2 AS STRING), '.org') END AS email,
  CASE WHEN c_custkey % 9 = 0 THEN concat('NCT', CAST(c_custkey % 50 AS STRING)) END AS registry,
  CAST(c_custkey % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS score FROM {customer}"""
M = f"WITH m AS ({MEMBERS.replace('{customer}', 'customer')})"

#: Source ids of orders, two to a row.
LISTS = "SELECT o_orderkey AS uid, concat('a', CAST(o_custkey AS STRING), '|b', CAST(o_orderkey % 900 AS STRING)) AS ids FROM {orders}"
L = f"WITH l AS ({LISTS.replace('{orders}', 'orders')})"

#: Names with doses, stop words and lists, made from parts.
NAMES = "SELECT p_partkey, concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' 20 mg/kg daily' WHEN 1 THEN ' and the [copper]' WHEN 2 THEN ', zinc, tin' ELSE ' 5 (x)' END, ' of ', lower(p_type)) AS name FROM {part}"
N = f"WITH n AS ({NAMES.replace('{part}', 'part')})"


def members(t: Tables) -> DataFrame:
    return t.sql(MEMBERS, "customer")


@query(f"{M}, k AS (SELECT *, count(*) OVER (PARTITION BY cluster_id, first_name, last_name) AS n FROM m) SELECT uid, CASE WHEN n > 1 THEN CAST(cluster_id AS VARCHAR) ELSE concat('unclustered_', uid) END AS cluster_id FROM k")
def rule_name_consistency(t: Tables) -> DataFrame:
    return curation.keep_consistent(members(t), "cluster_id", ["first_name", "last_name"]).select("uid", "cluster_id")


@query(f"""{M}, k AS (SELECT cluster_id, least(lower(first_name), lower(last_name)) || ' ' || greatest(lower(first_name), lower(last_name)) AS nm, x AS contact
  FROM m, unnest([concat('p:' || phone), 'e:' || lower(split_part(email, '@', 1))]) u(x) WHERE x IS NOT NULL AND x <> ''),
b AS (SELECT nm, contact, min(cluster_id) AS lo FROM k GROUP BY 1, 2), g AS (SELECT cluster_id, min(lo) AS z FROM k JOIN b USING (nm, contact) GROUP BY 1)
SELECT uid, coalesce(z, cluster_id) AS cluster_id FROM m LEFT JOIN g USING (cluster_id)""")
def rule_contact_merge(t: Tables) -> DataFrame:
    return curation.merge_by_contact(members(t), "cluster_id", "first_name", "last_name", "phone", "email").select("uid", "cluster_id")


@query(f"{M}, g AS (SELECT first_name, last_name, min(cluster_id) AS z FROM m WHERE coalesce(phone, email) IS NOT NULL GROUP BY 1, 2) SELECT uid, CASE WHEN coalesce(phone, email) IS NULL THEN coalesce(z, cluster_id) ELSE cluster_id END AS cluster_id FROM m LEFT JOIN g USING (first_name, last_name)")
def rule_name_adopt(t: Tables) -> DataFrame:
    return curation.adopt_by_name(members(t), "cluster_id", ["first_name", "last_name"], ["phone", "email"]).select("uid", "cluster_id")


@query(f"{M} SELECT uid, CASE WHEN registry IS NOT NULL THEN registry WHEN length(last_name) <= 8 THEN concat('unclustered_', uid) ELSE CAST(cluster_id AS VARCHAR) END AS cluster_id, CASE WHEN registry IS NOT NULL THEN 0.9::DOUBLE ELSE score END AS score FROM m")
def rule_registry_override(t: Tables) -> DataFrame:
    return curation.registry_override(members(t), "cluster_id", "last_name", "registry", "score", least_title=9).select("uid", "cluster_id", "score")


@query(f"{M}, k AS (SELECT *, row_number() OVER (PARTITION BY hash_uid ORDER BY score DESC NULLS LAST, cluster_id) AS rn FROM m) SELECT hash_uid, cluster_id, dense_rank() OVER (ORDER BY cluster_id) AS new_id FROM k WHERE rn = 1")
def renumber_clusters(t: Tables) -> DataFrame:
    return curation.one_cluster_per_source(members(t), "cluster_id", "hash_uid", "score", "new_id").select("hash_uid", "cluster_id", "new_id")


@query(f"{M}, o AS (SELECT concat('h', o_custkey % 800) AS hash_uid, max_by(o_orderkey, (o_orderkey)) AS k, arg_max(o_orderstatus, o_orderkey) AS s FROM orders WHERE o_totalprice > 300000 GROUP BY 1) SELECT uid, coalesce(k, cluster_id) AS cluster_id, coalesce(s, last_name) AS last_name FROM m LEFT JOIN o USING (hash_uid)")
def km_override(t: Tables) -> DataFrame:
    curated = t.orders.where("o_totalprice > 300000").select(F.expr("concat('h', o_custkey % 800)").alias("hash_uid"), "o_orderkey", c("o_orderkey").alias("cluster_id"), c("o_orderstatus").alias("last_name"))
    return curation.override(members(t), curated, "hash_uid", "o_orderkey", ["cluster_id", "last_name"]).select("uid", "cluster_id", "last_name")


@query(f"""{M}, o AS (SELECT n_nationkey AS nr, CASE WHEN n_nationkey % 2 = 0 THEN 'c' ELSE 'd' END AS a, unnest([n_nationkey * 3, n_nationkey * 3 + 1, n_nationkey * 4]) AS uid FROM nation),
e AS (SELECT uid, max(nr) AS nr, arg_max(a, nr) AS a FROM o GROUP BY 1), k AS (SELECT uid, 9 + dense_rank() OVER (ORDER BY nr, CASE WHEN a = 'd' THEN uid END) AS z FROM e)
SELECT uid, coalesce(z, cluster_id) AS cluster_id FROM m LEFT JOIN k USING (uid)""")
def manual_cluster(t: Tables) -> DataFrame:
    orders = t.nation.select(c("n_nationkey").alias("nr"), F.expr("if(n_nationkey % 2 = 0, 'c', 'd')").alias("action"), F.expr("concat_ws('|', n_nationkey * 3, n_nationkey * 3 + 1, n_nationkey * 4)").alias("uids"))
    return curation.manual_clusters(members(t), orders, "cluster_id", "uid", 10).select("uid", "cluster_id")


@query("WITH h AS (SELECT o_custkey AS k, max(o_orderkey) FILTER (year(o_orderdate) = 1996) AS run_1, max(o_orderkey) FILTER (year(o_orderdate) = 1997) AS run_2, max(o_orderkey) FILTER (year(o_orderdate) = 1998) AS run_3 FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1) SELECT *, coalesce(run_3, run_2, run_1) AS run_latest FROM h")
def bridge_history(t: Tables) -> DataFrame:
    return curation.bridge(t.orders.select(c("o_custkey").alias("k"), F.year("o_orderdate").alias("run"), "o_orderkey"), "k", "run", "o_orderkey", [1996, 1997, 1998])


@query(f"{M} SELECT uid, 1000 + dense_rank() OVER (ORDER BY CASE WHEN score >= 0.5 THEN 0 ELSE 1 END, CASE WHEN score >= 0.5 THEN cluster_id ELSE uid END) AS golden_id FROM m")
def id_assign(t: Tables) -> DataFrame:
    return curation.assign_ids(members(t), "cluster_id", "score", 0.5, "golden_id", 1000).select("uid", "golden_id")


@query(f"{M}, p AS (SELECT DISTINCT hash_uid, cluster_id FROM m), n AS (SELECT cluster_id, count(*) AS n FROM p GROUP BY 1) SELECT hash_uid, arg_max(cluster_id, n * 1000000 + cluster_id) AS cluster_id FROM p JOIN n USING (cluster_id) GROUP BY 1")
def hash_id_conflict(t: Tables) -> DataFrame:
    return curation.one_id_per_hash(members(t), "cluster_id", "hash_uid")


@query(f"""{L}, e AS (SELECT DISTINCT uid, unnest(string_split(ids, '|')) AS id FROM l), b AS (SELECT id, min(uid) AS z FROM e GROUP BY 1), k AS (SELECT uid, min(z) AS z FROM e JOIN b USING (id) GROUP BY 1)
SELECT z AS uid, string_agg(DISTINCT id, '|' ORDER BY id) AS ids FROM e JOIN k USING (uid) GROUP BY 1""")
def shared_id_merge(t: Tables) -> DataFrame:
    return curation.merge_shared_ids(t.sql(LISTS, "orders").withColumn("rank", c("uid")), "uid", "ids", "rank")


@query(f"{M}, s AS (SELECT cluster_id, count(DISTINCT hash_uid) > 1 AS several FROM m GROUP BY 1), h AS (SELECT hash_uid, count(registry) > 0 AS known FROM m GROUP BY 1) SELECT uid, CASE WHEN NOT (several AND NOT known) THEN cluster_id END AS cluster_id FROM m JOIN s USING (cluster_id) JOIN h USING (hash_uid)")
def cluster_repair(t: Tables) -> DataFrame:
    return curation.repair_clusters(members(t), "cluster_id", "hash_uid", "registry").select("uid", "cluster_id")


@query(f"{M}, w AS (SELECT *, CASE WHEN score >= 0.5 THEN cluster_id END AS k FROM m), r AS (SELECT *, first_value(uid) OVER (PARTITION BY source, k ORDER BY CASE WHEN phone IS NULL THEN 1 ELSE 0 END, score DESC, uid) AS g FROM w) SELECT uid, k AS cluster_id, CASE WHEN k IS NULL THEN uid ELSE g END AS golden_uid FROM r")
def pre_golden(t: Tables) -> DataFrame:
    return curation.pre_golden(members(t), "source", "cluster_id", "score", "phone").select("uid", "cluster_id", "golden_uid")


@query("SELECT s_suppkey, CASE WHEN s_nationkey = 1 THEN substr(s_name, 1, 8) WHEN s_nationkey = 2 THEN upper(s_name) ELSE s_name END AS code FROM supplier")
def config_case(t: Tables) -> DataFrame:
    rules = [("1", "substring(s_name, 1, 8)"), ("2", "upper(s_name)")]
    return t.supplier.select("s_suppkey", curation.config_case("s_nationkey", rules, "s_name").alias("code"))


@query("""WITH p AS (SELECT p_partkey, concat(' ', p_name, ' | ', p_brand, '  ') AS name, concat(p_type, '||', p_size) AS address, concat(10000 + p_partkey, '-77') AS zip FROM part),
k AS (SELECT p_partkey, trim(regexp_replace(name, '[|\\s]+', ' ', 'g')) AS name, trim(regexp_replace(address, '[|\\s]+', ' ', 'g')) AS address, nullif(regexp_extract(zip, '^\\s*([0-9]{5})', 1), '') AS zip FROM p),
n AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS a, regexp_replace(lower(address), '[^a-z0-9]', '', 'g') AS b FROM k)
SELECT p_partkey, name, address, zip, sha256(a || '|' || b) AS site_hash FROM n WHERE a NOT IN ('smallringbrand2', 'redwidgetbrand17')""")
def site_cleanse(t: Tables) -> DataFrame:
    sites = t.part.selectExpr("p_partkey", "concat(' ', p_name, ' | ', p_brand, '  ') AS name", "concat(p_type, '||', p_size) AS address", "concat(10000 + p_partkey, '-77') AS zip")
    return curation.cleanse_site(sites, "name", "address", "zip", ["smallringbrand2", "redwidgetbrand17"])


_STOP = ", ".join(f"'{w}'" for w in mapping.STOP_WORDS)


@query(f"{N}, k AS (SELECT p_partkey, regexp_replace(name, '[=?()\\[\\]-]', '', 'g') AS x FROM n) SELECT p_partkey, CASE WHEN length(x) >= 30 THEN array_to_string([w FOR w IN regexp_split_to_array(x, '\\s+') IF w NOT IN ({_STOP})], ' ') ELSE x END AS name FROM k")
def stopwords(t: Tables) -> DataFrame:
    return t.sql(NAMES, "part").select("p_partkey", mapping.without_stop_words(c("name")).alias("name"))


_UNITS, _DOSE = "|".join(mapping.DOSE_UNITS).replace("^", r"\^"), "|".join(mapping.DOSE_WORDS)


@query(rf"{N}, k AS (SELECT p_partkey, string_split(trim(regexp_replace(regexp_replace(name, '(?i)\b[0-9]+ ?(?:{_UNITS})\b|\b(?:{_DOSE})\b', ' ', 'g'), '[^A-Za-z0-9-]+', ' ', 'g')), ' ') AS w FROM n) SELECT p_partkey, array_to_string([x FOR x IN w IF x NOT IN ({_STOP}) AND NOT regexp_matches(x, '^[0-9-]*$')], ' ') AS name FROM k")
def drug_clean(t: Tables) -> DataFrame:
    return t.sql(NAMES, "part").select("p_partkey", mapping.clean_drug(c("name")).alias("name"))


@query(f"{N} SELECT p_partkey, regexp_matches(name, '&|\\+|and|And|AND|combination|Combination|,.*,') AS combo FROM n")
def combo_flag(t: Tables) -> DataFrame:
    return t.sql(NAMES, "part").select("p_partkey", mapping.is_combination(c("name")).alias("combo"))


@query("WITH s AS (SELECT lower(p_name) AS k, min(p_brand) AS b FROM part GROUP BY 1), n AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type ELSE p_name END AS name FROM part) SELECT p_partkey, coalesce(b, name) AS name FROM n LEFT JOIN s ON lower(name) = k")
def synonym_resolve(t: Tables) -> DataFrame:
    """Names of parts are synonyms of their brands; types of parts are not known."""
    synonyms = t.part.select(F.upper("p_name").alias("synonym"), c("p_brand").alias("primary"))
    return mapping.primary_names(t.part.select("p_partkey", F.when(c("p_size") > 25, c("p_type")).otherwise(c("p_name")).alias("name")), "name", synonyms)


@query("SELECT p_partkey, array_to_string(list_distinct_kept, ';') AS sponsors FROM (SELECT p_partkey, CASE WHEN p_name = p_type THEN [p_brand, p_name] WHEN p_name = p_brand THEN [p_brand, p_type] WHEN p_brand = p_type THEN [p_brand, p_name] ELSE [p_brand, p_name, p_type] END AS list_distinct_kept FROM part)")
def sponsor_parse(t: Tables) -> DataFrame:
    text = F.concat("p_brand", F.lit(" {"), "p_name", F.lit("|"), "p_type", F.lit("/"), "p_name", F.lit("}| "), "p_brand")
    return t.part.select("p_partkey", F.array_join(mapping.sponsors(text), ";").alias("sponsors"))


@query("WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS lo, CASE WHEN p_partkey % 2 > 0 THEN CAST(p_size + 20 AS VARCHAR) END AS hi FROM part) SELECT p_partkey, CASE WHEN lo <> '' AND hi <> '' THEN lo || ' to ' || hi WHEN lo <> '' THEN lo || ' and older' WHEN hi <> '' THEN 'upto ' || hi ELSE 'Child, Adult, Older Adult' END AS age FROM a")
def age_phrase(t: Tables) -> DataFrame:
    low, high = F.expr("if(p_partkey % 3 > 0, string(p_size), '')"), F.expr("if(p_partkey % 2 > 0, string(p_size + 20), null)")
    return t.part.select("p_partkey", mapping.age_phrase(low, high).alias("age"))


@query("SELECT p_partkey, p_name AS first, p_type AS second FROM part")
def criteria_split(t: Tables) -> DataFrame:
    text = F.concat(F.lit("Inclusion Criteria: "), "p_name", F.lit("\nExclusion Criteria:\n"), "p_type", F.lit("\nWithdrawal Criteria: none"))
    parts = mapping.sections(text, "inclusion criteria:", "exclusion criteria:", "withdrawal criteria")
    return t.part.select("p_partkey", parts["first"].alias("first"), parts["second"].alias("second"))


@query(f"""{L}, a AS (SELECT concat('a', c_custkey) AS alias, CASE WHEN c_acctbal > 0 THEN concat('a', c_custkey + 1) END AS id FROM customer WHERE c_mktsegment <> 'MACHINERY'),
e AS (SELECT uid, unnest(string_split(ids, '|')) AS alias FROM l), r AS (SELECT uid, CASE WHEN a.alias IS NULL THEN e.alias ELSE id END AS id FROM e LEFT JOIN a ON a.alias = e.alias)
SELECT uid, coalesce(string_agg(DISTINCT id, '|' ORDER BY id), '') AS ids FROM r GROUP BY 1""")
def alias_resolve(t: Tables) -> DataFrame:
    """Customers of one segment are current; those of the others gave way to the next one, or to none."""
    aliases = t.customer.where("c_mktsegment <> 'MACHINERY'").selectExpr("concat('a', c_custkey) AS alias", "CASE WHEN c_acctbal > 0 THEN concat('a', c_custkey + 1) END AS id")
    return curation.resolve_aliases(t.sql(LISTS, "orders"), "uid", "ids", aliases)
