"""Rules on clustered records: consistency, merging, overrides, id assignment and bridging.

Frames have a unique uid and a nullable cluster. Every rule is a hash-partitioned aggregate or equi-join on
its own key; none holds a cluster in one row or pairs a cluster's members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.operators.windows import ordered_ids, top1

c = F.col


def unclustered(uid: str = "uid") -> Column:
    return F.concat(F.lit("unclustered_"), c(uid).cast("string"))


def keep_consistent(df: DataFrame, cluster: str, names: list[str], uid: str = "uid") -> DataFrame:
    """Members that share their names with another member of the cluster keep it; all others leave it."""
    same = df.groupBy(cluster, *names).agg(F.count("*").alias("_same"))
    on = [c(f"a.{k}").eqNullSafe(c(f"b.{k}")) for k in (cluster, *names)]
    joined = df.alias("a").join(same.alias("b"), on).select("a.*", "b._same")
    return joined.withColumn(cluster, F.when(c("_same") > 1, c(cluster).cast("string")).otherwise(unclustered(uid))).drop("_same")


def merge_by_contact(df: DataFrame, cluster: str, first: str, last: str, phone: str, email: str) -> DataFrame:
    """Clusters with members of one name, in either order, and one phone or one local part of an e-mail take
    the least of their ids. One pass; chains over several clusters need another one."""
    name = F.concat_ws(" ", F.array_sort(F.array(F.lower(first), F.lower(last))))
    local = F.lower(F.substring_index(email, "@", 1))
    contacts = F.array_compact(F.array(F.concat(F.lit("p:"), c(phone)), F.concat(F.lit("e:"), local)))
    keyed = df.where(c(cluster).isNotNull()).select(cluster, name.alias("_name"), F.explode(contacts).alias("_contact"))
    least = keyed.groupBy("_name", "_contact").agg(F.min(cluster).alias("_least"))
    merged = keyed.distinct().join(least, ["_name", "_contact"]).groupBy(cluster).agg(F.min("_least").alias("_to"))
    return df.join(merged, cluster, "left").withColumn(cluster, F.coalesce("_to", cluster)).drop("_to")


def adopt_by_name(df: DataFrame, cluster: str, names: list[str], contacts: list[str]) -> DataFrame:
    """Records without any contact take the least cluster of the records of their name that have one."""
    has = F.coalesce(*contacts).isNotNull()
    named = df.where(has).groupBy(*names).agg(F.min(cluster).alias("_to"))
    return df.join(named, names, "left").withColumn(cluster, F.when(has, c(cluster)).otherwise(F.coalesce("_to", cluster))).drop("_to")


def registry_override(df: DataFrame, cluster: str, title: str, registry: str, score: str, uid: str = "uid", least_title: int = 11) -> DataFrame:
    """A registry id is the cluster, with score 0.9; else a short title leaves the cluster."""
    made = F.when(c(registry).isNotNull(), c(registry)).when(F.length(title) < least_title, unclustered(uid)).otherwise(c(cluster).cast("string"))
    return df.withColumns({cluster: made, score: F.when(c(registry).isNotNull(), 0.9).otherwise(c(score))})


def one_cluster_per_source(df: DataFrame, cluster: str, source: str, score: str, out: str) -> DataFrame:
    """Each source id keeps the cluster of its best score, then the least; clusters are numbered anew from 1."""
    return ordered_ids(top1(df, [source], c(score).desc_nulls_last(), c(cluster)), cluster, out)


def override(df: DataFrame, curated: DataFrame, key: str, when: str, columns: list[str]) -> DataFrame:
    """The latest curated values of the key take the place of the computed ones, where they are not null."""
    latest = curated.groupBy(key).agg(F.max_by(F.struct(*columns), when).alias("_set"))
    return df.join(latest, key, "left").withColumns({k: F.coalesce(c(f"_set.{k}"), c(k)) for k in columns}).drop("_set")


def manual_clusters(df: DataFrame, orders: DataFrame, cluster: str, uid: str, first: int) -> DataFrame:
    """orders(nr, action, uids): 'c' gives all the uids one new cluster, 'd' each its own. uids are a |-list.
    A uid in several orders follows the last; new clusters are numbered from `first`."""
    each = orders.select("nr", "action", F.explode(F.split("uids", r"\|").cast("array<bigint>")).alias(uid))
    each = each.groupBy(uid).agg(F.max_by("action", "nr").alias("action"), F.max("nr").alias("nr"))
    group = F.when(c("action") == "c", F.format_string("%012d", "nr")).otherwise(F.format_string("%012d-%012d", "nr", uid))
    numbered = ordered_ids(each.withColumn("_group", group), "_group", "_to", first).select(uid, "_to")
    return df.join(numbered, uid, "left").withColumn(cluster, F.coalesce("_to", cluster)).drop("_to")


def bridge(history: DataFrame, key: str, run: str, value: str, runs: list[int]) -> DataFrame:
    """The wide bridging table of a long history: run_1 is the first of `runs`; run_latest the last value there."""
    wide = [F.max(F.when(c(run) == r, c(value))).alias(f"run_{k + 1}") for k, r in enumerate(runs)]
    made = history.where(c(run).isin(runs)).groupBy(key).agg(*wide)
    return made.withColumn("run_latest", F.coalesce(*(f"run_{k}" for k in range(len(runs), 0, -1))))


def assign_ids(df: DataFrame, cluster: str, score: str, least: float, out: str, highest: int = 0, uid: str = "uid") -> DataFrame:
    """Rows of a cluster with a score of at least `least` share one id after `highest`; all others get their own."""
    shares = (c(score) >= least) & c(cluster).isNotNull()
    key = F.when(shares, F.format_string("a%015d", cluster)).otherwise(F.format_string("b%015d", uid))
    return ordered_ids(df.withColumn("_key", key), "_key", out, highest + 1).drop("_key")


def one_id_per_hash(df: DataFrame, golden: str, hash_uid: str) -> DataFrame:
    """(hash, id): the id that covers most hashes, then the highest."""
    pairs = df.select(hash_uid, golden).distinct()
    covers = pairs.groupBy(golden).agg(F.count("*").alias("_n"))
    return pairs.join(covers, golden).groupBy(hash_uid).agg(F.max(F.struct("_n", golden)).getField(golden).alias(golden))


def merge_shared_ids(df: DataFrame, uid: str, ids: str, rank: str, sep: str = "|") -> DataFrame:
    """(uid, ids): rows that have any source id in common keep the best-ranked one with the union of their ids.
    One pass, no transitive closure."""
    each = df.select(uid, rank, F.explode(F.split(ids, rf"\{sep}")).alias("_id")).distinct()
    best = each.groupBy("_id").agg(F.min(F.struct(rank, uid)).alias("_best"))
    kept = each.join(best, "_id").groupBy(uid).agg(F.min("_best").getField(uid).alias("_kept"))
    return each.join(kept, uid).groupBy(c("_kept").alias(uid)).agg(F.array_join(F.array_sort(F.collect_set("_id")), sep).alias(ids))


def repair_clusters(df: DataFrame, cluster: str, hash_uid: str, registry: str) -> DataFrame:
    """Hashes without any registry id leave clusters that hold several hashes."""
    several = df.groupBy(cluster).agg((F.count_distinct(hash_uid) > 1).alias("_several"))
    known = df.groupBy(hash_uid).agg((F.count(registry) > 0).alias("_known"))
    joined = df.join(several, cluster, "left").join(known, hash_uid)
    return joined.withColumn(cluster, F.when(~(F.coalesce("_several", F.lit(False)) & ~c("_known")), c(cluster))).drop("_several", "_known")


def pre_golden(df: DataFrame, source: str, cluster: str, score: str, filled: str, uid: str = "uid", least: float = 0.5) -> DataFrame:
    """All rows with `golden_uid`: inside a source, a cluster's row with `filled` not null, then the highest
    score, then the least uid. Rows with a score under `least` have no cluster and stand for themselves."""
    weak = df.withColumn(cluster, F.when(c(score) >= least, c(cluster)))
    order = F.struct(c(filled).isNotNull().cast("int"), F.coalesce(score, F.lit(0.0)), -c(uid))
    best = weak.where(c(cluster).isNotNull()).groupBy(source, cluster).agg(F.max_by(uid, order).alias("_best"))
    return weak.join(best, [source, cluster], "left").withColumn("golden_uid", F.coalesce("_best", uid)).drop("_best")


def config_case(column: str, rules: list[tuple[str, str]], default: str) -> Column:
    """One CASE from configured (value, SQL expression) rows."""
    made = F.lit(None)
    for k, (value, text) in enumerate(rules):
        made = (F if k == 0 else made).when(c(column) == value, F.expr(text))
    return made.otherwise(F.expr(default)) if rules else F.expr(default)


def cleanse_site(df: DataFrame, name: str, address: str, zip_: str, junk: list[str]) -> DataFrame:
    """Pipes and space runs to one space, zip cut at its first five digits, junk names dropped, and site_hash
    of lower-case letters and digits of name and address."""
    squeezed = lambda k: F.trim(F.regexp_replace(k, r"[|\s]+", " "))
    plain = lambda k: F.regexp_replace(F.lower(F.coalesce(k, F.lit(""))), "[^a-z0-9]", "")
    clean = df.withColumns({name: squeezed(name), address: squeezed(address), zip_: F.nullif(F.regexp_extract(zip_, r"^\s*([0-9]{5})", 1), F.lit(""))})
    return clean.where(~plain(name).isin(junk)).withColumn("site_hash", F.sha2(F.concat_ws("|", plain(name), plain(address)), 256))


def resolve_aliases(df: DataFrame, key: str, ids: str, aliases: DataFrame, sep: str = "|") -> DataFrame:
    """aliases(alias, id): obsolete ids leave the list, or give way to the id that took their place; all other
    ids stay. Sorted, distinct; a list that loses all of its ids is empty."""
    known = aliases.select("alias", "id", F.lit(True).alias("known"))
    each = df.select(key, F.explode_outer(F.split(ids, rf"\{sep}")).alias("alias")).join(known, "alias", "left")
    made = F.when(c("known").isNull(), c("alias")).otherwise(c("id"))
    return each.select(key, made.alias("id")).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("id")), sep).alias(ids))
