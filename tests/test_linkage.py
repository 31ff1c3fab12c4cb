"""Similarity joins, even blocks, the learned matcher, hot groups, databases and catalog tables."""

import itertools
import math
import random
import re
import statistics
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldenloom.operators import mapping, matching, metrics, nearest, resolve, similarity, windows
from goldenloom.plans import linkage
from goldenloom.plans.registry import ORACLE_SQL, Tables
from goldenloom.sources import databases, files, tables

DATA = "/root/testdata/sf0.001"


def made_names(rng, n):
    words = ["anna", "ana", "maria", "mary", "lopez", "lopes", "st", "clinic", "clinics", "of", "the", "north", "nord", "x", "müller", "mueller", "o'neil"]
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(n)}
    for name in list(names)[: n // 2]:
        k = rng.randrange(len(name))
        names.add(rng.choice([name[:k] + name[k + 1 :], name[:k] + "q" + name[k:], name.replace(" ", "-"), name.upper(), " ".join(reversed(name.split()))]))
    return sorted(names - {""})


@pytest.mark.parametrize("least", [0.6, 0.75, 0.85, 0.96])
def test_no_similar_pair_is_lost(spark, least):
    names = made_names(random.Random(7), 70)
    df = spark.createDataFrame([(x,) for x in [*names, *names[:9], None, ""]], "name string")
    pairs = spark.createDataFrame([(a, b) for a, b in itertools.combinations(names, 2)], "left string, right string")
    for join, score in ((similarity.similar_names, resolve.name_score), (similarity.similar_texts, resolve.similarity)):
        want = pairs.withColumn("score", score(F.col("left"), F.col("right"))).where(F.col("score") >= least - 1e-12)
        assert sorted(map(tuple, join(df, "name", least).collect())) == sorted(map(tuple, want.collect()))
    assert pairs.count() > 2000 and similarity.similar_names(df.where("false"), "name", least).count() == 0
    with pytest.raises(ValueError):
        similarity.similar_names(df, "name", 0.5)


@pytest.mark.parametrize("common", [0, 5])
@pytest.mark.parametrize("least", [0.6, 0.8])
def test_no_similar_pair_is_lost_among_common_stretches_and_words(spark, monkeypatch, common, least):
    monkeypatch.setattr(similarity, "COMMON", common)
    monkeypatch.setattr(similarity, "MOST_EDITS", 3)
    test_no_similar_pair_is_lost(spark, least)


def test_short_names_meet_on_few_rows(spark):
    """Of random names nearly all that meet on the rarest grams have other stretches."""
    rng = random.Random(4)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(15)) for _ in range(3000)]
    df = spark.createDataFrame([(n,) for n in [*names, names[0][:7] + names[0][8:], "zz" + names[1]]], "t string")
    pairs, rest = similarity._stretches(df, 0.8)
    assert rest.count() == 0 and sorted(map(tuple, pairs.collect())) == sorted(tuple(sorted(p)) for p in ((names[0], names[0][:7] + names[0][8:]), (names[1], "zz" + names[1])))


@pytest.mark.parametrize("least, shortest, longest, start", [(0.8, 12, 24, "abcd"), (0.7, 7, 16, ""), (0.6, 5, 12, "")])
def test_short_names_meet_on_parts_longer_than_common_stretches(spark, monkeypatch, least, shortest, longest, start):
    """The first stretch is that of all names, if they have the same start; halves and thirds within an edit are longer."""
    monkeypatch.setattr(similarity, "COMMON", 25 if start else 1000)
    rng = random.Random(11)
    letters = "abcdefghijklmnop" if start else "abcd"
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest) - len(start))) for _ in range(700)]
    for name in names[:200]:
        for _ in range(rng.randint(1, 4)):
            k = rng.randrange(len(name))
            name = rng.choice([name[:k] + name[k + 1 :], name[:k] + "d" + name[k:], name[:k] + "a" + name[k + 1 :]])
        names.append(name.ljust(shortest - len(start), "p")[: longest - len(start)])
    df = spark.createDataFrame([(start + n,) for n in sorted(set(names))], "t string")
    pairs, rest = similarity._stretches(df, least)
    every = df.select(F.col("t").alias("a")).crossJoin(df.select(F.col("t").alias("b"))).where("a < b")
    want = every.where(resolve.similarity(F.col("a"), F.col("b")) >= least - 1e-12)
    assert want.count() > 100 and sorted(map(tuple, pairs.collect())) == sorted(map(tuple, want.collect()))
    assert rest.where(F.floor(F.ceil(F.length("t") / least + 1e-9) * (1 - least) + 1e-9) <= similarity.MOST_EDITS).count() == 0


def test_comparators(spark):
    rows = [("a b|c", "C|a b| ", "Main St", "Main Street", "abc", "xxabdxx"), ("", "x", "", "", "", "ab"), (None, "x", None, "y", None, "y"), ("A", "a", "Main", "main", "same", "same")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    c = F.col
    got = df.select(similarity.set_similarity(c("a"), c("b")), similarity.short_string(c("c"), c("d")), similarity.partial_ratio(c("e"), c("f")), similarity.weighted_ratio(c("e"), c("f"))).collect()
    near = lambda row: [None if x is None else round(x, 4) for x in row]
    assert [near(r)[:3] for r in got] == [[1.0, round(7 / 11, 4), round(2 / 3, 4)], [None, None, 0.0], [None, None, None], [1.0, 1.0, 1.0]]
    assert near(got[0])[3] == 0.6 and near(got[3])[3] == 1.0


def test_filter_never_stops_a_jaro_pair(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string").withColumn("j", resolve.jaro(F.col("a"), F.col("b")))
    for least in (0.5, 0.7, 0.8, 0.9):
        ways = df.groupBy(similarity.jaro_can_reach(F.col("a"), F.col("b"), least).alias("can")).agg(F.max("j").alias("best"), F.count("*").alias("n")).collect()
        stopped = [r for r in ways if not r.can]
        assert stopped and all(r.best < least for r in stopped)


def test_one_block_is_many_even_tasks(spark):
    n = 700
    df = spark.range(n).select("id", F.lit("all").alias("k"), (F.col("id") * 2).alias("x")).union(spark.createDataFrame([(5000, "b", 1), (5001, "b", 2), (6000, None, 3)], "id long, k string, x long"))
    pairs = similarity.tiled(df, "id", ["k"], ["x"], tile=64)
    got = pairs.select("left", "right").collect()
    assert len(got) == len(set(got)) == n * (n - 1) // 2 + 1 and all(r.left < r.right for r in got)
    assert pairs.where("left_x <> 2 * left and k = 'all'").count() == 0
    tiles = pairs.where("k = 'all'").groupBy(F.floor(F.col("left") / 64), F.floor(F.col("right") / 64)).count()
    assert tiles.agg(F.max("count")).first()[0] <= 64 * 64 and tiles.count() == 66


@pytest.mark.parametrize("known", [0, 250_000])
def test_scores_of_values_reach_all_their_pairs(spark, monkeypatch, known):
    monkeypatch.setattr(similarity, "KNOWN", known)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["red ring", "ring red", "old pin", "", None])) for i in range(300)] + [(7, "a", "old pin"), (None, "a", "x")]
    df = spark.createDataFrame(rows, "id long, k string, v string")
    code = lambda x, y: F.concat_ws("|", F.coalesce(x, F.lit("-")), F.coalesce(y, F.lit("-")))
    got = similarity.scored_pairs(df, "id", ["k"], "v", lambda x, y: {"s": code(x, y)}, symmetric=False, tile=16)
    text = lambda v: "-" if v is None else v
    have = [r for r in rows if r[0] is not None and r[1] is not None]
    want = sorted((x[0], y[0], f"{text(x[2])}|{text(y[2])}") for x in have for y in have if x[1] == y[1] and x[0] < y[0])
    assert sorted(map(tuple, got.select("left", "right", "s").collect())) == want
    some = similarity.scored_pairs(df, "id", ["k"], "v", lambda x, y: {"s": F.levenshtein(x, y)}, lambda s: s["s"] == 0, tile=16)
    alike = sorted((x[0], y[0], 0) for x in have for y in have if x[1] == y[1] and x[0] < y[0] and x[2] == y[2] is not None)
    assert sorted(map(tuple, some.collect())) == alike
    assert similarity.scored_pairs(df.where("false"), "id", ["k"], "v", lambda x, y: {"s": F.levenshtein(x, y)}).count() == 0


def test_no_loop_keeps_the_rows_of_two_lists(spark):
    """The lists of two values are written out by loops of their own, not by one whose rows are all kept until it ends."""
    df = spark.range(300).select("id", F.lit("all").alias("k"), F.when(F.col("id") % 2 == 0, "ring").otherwise("pin").alias("v"))
    pairs = similarity.scored_pairs(df, "id", ["k"], "v", lambda x, y: {"s": F.levenshtein(x, y)})
    assert len(pairs.collect()) == 300 * 299 // 2
    loops = [line.split("Generate")[0].strip(" +-:") for line in pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if re.search(r"Generate explode\(.*_[xy]", line)]
    assert len(loops) == 2 and len(set(loops)) == 2


def test_fuzzy_pairs_of_a_block_of_copies(spark):
    n = 4000
    df = spark.range(n).select("id", F.lit("all").alias("k"), F.when(F.col("id") % 2 == 0, "large ring").otherwise("cold plate").alias("v"))
    assert similarity.fuzzy_pairs(df, "id", "v", ["k"], 0.9).count() == 2 * (n // 2) * (n // 2 - 1) // 2


def test_links_of_a_block_grow_with_its_rows(spark):
    n = 3000
    df = spark.range(n).select("id", F.lit("all").alias("k"), F.when(F.col("id") % 3 == 0, "small").when(F.col("id") % 3 == 1, "smalls").otherwise("economy").alias("v"))
    links = similarity.block_links(df, "id", ["k"], "v", resolve.similarity, 0.8)
    assert links.count() == n - 3 + 1  # copies, and small with smalls
    folder = files.scratch(spark)
    got = resolve.clusters(df.select("id"), links, lambda k: f"{folder}/{k}")
    assert sorted(map(tuple, got.collect())) == [(i, 2 if i % 3 == 2 else 0) for i in range(n)]


def test_sorted_neighbours_over_borders(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "a", "b", "c", "d"])) for i in range(500)]
    got = similarity.sorted_neighbours(spark.createDataFrame(rows, "id long, v string").repartition(7), "id", ["v"], 5)
    order = [i for i, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))]
    assert sorted(map(tuple, got.collect())) == sorted((order[i], order[j]) for i in range(500) for j in range(i + 1, min(i + 5, 500)))


def test_ids_do_not_depend_on_reuse_and_keep_rows_without_value(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("v")).union(spark.createDataFrame([(None,), (None,)], "v string"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = windows.ordered_ids(df, "v", "n", 5).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    order = {v: k + 5 for k, v in enumerate(sorted({str(i) for i in range(1500)}))}
    assert len(got) == 3002 and all(r.n == (None if r.v is None else order[r.v]) for r in got)


def test_ranks_and_medians_of_one_huge_group(spark):
    rng = random.Random(3)
    rows = [("g", rng.choice([0.5, 1.0, rng.random(), None])) for _ in range(4000)] + [(None, 1.0), (None, 2.0), ("lone", 0.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for up in (True, False):
        got = windows.rank_norm(df, ["g"], "v", "s", up).collect()
        values = [v for g, v in rows if g == "g" and v is not None]
        rank = {v: sum((x < v) if up else (x > v) for x in values) for v in set(values)}
        top = max(rank.values())
        want = [(g, v, None if v is None else rank[v] / top if g == "g" else float((v == 2.0) == up) if g is None else 0.0) for g, v in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    medians = {r.g: r.m for r in windows.median_of(df, ["g"], "v", "m").collect()}
    assert medians == {"g": statistics.median(values), None: 1.5, "lone": 0.0, "none": None}
    assert windows.median_of(df, [], "v", "m").collect()[0].m == statistics.median(v for _, v in rows if v is not None)


def test_no_range_holds_a_group(spark):
    counted = spark.range(200_000).select(F.lit(1).alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = windows.cumulated(counted, ["g"], "v", "n", "before")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert made.where("before <> v").count() == 0
    laid = spark.read.parquet(*made.inputFiles()).groupBy("_p").count().select("count").toPandas()["count"]
    assert len(laid) > 1 and laid.max() <= 3 * laid.median()


def test_decay_keeps_rows_of_null_keys_and_times(spark):
    rows = [(None, 1.0, 5.0), (None, 2.0, 1.0), (1, None, 9.0), (1, 0.0, 2.0), (1, 0.0, 3.0), (1, 700.0, None), (1, 700.5, 1.0)]
    got = metrics.decayed(spark.createDataFrame(rows, "k int, t double, v double"), ["k"], "t", "v", "b", k=0.5).collect()
    want = {(None, 1.0, 5.0): 5.0, (None, 2.0, 1.0): 1 + 5 * math.exp(-0.5), (1, None, 9.0): None, (1, 0.0, 2.0): 5.0, (1, 0.0, 3.0): 5.0, (1, 700.0, None): 0.0, (1, 700.5, 1.0): 1.0}
    assert len(got) == len(rows) and all((r.b is None) == (want[r.k, r.t, r.v] is None) and abs((r.b or 0) - (want[r.k, r.t, r.v] or 0)) < 1e-9 for r in got)


def test_pruned_top1_scores_few_pairs_and_loses_none(spark):
    """A vocabulary where all values share long common words."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 5)))
    std = sorted({f"north clinical research hospital {word()}" for _ in range(150)})
    raw = sorted({s.replace("clinical", "clinic") if rng.random() < 0.5 else s + "s" for s in std[:80]} | {f"{word()} {word()}" for _ in range(40)} | {"", "hospital"})
    raws, stds = (spark.createDataFrame([(x,) for x in values], f"{name} string") for name, values in (("raw", raw), ("std", std)))
    a, b = mapping.tfidf_weights(raws, stds, 3, None)
    every = a.withColumnRenamed("w", "wa").join(b.withColumnRenamed("w", "wb").drop("df"), "g").groupBy("raw", "std").agg(F.sum(F.col("wa") * F.col("wb")).alias("score"))
    want = {}
    for r in every.where("score >= 0.8").collect():
        best = want.get(r.raw)
        if best is None or (-round(r.score, 9), r.std) < (-round(best[1], 9), best[0]):
            want[r.raw] = (r.std, r.score)
    got = {r.raw: (r.std, r.score) for r in mapping.tfidf_top1(raws, stds, 0.8).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and len(want) > 60
    assert mapping.tfidf_candidates(a, b, 0.8).count() < 0.25 * every.count()


def test_files_are_checked_line_by_line(spark, tmp_path):
    for name, text in {"a": 'Id|Full Name\n1|x\n2|"y|z"\n', "b": "name|id\n1|2|3\n1\n", "c": "id\n1|2\n", "d": ""}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
    got = {r.file: (r.same_header, r.n_rows, r.n_bad) for r in files.check_files(spark, f"file://{tmp_path}", ["id", "full_name"], "|").collect()}
    assert got == {"a/f.csv": (True, 2, 0), "b/f.csv": (False, 2, 2), "c/f.csv": (False, 1, 0)}


def test_a_large_file_lands_by_many_tasks(spark, tmp_path):
    (tmp_path / "x.csv").write_text("k,v\n" + "".join(f"{i},{'v' * 90}\n" for i in range(40_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    try:
        read = spark.read.options(header=True).csv(f"file://{tmp_path}/x.csv")
        assert read.rdd.getNumPartitions() > 3
        landed = files.land(spark, f"file://{tmp_path}/x.csv", f"file://{tmp_path}/landed")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed.count() == 40_000 and landed.agg(F.count_distinct("k")).first()[0] == 40_000
    (tmp_path / "y.csv").write_text('k,v\n1,"two\nlines"\n')
    assert files.land(spark, f"file://{tmp_path}/y.csv", f"file://{tmp_path}/l2", multi_line=True).collect() == [("1", "two\nlines")]


def near_by_force(rows, asked, k, same_block=False):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    block = {i: b for i, _, b in rows}
    out = []
    for q in asked:
        scores = sorted((-round(float(unit[q] @ unit[i]), 9), i) for i in unit if i != q and (not same_block or block[i] == block[q]))
        out += [(q, i, s) for s, i in scores[:k]]
    return sorted((q, i, round(-s, 6)) for q, i, s in out)


def test_nearest_are_exact_and_cells_alone_nearly(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ITEMS", 50)
    monkeypatch.setattr(nearest, "QUERIES", 4)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + 0.3 * rng.normal(size=8)).tolist(), "xy"[i % 2]) for i in range(1500)]
    rows += [(5000 + i, [1.0, *[0.0] * 7], "x") for i in range(200)]
    df = spark.createDataFrame([*rows, (9000, [0.0] * 8, "x"), (9001, None, "x"), (None, [1.0] * 8, "x"), (9002, [float("nan"), *[1.0] * 7], "y")], "i long, w array<double>, b string")
    asked = df.where("i % 50 = 0").select(F.col("i").alias("q"), F.col("w").alias("v"), "b")
    ids = [i for i, _, _ in rows if i % 50 == 0]
    got = lambda **how: sorted((r.q, r.i, round(r.score, 6)) for r in nearest.nearest(asked, df, 5, **how).collect())
    want = near_by_force(rows, ids, 5)
    assert got() == want and got(block="b") == near_by_force(rows, ids, 5, True)
    found = {(q, i) for q, i, _ in got(exact=False, probe=6)}
    assert len(found & {(q, i) for q, i, _ in want}) >= 0.9 * len(want)
    assert nearest.nearest(asked, df.where("false"), 5).count() == 0 == nearest.nearest(asked.where("false"), df, 5).count()
    few = nearest.nearest(asked.where("q = 0"), df.where("i <= 2"), 5).collect()
    assert len(few) == 2


# The learned matcher


def test_weights_come_close_to_those_that_made_the_patterns():
    """Pairs drawn from known chances; the counts of patterns are all that is seen."""
    share, m, u = 0.2, [(0.05, 0.15, 0.8), (0.1, 0.9), (0.02, 0.08, 0.9)], [(0.9, 0.08, 0.02), (0.8, 0.2), (0.95, 0.04, 0.01)]
    patterns = {}
    for levels in itertools.product(range(3), range(2), range(3)):
        chance = share * math.prod(x[k] for x, k in zip(m, levels)) + (1 - share) * math.prod(x[k] for x, k in zip(u, levels))
        patterns[levels] = round(chance * 1_000_000)
    model = matching.learn(patterns, [3, 2, 3])
    assert abs(model.share - share) < 0.01
    assert all(abs(a - b) < 0.02 for got, want in ((model.m, m), (model.u, u)) for x, y in zip(got, want) for a, b in zip(x, y))


def test_expectation_maximisation_is_that_over_single_pairs():
    """The same steps pair by pair, without patterns and logarithms, missing fields included."""
    rng = random.Random(4)
    pairs = [tuple(rng.choice([-1, 0, 1, 1]) for _ in range(3)) for _ in range(200)]
    share, m, u = 0.1, [[1 / 3, 2 / 3]] * 3, [[2 / 3, 1 / 3]] * 3
    for _ in range(5):
        p = []
        for x in pairs:
            a = share * math.prod(m[f][k] for f, k in enumerate(x) if k >= 0)
            b = (1 - share) * math.prod(u[f][k] for f, k in enumerate(x) if k >= 0)
            p.append(a / (a + b))
        share = sum(p) / len(p)
        tally = lambda weights: [[(0.5 + sum(w for w, x in zip(weights, pairs) if x[f] == k)) / (1.0 + sum(w for w, x in zip(weights, pairs) if x[f] >= 0)) for k in (0, 1)] for f in range(3)]
        m, u = tally(p), tally([1 - x for x in p])
    model = matching.learn({x: pairs.count(x) for x in set(pairs)}, [2, 2, 2], rounds=5)
    assert abs(model.share - share) < 1e-9 and all(abs(a - b) < 1e-9 for got, want in ((model.m, m), (model.u, u)) for x, y in zip(got, want) for a, b in zip(x, y))


def test_threshold_weighs_recall():
    model = matching.Model(0.5, ((0.1, 0.9),), ((0.9, 0.1),))
    few, many = {(1,): 90, (0,): 10}, {(1,): 10, (0,): 90}
    assert matching.threshold(few, model, 0.1) == pytest.approx(0.9)
    assert matching.threshold(many, model, 9.0) == pytest.approx(0.1)


def test_made_duplicates_are_found(spark):
    t = Tables(spark, DATA)
    found, model = linkage.learned_pairs(t)
    n = t.customer.count()
    right = found.where("right = left + 1 and left % 2 = 0").count()
    assert right >= 0.9 * n and found.count() <= right / 0.9 and 0 < model.share < 1
    assert all(m[-1] > u[-1] for m, u in zip(model.m, model.u))
    assert matching.match(found.limit(0).drop("probability"), [matching.Comparison("name", F.lit(1.0))])[0].count() == 0


# Databases and catalog tables


def test_parts_are_filtered_by_the_database(spark):
    at = databases.address("derby", "parts")
    rows = [(i, f"v{i % 3}") for i in range(-50, 1000)] + [(None, "none"), (None, "v1")]
    databases.write_table(spark.createDataFrame(rows, "ID long, V string"), at, "T", "ID BIGINT, V VARCHAR(9)")
    df = databases.read_parts(spark, at, "SELECT ID, V FROM T", "ID", 4)
    assert df.rdd.getNumPartitions() == 5 and sorted(map(tuple, df.collect()), key=str) == sorted(rows, key=str)
    assert max(len(p) for p in df.rdd.glom().collect()) <= 263
    pushed = df.where("V = 'v1'")._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(V), *EqualTo(V,v1)]" in pushed
    assert databases.read_parts(spark, at, "SELECT ID, V FROM T WHERE ID > 5000", "ID", 4).count() == 0
    with pytest.raises(ValueError):
        databases.address("access", "x")
    assert databases.address("oracle", "orcl", "h", 1521)["url"] == "jdbc:oracle:thin:@//h:1521/orcl"


def test_loads_take_only_what_is_new(spark, tmp_path):
    at, target = databases.address("derby", "loads"), f"file://{tmp_path}/loaded"
    put = lambda rows, mode: databases.write_table(spark.createDataFrame(rows, "ID long, V string"), at, "T", "ID BIGINT, V VARCHAR(9)", mode=mode)
    put([(1, "a"), (2, "b"), (None, "n")], "overwrite")
    load = lambda: sorted(map(tuple, databases.load_new(spark, at, "SELECT ID, V FROM T", "ID", target).collect()))
    assert load() == [(1, "a"), (2, "b")] and load() == []
    put([(2, "again"), (3, "c")], "append")
    assert load() == [(3, "c")] and spark.read.parquet(target).count() == 3


def test_runs_are_unloaded_and_copied_apart(spark, tmp_path):
    at, path = databases.address("derby", "runs"), f"file://{tmp_path}/runs"
    databases.write_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "ID long, V string"), at, "T", "ID BIGINT, V VARCHAR(9)")
    out = lambda v, day: databases.unload(spark, at, "SELECT ID, V FROM T WHERE V = '$$v'", "ID", path, {"v": v}, pt_data_dt=day).count()
    assert (out("a", "d1"), out("b", "d2"), out("none", "d3"), out("a", "d2")) == (1, 2, 0, 1)
    assert databases.copy_into(spark, path, at, "D2", "ID BIGINT, V VARCHAR(9)", pt_data_dt="d2") == 1
    assert databases.read_query(spark, at, "SELECT * FROM D2").collect() == [(1, "a")] and spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        databases.unload(spark, at, "SELECT ID FROM T WHERE V = '$$x'", "ID", path, {}, pt_data_dt="d1")


def test_derby_in_files_imports_all_values(spark):
    at = databases.files_database(spark)
    rows = [(1, 'a "b", c', 1e-7), (2, " \n x ' ", None), (3, "", -2.5), (None, None, None), (5, "é", 0.1 + 0.2)]
    put = lambda rows, mode: databases.write_table(spark.createDataFrame(rows, "ID long, V string, D double"), at, "Copied", "ID BIGINT, V VARCHAR(20), D DOUBLE", mode=mode)
    put([(9, "old", 0.0)], "overwrite"), put(rows, "overwrite"), put([], "append")
    old = databases.archived(spark, at)
    databases.write_table(spark.createDataFrame([("last", 7)], "V string, ID long"), at, "Copied", mode="append")
    found = lambda at: sorted(map(tuple, databases.read_query(spark, at, "SELECT ID, V, D FROM Copied").collect()), key=str)
    assert found(old) == sorted(rows, key=str)
    assert found(databases.archived(spark, at)) == sorted([*rows, (7, "last", None)], key=str)


def test_rows_of_one_null_are_imported(spark):
    at = databases.files_database(spark)
    databases.write_table(spark.createDataFrame([("a",), (None,), ("",)], "V string"), at, "T", "V VARCHAR(9)")
    assert sorted(databases.read_query(spark, databases.archived(spark, at), "SELECT V FROM T").collect(), key=str) == [("",), ("a",), (None,)]


ON_EXECUTORS = """
import sys
from pyspark.sql import SparkSession
from goldenloom.plans import catalog
shared, data = sys.argv[1:]
conf = {"spark.executor.memory": "600m", "spark.checkpoint.dir": f"file://{shared}", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.master("local-cluster[2,2,1000]").config(map=conf).getOrCreate()
for name in ("jdbc_parts", "jdbc_incremental", "warehouse_unload"):
    catalog.QUERIES[name](spark, data).write.parquet(f"file://{shared}/{name}")
"""


def test_databases_are_read_by_executors_of_their_own(spark, tmp_path):
    import duckdb

    subprocess.run([sys.executable, "-c", ON_EXECUTORS, str(tmp_path), DATA], cwd=tmp_path, check=True, timeout=300)
    for name in ("jdbc_parts", "jdbc_incremental", "warehouse_unload"):
        con = duckdb.connect()
        con.execute(f"create view orders as select * from '{DATA}/orders.parquet'")
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{name}").collect())) == sorted(con.execute(ORACLE_SQL[name]).fetchall())


def test_bucketed_join_has_no_shuffle(spark):
    plan = linkage.bucketed_join(Tables(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string")
    try:
        tables.save(rows, "gl_parts", partition_by=("p",), path=f"file://{tmp_path}/t")
        tables.overwrite_partitions(spark.createDataFrame([("b", 20), ("d", 4)], "p string, v int"), "gl_parts")
        tables.overwrite_partition(spark.createDataFrame([(30,)], "v int"), "gl_parts", p="c")
        assert sorted(map(tuple, spark.table("gl_parts").select("v", "p").collect())) == [(1, "a"), (4, "d"), (20, "b"), (30, "c")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        assert tables.size_in_bytes(spark, "gl_parts") > 0
    finally:
        spark.sql("DROP TABLE IF EXISTS gl_parts")


def test_stored_rows_stay_as_drawn(spark):
    df = files.stored(spark.range(100).select(F.rand().alias("r")))
    assert df.collect() == df.collect()


def test_intermediates_go_when_asked():
    """In a session of its own process, as others' files are in the same folder."""
    code = (
        "from pyspark.sql import SparkSession; from goldenloom.sources import files; import os\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "kept = files.stored(s.range(3)); path = kept.inputFiles()[0].removeprefix('file://'); assert os.path.exists(path) and kept.count() == 3\n"
        "other = files.stored(s.range(2)).inputFiles()[0].removeprefix('file://')\n"
        "files.drop_intermediates(s); assert not os.path.exists(path) and not os.path.exists(other); print('gone')"
    )
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout.endswith("gone\n")
