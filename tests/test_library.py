"""Micro-fixtures with results worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from goldenloom.functions import keys, multi
from goldenloom.operators import checks, history, mapping, metrics, resolve, windows
from goldenloom.operators.checks import Check
from goldenloom.sources import files


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_scd1_keeps_current_and_absent_history(spark):
    now = spark.createDataFrame([("a", 1), (" B ", 2), (None, 3)], "k string, v int")
    old = spark.createDataFrame([("A", 9), ("b", 9), ("c", 9), (None, 9)], "k string, v int")
    assert got(history.scd1_stitch(now, old, ["k"])) == [(" B ", 2), ("a", 1), ("c", 9), (None, 3)]


def test_golden_ids_stay_merge_split_and_grow(spark):
    previous = spark.createDataFrame([("a", "x_1"), ("b", "x_1"), ("c", "x_2"), ("d", "x_3"), ("e", "x_3")], "hash_uid string, golden_id string")
    clusters = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 20), ("e", 30), ("f", 40)], "hash_uid string, cluster_id int")
    assert got(history.golden_ids(previous, clusters, "x_")) == [("a", "x_1"), ("b", "x_1"), ("c", "x_1"), ("d", "x_3"), ("e", "x_4"), ("f", "x_5")]


def test_cdc(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (3, "c"), (4, None)], "k int, v string")
    assert got(history.cdc_merge(old, new, ["k"], ["v"])) == [(1, "a", "unchanged", "Y"), (2, "b", "gone", "N"), (3, "c", "updated", "Y"), (4, None, "new", "Y")]


def test_rank_norm_lone_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 5.0), ("c", 1.0), ("c", 1.0), ("c", 2.0), ("c", None)], "g string, v double")
    assert got(windows.rank_norm(df, ["g"], "v", "s")) == [("a", 0.0, 0.0), ("b", 5.0, 1.0), ("c", 1.0, 0.0), ("c", 1.0, 0.0), ("c", 2.0, 1.0), ("c", None, None)]


def test_golden_record_takes_each_column_on_its_own(spark):
    df = spark.createDataFrame([(1, 1, None, "p"), (1, 2, "x", "q"), (2, 1, None, None)], "k int, r int, a string, b string")
    assert got(windows.golden_record(df, ["k"], ["a", "b"], "r")) == [(1, "x", "p"), (2, None, None)]


def test_checks(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, " ", "b"), (4, "12", "c")], "row int, v string, u string")
    rules = [Check(1, "null", "v"), Check(2, "length", "v", "> 1", criticality="C"), Check(3, "unique", "u", criticality="C"), Check(4, "integer", "v", scope="row > 2"), Check(5, "length", "v", "about 3")]
    failed = checks.errors(df, "row", rules)
    assert got(failed.select("row_id", "qc_id")) == [(1, 1), (1, 2), (1, 3), (1, 5), (2, 2), (2, 3), (2, 5), (3, 2), (3, 4), (3, 5), (4, 5)]
    assert got(checks.passed(df, "row", failed).select("row")) == [(4,)]
    with pytest.raises(ValueError):
        checks.errors(df, "row", [Check(9, "referential", "v")])


def test_zip_lists_cut_to_the_shortest(spark):
    df = spark.createDataFrame([(1, "a|b|c", "x|"), (2, None, "y"), (3, "", "")], "k int, p string, q string")
    assert got(multi.zip_lists(df, {"p": "a", "q": "b"})) == [(1, "a", "x"), (1, "b", ""), (3, "", "")]


def test_metrics(spark):
    row = spark.range(1).select(
        metrics.share(F.lit(1), F.lit(0)).alias("a"), metrics.rate(F.lit(0), F.lit(None).cast("double")).alias("b"), metrics.clamp(F.lit(-3.0)).alias("c"), metrics.clamp(F.lit(300.0), 100.0).alias("d"),
        metrics.entropy([F.lit(0.0), F.lit(0.0)], 2).alias("e"), metrics.entropy([F.lit(1.0), F.lit(1.0)], 2).alias("f"), metrics.largest({"x": F.lit(2.0), "y": F.lit(2.0)}).alias("g")).first()
    assert tuple(row) == (None, 0.0, 0.0, 100.0, None, 1.0, "x")
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 1.0)], "k int, t int, v double")
    assert [round(r["b"], 4) for r in metrics.decayed(df, ["k"], "t", "v", "b").orderBy("t").collect()] == [1.0, 1.4017]


def test_text_helpers(spark):
    row = spark.range(1).select(
        keys.null_if_in(F.lit(" N/A ")).alias("a"), keys.ascii_fold(F.lit("Müßig Ñandú ☃")).alias("b"), keys.squeeze(F.lit("  a \t b ")).alias("c"), multi.distinct_tokens(F.lit("A-b|ab|C|c.")).alias("d"), multi.sorted_tokens(F.lit("b; a,c||")).alias("e"),
        keys.replace_words(F.lit("st of x"), {"st": "street"}).alias("f"), keys.initials(F.lit(" ada  b lovelace")).alias("g")).first()
    assert tuple(row) == (None, "Mussig Nandu ", "a b", "A-b|C", "a|b|c", "street of x", "ABL")
    s = spark.range(1).select(mapping.sections(F.lit("Inclusion: old age\nExclusion: none Withdrawal x"), "inclusion:", "exclusion:", "withdrawal").alias("s")).first()["s"]
    assert tuple(s) == ("old age", "none")


def test_clusters(spark, tmp_path):
    nodes = spark.createDataFrame([(k,) for k in range(1, 9)], "id int")
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (6, 7)], "left int, right int")
    assert got(resolve.clusters(nodes, links, lambda k: str(tmp_path / str(k)))) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 6), (7, 6), (8, 8)]


def test_files(spark, tmp_path):
    assert files.same_header(["A b", "c_"], ["ab", "C"]) and not files.same_header(["a"], ["b"])
    assert files.file_name_matches("trial_20240131.csv", "trial_YYYYMMDD.csv") and not files.file_name_matches("trial_2024.csv", "trial_YYYYMMDD.csv")
    assert files.render("a $$b", {"b": "c"}) == "a c" and files.snake_case("IsoCode two") == "iso_code_two"
    with pytest.raises(ValueError):
        files.render("$$x", {})
    (tmp_path / "a.json").write_text('[{"x": 1, "y": {"z": ["p", "q"]}}]')
    assert files.read_json(spark, str(tmp_path / "a.json"), str(tmp_path / "a.json")).select("x", F.col("y.z")[1]).first()[1] == "q"
    (tmp_path / "a.xml").write_text("<r><e><n>1</n></e><e><n>2</n></e></r>")
    assert files.read_xml(spark, [str(tmp_path / "a.xml")], "e").count() == 2
    df = spark.createDataFrame([("1", "31/01/2024"), ("x", "bad")], "a string, b string")
    assert [tuple(map(str, r)) for r in files.convert(df, [("a", "int", None), ("b", "date", "dd/MM/yyyy")]).collect()] == [("1", "2024-01-31"), ("None", "None")]
    files.export_csv(df, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_ordered_ids_are_dense(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "v string")
    assert got(windows.ordered_ids(df, "v", "n")) == [("a", 1), ("a", 1), ("b", 2), ("c", 3)]


def plain_jaro(a, b):
    if not a and not b:
        return 1.0
    reach, used, met = max(0, max(len(a), len(b)) // 2 - 1), [], []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if b[j] == x and j not in used), None)
        if j is not None:
            used.append(j)
            met.append(i)
    k = len(met)
    moved = sum(a[i] != b[j] for i, j in zip(met, sorted(used))) // 2
    return (k / len(a) + k / len(b) + (k - moved) / k) / 3 if k else 0.0


def test_name_scores(spark):
    pairs = [("martha", "marhta"), ("dwayne", "duane"), ("", ""), ("a", ""), ("abc", "xyz"), ("dixon", "dicksonx"), ("aab", "aba")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [round(r[0], 9) for r in df.select(resolve.jaro(F.col("a"), F.col("b"))).collect()] == [round(plain_jaro(a, b), 9) for a, b in pairs]
    row = spark.range(1).select(
        resolve.jaro(F.lit(None).cast("string"), F.lit("a")), resolve.token_set(F.lit("Main Street 5"), F.lit("5, main street, Rome")), resolve.token_set(F.lit("a b"), F.lit("c d")) < 0.7,
        resolve.name_score(F.lit("Ana Maria Sol"), F.lit("sol, ana maria")), resolve.address_score(F.lit("Long Lane 3"), F.lit("long lane 7 b"))).first()
    assert tuple(row) == (None, 1.0, True, 0.95, 1.0)


def test_unique_check_keeps_one_row_of_each_whole_key(spark):
    df = spark.createDataFrame([(1, "A", "x"), (2, "A", "x"), (3, "B", "x"), (4, "B", "x"), (5, None, "x"), (6, None, "x"), (7, "", "x")], "id int, a string, b string")
    found = checks.errors(df, "id", [checks.Check(1, "unique", "a,b", criticality="C")])
    assert sorted(r["row_id"] for r in checks.survivors(found, 1).collect()) == [1, 3, 5]
    with pytest.raises(ValueError):
        checks.errors(df, "id", [checks.Check(2, "Referential Integrity", "a")])
    assert checks.errors(df, "id", []).count() == 0


def test_decay_over_thousands_of_days(spark):
    rows, want, b, before = [], [], 0.0, None
    for k, (t, v) in enumerate([(0, 1.0), (1, 2.0), (400, 0.0), (401, 3.0), (800, 1.0), (801, 1.0), (2500, 5.0), (2500.5, 0.0)]):
        b = v + (b * math.exp(-0.912 * (t - before)) if before is not None else 0.0)
        before = t
        rows.append((1, float(t), v))
        want.append(b)
    made = metrics.decayed(spark.createDataFrame(rows, "k int, t double, v double"), ["k"], "t", "v", "b").orderBy("t").collect()
    assert all(math.isclose(r["b"], w, rel_tol=1e-9, abs_tol=1e-12) for r, w in zip(made, want))


def test_recruitment_counts_to_today_only_where_told(spark):
    given = [("Ongoing", None, 0.6, 0.1), ("ongoing", None, 0.4, 0.6), ("ongoing", None, 0.5, 0.9), ("ongoing", None, 0.4, 0.4), ("ongoing", "2020-03-01", 0.4, 0.4), ("completed", None, 0.9, 0.9), ("completed", "2020-03-01", None, None), ("planned", "2020-03-01", 0.9, 0.9)]
    df = spark.createDataFrame(given, "s string, z string, p double, e double").withColumn("z", F.to_date("z"))
    made = metrics.recruitment_months(F.col("s"), F.lit("2020-01-01").cast("date"), F.col("z"), F.lit("2020-01-31").cast("date"), F.col("p"), F.col("e"), ("ongoing",), ("completed",))
    assert [None if r[0] is None else round(r[0] * 30.4) for r in df.select(made).collect()] == [30, 30, None, None, 60, None, 60, None]
