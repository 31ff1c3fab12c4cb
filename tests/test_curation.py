"""Rules on small hand-made clusters, the rule runner and workbooks."""

import zipfile

import pytest
from pyspark.sql import functions as F

from goldenloom.operators import curation, mapping, runner
from goldenloom.sources import workbooks

c = F.col


def got(df, *columns):
    return {tuple(r[k] for k in columns) for r in df.collect()}


def test_names_must_agree_inside_a_cluster(spark):
    df = spark.createDataFrame([(1, 7, "a", "b"), (2, 7, "a", "b"), (3, 7, "x", None), (4, 8, "a", "b")], "uid int, k int, f string, l string")
    assert got(curation.keep_consistent(df, "k", ["f", "l"]), "uid", "k") == {(1, "7"), (2, "7"), (3, "unclustered_3"), (4, "unclustered_4")}


def test_swapped_names_with_one_contact_merge(spark):
    rows = [(1, 5, "Ann", "Lee", "1", None), (2, 3, "Lee", "ann", None, "q@b.c"), (3, 9, "Ann", "Lee", "1", "Q@z.org"), (4, 8, "Bo", "Lee", "1", None), (5, None, "Ann", "Lee", "1", None)]
    df = spark.createDataFrame(rows, "uid int, k int, f string, l string, p string, e string")
    assert got(curation.merge_by_contact(df, "k", "f", "l", "p", "e"), "uid", "k") == {(1, 5), (2, 3), (3, 3), (4, 8), (5, None)}


def test_manual_orders_and_ids(spark):
    df = spark.createDataFrame([(u, 1) for u in range(1, 7)], "uid long, k long")
    orders = spark.createDataFrame([(1, "c", "1|2|3"), (2, "d", "3|4")], "nr int, action string, uids string")
    assert got(curation.manual_clusters(df, orders, "k", "uid", 100), "uid", "k") == {(1, 100), (2, 100), (3, 101), (4, 102), (5, 1), (6, 1)}
    scored = spark.createDataFrame([(1, 4, 0.9), (2, 4, 0.8), (3, 4, 0.2), (4, None, 0.9)], "uid long, k long, s double")
    assert got(curation.assign_ids(scored, "k", "s", 0.5, "id", 10), "uid", "id") == {(1, 11), (2, 11), (3, 12), (4, 13)}


def test_bridge_takes_the_last_run_that_has_a_value(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, run int, v string")
    assert got(curation.bridge(df, "k", "run", "v", [1, 2, 3]), "k", "run_1", "run_2", "run_3", "run_latest") == {("a", "x", "y", None, "y"), ("b", "z", None, None, "z")}


def test_names_and_phrases(spark):
    text = "Nordwind {Alpha/Beta {Gamma|Delta/Gamma}}| Suedlicht"
    one = spark.createDataFrame([(text, "", "65")], "t string, lo string, hi string")
    made = one.select(mapping.sponsors(c("t")), mapping.age_phrase(c("lo"), c("hi")), mapping.clean_drug(F.lit("Zinc, 20 mg/kg daily of the 7 B-12"))).first()
    assert list(made) == [["Nordwind", "Alpha", "Beta", "Gamma", "Delta", "Suedlicht"], "upto 65", "Zinc B-12"]


def test_empty_frames(spark):
    e = spark.createDataFrame([], "uid long, k long, f string, l string, s double")
    assert not curation.keep_consistent(e, "k", ["f", "l"]).collect()
    assert not curation.assign_ids(e, "k", "s", 0.5, "id").collect()
    assert not curation.pre_golden(e, "f", "k", "s", "l").collect()


def test_rules_run_in_order_and_batches_move(spark, tmp_path):
    rules = [
        runner.Rule("b", lambda s, t: t["a"].groupBy().agg(F.sum("x").alias("x")), ("a",)),
        runner.Rule("a", lambda s, t: t["raw"].select((c("id") * 2).alias("x")), ("raw",)),
        runner.Rule("off", lambda s, t: t["none"], ("none",), active=False),
    ]
    root = f"file://{tmp_path}"
    for batch in ("001", "002"):
        made, lineage = runner.run_rules(spark, rules, root, batch, {"raw": spark.range(4)})
    assert got(made["b"], "x", "batch_id") == {(12, "002")}
    assert ("b", "uses", "a") in got(lineage.frame(spark), "subject", "predicate", "object")
    batches = lambda: got(spark.read.parquet(f"{root}/a").select(c("batch_id").cast("int").alias("n")), "n")
    assert batches() == {(1,), (2,)}
    assert runner.withdraw(spark, f"{root}/a", "001", f"{root}/away") and batches() == {(2,)}
    assert not runner.withdraw(spark, f"{root}/a", "001", f"{root}/away")
    assert runner.restore(spark, f"{root}/a", "001", f"{root}/away") and batches() == {(1,), (2,)}
    runner.publish(spark.range(1), f"{root}/a", "003", latest=True)
    assert batches() == {(3,)}
    with pytest.raises(ValueError, match="each other"):
        runner.in_order([runner.Rule("p", None, ("q",)), runner.Rule("q", None, ("p",))])


def test_inputs_resolve():
    batches = {"a": ["1", "2"], "b": ["1"]}
    assert runner.resolve_inputs({"a": "full", "b": "latest"}, batches) == {"a": ["1", "2"], "b": ["1"]}
    assert runner.resolve_inputs({"a": "latest"}, batches, {"a": "1"}) == {"a": ["1"]}
    for needs, over in (({"c": "full"}, None), ({"a": "some"}, None), ({"a": "full"}, {"a": "9"})):
        with pytest.raises(ValueError):
            runner.resolve_inputs(needs, batches, over)


def test_checks_all_run_and_critical_ones_raise_together():
    ran = []
    count = lambda name, n: lambda: ran.append(name) or n
    done = runner.check_all({"x": ("C", count("x", 0)), "y": ("N", count("y", 3))})
    assert [(o.name, o.status, o.count) for o in done] == [("x", "PASSED", 0), ("y", "FAILED", 3)]
    with pytest.raises(runner.CriticalFailure, match="p: 2 rows; q: .*zero"):
        runner.check_all({"p": ("C", count("p", 2)), "q": ("C", lambda: 1 // 0), "r": ("C", count("r", 0))})
    assert {"p", "r"} <= set(ran)


def test_workbooks(spark, tmp_path):
    rows = [("1", None, 1.5, 10**17), (" a  b ", "<&>\"'\n\r\t\x01_x0041_", -0.0, None), ("", "é😀", float("nan"), -1), (None, None, None, None), ("2024-01-01", "=1+1", 1e300, 0)]
    df = spark.createDataFrame(rows, "`a b` string, c string, `d.e` double, f long")
    path = f"file://{tmp_path}/x.xlsx"
    workbooks.write_workbook(df, path, 'A "sheet" & more')
    made = workbooks.read_workbook(spark, path, 'A "sheet" & more')
    assert made.columns == df.columns
    text = lambda x: None if x is None else repr(x) if isinstance(x, float) and x == x else str(x)
    assert sorted(map(tuple, made.collect()), key=str) == sorted((tuple(map(text, r)) for r in rows if any(x is not None for x in r)), key=str)
    workbooks.write_workbook(df.limit(0), f"file://{tmp_path}/none.xlsx")
    assert workbooks.read_workbook(spark, f"file://{tmp_path}/none.xlsx").count() == 0
    assert workbooks.read_workbook(spark, f"file://{tmp_path}/*.xlsx").count() == len(rows) - 1


def test_workbooks_of_other_programs(spark, tmp_path):
    """Shared strings in parts, cells and rows left out, a second sheet by name, booleans and formula results."""
    main = workbooks.MAIN
    sheet = (
        '<sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c><c r="D2" t="s"><v>0</v></c></row>'
        '<row r="5"><c r="B5"><f>1+1</f><v>2</v></c><c r="AA5" t="b"><v>1</v></c></row><row><c t="str"><v>x</v></c></row></sheetData>'
    )
    parts = workbooks.PARTS | {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{workbooks.LINKS}"><sheets><sheet name="one" sheetId="1" r:id="rId9"/><sheet name="two" sheetId="2" r:id="rId1"/></sheets></workbook>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><r><t>na</t></r><r><t>me</t></r><rPh><t>no</t></rPh></si><si><t> v </t></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}">{sheet}</worksheet>',
    }
    with zipfile.ZipFile(tmp_path / "o.xlsx", "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    found = list(workbooks.sheet_rows((tmp_path / "o.xlsx").read_bytes(), "two"))
    assert found == [[], ["name", None, " v ", "name"], [], [], [None, "2", *[None] * 24, "true"], ["x"]]
    with pytest.raises(ValueError, match="no sheet"):
        list(workbooks.sheet_rows((tmp_path / "o.xlsx").read_bytes(), "three"))
    assert [workbooks.column_number(workbooks.column_letters(k) + "7") for k in range(2000)] == list(range(2000))


def test_large_workbooks_are_streamed(spark, tmp_path):
    n = 60_000
    df = spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    workbooks.write_workbook(df, f"file://{tmp_path}/l.xlsx")
    made = workbooks.read_workbook(spark, f"file://{tmp_path}/l.xlsx")
    assert made.select(F.col("id").cast("long"), "h").exceptAll(df).count() == 0 and made.count() == n
