from decimal import Decimal

from pyspark.sql import functions as F

from newsledger.functions import reports as R
from newsledger.operators import reports


def test_lines(spark):
    rows = [(1, "T", "N", "x" * 60, None), (2, None, "N", None, "c"), (3, None, None, None, None), (4, "T", None, "y" * 400, None)]
    df = spark.createDataFrame(rows, "i int, title string, name string, summary string, content string")
    got = {}
    for r in reports.report_line_rows(df, ["i"]).orderBy("i", "line_no").collect():
        got.setdefault(r.i, []).append(r.line)
    text = "【T】: " + "x" * 60
    assert got[1] == [text[:60], text[60:]] and got[2] == ["【N】: c"]
    assert got[3][0].startswith("【未具名項目】: {") and len(got[4]) == 5 and all(len(x) == 60 for x in got[4])
    empty = spark.createDataFrame([("",)], "t string").select(R.report_lines(F.col("t")).alias("l")).first()
    assert empty.l == []


def test_widths(spark):
    df = spark.createDataFrame([("ab", None), ("a" * 70, None)], "name string, long_column string")
    assert {r.column_name: r.width for r in reports.column_widths(df).collect()} == {"name": 50, "long_column": 13}
    nulls = spark.createDataFrame([(None,)], "a string")
    assert reports.column_widths(nulls).first().width == 4
    assert reports.column_widths(nulls.limit(0)).first().width == 3


def test_rows_and_files(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "y")], "a int, c string")
    both = reports.report_rows(a, b)
    assert both.columns == ["a", "b", "c"] and both.count() == 2
    for kind in ("csv", "json", "parquet"):
        assert reports.write_report(both, f"{tmp_path}/{kind}", kind)
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    assert reports.write_report(both.limit(0), f"{tmp_path}/none") is False and not (tmp_path / "none").exists()


def test_templates(spark):
    data = {"name": "N", "k 2": "{{name}}", "none": None}
    rows = [
        ("a.xlsx", "{{ name }}"), ("a.xlsx", "{{name"), ("a.xlsx", "x {{name}}"), ("a.xlsx", "name"), ("a.xlsx", "{{unknown}}"),
        ("a.xlsx", None), ("b.pptx", "{{name}} {{ name }} {{k 2}}{{none}}"), ("b.pptx", "plain"), ("c.txt", "{{name}}"),
    ]
    df = spark.createDataFrame([(i, n, t, data) for i, (n, t) in enumerate(rows)], "i int, n string, t string, d map<string,string>")
    c = [F.col(x) for x in "ntd"]
    got = [r.x for r in df.select("i", R.template_route(*c).alias("x")).orderBy("i").collect()]
    assert got[:6] == ["N", "N", "x {{name}}", "name", "{{unknown}}", None]
    assert got[6] == "N {{ name }} {{name}}None" and got[7:] == ["plain", ""]
    names = spark.createDataFrame([("../../etc/x.xlsx",), ("x",), ("a/",)], "n string")
    assert [r.f for r in names.select(R.template_file(F.col("n")).alias("f")).collect()] == ["x.xlsx", "x", ""]


def test_rows_of_objects(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": {"d": [1]}}', '{"A": true, "b": 7, "day": "2024-01-01"}', None, "[1]", "5", "not json", "{}", '{"k.1 `q` \\"\'": null, "id": 3}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", F.try_parse_json("t").alias("row"))
    found = reports.rows_of_objects(df, "row", keep=("id",))
    assert found.columns == ["id", "A", "a_2", "b", "c", "day", "id_2", "k.1 `q` \"'"]
    rows = [tuple(r) for r in found.orderBy("id").collect()]
    none = (None,) * 7
    assert rows[0] == (0, None, Decimal("1.0"), "x", None, None, None, None)
    assert rows[1] == (1, None, Decimal("2.5"), None, '{"d":[1]}', None, None, None)
    assert rows[2] == (2, True, None, "7", None, "2024-01-01", None, None)
    assert [r[1:] for r in rows[3:8]] == [none] * 5 and rows[8][6:] == (3, None)
    assert reports.rows_of_objects(df.limit(0), "row", keep=("id",)).columns == ["id"]
