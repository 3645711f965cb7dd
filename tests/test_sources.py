"""Sources and sinks: raw CSV ingest, Parquet and rules CSV round trips."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.sources import files as A
from tillroll.sources import testdata as V

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_raw_csv_ingest_cleans_like_the_frame(spark, tmp_path):
    raw = V.raw_sales(spark, SF)
    path = str(tmp_path / "raw_csv")
    raw.write.option("header", True).csv(path)
    back = A.read_raw(spark, path, "csv")
    assert back.schema == A.RAW_SCHEMA
    a, b = C.clean_sales(raw), C.clean_sales(back)
    # CSV has no null/empty distinction for text: compare the pipeline output
    assert a.count() == b.count()
    assert _rows(a.select("InvoiceNo", "Quantity", "TotalValue")) == _rows(b.select("InvoiceNo", "Quantity", "TotalValue"))


def test_sales_parquet_round_trip_keeps_ms_timestamps(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2011, 1, 2, 3, 4, 5, 678000), 1.5)], "InvoiceDate timestamp, TotalValue double")
    path = str(tmp_path / "sales")
    A.write_sales(df, path)
    assert A.read_sales(spark, path).first().InvoiceDate == dt.datetime(2011, 1, 2, 3, 4, 5, 678000)
    import pyarrow.parquet as pq
    import glob
    f = glob.glob(path + "/*.parquet")[0]
    assert "ms" in str(pq.read_schema(f).field("InvoiceDate").type)


def test_partitioned_write_prunes(spark, tmp_path):
    import contextlib
    import io

    from tillroll.operators import filters as FL

    path = str(tmp_path / "by_month")
    A.write_sales(V.sales(spark, SF), path, partition_by=["Year", "Month"])
    back = A.read_sales(spark, path)
    assert back.count() == V.sales(spark, SF).count()
    q = FL.filter_sales(back, ["NATION_1"], "1996-11-20", "1997-02-03")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    filters = next(x for x in buf.getvalue().splitlines() if "PartitionFilters" in x)
    assert "Year" in filters and "Month" in filters
    files = {f.split("Year=")[1].rsplit("/", 1)[0] for f in (r[0] for r in q.select(F.input_file_name()).distinct().collect())}
    assert files <= {"1996/Month=11", "1996/Month=12", "1997/Month=1", "1997/Month=2"}
    want = FL.filter_sales(V.sales(spark, SF).drop("Year", "Month"), ["NATION_1"], "1996-11-20", "1997-02-03")
    assert q.count() == want.count() > 0


def test_pipeline_output_has_ms_timestamps(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "clean")
    A.write_sales(C.clean_sales(V.raw_sales(spark, SF)), path)
    assert "ms" in str(pq.read_schema(glob.glob(path + "/*.parquet")[0]).field("InvoiceDate").type)


def test_cleaning_program_leaves_no_scratch_table(spark, tmp_path):
    from tillroll.plans.cleaning import clean_to_parquet
    from tillroll.session import ensure_checkpoint_dir

    V.raw_sales(spark, SF).write.option("header", True).option("escape", '"').csv(str(tmp_path / "raw"))
    jvm = spark._jvm.org.apache.hadoop.fs
    tables = jvm.Path(ensure_checkpoint_dir(spark) + "/tables")
    names = lambda: {str(s.getPath().getName()) for s in tables.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(tables)}
    summary, _ = clean_to_parquet(spark, str(tmp_path / "raw"), str(tmp_path / "sales"), str(tmp_path / "baskets"), escape='"')
    assert summary.first()["n_rows"] == C.clean_sales(V.raw_sales(spark, SF)).count()
    assert not any(n.startswith("valid_lines") for n in names())


def test_list_text_is_what_python_prints_and_reads_back(spark):
    import ast

    from tillroll.functions.columns import list_repr

    lists = [["a", "b"], [], ["it's"], ['6"'], ["both ' and \""], ["back\\slash", "line\nfeed", "tab\t", "cr\r"], ["A: POPPY'S HOUSE", "B: X"], ["\\'"]]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, x array<string>").withColumn("t", list_repr("x"))
    got = frame.withColumn("back", A.parse_list_text("t")).orderBy("k").collect()
    assert [r["t"] for r in got] == [repr(x) for x in lists]
    assert [r["back"] for r in got] == lists == [ast.literal_eval(r["t"]) for r in got]
    bad = spark.createDataFrame([("['x', oops",), ("no list",), (None,)], "t string").select(A.parse_list_text("t").alias("x")).collect()
    assert [r["x"] for r in bad] == [None, None, None]


def test_rules_csv_round_trip(spark, tmp_path):
    rules = spark.createDataFrame(
        [(["A1", "B2"], ["C3"], 0.75, 12.5, 0.01, ["A1: RED MUG", "B2: DOLLY'S CUP"], ["C3: TEA, GREEN"])],
        "antecedent array<string>, consequent array<string>, confidence double, lift double, support double, "
        "antecedent_with_desc array<string>, consequent_with_desc array<string>")
    path = str(tmp_path / "rules")
    A.write_rules_csv(rules, path)
    assert _rows(A.read_rules_csv(spark, path)) == _rows(rules)


def test_reads_python_list_text(spark, tmp_path):
    path = tmp_path / "legacy.csv"
    path.write_text(
        "antecedent,consequent,confidence,lift,support,antecedent_with_desc,consequent_with_desc\n"
        "\"['X1', 'Y2']\",['Z3'],0.8,20.0,0.01,\"['X1: BLUE JUG', \"\"Y2: SAM'S HAT\"\"]\",['Z3: LAMP']\n")
    r = A.read_rules_csv(spark, str(path)).first()
    assert r.antecedent == ["X1", "Y2"] and r.consequent == ["Z3"]
    assert r.antecedent_with_desc == ["X1: BLUE JUG", "Y2: SAM'S HAT"]
    top = B.top_rules(A.read_rules_csv(spark, str(path)), "lift").first()
    assert top.rule == """['X1: BLUE JUG', "Y2: SAM'S HAT"] → ['Z3: LAMP']"""


def test_profile(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    r = A.profile(df).first()
    assert (r.n_rows, r.n_columns) == (5, 2)
    assert [(r.column, r.type) for r in A.schema_table(df).collect()] == [("id", "bigint"), ("x", "int")]
    assert A.sample_rows(df, 3).count() == 3


def test_mine_and_report_writes_the_four_reports(spark, tmp_path):
    from tillroll.plans.mining import REPORTS, mine_and_report

    lines = C.clean_basket_lines(V.raw_sales(spark, SF))
    summary = mine_and_report(lines, str(tmp_path), ladder=((0.02, 0.1),))
    s = summary.first()
    rules = A.read_rules_csv(spark, str(tmp_path / REPORTS[1]))
    assert rules.count() == s.n_rules > 0
    assert A.read_rules_csv(spark, str(tmp_path / REPORTS[0]), "itemsets").count() == s.n_itemsets
    assert A.read_rules_csv(spark, str(tmp_path / REPORTS[2])).count() == min(20, s.n_rules)
    friendly = spark.read.option("header", True).csv(str(tmp_path / REPORTS[3]))
    assert friendly.columns == ["rule_id", "antecedent_codes", "antecedent_descriptions", "consequent_codes",
                                "consequent_descriptions", "confidence", "lift"]


def test_clean_to_parquet(spark, tmp_path):
    from tillroll.plans.cleaning import clean_to_parquet

    raw_dir = str(tmp_path / "raw")
    V.raw_sales(spark, SF).write.option("header", True).csv(raw_dir)
    summary, days = clean_to_parquet(spark, raw_dir, str(tmp_path / "sales"), str(tmp_path / "basket"),
                                     partition_by=["Year", "Month"])
    s = summary.first()
    assert s.n_rows == C.clean_sales(V.raw_sales(spark, SF)).count()
    assert days.agg(F.sum("n_rows")).first()[0] == s.n_rows
    assert A.read_sales(spark, str(tmp_path / "basket")).filter(F.col("StockCode").rlike(r"\\s|[a-z]")).count() == 0


def test_raw_json_and_parquet_ingest(spark, tmp_path):
    raw = V.raw_sales(spark, SF)
    jpath, ppath = str(tmp_path / "raw_json"), str(tmp_path / "raw_parquet")
    raw.write.json(jpath)
    raw.write.parquet(ppath)
    want = C.clean_sales(raw).count()
    for path, fmt in ((jpath, "json"), (ppath, "parquet")):
        back = A.read_raw(spark, path, fmt)
        assert back.schema == A.RAW_SCHEMA
        assert C.clean_sales(back).count() == want
