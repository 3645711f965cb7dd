"""Mining without a task per item, size guard, bad lines, isolated writes."""

import os
import random
import threading
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.operators import itemsets as I
from tillroll.plans.lineage import Scratch
from tillroll.sources import files as A

SF = "/root/testdata/sf0.001"
LINES = "InvoiceNo string, StockCode string, Quantity int"


def lines_of(spark, sets):
    return spark.createDataFrame([(str(n), i, 1) for n, s in enumerate(sets) for i in s], LINES)


def all_itemsets(sets, least):
    counts = Counter()
    for s in sets:
        for k in range(1, len(s) + 1):
            counts.update(combinations(sorted(s), k))
    return {i: c for i, c in counts.items() if c >= least}


def random_sets(seed, n=250):
    r = random.Random(seed)
    return [{f"i{int(r.expovariate(0.25))}" for _ in range(r.randint(1, 7))} | ({"hot"} if r.random() < 0.4 else set()) for _ in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_projection_finds_what_fp_growth_finds(spark, seed):
    sets = random_sets(seed)
    want = all_itemsets(sets, 0.02 * len(sets))
    got = []
    for cells in (0, 10 ** 9):
        run = B.mine_with_backoff(lines_of(spark, sets), ((0.02, 0.3),), split_cells=cells)
        found = run.itemsets.collect()
        assert {tuple(r["items"]): r["freq"] for r in found} == want and len(found) == len(want)
        got.append(sorted(map(tuple, run.rules.collect())))
        run.close()
    assert got[0] == got[1] and got[0]


def test_rules_are_those_of_spark_ml(spark):
    sets = random_sets(2)
    used = B.baskets(lines_of(spark, sets))
    model = B.fit_fpgrowth(used, 0.02, 0.4)
    ours = I.rules_of(B.frequent_itemsets(model), len(sets), 0.4)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, B.association_rules(model).select(ours.columns).collect()))


def test_one_item_is_worked_on_by_several_tasks(spark):
    """The database of the rarest frequent item, which every basket holds."""
    r = random.Random(3)
    sets = [set(r.sample([f"c{k}" for k in range(40)], 8)) for _ in range(600)]
    sets = [s | {"zz"} for s in sets[:200]] + sets[200:]
    with Scratch(spark) as scratch:
        used = B.baskets(lines_of(spark, sets))
        ranked = I.ranked_items(used, 20, scratch)
        rows = scratch.table(I.ranked_baskets(used, ranked), "rows")
        level = scratch.table(I.extensions(rows, 20).withColumn("next", F.monotonically_increasing_id()), "level")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            dealt = I.projected(rows, level).withColumn("task", F.spark_partition_id())
            tasks = dealt.groupBy("set").agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("rows")).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    large = [t for t in tasks if t["rows"] > 50]
    assert large and all(t["tasks"] == 8 for t in large)  # the session's shuffle partitions


def test_the_rung_comes_from_item_counts(spark, monkeypatch):
    sets = [{"a", f"x{k}"} if k % 5 == 0 else {f"x{k}"} for k in range(100)]
    fits = []
    plain = B.fit_fpgrowth
    monkeypatch.setattr(B, "fit_fpgrowth", lambda b, s, c, n=None: fits.append(s) or plain(b, s, c, n))
    run = B.mine_with_backoff(lines_of(spark, sets), ((0.9, 0.5), (0.5, 0.5), (0.2, 0.4), (0.1, 0.3)))
    assert fits == [0.2] and (run.min_support, run.min_confidence) == (0.2, 0.4)
    assert [tuple(r) for r in run.itemsets.collect()] == [(["a"], 20)]
    run.close()
    run = B.mine_with_backoff(lines_of(spark, sets), ((0.9, 0.5), (0.5, 0.5)))
    assert fits == [0.2] and run.min_support == 0.5 and run.itemsets.count() == 0 and run.rules.count() == 0
    assert B.mining_summary(run).first().asDict() == {"n_baskets": 100, "n_used": 100, "n_itemsets": 0, "n_rules": 0, "min_support": 0.5, "min_confidence": 0.5}
    run.close()


@pytest.mark.parametrize("placeholder", ["none", None])
def test_a_placeholder_invoice_never_becomes_a_set(spark, placeholder):
    sets = [{f"i{k % 7}", f"i{k % 5}", "a"} for k in range(60)]
    rows = [(str(n), i, 1) for n, s in enumerate(sets) for i in s] + [(placeholder, f"p{k}", 1) for k in range(90)] * 2
    lines = spark.createDataFrame(rows, LINES)
    kept = B.baskets(lines, max_items=3)
    want = sorted(tuple(r) for r in B.baskets(lines).filter("basket_size <= 3").collect())
    assert sorted(map(tuple, kept.collect())) == want and len(want) == 60
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("LeftAnti")  # the join is below the collecting
    run = B.mine_with_backoff(lines, ((0.1, 0.5),), max_items=3)
    assert run.limits.first().asDict() == {"n_baskets": 61, "n_kept": 60, "n_dropped": 1, "n_null": 0}
    assert run.baskets.agg(F.max("basket_size")).first()[0] == 3
    run.close()


# ---- bad lines ------------------------------------------------------------------

GOOD = '536365,85123A,"HOLDER, ""T-LIGHT""",6,12/1/2010 8:26,2.55,17850,United Kingdom'
BAD = ["536366,22633,SHORT", "536367,a,b,1,12/1/2010 8:26,1.5,c,d,more", '"536368,22745,never closed,6,12/1/2010 8:34,2.1,13047,UK', ",,", "x"]


def written(tmp_path, name, rows):
    path = tmp_path / name
    path.write_text("\n".join(["InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country", *rows]) + "\n")
    return str(path)


def test_bad_lines_are_told_apart_and_counted(spark, tmp_path):
    raw = A.read_raw(spark, written(tmp_path, "raw.csv", [GOOD, *BAD, GOOD.replace("6,12/1/2010 8:26", "x,never")]), bad_line=A.BAD_LINE, escape='"')
    counts = C.dropped_counts(raw, bad_line=A.BAD_LINE).first().asDict()
    assert counts == {"n_rows": 7, "n_malformed": 5, "n_no_date": 1, "n_no_number": 0, "n_negative": 0, "n_kept": 1}
    # A query that needs few columns must not take short lines for records.
    assert len(raw.filter(F.col(A.BAD_LINE).isNull()).select("InvoiceNo").collect()) == 2
    records, bad = A.split_bad_lines(raw.persist())
    assert sorted(r[0] for r in bad.collect()) == sorted(BAD)
    assert [r["Description"] for r in records.collect()] == ['HOLDER, "T-LIGHT"'] * 2 and A.BAD_LINE not in records.columns
    raw.unpersist()
    # Without the column the reader pads them, as before.
    assert A.read_raw(spark, str(tmp_path / "raw.csv"), escape='"').count() == 7


def test_bad_json_and_typed_sources(spark, tmp_path):
    (tmp_path / "raw.json").write_text('{"InvoiceNo": "1", "StockCode": "A"}\n{"InvoiceNo": \nnot json\n')
    raw = A.read_raw(spark, str(tmp_path / "raw.json"), "json", bad_line="_oops").persist()
    records, bad = A.split_bad_lines(raw, "_oops")
    assert records.count() == 1 and sorted(r[0] for r in bad.collect()) == ['not json', '{"InvoiceNo": ']
    raw.unpersist()
    records.write.parquet(str(tmp_path / "typed"))
    again = A.read_raw(spark, str(tmp_path / "typed"), "parquet", bad_line="_oops")
    assert again.columns[-1] == "_oops" and A.split_bad_lines(again, "_oops")[0].count() == 1


def test_the_cleaning_program_reports_bad_lines(spark, tmp_path):
    from tillroll.plans.cleaning import clean_to_parquet

    path = written(tmp_path, "raw.csv", [GOOD, *BAD])
    out = {}
    for report in (None, str(tmp_path / "report")):
        summary, _ = clean_to_parquet(spark, path, str(tmp_path / f"sales{report is None}"), report_path=report, escape='"')
        out[report is None] = summary.first()["n_rows"]
    assert out == {True: 1, False: 1}
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "report/bad_lines")).collect()) == sorted(BAD)
    assert spark.read.parquet(str(tmp_path / "report/dropped_counts")).first()["n_malformed"] == 5


# ---- friendly report -------------------------------------------------------------

def test_a_friendly_report_reads_back(spark, tmp_path):
    rules = spark.createDataFrame([(3, ["22697", "22698"], ['GREEN "TEA" CUP', "PINK, CUP "], ["9"], ["x; y"], 0.9, 33.5), (7, ["1"], [""], ["2"], ["two"], 0.5, 1.0)],
                                  "rule_id long, antecedent array<string>, antecedent_names array<string>, consequent array<string>, consequent_names array<string>, confidence double, lift double")
    A.write_rules_csv(A.friendly_text(rules), str(tmp_path / "friendly"))
    got = sorted(map(tuple, A.read_friendly_rules(spark, str(tmp_path / "friendly")).collect()))
    # A name that holds the separator leaves more parts than codes.
    assert got == [(3, ["22697", "22698"], ['GREEN "TEA" CUP', "PINK, CUP "], ["9"], None, 0.9, 33.5), (7, ["1"], [""], ["2"], ["two"], 0.5, 1.0)]


def test_a_friendly_report_under_other_headers(spark, tmp_path):
    (tmp_path / "shown.csv").write_text('Rule #,If bought,Names,Then,Name,Conf.,Lift\n26,"22698, 22699",PINK CUP; ROSES CUP ,22697,GREEN CUP,0.9,33.7\n')
    got = A.read_friendly_rules(spark, str(tmp_path / "shown.csv")).first()
    assert tuple(got) == (26, ["22698", "22699"], ["PINK CUP", "ROSES CUP "], ["22697"], ["GREEN CUP"], 0.9, 33.7)


# ---- isolated write --------------------------------------------------------------

def timestamp_units(path):
    import glob

    import pyarrow.parquet as pq

    return {pq.read_schema(f).field("InvoiceDate").type.unit for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_two_writers_of_one_session(spark, tmp_path):
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    df = spark.range(0, 2000, 1, 8).selectExpr("timestamp_micros(1291191960123456 + id) AS InvoiceDate", "id", "2010 AS Year", "CAST(id % 3 AS INT) AS Month")
    errors = []

    def run(write):
        try:
            write()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    try:
        jobs = [threading.Thread(target=run, args=(w,)) for n in range(4) for w in (
            lambda n=n: A.write_sales(df, str(tmp_path / f"ms{n}"), partition_by=["Year", "Month"]),
            lambda n=n: df.write.parquet(str(tmp_path / f"us{n}")))]
        [j.start() for j in jobs]
        [j.join() for j in jobs]
        assert not errors and spark.conf.get(key) == "TIMESTAMP_MICROS"
        for n in range(4):
            assert timestamp_units(tmp_path / f"ms{n}") == {"ms"} and timestamp_units(tmp_path / f"us{n}") == {"us"}
            assert A.read_sales(spark, str(tmp_path / f"ms{n}")).count() == 2000
        assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("apart_")]
    finally:
        spark.conf.set(key, before)


def test_the_isolated_write_keeps_the_callers_settings(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([("2010-12-01 08:26:00",)], "t string").select(F.col("t").cast("timestamp").alias("InvoiceDate"))
        A.write_sales(df, str(tmp_path / "zoned"))
        assert A.read_sales(spark, str(tmp_path / "zoned")).select(F.col("InvoiceDate").cast("string")).first()[0] == "2010-12-01 08:26:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# ---- terciles of text ids --------------------------------------------------------

def texts(seed):
    r = random.Random(seed)
    parts = ["", "a", "ab", "ab\0", "abcdefg", "abcdefgh", "abcdefg\0", "é", "一", "\U0001f600", "customer-000"]
    return sorted({r.choice(parts) + r.choice(parts) + str(r.randint(0, 400)) * r.randint(0, 3) for _ in range(700)}, key=str.encode)


@pytest.mark.parametrize("seed", [0, 1])
def test_the_kth_text_without_a_sort(spark, seed, monkeypatch):
    from tillroll.plans import ranking

    monkeypatch.setattr(ranking, "global_row_number", None)  # nothing may be sorted
    want = texts(seed)
    df = spark.createDataFrame([(t, 5.0 if k % 9 else float(k)) for k, t in enumerate(want)], "CustomerID string, Monetary double").repartition(4)
    n = len(want)
    for k in (1, 2, n // 3, n // 2, n - 1, n):
        assert ranking.kth_text(df, "CustomerID", k, n) == want[k - 1]
    ordered = sorted(((5.0 if k % 9 else float(k)), t.encode()) for k, t in enumerate(want))
    ks = [1, n // 3, 2 * n // 3, n]
    assert ranking.kth_keys(df, "Monetary", "CustomerID", ks, n) == [(m, t.decode()) for m, t in (ordered[k - 1] for k in ks)]
    same = spark.createDataFrame([("twice",), ("twice",), ("once",)], "CustomerID string")
    assert [ranking.kth_text(same, "CustomerID", k, 3) for k in (1, 2, 3)] == ["once", "twice", "twice"]


def test_scores_of_text_customers_sort_nothing(spark, monkeypatch):
    from tillroll.operators import rfm as R
    from tillroll.plans import ranking
    from tillroll.sources import testdata as V

    sales = V.sales(spark, SF, null_customers=True)
    numbers = {str(r["CustomerID"]).rjust(9): tuple(r)[1:] for r in R.rfm_scores(sales).collect()}
    monkeypatch.setattr(ranking, "global_row_number", None)
    as_text = R.rfm_scores(sales.withColumn("CustomerID", F.lpad(F.col("CustomerID").cast("string"), 9, " ")))
    assert {r["CustomerID"]: tuple(r)[1:] for r in as_text.collect()} == numbers


# ---- layout, footers, sketches ---------------------------------------------------

def test_a_bucketed_table_groups_by_invoice_without_an_exchange(spark, tmp_path):
    from tillroll.operators import overview as K
    from tillroll.sources import testdata as V

    sales = V.sales(spark, SF)
    A.write_sales_bucketed(sales, str(tmp_path / "by_invoice"), "sales_by_invoice_test", 8)
    try:
        table = A.read_sales_table(spark, "sales_by_invoice_test")
        for made, plain in ((K.order_values(table), K.order_values(sales)), (B.baskets(table), B.baskets(sales)),
                            (table.groupBy("InvoiceNo").count(), sales.groupBy("InvoiceNo").count())):
            rows = sorted(map(tuple, made.collect()))
            assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
            assert rows == sorted(map(tuple, plain.collect()))
        # The invoices of K1: only the one-row total moves.
        invoices = table.agg(F.countDistinct("InvoiceNo"))
        assert invoices.first()[0] == sales.select("InvoiceNo").distinct().count()
        assert "hashpartitioning" not in invoices._jdf.queryExecution().executedPlan().toString()
        assert timestamp_units(tmp_path / "by_invoice") == {"ms"}
    finally:
        spark.sql("DROP TABLE sales_by_invoice_test")


def test_footers_answer_without_a_data_page(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from tillroll.operators import filters as FL
    from tillroll.sources import testdata as V

    sales = V.sales(spark, SF)
    path = str(tmp_path / "by_month")
    A.write_sales(sales, path, partition_by=["Year", "Month"])
    want = (tuple(A.profile(sales).first()), tuple(FL.date_bounds(sales).first()))
    months = sorted(map(tuple, sales.groupBy("Year", "Month").agg(F.min("Day"), F.max("Day"), F.count(F.lit(1))).collect()))
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        columns = [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns)]
        end = max(min(c.dictionary_page_offset or c.data_page_offset, c.data_page_offset) + c.total_compressed_size for c in columns)
        with open(name, "r+b") as f:  # pages become zeros, the footer stays
            f.seek(4)
            f.write(b"\0" * (end - 4))
    for checksum in glob.glob(f"{path}/**/.*.crc", recursive=True):
        os.unlink(checksum)
    with pytest.raises(Exception):
        A.read_sales(spark, path).agg(F.sum("Quantity")).collect()
    assert (tuple(A.footer_profile(spark, path).first()), tuple(A.footer_bounds(spark, path).first())) == want
    assert sorted(map(tuple, A.footer_months(spark, path).collect())) == months
    A.write_sales(sales.limit(0), str(tmp_path / "none"))
    assert A.footer_profile(spark, str(tmp_path / "none")).first()["n_rows"] == 0


def test_sketches_roll_up_within_their_error(spark):
    from tillroll.operators import sketches as S

    lines = spark.range(0, 60_000, 1, 6).select(
        F.concat(F.lit("o"), (F.col("id") / 2).cast("long").cast("string")).alias("InvoiceNo"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 9_000).alias("CustomerID"), (F.col("id") % 100 / 100).alias("TotalValue"),
        (F.col("id") % 5).cast("string").alias("Country"), F.lit(2011).alias("Year"), (F.col("id") % 12).cast("int").alias("Month"))
    fine = S.sketched(lines, ["Country", "Year", "Month"])
    with Scratch(spark) as scratch:
        stored = scratch.table(fine, "sketches")
        assert stored.count() == 60
        for keys in ([], ["Country"], ["Year", "Month"]):
            exact = {tuple(r[k] for k in keys): r for r in lines.groupBy(*keys).agg(
                F.countDistinct("InvoiceNo").alias("o"), F.countDistinct("CustomerID").alias("c"), F.count(F.lit(1)).alias("n"),
                F.sum(F.col("TotalValue").cast("decimal(28,6)")).cast("double").alias("v")).collect()}
            got = S.estimated(S.rolled_up(stored, keys)).collect()
            assert len(got) == len(exact)
            for r in got:
                e = exact[tuple(r[k] for k in keys)]
                assert r["n_lines"] == e["n"] and r["Revenue"] == e["v"]
                assert abs(r["Orders"] - e["o"]) <= 0.05 * e["o"] and abs(r["Customers"] - e["c"]) <= 0.05 * e["c"]
        assert S.estimated(S.sketched(lines.limit(0), ["Country"])).count() == 0


# ---- the entry point ---------------------------------------------------------------

def test_a_missing_module_of_the_optional_part_leaves_the_rest(tmp_path):
    """Without ``tiktoken``, or without the subpackage, the other queries register."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for blocked in ("tiktoken", "public_tokenizers", "tillroll.llm"):
        code = (f"import sys; sys.path.insert(0, {root!r}); sys.modules[{blocked!r}] = None\n"
                "import __spark_entry__ as e\nnames = set(e.queries())\n"
                "assert 'kpis' in names and not any(n.startswith('op') and n[2:3].isdigit() for n in names) and 'pipeline' not in names\n"
                "assert set(e.oracle_sql()) <= names")
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        assert "training-data queries left out" in done.stderr
