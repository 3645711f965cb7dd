"""Fixture views over the TPC-H-style test tables (see FIXTURES.md).

They map orders/lineitem/part/customer/nation onto invoice lines so that
every operator runs on the full given tables. ``sales`` is the clean
dashboard table, ``activity`` gives real times of day, ``raw_sales`` makes
dirty text columns by fixed key arithmetic (no row is removed by it) and
``basket_source`` feeds the miner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the customer's country; built before touching lineitem so
    the line-sized side is shuffled once (by order key)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return orders.join(cn, orders.o_custkey == cn.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "n_name")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    # lines x orders: both sides grow with the data, so this is a shuffle
    # (sort-merge) join on the order key at any size; the part and nation
    # dimensions are left to the size-checked auto-broadcast / AQE.
    return (li.join(_order_dims(spark, sf_dir).hint("merge"), li.l_orderkey == F.col("o_orderkey"))
              .join(part, li.l_partkey == part.p_partkey))


def calendar(ts) -> list:
    return [
        F.year(ts).alias("Year"), F.month(ts).alias("Month"), F.dayofmonth(ts).alias("Day"),
        F.hour(ts).alias("Hour"), F.weekday(ts).alias("DayOfWeek"),
    ]


def sales(spark: SparkSession, sf_dir: str, null_customers: bool = False) -> DataFrame:
    """Clean sales lines (schema of SURVEY 1.1)."""
    cust = F.col("o_custkey")
    if null_customers:
        cust = F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).otherwise(cust)
    d = F.col("o_orderdate")
    return _lines(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("p_brand").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("long").alias("Quantity"),
        d.alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("TotalValue"),
        cust.alias("CustomerID"),
        F.col("n_name").alias("Country"),
        *calendar(d),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as invoice lines with real times of day (µs precision)."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.col("event_type").alias("StockCode"),
        ts.alias("InvoiceDate"),
        F.col("value").alias("TotalValue"),
        F.col("user_id").alias("CustomerID"),
        F.col("event_type").alias("Country"),
        *calendar(ts),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines, all text, with malformed values (FIXTURES.md 3)."""
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("long").cast("string")
    quantity = (F.when(ok % 97 == 0, F.lit("bad"))
                 .when(ok % 101 == 1, F.lit("NaN")).when(ok % 103 == 1, F.lit("Infinity"))
                 .when(ok % 107 == 1, F.lit("1e12")).when(ok % 109 == 1, F.lit("1d"))
                 .when(ok % 113 == 1, F.concat(qty, F.lit(".5")))
                 .when(ok % 31 == 0, F.concat(F.lit("-"), qty))
                 .when(ok % 29 == 0, F.lit("0"))
                 .otherwise(qty))
    date_text = (F.when(ok % 89 == 0, F.lit("not a date"))
                  .when(ok % 91 == 1, F.date_format("o_orderdate", "M/d/yyyy H:mm"))
                  .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    price = (F.when(pk % 83 == 0, F.lit("n/a")).when(pk % 7 == 1, F.lit("0.004"))
              .otherwise(F.col("p_retailprice").cast("string")))
    code = F.when(ln % 2 == 0, F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" "))).otherwise(F.col("p_brand"))
    m11 = (ok + ln) % 11
    desc = (F.when((F.col("p_brand") == "Brand#13") | (m11 == 0), F.lit(None).cast("string"))
             .when(m11 == 1, F.lit(""))
             .when(pk % 5 == 0, F.concat(F.col("p_name"), F.lit("'S"))).when(pk % 5 == 1, F.concat(F.col("p_name"), F.lit(" 'A' 6\"")))
             .otherwise(F.col("p_name")))
    cust = F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast("string")).otherwise(
        F.col("o_custkey").cast("string"))
    return _lines(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        code.alias("StockCode"),
        desc.alias("Description"),
        quantity.alias("Quantity"),
        date_text.alias("InvoiceDate"),
        price.alias("UnitPrice"),
        cust.alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


# Lines of :func:`raw_text` that are no record: order number modulo 53.
SHORT, LONG, UNCLOSED = 1, 2, 3


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines as CSV text (``value``), those of some orders replaced by
    lines with too few fields, too many, or a quote that is never closed."""
    raw = raw_sales(spark, sf_dir)
    as_is = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    kind = F.col("InvoiceNo").cast("long") % 53
    line = (F.when(kind == SHORT, F.concat("InvoiceNo", F.lit(",too,short")))
             .when(kind == LONG, F.concat("InvoiceNo", F.lit(",a,b,1,2010-12-01,1.5,c,d,too long")))
             .when(kind == UNCLOSED, F.concat(F.lit('"'), "InvoiceNo", F.lit(",a,b,1,2010-12-01,1.5,c,d")))
             .otherwise(F.to_csv(F.struct(*raw.columns), as_is)))
    return raw.select(line.alias("value"))


def basket_source(spark: SparkSession, sf_dir: str, item: str = "p_type") -> DataFrame:
    """Distinct (InvoiceNo, item, Quantity) lines for the miner."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    item_col = F.col("l_partkey").cast("string") if item == "l_partkey" else F.col(item)
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select(F.col("l_orderkey").cast("string").alias("InvoiceNo"),
                      item_col.alias("StockCode"),
                      F.col("l_quantity").alias("Quantity"))
              .distinct())
