"""DuckDB SQL equal to each registered query (the correctness oracle).

The fixture views are written as CTEs over the pre-registered tables.
Money is summed as plain decimals; arrays are rendered as text
the same way as :func:`tillroll.plans.registry.flat`.
"""

from __future__ import annotations

from tillroll.functions.columns import MONTH_NAMES, NO_DESCRIPTION, UNKNOWN_PRODUCT, WEEKDAY_NAMES
from tillroll.plans import registry as Q
from tillroll.sources import testdata as V


def _list_lit(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


WEEKDAY = _list_lit(WEEKDAY_NAMES)
MONTHS = _list_lit(MONTH_NAMES)
NO_DESC = NO_DESCRIPTION.replace("'", "''")


def money(expr: str) -> str:
    return f"CAST(CAST(SUM(CAST({expr} AS DECIMAL(28, 6))) AS VARCHAR) AS DOUBLE)"


def month_year(y="Year", m="Month") -> str:
    return f"({MONTHS}[{m}] || ' ' || CAST({y} AS VARCHAR))"


def list_repr(arr: str) -> str:
    shown = "replace(replace(replace(replace(x, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
    item = (f"CASE WHEN contains(x, chr(39)) AND NOT contains(x, chr(34)) THEN chr(34) || {shown} || chr(34) "
            f"ELSE chr(39) || replace({shown}, chr(39), chr(92) || chr(39)) || chr(39) END")
    return f"('[' || array_to_string(list_transform({arr}, lambda x: {item}), ', ') || ']')"


def codes(arr: str) -> str:
    return f"array_to_string({arr}, ', ')"


def _calendar(ts: str) -> str:
    return (f"CAST(year({ts}) AS INTEGER) AS Year, CAST(month({ts}) AS INTEGER) AS Month, "
            f"CAST(day({ts}) AS INTEGER) AS Day, CAST(hour({ts}) AS INTEGER) AS Hour, "
            f"CAST(isodow({ts}) - 1 AS INTEGER) AS DayOfWeek")


_LINES = """lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN part ON l_partkey = p_partkey"""


def sales_cte(null_customers: bool = False, name: str = "sales") -> str:
    cust = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END" if null_customers else "o_custkey"
    return f"""{name} AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNo, p_brand AS StockCode, p_name AS Description,
         CAST(l_quantity AS BIGINT) AS Quantity, o_orderdate AS InvoiceDate, p_retailprice AS UnitPrice,
         l_quantity * p_retailprice AS TotalValue, {cust} AS CustomerID, n_name AS Country,
         {_calendar('o_orderdate')}
  FROM {_LINES})"""


ACTIVITY = f"""activity AS (
  SELECT CAST(event_id AS VARCHAR) AS InvoiceNo, event_type AS StockCode, ts AS InvoiceDate,
         value AS TotalValue, user_id AS CustomerID, event_type AS Country, {_calendar('ts')}
  FROM events)"""

RAW = f"""raw_sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNo,
         CASE WHEN l_linenumber % 2 = 0 THEN ' ' || lower(p_brand) || ' ' ELSE p_brand END AS StockCode,
         CASE WHEN p_brand = 'Brand#13' OR (l_orderkey + l_linenumber) % 11 = 0 THEN NULL
              WHEN (l_orderkey + l_linenumber) % 11 = 1 THEN ''
              WHEN l_partkey % 5 = 0 THEN p_name || '''S' WHEN l_partkey % 5 = 1 THEN p_name || ' ''A'' 6"'
              ELSE p_name END AS Description,
         CASE WHEN l_orderkey % 97 = 0 THEN 'bad'
              WHEN l_orderkey % 101 = 1 THEN 'NaN' WHEN l_orderkey % 103 = 1 THEN 'Infinity'
              WHEN l_orderkey % 107 = 1 THEN '1e12' WHEN l_orderkey % 109 = 1 THEN '1d'
              WHEN l_orderkey % 113 = 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5'
              WHEN l_orderkey % 31 = 0 THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
              WHEN l_orderkey % 29 = 0 THEN '0'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS Quantity,
         CASE WHEN l_orderkey % 89 = 0 THEN 'not a date'
              WHEN l_orderkey % 91 = 1 THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
         CASE WHEN l_partkey % 83 = 0 THEN 'n/a' WHEN l_partkey % 7 = 1 THEN '0.004' ELSE CAST(p_retailprice AS VARCHAR) END AS UnitPrice,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
         n_name AS Country
  FROM {_LINES})"""

# Lines of these orders are replaced by lines that are no record.
BAD_ORDER = f"CAST(InvoiceNo AS BIGINT) % 53 IN ({V.SHORT}, {V.LONG}, {V.UNCLOSED})"
RAW_ALL = RAW.replace("raw_sales AS (", "raw_all AS (", 1)
RECORDS = f"{RAW_ALL},\nraw_sales AS (SELECT * FROM raw_all WHERE NOT {BAD_ORDER})"

DATED = "COALESCE(TRY_CAST(InvoiceDate AS TIMESTAMP), try_strptime(InvoiceDate, '%m/%d/%Y %H:%M'))"
PARSED_DATES = f"""parsed AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, {DATED} AS InvoiceDate,
         UnitPrice, CustomerID, Country FROM raw_sales WHERE {DATED} IS NOT NULL)"""


def number(col: str) -> str:
    """A text as finite number, else null."""
    return f"CASE WHEN isfinite(TRY_CAST({col} AS DOUBLE)) AND NOT regexp_matches({col}, '[a-df-zA-DF-Z]') THEN TRY_CAST({col} AS DOUBLE) END"


NUMERIC = f"""numeric AS (
  SELECT InvoiceNo, StockCode, Description, {number('Quantity')} AS Quantity,
         InvoiceDate, {number('UnitPrice')} AS UnitPrice, CustomerID, Country
  FROM parsed WHERE {number('Quantity')} IS NOT NULL AND {number('UnitPrice')} IS NOT NULL)"""

VALID = """valid AS (SELECT * FROM numeric WHERE Quantity >= 0 AND UnitPrice >= 0)"""

VALID_CHAIN = ",\n".join([RAW, PARSED_DATES, NUMERIC, VALID])


def modal_ctes(src: str, prefix: str = "") -> str:
    return f"""{prefix}counts AS (
  SELECT StockCode, Description, COUNT(*) AS n_lines FROM {src}
  WHERE Description IS NOT NULL AND Description <> '' GROUP BY StockCode, Description),
{prefix}modal AS (
  SELECT StockCode, Description FROM (
    SELECT StockCode, Description,
           row_number() OVER (PARTITION BY StockCode ORDER BY n_lines DESC, Description) AS rn
    FROM {prefix}counts) WHERE rn = 1)"""


def standardized(src: str, prefix: str = "") -> str:
    return f"""SELECT v.InvoiceNo, v.StockCode, COALESCE(m.Description, '{UNKNOWN_PRODUCT}') AS Description,
         v.Quantity, v.InvoiceDate, v.UnitPrice, v.CustomerID, v.Country
  FROM {src} v LEFT JOIN {prefix}modal m ON v.StockCode = m.StockCode"""


CLEAN_SALES = f"""{VALID_CHAIN},
{modal_ctes('valid')},
std AS ({standardized('valid')}),
clean_sales AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, date_trunc('millisecond', InvoiceDate) AS InvoiceDate,
         UnitPrice, CustomerID, Country, Quantity * UnitPrice AS TotalValue,
         {_calendar("date_trunc('millisecond', InvoiceDate)")}
  FROM std)"""

CLEAN_BASKET = f"""{VALID_CHAIN},
bnorm AS (SELECT InvoiceNo, upper(regexp_replace(StockCode, '\\s+', '', 'g')) AS StockCode, Description, Quantity,
                 InvoiceDate, UnitPrice, CustomerID, Country FROM valid),
{modal_ctes('bnorm', 'b')},
bstd AS ({standardized('bnorm', 'b')}),
clean_basket_lines AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, date_trunc('millisecond', InvoiceDate) AS InvoiceDate,
         UnitPrice, CustomerID, Country FROM bstd)"""


def basket_source_cte(item: str) -> str:
    col = "CAST(l_partkey AS VARCHAR)" if item == "l_partkey" else item
    return f"""basket_source AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, {col} AS StockCode, l_quantity AS Quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def baskets_cte(src: str) -> str:
    return f"""bk_all AS (
  SELECT InvoiceNo, list_sort(list_distinct(list(StockCode))) AS items
  FROM {src} WHERE Quantity > 0 AND StockCode IS NOT NULL GROUP BY InvoiceNo)"""


def miner_ctes(min_support: float, max_items: int, tag: str = "") -> str:
    """Level-wise frequent itemsets (recursive). ``occ`` holds one row per
    (frequent itemset, basket containing it); an itemset of k+1 items extends
    a frequent k-itemset by a larger item of the same basket and is kept when
    at least ceil(support * baskets) baskets contain it."""
    t = tag
    return f"""bk{t} AS (SELECT row_number() OVER () AS bid, items FROM bk_all WHERE len(items) <= {max_items}),
nb{t} AS (SELECT COUNT(*) AS n, CEIL(CAST({min_support} AS DOUBLE) * COUNT(*)) AS min_count FROM bk{t}),
bi{t} AS (SELECT bid, unnest(items) AS item FROM bk{t}),
f1{t} AS (SELECT item, COUNT(*) AS freq FROM bi{t} GROUP BY item HAVING COUNT(*) >= (SELECT min_count FROM nb{t})),
occ{t}(items, bid) AS (
  SELECT [item], bid FROM bi{t} WHERE item IN (SELECT item FROM f1{t})
  UNION ALL
  SELECT items, bid FROM (
    SELECT list_append(o.items, b.item) AS items, o.bid,
           COUNT(*) OVER (PARTITION BY list_append(o.items, b.item)) AS c
    FROM occ{t} o JOIN bi{t} b ON b.bid = o.bid AND b.item > o.items[-1])
  WHERE c >= (SELECT min_count FROM nb{t})),
fi{t} AS (SELECT items, COUNT(*) AS freq FROM occ{t} GROUP BY items)"""


def rules_ctes(min_confidence: float, tag: str = "") -> str:
    t = tag
    return f"""sx{t} AS (SELECT items, freq, unnest(items) AS item FROM fi{t} WHERE len(items) >= 2),
rules{t} AS (
  SELECT list_filter(sx{t}.items, lambda x: x <> sx{t}.item) AS antecedent, [sx{t}.item] AS consequent,
         CAST(sx{t}.freq AS DOUBLE) / a.freq AS confidence,
         (CAST(sx{t}.freq AS DOUBLE) / a.freq) / (CAST(c.freq AS DOUBLE) / (SELECT n FROM nb{t})) AS lift,
         CAST(sx{t}.freq AS DOUBLE) / (SELECT n FROM nb{t}) AS support
  FROM sx{t} JOIN fi{t} a ON a.items = list_filter(sx{t}.items, lambda x: x <> sx{t}.item)
             JOIN f1{t} c ON c.item = sx{t}.item
  WHERE CAST(sx{t}.freq AS DOUBLE) / a.freq >= {min_confidence})"""


def describe_ctes(src: str, arr: str, out: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""{out}_ex AS (SELECT {k}, unnest({arr}) AS code, generate_subscripts({arr}, 1) AS pos FROM {src}),
{out}_named AS (SELECT e.*, COALESCE(d.Description, '{NO_DESC}') AS name
              FROM {out}_ex e LEFT JOIN dim d ON d.StockCode = e.code),
{out} AS (SELECT {k}, list(name ORDER BY pos) AS {arr}_names,
                 list(code || ': ' || name ORDER BY pos) AS {arr}_with_desc
          FROM {out}_named GROUP BY {k})"""


DIM = """dim AS (SELECT StockCode, MIN(Description) AS Description FROM clean_basket_lines
        WHERE Quantity > 0 AND StockCode IS NOT NULL GROUP BY StockCode)"""

DESCRIBED_SUPPORT, DESCRIBED_CONF = Q.DESCRIBED_LADDER[0]
DESCRIBED = f"""{CLEAN_BASKET},
{DIM},
{baskets_cte('clean_basket_lines')},
{miner_ctes(DESCRIBED_SUPPORT, 30)},
{rules_ctes(DESCRIBED_CONF)},
{describe_ctes('fi', 'items', 'fid', ['items', 'freq'])},
ra AS (SELECT * FROM rules),
{describe_ctes('ra', 'antecedent', 'rad', ['antecedent', 'consequent', 'confidence', 'lift', 'support'])},
{describe_ctes('rad', 'consequent', 'rd', ['antecedent', 'consequent', 'confidence', 'lift', 'support', 'antecedent_names', 'antecedent_with_desc'])}"""

RULES_DESCRIBED_COLS = f"""{codes('antecedent')} AS antecedent, {codes('consequent')} AS consequent,
       confidence, lift, support, {codes('antecedent_names')} AS antecedent_names,
       {list_repr('antecedent_with_desc')} AS antecedent_with_desc,
       {codes('consequent_names')} AS consequent_names, {list_repr('consequent_with_desc')} AS consequent_with_desc"""


def _rule_order(by: str) -> str:
    other = "lift" if by == "confidence" else "confidence"
    return (f"round({by}, 9) DESC, round({other}, 9) DESC, array_to_string(antecedent, ','), "
            f"array_to_string(consequent, ',')")


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


S, SN = sales_cte(), sales_cte(True)

ALL_SALES_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, TotalValue, CustomerID, Country, Year, Month, Day, Hour, DayOfWeek"
RAW_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

ORDER_VALUES = f"ov AS (SELECT InvoiceNo, {money('TotalValue')} AS TotalValue FROM sales GROUP BY InvoiceNo)"
P95 = """p95 AS (
  SELECT TotalValue AS upper_limit FROM (
    SELECT TotalValue, row_number() OVER (ORDER BY TotalValue) AS k, COUNT(*) OVER () AS n FROM ov)
  WHERE k = GREATEST(CEIL(0.95 * n), 1))"""
TRIMMED = "tr AS (SELECT InvoiceNo, ov.TotalValue FROM ov, p95 WHERE ov.TotalValue <= p95.upper_limit)"

MONTHLY_COUNTRY = f"mc AS (SELECT Country, Year, Month, {money('TotalValue')} AS TotalValue FROM sales GROUP BY Country, Year, Month)"
GROWTH = """gr AS (
  SELECT Country, Year, Month, TotalValue, PrevRevenue,
         CASE WHEN PrevRevenue = 0 THEN NULL ELSE (TotalValue - PrevRevenue) / PrevRevenue * 100 END AS GrowthRate
  FROM (SELECT *, lag(TotalValue) OVER (PARTITION BY Country ORDER BY Year, Month) AS PrevRevenue FROM mc))"""

RFM_BASE = f"""cs AS (SELECT * FROM sales WHERE CustomerID IS NOT NULL),
per AS (SELECT CustomerID, max(InvoiceDate) AS last_ts, COUNT(DISTINCT InvoiceNo) AS Frequency,
               {money('TotalValue')} AS Monetary FROM cs GROUP BY CustomerID),
base AS (SELECT CustomerID,
                CAST(date_diff('day', CAST(last_ts AS DATE), CAST((SELECT max(last_ts) FROM per) AS DATE)) AS INTEGER) AS Recency,
                Frequency, Monetary FROM per)"""
_Q1, _Q2 = (float(q) for q in __import__("numpy").true_divide(
    __import__("numpy").linspace(0, 1, 4)[1:3] * 100, 100))


def _lerp_sql(a: str, b: str, t: str) -> str:
    a, b = f"({a})", f"({b})"
    return f"(CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1 - {t}) ELSE {a} + ({b} - {a}) * {t} END)"


RFM_SCORES = f"""vv AS (SELECT n, CAST(n - 1 AS DOUBLE) * CAST('{_Q1!r}' AS DOUBLE) AS v1,
                  CAST(n - 1 AS DOUBLE) * CAST('{_Q2!r}' AS DOUBLE) AS v2 FROM (SELECT COUNT(*) AS n FROM base)),
pos AS (SELECT n,
          CASE WHEN v1 >= n - 1 THEN n - 1 ELSE floor(v1) END AS lo1, CASE WHEN v1 >= n - 1 THEN n - 1 ELSE floor(v1) + 1 END AS hi1,
          CASE WHEN v1 >= n - 1 THEN 0.0 ELSE v1 - floor(v1) END AS t1,
          CASE WHEN v2 >= n - 1 THEN n - 1 ELSE floor(v2) END AS lo2, CASE WHEN v2 >= n - 1 THEN n - 1 ELSE floor(v2) + 1 END AS hi2,
          CASE WHEN v2 >= n - 1 THEN 0.0 ELSE v2 - floor(v2) END AS t2 FROM vv),
rr AS (SELECT Recency, row_number() OVER (ORDER BY Recency) - 1 AS k FROM base),
rv AS (SELECT MAX(CASE WHEN k = lo1 THEN CAST(Recency AS DOUBLE) END) AS a1, MAX(CASE WHEN k = hi1 THEN CAST(Recency AS DOUBLE) END) AS b1,
              MAX(CASE WHEN k = lo2 THEN CAST(Recency AS DOUBLE) END) AS a2, MAX(CASE WHEN k = hi2 THEN CAST(Recency AS DOUBLE) END) AS b2,
              ANY_VALUE(t1) AS t1, ANY_VALUE(t2) AS t2 FROM rr, pos),
cuts AS (SELECT {_lerp_sql('a1', 'b1', 't1')} AS c1, {_lerp_sql('a2', 'b2', 't2')} AS c2,
                (SELECT floor({_lerp_sql('lo1 + 1.0', 'hi1 + 1.0', 't1')}) FROM pos) AS e1,
                (SELECT floor({_lerp_sql('lo2 + 1.0', 'hi2 + 1.0', 't2')}) FROM pos) AS e2 FROM rv),
ranked AS (SELECT b.*, row_number() OVER (ORDER BY Frequency, CustomerID) AS rf,
                  row_number() OVER (ORDER BY Monetary, CustomerID) AS rm FROM base b),
scores AS (
  SELECT CustomerID, Recency, Frequency, Monetary,
         CASE WHEN Recency <= c1 THEN 3 WHEN Recency <= c2 THEN 2 ELSE 1 END AS R_Score,
         CASE WHEN rf <= e1 THEN 1 WHEN rf <= e2 THEN 2 ELSE 3 END AS F_Score,
         CASE WHEN rm <= e1 THEN 1 WHEN rm <= e2 THEN 2 ELSE 3 END AS M_Score
  FROM ranked, cuts),
rfm AS (SELECT *, R_Score + F_Score + M_Score AS RFM_Score FROM scores),
seg AS (SELECT *, CASE WHEN RFM_Score > 0 AND RFM_Score <= 3 THEN 'Low Value'
                       WHEN RFM_Score > 3 AND RFM_Score <= 6 THEN 'Mid Value'
                       WHEN RFM_Score > 6 AND RFM_Score <= 9 THEN 'High Value' END AS Segment FROM rfm)"""

HEAT = "hl AS (SELECT DayOfWeek, Hour, COUNT(DISTINCT InvoiceNo) AS Orders FROM activity GROUP BY DayOfWeek, Hour)"
HEAT_COLS = ", ".join(f"MAX(CASE WHEN hl.Hour = {h} THEN hl.Orders END) AS h{h:02d}" for h in range(24))


def _mined(run, with_rules: float | None = None) -> str:
    item, ladder, max_items = run
    s, _ = ladder[0]
    parts = [basket_source_cte(item), baskets_cte("basket_source"), miner_ctes(s, max_items)]
    if with_rules is not None:
        parts.append(rules_ctes(with_rules))
    return _with(*parts)


def _backoff() -> str:
    item, ladder, max_items = Q.BACKOFF_RUN
    (s1, _), (s2, _) = ladder
    return (_with(basket_source_cte(item), baskets_cte("basket_source"),
                  miner_ctes(s1, max_items, "a"), miner_ctes(s2, max_items, "b"))
            + f"""SELECT {codes('items')} AS items, freq, CAST({s1} AS DOUBLE) AS min_support FROM fia
UNION ALL
SELECT {codes('items')} AS items, freq, CAST({s2} AS DOUBLE) AS min_support FROM fib
WHERE NOT EXISTS (SELECT 1 FROM fia)""")


def _filter_sql() -> dict[str, str]:
    c1 = ", ".join(f"'{c}'" for c in Q.FILTER_COUNTRIES)
    s, e = Q.FILTER_ACTIVITY_DATES
    bc, bs, be = Q.FILTER_BOTH
    c2 = ", ".join(f"'{c}'" for c in bc)
    return {
        "filter_country": _with(S) + f"SELECT * FROM sales WHERE Country IN ({c1})",
        "filter_dates": _with(ACTIVITY) + f"""SELECT * FROM activity
WHERE InvoiceDate >= TIMESTAMP '{s} 00:00:00' AND InvoiceDate < TIMESTAMP '{e} 00:00:00' + INTERVAL 1 DAY""",
        "filter_both": _with(S) + f"""SELECT * FROM sales WHERE Country IN ({c2})
AND InvoiceDate >= TIMESTAMP '{bs} 00:00:00' AND InvoiceDate < TIMESTAMP '{be} 00:00:00' + INTERVAL 1 DAY""",
    }


def oracle_sql() -> dict[str, str]:
    q = {}
    # A
    q["scan_sales"] = _with(S) + f"SELECT {ALL_SALES_COLS} FROM sales"
    q["roundtrip_parquet"] = q["scan_sales"]
    q["profile_counts"] = _with(S) + "SELECT COUNT(*) AS n_rows, 14 AS n_columns FROM sales"
    q["footer_profile"] = q["profile_counts"]
    q["rules_described"] = _with(DESCRIBED) + f"SELECT {RULES_DESCRIBED_COLS} FROM rd"
    q["roundtrip_rules_csv"] = _with(DESCRIBED) + f"""SELECT {codes('antecedent')} AS antecedent,
       {codes('consequent')} AS consequent, confidence, lift, support,
       {list_repr('antecedent_with_desc')} AS antecedent_with_desc,
       {list_repr('consequent_with_desc')} AS consequent_with_desc FROM rd"""
    # C
    q["clean_dates"] = _with(RAW, PARSED_DATES) + f"SELECT {RAW_COLS} FROM parsed"
    q["clean_numeric"] = _with(RAW, PARSED_DATES, NUMERIC) + f"SELECT {RAW_COLS} FROM numeric"
    q["clean_nonnegative"] = _with(VALID_CHAIN) + f"SELECT {RAW_COLS} FROM valid"
    q["code_strip_all"] = _with(RAW) + """SELECT InvoiceNo, upper(regexp_replace(StockCode, '\\s+', '', 'g')) AS StockCode,
       Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw_sales"""
    q["code_trim"] = _with(RAW) + """SELECT InvoiceNo, trim(upper(StockCode), ' ') AS StockCode,
       Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw_sales"""
    q["desc_counts"] = _with(VALID_CHAIN, modal_ctes("valid")) + "SELECT * FROM counts"
    q["modal_description"] = _with(VALID_CHAIN, modal_ctes("valid")) + "SELECT * FROM modal"
    q["standardize_description"] = _with(VALID_CHAIN, modal_ctes("valid")) + standardized("valid")
    q["missing_description"] = _with(VALID_CHAIN, modal_ctes("valid")) + """SELECT COUNT(*) FILTER (WHERE m.Description IS NULL) AS n_missing
FROM valid v LEFT JOIN modal m ON v.StockCode = m.StockCode"""
    q["line_total"] = _with(VALID_CHAIN) + f"SELECT {RAW_COLS}, Quantity * UnitPrice AS TotalValue FROM valid"
    q["floor_ms"] = _with(ACTIVITY) + "SELECT InvoiceNo, date_trunc('millisecond', InvoiceDate) AS InvoiceDate FROM activity"
    q["calendar_columns"] = _with(ACTIVITY) + "SELECT InvoiceNo, InvoiceDate, Year, Month, Day, Hour, DayOfWeek FROM activity"
    q["clean_summary"] = _with(CLEAN_SALES) + """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT StockCode) AS n_codes,
       (SELECT COUNT(*) FROM modal) AS n_lookup FROM clean_sales"""
    q["weekday_profile"] = _with(S) + f"""SELECT DayOfWeek, {WEEKDAY}[DayOfWeek + 1] AS Weekday, n_rows,
       bool_or(DayOfWeek = 5) OVER () AS has_saturday
FROM (SELECT DayOfWeek, COUNT(*) AS n_rows FROM sales GROUP BY DayOfWeek)"""
    q["clean_sales"] = _with(CLEAN_SALES) + "SELECT * FROM clean_sales"
    q["clean_basket_lines"] = _with(CLEAN_BASKET) + "SELECT * FROM clean_basket_lines"
    q["dropped_counts"] = _with(RAW) + f"""SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (d IS NULL) AS n_no_date,
       COUNT(*) FILTER (d IS NOT NULL AND (n IS NULL OR p IS NULL)) AS n_no_number,
       COUNT(*) FILTER (d IS NOT NULL AND n IS NOT NULL AND p IS NOT NULL AND (n < 0 OR p < 0)) AS n_negative,
       COUNT(*) FILTER (d IS NOT NULL AND n >= 0 AND p >= 0) AS n_kept
FROM (SELECT {DATED} AS d, {number('Quantity')} AS n, {number('UnitPrice')} AS p FROM raw_sales)"""
    q["clean_kpis"] = _with(CLEAN_SALES) + f"""SELECT total_revenue, total_invoices, total_customers,
       total_revenue / total_invoices AS avg_order_value
FROM (SELECT {money('TotalValue')} AS total_revenue, COUNT(DISTINCT InvoiceNo) AS total_invoices,
             COUNT(DISTINCT CustomerID) AS total_customers FROM clean_sales)"""
    q["ingest_raw"] = q["clean_sales"]
    q["ingest_records"] = q["clean_sales"].replace(RAW, RECORDS)
    q["malformed_counts"] = q["dropped_counts"].replace(RAW, RECORDS).replace(
        "SELECT COUNT(*) AS n_rows,", f"""SELECT COUNT(*) + (SELECT COUNT(*) FROM raw_all WHERE {BAD_ORDER}) AS n_rows,
       (SELECT COUNT(*) FROM raw_all WHERE {BAD_ORDER}) AS n_malformed,""")
    q["malformed_lines"] = _with(RAW_ALL) + f"""SELECT bad_line, COUNT(*) AS n_lines FROM (
  SELECT CASE CAST(InvoiceNo AS BIGINT) % 53 WHEN {V.SHORT} THEN InvoiceNo || ',too,short'
              WHEN {V.LONG} THEN InvoiceNo || ',a,b,1,2010-12-01,1.5,c,d,too long'
              ELSE chr(34) || InvoiceNo || ',a,b,1,2010-12-01,1.5,c,d' END AS bad_line FROM raw_all WHERE {BAD_ORDER}) GROUP BY 1"""
    q["load_sales"] = _with(S) + f"SELECT {ALL_SALES_COLS.replace('StockCode', 'upper(trim(StockCode)) AS StockCode')} FROM sales"
    # F
    q.update(_filter_sql())
    q["filtered_count"] = f"SELECT COUNT(*) AS n_rows FROM ({q['filter_both']})"
    q["list_countries"] = _with(S) + "SELECT DISTINCT Country FROM sales"
    q["date_bounds"] = _with(S) + """SELECT CAST(min(InvoiceDate) AS DATE) AS min_date,
       CAST(max(InvoiceDate) AS DATE) AS max_date FROM sales"""
    # K
    q["kpis"] = _with(SN) + f"""SELECT total_revenue, total_invoices, total_customers,
       CASE WHEN total_invoices > 0 THEN total_revenue / total_invoices ELSE 0.0 END AS avg_order_value
FROM (SELECT {money('TotalValue')} AS total_revenue, COUNT(DISTINCT InvoiceNo) AS total_invoices,
             COUNT(DISTINCT CustomerID) AS total_customers FROM sales)"""
    q["monthly_revenue"] = _with(S) + f"""SELECT Year, Month, {money('TotalValue')} AS Revenue,
       printf('%d-%02d', Year, Month) AS "Date" FROM sales GROUP BY Year, Month"""
    q["top_products"] = _with(S) + """SELECT Description, CAST(SUM(Quantity) AS BIGINT) AS Quantity FROM sales
WHERE Description IS NOT NULL GROUP BY Description ORDER BY Quantity DESC, Description LIMIT 10"""
    q["footer_bounds"] = q["date_bounds"]
    q["order_values"] = _with(S, ORDER_VALUES) + "SELECT * FROM ov"
    q["bucketed_order_values"] = q["order_values"]
    q["bucketed_baskets"] = _with(S, baskets_cte("sales")) + f"""SELECT InvoiceNo,
       {codes('items')} AS items, CAST(len(items) AS INTEGER) AS basket_size FROM bk_all"""
    for key, cte, view, keys in (("approx_country_metrics", SN, "sales", "Country"), ("approx_monthly_metrics", SN, "sales", "Year, Month"),
                                 ("approx_heatmap", ACTIVITY, "activity", "DayOfWeek, Hour")):
        q[key] = _with(cte) + f"""SELECT {keys}, COUNT(*) AS n_lines, {money('TotalValue')} AS Revenue,
       true AS orders_near, true AS customers_near FROM {view} GROUP BY {keys}"""
    q["order_value_p95"] = _with(S, ORDER_VALUES, P95) + "SELECT * FROM p95"
    q["order_value_p95_approx"] = _with(S, ORDER_VALUES) + "SELECT COUNT(*) AS n_orders, true AS within FROM ov"
    q["trimmed_order_values"] = _with(S, ORDER_VALUES, P95, TRIMMED) + "SELECT * FROM tr"
    q["order_value_histogram"] = _with(S, ORDER_VALUES, P95, TRIMMED) + """, b AS (SELECT min(TotalValue) AS lo, max(TotalValue) AS hi FROM tr),
c AS (SELECT CASE WHEN hi - lo > 0 THEN LEAST(CAST(floor((TotalValue - lo) * 50 / (hi - lo)) AS INTEGER) + 1, 50)
                  ELSE 1 END AS bin, COUNT(*) AS n FROM tr, b GROUP BY 1)
SELECT CAST(s.bin AS INTEGER) AS bin, lo + (hi - lo) * (s.bin - 1) / 50 AS bin_start,
       lo + (hi - lo) * s.bin / 50 AS bin_end, COALESCE(c.n, 0) AS n_orders
FROM range(1, 51) s(bin) CROSS JOIN b LEFT JOIN c ON c.bin = s.bin"""
    # G
    cm = f"""cm AS (SELECT Country, {money('TotalValue')} AS Revenue, COUNT(DISTINCT InvoiceNo) AS Orders,
               COUNT(DISTINCT CustomerID) AS Customers FROM sales GROUP BY Country)"""
    q["country_metrics"] = _with(SN, cm) + "SELECT *, Revenue / Orders AS Avg_Order_Value FROM cm"
    q["top_countries_revenue"] = _with(S, cm) + "SELECT Country, Revenue, Orders FROM cm ORDER BY Revenue DESC, Country LIMIT 10"
    q["top_countries_aov"] = _with(S, cm) + """SELECT Country, Revenue / Orders AS Avg_Order_Value FROM cm
ORDER BY Avg_Order_Value DESC, Country LIMIT 10"""
    # T
    q["hourly"] = _with(ACTIVITY) + f"""SELECT Hour, COUNT(DISTINCT InvoiceNo) AS Orders, {money('TotalValue')} AS TotalValue
FROM activity GROUP BY Hour"""
    q["weekday_revenue"] = _with(S) + f"""SELECT DayOfWeek, {money('TotalValue')} AS TotalValue,
       {WEEKDAY}[DayOfWeek + 1] AS Weekday FROM sales GROUP BY DayOfWeek"""
    q["daily_trend"] = _with(S) + f"""SELECT CAST(InvoiceDate AS DATE) AS "Date", {money('TotalValue')} AS Revenue,
       COUNT(DISTINCT InvoiceNo) AS Orders FROM sales GROUP BY 1"""
    q["heatmap_long"] = _with(ACTIVITY, HEAT) + "SELECT * FROM hl"
    q["heatmap_matrix"] = _with(ACTIVITY, HEAT) + f"""SELECT CAST(d.DayOfWeek AS INTEGER) AS DayOfWeek,
       {WEEKDAY}[d.DayOfWeek + 1] AS Weekday, {HEAT_COLS}
FROM range(0, 7) d(DayOfWeek) LEFT JOIN hl ON hl.DayOfWeek = d.DayOfWeek GROUP BY d.DayOfWeek"""
    q["month_year_revenue"] = _with(S) + f"""SELECT Year, Month, TotalValue, {month_year()} AS MonthYear
FROM (SELECT Year, Month, {money('TotalValue')} AS TotalValue FROM sales GROUP BY Year, Month)"""
    q["monthly_country_revenue"] = _with(S, MONTHLY_COUNTRY) + "SELECT * FROM mc"
    q["monthly_growth"] = _with(S, MONTHLY_COUNTRY, GROWTH) + "SELECT * FROM gr"
    q["growth_signed"] = _with(S, MONTHLY_COUNTRY, GROWTH) + f"""SELECT *, {month_year()} AS MonthYear,
       CASE WHEN GrowthRate >= 0 THEN 'Positive Growth' ELSE 'Negative Growth' END AS Sign
FROM gr WHERE Country IS NOT NULL AND Year IS NOT NULL AND Month IS NOT NULL AND TotalValue IS NOT NULL
  AND PrevRevenue IS NOT NULL AND GrowthRate IS NOT NULL"""
    # R
    q["rfm_reference_date"] = _with(SN) + "SELECT max(InvoiceDate) AS max_date FROM sales WHERE CustomerID IS NOT NULL"
    q["rfm_base"] = _with(SN, RFM_BASE) + "SELECT * FROM base"
    q["rfm_r_score"] = _with(SN, RFM_BASE, RFM_SCORES) + "SELECT CustomerID, Recency, R_Score FROM scores"
    q["rfm_fm_score"] = _with(SN, RFM_BASE, RFM_SCORES) + "SELECT CustomerID, Frequency, Monetary, F_Score, M_Score FROM scores"
    q["rfm_score"] = _with(SN, RFM_BASE, RFM_SCORES) + "SELECT * FROM rfm"
    q["rfm_segments"] = _with(SN, RFM_BASE, RFM_SCORES) + "SELECT * FROM seg"
    q["segment_counts"] = _with(SN, RFM_BASE, RFM_SCORES) + """SELECT s.Segment, COALESCE(c.n, 0) AS Count
FROM (VALUES ('Low Value'), ('Mid Value'), ('High Value')) s(Segment)
LEFT JOIN (SELECT Segment, COUNT(*) AS n FROM seg GROUP BY Segment) c ON c.Segment = s.Segment"""
    q["rfm_sample"] = _with(SN, RFM_BASE, RFM_SCORES) + """SELECT * FROM seg
ORDER BY md5('42:' || CAST(CustomerID AS VARCHAR)), CustomerID LIMIT 1000"""
    # B
    q["product_dim"] = _with(CLEAN_BASKET, DIM) + "SELECT * FROM dim"
    q["baskets"] = _with(basket_source_cte("p_type"), baskets_cte("basket_source")) + f"""SELECT InvoiceNo,
       {codes('items')} AS items, CAST(len(items) AS INTEGER) AS basket_size FROM bk_all"""
    q["basket_count"] = _with(basket_source_cte("p_type"), baskets_cte("basket_source")) + "SELECT COUNT(*) AS n_baskets FROM bk_all"
    q["basket_size_distribution"] = _with(basket_source_cte("l_partkey"), baskets_cte("basket_source")) + """SELECT CAST(len(items) AS INTEGER) AS basket_size,
       COUNT(*) AS n_baskets FROM bk_all GROUP BY 1"""
    m = Q.LIMIT_MAX_ITEMS
    q["basket_limit"] = _with(basket_source_cte("l_partkey"), baskets_cte("basket_source")) + f"""SELECT COUNT(*) AS n_baskets,
       COUNT(*) FILTER (WHERE len(items) <= {m} AND items IS NOT NULL) AS n_kept,
       COUNT(*) FILTER (WHERE len(items) > {m}) AS n_dropped, COUNT(*) FILTER (WHERE items IS NULL) AS n_null FROM bk_all"""
    q["baskets_within_limit"] = _with(basket_source_cte("l_partkey"), baskets_cte("basket_source")) + f"""SELECT InvoiceNo,
       {codes('items')} AS items, CAST(len(items) AS INTEGER) AS basket_size FROM bk_all WHERE len(items) <= {m}"""
    q["frequent_itemsets"] = _mined(Q.ITEMSETS_RUN) + f"SELECT {codes('items')} AS items, freq FROM fi"
    q["projected_itemsets"] = q["frequent_itemsets"]
    q["itemsets_backoff"] = _backoff()
    _, rladder, _ = Q.RULES_RUN
    q["association_rules"] = _mined(Q.RULES_RUN, rladder[0][1]) + f"""SELECT {codes('antecedent')} AS antecedent,
       {codes('consequent')} AS consequent, confidence, lift, support FROM rules"""
    q["projected_rules"] = q["association_rules"]
    q["itemsets_described"] = _with(DESCRIBED) + f"""SELECT {codes('items')} AS items, freq,
       {list_repr('items_with_desc')} AS items_with_desc FROM fid"""
    for key, by in (("top_rules_confidence", "confidence"), ("top_rules_lift", "lift")):
        q[key] = _with(DESCRIBED) + f"""SELECT {RULES_DESCRIBED_COLS},
       {list_repr('antecedent_with_desc')} || ' → ' || {list_repr('consequent_with_desc')} AS rule
FROM (SELECT * FROM rd ORDER BY {_rule_order(by)} LIMIT 20)"""
    q["friendly_rules"] = _with(DESCRIBED) + f"""SELECT CAST(rule_id AS BIGINT) AS rule_id,
       {codes('antecedent')} AS antecedent_codes, array_to_string(antecedent_names, '; ') AS antecedent_descriptions,
       {codes('consequent')} AS consequent_codes, array_to_string(consequent_names, '; ') AS consequent_descriptions,
       confidence, lift
FROM (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY array_to_string(antecedent, ', '), array_to_string(consequent, ', ')) AS rule_id FROM rd)
      ORDER BY {_rule_order('confidence')} LIMIT 20)"""
    q["roundtrip_friendly_rules"] = q["friendly_rules"]
    q["top_itemsets"] = _with(DESCRIBED) + f"""SELECT {codes('items')} AS items, freq, {list_repr('items_with_desc')} AS items_with_desc,
       CASE WHEN length({list_repr('items_with_desc')}) > 75 THEN substring({list_repr('items_with_desc')}, 1, 75) || '...'
            ELSE {list_repr('items_with_desc')} END AS items_display
FROM (SELECT * FROM fid ORDER BY freq DESC, array_to_string(items, ',') LIMIT 20)"""
    q["mining_summary"] = _with(DESCRIBED) + f"""SELECT (SELECT COUNT(*) FROM bk_all) AS n_baskets,
       (SELECT COUNT(*) FROM bk) AS n_used, (SELECT COUNT(*) FROM fi) AS n_itemsets,
       (SELECT COUNT(*) FROM rules) AS n_rules, CAST({DESCRIBED_SUPPORT} AS DOUBLE) AS min_support,
       CAST({DESCRIBED_CONF} AS DOUBLE) AS min_confidence"""
    return q
