"""DuckDB twins of the registered queries."""

from __future__ import annotations

from . import trend_sql
from .fixtures import AS_OF, with_tables
from .schemas import GENERIC_CODE, GENERIC_NAMES, REASON_SHARED, REASON_UNKNOWN, STRATEGIES

W = with_tables


def _half_even(x: str, places: int) -> str:
    """x, not negative, rounded half to even by its shortest decimal form."""
    d, unit = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16))", 10**places
    low = f"floor({d} * {unit})"
    return f"CASE WHEN {d} * {unit} - {low} = 0.5 AND {low} % 2 = 0 THEN CAST({low} AS DOUBLE) / {unit} ELSE CAST(round({d}, {places}) AS DOUBLE) END"


def _recursive(sql: str) -> str:
    return sql.replace("WITH", "WITH RECURSIVE", 1)


_MONTHLY = "monthly AS (SELECT GoodsID, CAST(date_trunc('month', rDate) AS DATE) AS Month, sum(TotalQty) AS Qty FROM daily GROUP BY 1, 2)"

_DENSE = (
    _MONTHLY
    + """, spans AS (SELECT GoodsID, min(Month) AS a, max(Month) AS b FROM monthly GROUP BY 1),
dense AS (SELECT s.GoodsID, CAST(m.m AS DATE) AS Month, coalesce(q.Qty, 0.0e0) AS Qty
  FROM (SELECT GoodsID, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM spans) m JOIN spans s USING (GoodsID)
  LEFT JOIN monthly q ON q.GoodsID = s.GoodsID AND q.Month = CAST(m.m AS DATE)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY GoodsID ORDER BY Month DESC) AS n FROM dense)"""
)

_RECENT = "recent AS (SELECT * FROM daily WHERE rDate >= (SELECT max(rDate) - INTERVAL 12 MONTH FROM daily))"

_PROFIT = (
    _RECENT
    + f""", summ AS (SELECT GoodsID, sum(TotalQty) AS TotalQty, CAST(sum(CAST(TotalAmt AS DECIMAL(18,4))) AS DOUBLE) AS TotalAmt,
  count(*) AS SalesDays, min(rDate) AS FirstSaleDate FROM recent GROUP BY 1),
age AS (SELECT GoodsID, greatest(datediff('month', min(rDate), (SELECT max(rDate) FROM daily)), 1) AS Month_Age FROM daily GROUP BY 1),
joined AS (SELECT coalesce(s.GoodsID, m.GoodsID) AS GoodsID, s.* EXCLUDE (GoodsID), m.* EXCLUDE (GoodsID) FROM stock s FULL JOIN summ m ON s.GoodsID = m.GoodsID),
filled AS (SELECT j.GoodsID, coalesce(ProductCode, 'Deleted (ID: ' || j.GoodsID || ')') AS ProductCode,
  CASE WHEN ProductCode IS NULL THEN 'Deleted (ID: ' || j.GoodsID || ')' ELSE Name END AS Name, coalesce(Note, 'DELETED') AS Note,
  coalesce(TotalQty, 0.0e0) AS TotalQty, coalesce(TotalAmt, 0.0e0) AS TotalAmt, coalesce(LastInCost, 0.0e0) AS LastInCost, coalesce(SalesDays, 0) AS SalesDays,
  greatest(coalesce(Month_Age, 99), 1) AS Month_Age FROM joined j LEFT JOIN age a ON j.GoodsID = a.GoodsID),
costed AS (SELECT *, CASE WHEN ProductCode = '{GENERIC_CODE}' OR regexp_matches(Name, '{GENERIC_NAMES}') THEN 'Yes' ELSE 'No' END AS Is_Generic,
  CASE WHEN TotalQty > 0 THEN TotalAmt / TotalQty ELSE 0.0e0 END AS unit FROM filled),
adj AS (SELECT *, CASE WHEN LastInCost <= 0 OR unit / LastInCost > 9 THEN unit * 0.8e0 ELSE LastInCost END AS AdjustedCost FROM costed),
profit AS (SELECT *, AdjustedCost * TotalQty AS TotalCost, TotalAmt - AdjustedCost * TotalQty AS TotalProfit,
  (TotalAmt - AdjustedCost * TotalQty) / Month_Age AS Monthly_Avg_Profit FROM adj)"""
)

_ABC = (
    _PROFIT
    + """, best AS (SELECT GoodsID, Monthly_Avg_Profit, CAST(Monthly_Avg_Profit AS DECIMAL(28,8)) AS p FROM profit
  WHERE Is_Generic = 'No' AND Month_Age >= 4 AND Monthly_Avg_Profit > 0),
shares AS (SELECT GoodsID, CAST(sum(p) OVER (ORDER BY Monthly_Avg_Profit DESC, GoodsID ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(p) OVER () AS DOUBLE) AS share FROM best),
abc AS (SELECT profit.*, CASE WHEN Is_Generic = 'Yes' THEN 'Excluded' WHEN Month_Age < 4 THEN 'New' WHEN share IS NULL THEN 'C'
  WHEN share <= 0.7e0 THEN 'A' WHEN share <= 0.9e0 THEN 'B' ELSE 'C' END AS ABC_Class,
  CASE WHEN Is_Generic = 'Yes' THEN NULL ELSE coalesce(share, 1.0e0) END AS ProfitCumulativeRatio FROM profit LEFT JOIN shares USING (GoodsID))"""
)

_XYZ = """xs AS (SELECT GoodsID, sum(Qty) AS s, sum(Qty * Qty) AS ss, (SELECT CAST(count(DISTINCT Month) AS DOUBLE) FROM monthly) AS n FROM monthly GROUP BY 1),
xm AS (SELECT GoodsID, s / n AS Mean_Monthly_Qty, CASE WHEN n > 1 THEN sqrt(greatest(ss - s * s / n, 0.0e0) / (n - 1)) END AS Std_Monthly_Qty FROM xs),
xyz AS (SELECT *, coalesce(CASE WHEN Mean_Monthly_Qty <= 0 THEN 9.99e0 ELSE Std_Monthly_Qty / Mean_Monthly_Qty END, 9.99e0) AS CV FROM xm),
xyzc AS (SELECT *, CASE WHEN CV <= 0.5e0 THEN 'X' WHEN CV <= 1.0e0 THEN 'Y' ELSE 'Z' END AS XYZ_Class FROM xyz)"""

_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STRATEGIES.items())

_FULL = (
    _ABC
    + ", "
    + _DENSE
    + ", "
    + _XYZ
    + f""", classes AS (SELECT a.GoodsID, ProductCode, Name, ABC_Class, coalesce(XYZ_Class, 'Z') AS XYZ_Class, coalesce(CV, 9.99e0) AS CV, Mean_Monthly_Qty,
  CASE WHEN ABC_Class = 'New' THEN '新品觀察 (手動控貨)' WHEN ABC_Class = 'Excluded' THEN '排除對象' ELSE CASE ABC_Class || coalesce(XYZ_Class, 'Z') {_CASES} ELSE '其他' END END AS Strategy,
  Name || ' | ' || ProductCode AS displayname FROM abc a LEFT JOIN xyzc x ON a.GoodsID = x.GoodsID)"""
)

_NOTE = r"""note AS (SELECT GoodsID, ProductCode, Name, CurrStock, Category, nullif(regexp_extract(Note, '(?:^|\s)([0-9]+)(?:\s|$)', 1), '') AS FirstOrderQty FROM stock)"""

_SEASON = """season0 AS (SELECT Category, CAST(date_trunc('month', rDate) AS DATE) AS m, sum(TotalQty) AS q FROM daily JOIN stock USING (GoodsID) WHERE Category IS NOT NULL GROUP BY 1, 2),
season1 AS (SELECT Category, month(m) AS Month, q / CASE WHEN avg(q) OVER (PARTITION BY Category) = 0 THEN 1 ELSE avg(q) OVER (PARTITION BY Category) END AS r FROM season0),
season AS (SELECT Category, Month, avg(r) AS Seasonal_Index FROM season1 GROUP BY 1, 2)"""

_RATE = """rate AS (SELECT GoodsID, CASE WHEN d < 7 THEN least(q / d * 30, q * 3) ELSE q / d * 30 END AS Base
  FROM (SELECT GoodsID, greatest(datediff('day', min(rDate), max(rDate)), 1) AS d, sum(TotalQty) AS q FROM daily GROUP BY 1))"""

_PEAK = """peak AS (SELECT GoodsID, CASE WHEN len(six) >= 2 AND six[1] = top AND six[1] > 0 THEN six[2] ELSE six[1] END AS Base
  FROM (SELECT GoodsID, max(Qty) AS top, list_reverse_sort(list(Qty) FILTER (n <= 6)) AS six FROM ranked GROUP BY 1))"""

_PLAN = (
    _FULL
    + ", "
    + _NOTE
    + ", "
    + _SEASON
    + ", "
    + _RATE
    + ", "
    + _PEAK
    + f""", trail AS (SELECT GoodsID, avg(Qty) AS Base FROM ranked WHERE n <= 3 GROUP BY 1),
base0 AS (SELECT c.*, o.CurrStock, o.Category, TRY_CAST(o.FirstOrderQty AS DOUBLE) AS f FROM classes c JOIN note o USING (GoodsID)),
base1 AS (SELECT b.*, coalesce(CASE WHEN ABC_Class = 'New' THEN r.Base WHEN XYZ_Class IN ('X', 'Y') THEN t.Base ELSE p.Base END, Mean_Monthly_Qty, 0.0e0) AS base, s.Seasonal_Index AS idx
  FROM base0 b LEFT JOIN rate r USING (GoodsID) LEFT JOIN trail t USING (GoodsID) LEFT JOIN peak p USING (GoodsID)
  LEFT JOIN season s ON s.Category = b.Category AND s.Month = (SELECT month(max(rDate) + INTERVAL 1 MONTH) FROM daily)
  WHERE ABC_Class IN ('A', 'B', 'New')),
base2 AS (SELECT *, CASE WHEN ABC_Class <> 'New' AND Mean_Monthly_Qty > 0 THEN least(base, Mean_Monthly_Qty * 3) ELSE base END AS capped FROM base1),
base3 AS (SELECT *, CASE WHEN capped <= 0 AND ABC_Class IN ('A', 'B') AND Mean_Monthly_Qty > 0 THEN Mean_Monthly_Qty ELSE capped END AS b FROM base2),
base4 AS (SELECT *, b * CASE WHEN ABC_Class = 'New' OR XYZ_Class = 'Z' THEN greatest(1.0e0, least(2.0e0, coalesce(idx, 1.0e0))) ELSE 1.0e0 END AS f2 FROM base3),
base5 AS (SELECT *, round(CASE WHEN ABC_Class = 'New' OR XYZ_Class = 'Z' THEN least(2.0e0, coalesce(idx, 1.0e0)) ELSE 1.0e0 END, 2) AS boost, f2 + f2 * least(CASE WHEN ABC_Class = 'A' THEN 0.5e0 ELSE 0.3e0 END, CV * 0.5e0) AS t FROM base4),
plan AS (SELECT ProductCode, Name, ABC_Class || XYZ_Class AS ABC_XYZ, ABC_Class, Strategy, CurrStock, b AS Base, f2 AS Final,
  CASE WHEN ABC_Class <> 'New' AND Mean_Monthly_Qty > 0 THEN least(t, greatest(Mean_Monthly_Qty * 4, 2.0e0)) ELSE t END AS Target, boost FROM base5
  UNION ALL SELECT ProductCode, Name, ABC_Class || XYZ_Class, ABC_Class, Strategy, CurrStock, coalesce(Mean_Monthly_Qty, 0.0e0), coalesce(Mean_Monthly_Qty, 0.0e0),
  CASE WHEN coalesce(Mean_Monthly_Qty, 0) <= 0 THEN 0.0e0 WHEN f > 0 AND f <= Mean_Monthly_Qty * 12 THEN f ELSE Mean_Monthly_Qty * 1.2e0 END, NULL FROM base0 WHERE ABC_Class = 'C'),
plan2 AS (SELECT ProductCode, Name, ABC_XYZ, ABC_Class, Strategy, CurrStock, boost, {_half_even('Base', 2)} AS Base_Demand, {_half_even('Final', 2)} AS Final_Demand, {_half_even('Target', 2)} AS Target_Stock FROM plan),
orders2 AS (SELECT *, greatest(Target_Stock - CurrStock, 0.0e0) AS so FROM plan2),
orders3 AS (SELECT *, CASE WHEN ABC_Class = 'C' THEN CASE WHEN so > 0 THEN greatest(so, 12.0e0) ELSE 0.0e0 END WHEN so > 6 THEN greatest(so, 12.0e0) ELSE 0.0e0 END AS fo FROM orders2)"""
)

_PLAN_MODEL = (
    _PLAN.replace("THEN t.Base ELSE p.Base END", "THEN coalesce(x.Base, t.Base) ELSE p.Base END").replace("LEFT JOIN trail t USING (GoodsID)", "LEFT JOIN trail t USING (GoodsID) LEFT JOIN fit x USING (GoodsID)")
    .replace(", trail AS", ", " + trend_sql.FIT + ", trail AS")
)


def _plan(sql: str) -> str:
    return _recursive(W(sql, _PLAN_MODEL))


_MOVES = f"""moves AS (SELECT GoodsNo, ChQty, BillDate FROM inbound WHERE MoveTypeID = 1 AND ChQty > 0
  AND BillDate BETWEEN CAST(strftime(DATE '{AS_OF}' - INTERVAL 730 DAY, '%Y%m%d') AS INTEGER) AND CAST(strftime(DATE '{AS_OF}', '%Y%m%d') AS INTEGER))"""

_GUESS = (
    _MOVES
    + """, qs AS (SELECT trim(GoodsNo) AS ProductCode, CAST(floor(ChQty) AS BIGINT) AS q, count(*) AS w FROM moves GROUP BY 1, 2 HAVING CAST(floor(ChQty) AS BIGINT) > 0),
votes AS (SELECT ProductCode, d, sum(w) AS v FROM qs, unnest(generate_series(1, q)) t(d) WHERE q % d = 0 GROUP BY 1, 2),
need AS (SELECT ProductCode, greatest(ceil(sum(w) * 0.6e0), 1) AS least FROM qs GROUP BY 1),
mult AS (SELECT ProductCode, max(d) AS guessed_multiple FROM votes JOIN need USING (ProductCode) WHERE v >= least GROUP BY 1),
guess AS (SELECT ProductCode, min(q) AS guessed_min, CAST(guessed_multiple AS BIGINT) AS guessed_multiple FROM qs JOIN mult USING (ProductCode) WHERE q % guessed_multiple = 0 GROUP BY 1, 3)"""
)

_CLEAN = r"""clean0 AS (SELECT file, line, regexp_replace(trim(barcode), '\.0+$', '') AS barcode, CAST(replace(unit_cost, '$ ', '') AS DOUBLE) AS c, markup_flag,
  CAST(replace(qty, ' pcs', '') AS INTEGER) AS qty, item_name, supplier FROM receipts),
clean AS (SELECT file, line, barcode, CASE WHEN markup_flag = 'Yes' THEN round_even(c * 1.2e0, 2) ELSE c END AS unit_cost, qty, item_name, supplier, '20011104' AS in_date, barcode AS product_code
  FROM clean0 WHERE barcode <> '' AND qty > 0)"""

_RESOLVED = (
    _CLEAN
    + f""", maps AS (SELECT barcode AS mb, trim(item_name) AS mn, arg_min(product_code, ord) AS code FROM mapping GROUP BY 1, 2),
resolved AS (SELECT c.* EXCLUDE (product_code), CASE WHEN m.code IS NOT NULL THEN 'mapping' WHEN p.pc IS NOT NULL THEN 'code' WHEN b.bc IS NOT NULL THEN 'barcode' ELSE 'unknown' END AS how,
  CASE WHEN m.code IS NOT NULL OR p.pc IS NOT NULL THEN NULL WHEN b.bc IS NOT NULL THEN '{REASON_SHARED}' ELSE '{REASON_UNKNOWN}' END AS reason,
  coalesce(m.code, p.pc) AS product_code
  FROM clean c LEFT JOIN maps m ON c.barcode = m.mb AND trim(c.item_name) = m.mn LEFT JOIN (SELECT DISTINCT ProductCode AS pc FROM stock) p ON p.pc = c.barcode
  LEFT JOIN (SELECT DISTINCT Barcode AS bc FROM stock) b ON b.bc = c.barcode)"""
)

_MANUAL = """manual AS (SELECT file, line, barcode, trim(item_name) AS item_name, product_code FROM (SELECT file, line, barcode, item_name,
  CASE WHEN l_partkey%7=0 THEN '99999999' WHEN l_partkey%3=0 THEN lpad(CAST(10000+l_partkey AS VARCHAR),8,'0') WHEN l_partkey%3=1 THEN '00010004' END AS product_code FROM receipts WHERE barcode LIKE 'X%')
  WHERE product_code IS NOT NULL),
owner AS (SELECT product_code AS oc, list(DISTINCT barcode || '/' || trim(item_name)) AS owners FROM mapping GROUP BY 1),
judged0 AS (SELECT m.*, m.product_code IN (SELECT ProductCode FROM stock) AS pos, owners IS NOT NULL AND NOT list_contains(owners, barcode || '/' || item_name) AS taken
  FROM manual m LEFT JOIN owner ON oc = m.product_code),
judged1 AS (SELECT *, first_value(CASE WHEN pos AND NOT taken THEN barcode || '/' || item_name END IGNORE NULLS) OVER (PARTITION BY product_code ORDER BY file, line ROWS UNBOUNDED PRECEDING) AS claim FROM judged0),
judged AS (SELECT file, line, barcode, item_name, product_code, CASE WHEN NOT pos THEN 'not in POS' WHEN taken OR claim <> barcode || '/' || item_name THEN 'code in use' ELSE 'ok' END AS verdict FROM judged1)"""

_PRICES = """prices AS (SELECT Supplier AS supplier, Barcode AS barcode, Name AS item_name, '2' AS qty, CASE WHEN GoodsID%4=0 THEN 'v' ELSE '' END AS "check", ProductCode AS product_code,
  't0' AS updated_at, 'f0' AS source_file, '4' AS uc, '1' AS cs, '3' AS rp FROM stock WHERE CurrStock >= 24),
batch AS (SELECT trim(product_code) AS c, arg_min(supplier, (file, line)) AS s, arg_min(barcode, (file, line)) AS b, arg_min(item_name, (file, line)) AS i, CAST(arg_min(qty, (file, line)) AS VARCHAR) AS q, CAST(arg_min(unit_cost, (file, line)) AS VARCHAR) AS u
  FROM resolved WHERE how IN ('mapping', 'code') GROUP BY 1)"""

_SHEETS = """config AS (SELECT DISTINCT file, CAST(substr(file, 5, 1) AS INTEGER) AS ord FROM receipts WHERE CAST(substr(file, 5, 1) AS INTEGER) < 5),
numbered AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line, l_partkey, unit_cost, qty) + 3 AS n FROM receipts)"""

_AS_OF_HOLIDAY = "SELECT event_id, (SELECT min(h.date) FROM holidays h WHERE h.date >= CAST(ts AS DATE)) AS h, CAST(ts AS DATE) AS day FROM events"

_CAL = """span AS (SELECT CAST(unnest(generate_series(DATE '2022-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS date),
cal AS (SELECT s.date, h.holiday_name FROM span s LEFT JOIN holidays h ON s.date = h.date),
ev AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n_events FROM events GROUP BY 1)"""

_LEGACY = (
    _RECENT
    + """, summ AS (SELECT GoodsID, sum(TotalQty) AS TotalQty, CAST(sum(CAST(TotalAmt AS DECIMAL(18,4))) AS DOUBLE) AS TotalAmt, min(rDate) AS f FROM recent GROUP BY 1),
lg0 AS (SELECT GoodsID, ProductCode, greatest(coalesce(datediff('day', f, (SELECT max(rDate) FROM daily)) / 30.0e0, 12.0e0), 1.0e0) AS Months_Active,
  coalesce(TotalAmt, 0.0e0) - coalesce(TotalQty, 0.0e0) * coalesce(LastInCost, 0.0e0) AS TotalProfit FROM stock LEFT JOIN summ USING (GoodsID)),
lg AS (SELECT *, {value} AS RankedProfit FROM lg0),
lb AS (SELECT GoodsID, RankedProfit, CAST(RankedProfit AS DECIMAL(28,8)) AS p FROM lg WHERE RankedProfit > 0{only}),
lsh AS (SELECT GoodsID, CAST(sum(p) OVER (ORDER BY RankedProfit DESC, GoodsID ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(p) OVER () AS DOUBLE) AS share FROM lb)"""
)
_LEGACY_SELECT = """SELECT GoodsID, ProductCode, Months_Active, RankedProfit,
  {new}CASE WHEN share <= 0.7e0 THEN 'A' WHEN share <= 0.9e0 THEN 'B' ELSE 'C' END{end} AS ABC_Class FROM lg LEFT JOIN lsh USING (GoodsID)"""


ORACLES = {
    "daily_sales": W("SELECT GoodsID, rDate, sum(l_quantity) AS TotalQty, CAST(sum(amt) AS DOUBLE) AS TotalAmt, strftime(rDate,'%Y') AS year, strftime(rDate,'%m') AS month FROM lines GROUP BY GoodsID, rDate"),
    "merge_sales": W("SELECT GoodsID, rDate, TotalQty + CASE WHEN rDate BETWEEN DATE '2001-07-13' AND DATE '2001-07-14' AND false THEN 1 ELSE 0 END AS TotalQty, TotalAmt, strftime(rDate,'%Y') AS year, strftime(rDate,'%m') AS month FROM daily WHERE rDate >= DATE '2001-07-01'"),
    "recent_months": W("SELECT * FROM recent", _RECENT),
    "sales_summary": W("SELECT GoodsID, sum(TotalQty) AS TotalQty, CAST(sum(CAST(TotalAmt AS DECIMAL(18,4))) AS DOUBLE) AS TotalAmt, count(*) AS SalesDays, min(rDate) AS FirstSaleDate FROM daily GROUP BY 1"),
    "month_age": W("SELECT GoodsID, greatest(datediff('month', min(rDate), (SELECT max(rDate) FROM daily)), 1) AS Month_Age FROM daily GROUP BY 1"),
    "monthly_sales": W("SELECT * FROM monthly", _MONTHLY),
    "dense_monthly_series": W("SELECT * FROM dense", _DENSE),
    "stock_master": W(r"SELECT GoodsID, ProductCode, Barcode, Name, trim(regexp_replace(Note, '[\n\r\t]+', ' ', 'g')) AS Note, CurrStock, RetailPrice, LastInCost, AvgCost, Category, InboundLocation, Supplier FROM stock"),
    "clean_text": W(r"SELECT GoodsID, trim(regexp_replace(Note, '[\n\r\t]+', ' ', 'g')) AS Note, ProductCode FROM stock"),
    "note_parse": W(r"SELECT GoodsID, nullif(regexp_extract(Note, '(?:^|\s)([0-9]+)(?:\s|$)', 1), '') AS FirstOrderQty, nullif(trim(regexp_replace(regexp_replace(Note, '(^|\s)[0-9]+(\s|$)', '\1 \2', 'g'), '\s+', ' ', 'g')), '') AS NoteDescription FROM stock"),
    "product_columns": W("SELECT ProductCode, Barcode, Name, CurrStock, RetailPrice, Category, Supplier FROM stock"),
    "supplier_dim": W("SELECT min(GoodsID) AS SID, Supplier AS Name FROM stock GROUP BY Supplier"),
    "inventory_health": W(
        """SELECT GoodsID, ProductCode, CurrStock, round(a, 4) AS AvgDailySales, round(CASE WHEN a <> 0 THEN CurrStock / a END, 4) AS DaysOfInventory,
  CASE WHEN a <> 0 AND CurrStock / a < 14 THEN 1 ELSE 0 END AS LowStock, CASE WHEN CurrStock > 0 AND (a <= 0 OR CurrStock / a > 365) THEN 1 ELSE 0 END AS DeadStock
  FROM (SELECT s.*, coalesce(q, 0.0e0) / 365.0e0 AS a FROM stock s LEFT JOIN (SELECT GoodsID, sum(TotalQty) AS q FROM daily WHERE rDate > (SELECT max(rDate) - INTERVAL 365 DAY FROM daily) GROUP BY 1) USING (GoodsID))"""
    ),
    "adjusted_cost_profit": W("SELECT GoodsID, Is_Generic, Month_Age, SalesDays, AdjustedCost, TotalCost, TotalProfit, Monthly_Avg_Profit FROM profit", _PROFIT),
    "abc_classification": W("SELECT GoodsID, ProductCode, ABC_Class, round(ProfitCumulativeRatio, 6) AS ProfitCumulativeRatio FROM abc", _ABC),
    "xyz_stats": W("SELECT GoodsID, round(Mean_Monthly_Qty, 6) AS Mean_Monthly_Qty, round(Std_Monthly_Qty, 6) AS Std_Monthly_Qty, round(CV, 6) AS CV, XYZ_Class FROM xyzc", _MONTHLY + ", " + _XYZ),
    "abc_xyz_full": W("SELECT GoodsID, ProductCode, Name, ABC_Class, XYZ_Class, round(CV, 6) AS CV, round(Mean_Monthly_Qty, 6) AS Mean_Monthly_Qty, Strategy, displayname FROM classes", _FULL),
    "strategy_labels": W("SELECT ABC_Class, XYZ_Class, Strategy, count(*) AS n FROM classes GROUP BY 1, 2, 3", _FULL),
    "class_counts": W("SELECT ABC_Class, count(*) AS n FROM abc GROUP BY 1", _ABC),
    "legacy_abc_v1": W(_LEGACY_SELECT.format(new="", end=""), _LEGACY.format(value="TotalProfit", only="")),
    "legacy_abc_v2": W(_LEGACY_SELECT.format(new="CASE WHEN Months_Active < 4 THEN 'New' ELSE ", end=" END"), _LEGACY.format(value="TotalProfit / Months_Active", only=" AND Months_Active >= 4")),
    "seasonal_index": W("SELECT Category, CAST(Month AS INTEGER) AS Month, round(Seasonal_Index, 4) AS Seasonal_Index FROM season", _SEASON),
    "run_rate_new": W("SELECT GoodsID, round(Base, 4) AS Base FROM rate", _RATE),
    "trailing_mean": W("SELECT GoodsID, round(avg(Qty), 4) AS Base FROM ranked WHERE n <= 3 GROUP BY 1", _DENSE),
    "z_peak": W("SELECT * FROM peak", _DENSE + ", " + _PEAK),
    "legacy_median6": W("SELECT GoodsID, median(Qty) AS Base FROM ranked WHERE n <= 6 GROUP BY 1", _DENSE),
    "legacy_last_weeks": W("SELECT GoodsID, sum(TotalQty) AS Base FROM (SELECT *, max(rDate) OVER (PARTITION BY GoodsID) AS l FROM daily) WHERE rDate >= l - INTERVAL 28 DAY GROUP BY 1"),
    "c_class_target": W("SELECT GoodsID, round(CASE WHEN coalesce(Mean_Monthly_Qty, 0) <= 0 THEN 0.0e0 WHEN f > 0 AND f <= Mean_Monthly_Qty * 12 THEN f ELSE Mean_Monthly_Qty * 1.2e0 END, 4) AS Target_Stock FROM (SELECT GoodsID, TRY_CAST(FirstOrderQty AS DOUBLE) AS f FROM note) LEFT JOIN xyzc USING (GoodsID)", _MONTHLY + ", " + _XYZ + ", " + _NOTE),
    "forecast_next_month": _recursive(W("SELECT GoodsID, round(Base, 4) AS Base, 0 AS failed FROM fit", _MONTHLY + ", " + trend_sql.FIT)),
    "forecast_backtest": _recursive(
        W("SELECT GoodsID, count(*) AS folds, round(avg(abs(fit - real)), 4) AS mae_fit, round(avg(abs(mean - real)), 4) AS mae_mean FROM tested GROUP BY 1", _MONTHLY + ", " + trend_sql.BACKTEST)
    ),
    "target_plan": W("SELECT ProductCode, Name, ABC_XYZ, Strategy, CurrStock, Base_Demand, Final_Demand, Target_Stock FROM plan2", _PLAN),
    "order_suggestion_moq": _plan("SELECT ProductCode, ABC_XYZ, round(so, 2) AS Suggested_Order, round(fo, 2) AS Final_Order FROM orders3"),
    "plan_summary": _plan("SELECT count(*) AS n_items, CAST(sum(CASE WHEN so > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_to_order, round(avg(boost), 2) AS mean_boost FROM orders3"),
    "target_plan_model": _plan("SELECT ProductCode, Name, ABC_XYZ, Strategy, CurrStock, Base_Demand, Final_Demand, Target_Stock FROM plan2"),
    "order_list_by_class": _plan("SELECT row_number() OVER (ORDER BY ABC_XYZ, so DESC, ProductCode) AS place, ABC_XYZ, ProductCode FROM orders3"),
    "order_list_by_order": _plan("SELECT row_number() OVER (ORDER BY fo DESC, ProductCode) AS place, ProductCode, round(fo, 2) AS Final_Order FROM orders3"),
    "plan_upload": _plan("SELECT ProductCode, CAST(" + _half_even("Base_Demand", 0) + " AS BIGINT) AS Target_Stock FROM plan2"),
    "inbound_movements": W("SELECT * FROM moves", _MOVES),
    "min_multiple": W("SELECT * FROM guess", _GUESS),
    "changed_rows": W("SELECT ProductCode AS key, GoodsID, CurrStock FROM stock WHERE GoodsID % 7 = 0 OR GoodsID % 11 = 0"),
    "merge_upsert": W("SELECT ProductCode AS key, CASE WHEN GoodsID%11 <> 0 THEN Name END AS Name, CASE WHEN GoodsID%7=0 THEN CurrStock+5 ELSE CurrStock END AS CurrStock, CASE WHEN GoodsID%7=0 THEN NULL ELSE Note END AS Note, CASE WHEN GoodsID%7=0 THEN Supplier END AS Supplier FROM stock WHERE GoodsID%11<>0 OR GoodsID%7=0"),
    "changed_classification": W("SELECT trim(ProductCode) AS key, ABC_Class, 'X' AS XYZ_Class, Note AS note FROM abc WHERE GoodsID % 9 = 0 AND ABC_Class <> 'C'", _ABC),
    "changed_min_multiple": W("SELECT * FROM guess WHERE guessed_min > 12", _GUESS),
    "doc_ids": W("SELECT GoodsID AS ord, coalesce(CASE WHEN GoodsID%3=0 THEN Barcode END, CASE WHEN GoodsID%2=0 THEN replace(Supplier || '/' || GoodsID, '/', '_') END, 'row_' || GoodsID) AS doc_id FROM stock"),
    "calendar_features": W(
        """SELECT c.date, holiday_name, CAST(isodow(c.date) - 1 AS INTEGER) AS day_of_week, CAST(isodow(c.date) >= 6 AS INTEGER) AS is_weekend, CAST(holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
  CASE WHEN holiday_name IS NULL THEN 'None' WHEN regexp_matches(lower(holiday_name), 'lunar new year|chinese new year|mid-autumn|dragon boat|chung yeung|qingming|easter|christmas') THEN 'Traditional_Gift' ELSE 'Public_Holiday' END AS holiday_category,
  CAST(isodow(c.date) < 6 AND holiday_name IS NULL AS INTEGER) AS is_working_day, CAST(holiday_name IS NOT NULL AND isodow(c.date) IN (1, 5) AS INTEGER) AS is_long_weekend,
  CAST(coalesce((SELECT min(h.date) FROM holidays h WHERE h.date >= c.date) - c.date, 999) AS INTEGER) AS days_until_next_holiday,
  CAST(coalesce(c.date - (SELECT max(h.date) FROM holidays h WHERE h.date <= c.date), 999) AS INTEGER) AS days_since_last_holiday,
  CAST(coalesce((SELECT min(h.date) FROM holidays h WHERE h.date >= c.date AND h.holiday_name LIKE '%Lunar New Year%') - c.date, 999) AS INTEGER) AS days_until_cny, n_events
  FROM cal c LEFT JOIN ev ON ev.date = c.date WHERE year(c.date) BETWEEN 2023 AND 2025""",
        _CAL,
    ),
    "plan_by_target": _plan("SELECT row_number() OVER (ORDER BY Target_Stock DESC, ProductCode) AS place, ProductCode, Target_Stock FROM plan2"),
    "price_list_order": W("SELECT row_number() OVER (ORDER BY Supplier, ProductCode) AS place, Supplier AS supplier, ProductCode AS product_code FROM stock"),
    "inbound_order": W("SELECT row_number() OVER (ORDER BY GoodsNo, BillDate, ChQty) AS place, GoodsNo, BillDate, ChQty FROM moves", _MOVES),
    "class_order": W(
        "SELECT row_number() OVER (ORDER BY list_position(['New', 'A', 'B', 'C', 'Excluded'], ABC_Class), Monthly_Avg_Profit DESC, GoodsID) AS place, ABC_Class, GoodsID FROM abc", _ABC
    ),
    "next_prev_holiday": W("SELECT event_id, CAST(h - day AS INTEGER) AS days_ahead, holiday_name, CAST(day - (SELECT max(p.date) FROM holidays p WHERE p.date <= day) AS INTEGER) AS days_since FROM (" + _AS_OF_HOLIDAY + ") a LEFT JOIN holidays ON holidays.date = a.h"),
    "last_purchase": W("SELECT event_id, b.paid FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS paid FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) b ON e.user_id = b.user_id AND e.ts >= b.ts"),
    "last_purchase_spread": W("SELECT event_id, b.paid FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS paid FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) b ON e.user_id = b.user_id AND e.ts >= b.ts"),
    "publish_changes": W("SELECT ProductCode AS key, Name, CurrStock FROM stock"),
    "weather_features": W(
        """SELECT station, date, first_value(m IGNORE NULLS) OVER f AS mean_temp, round(first_value(ma IGNORE NULLS) OVER f, 4) AS temp_ma_7, round(first_value(df IGNORE NULLS) OVER f, 4) AS temp_diff
  FROM (SELECT * FROM w2 WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28') WINDOW f AS (PARTITION BY station ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        """w0 AS (SELECT event_type AS station, CAST(ts AS DATE) AS date, CASE WHEN day(CAST(ts AS DATE)) % 5 <> 0 THEN round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*), 2) END AS m0 FROM events GROUP BY 1, 2),
w1 AS (SELECT station, date, last_value(m0 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date ROWS UNBOUNDED PRECEDING) AS m FROM w0),
w2 AS (SELECT station, date, m, CASE WHEN count(m) OVER s = 7 THEN avg(m) OVER s END AS ma, m - lag(m) OVER (PARTITION BY station ORDER BY date) AS df FROM w1 WINDOW s AS (PARTITION BY station ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    ),
    "receipt_clean": W("SELECT * FROM clean", _CLEAN),
    "resolve_products": W("SELECT file, line, barcode, how, reason, product_code FROM resolved", _RESOLVED),
    "barcode_options": W("SELECT Barcode AS barcode, string_agg(ProductCode || ':' || Name, '|' ORDER BY ProductCode, Name) AS options FROM stock WHERE Barcode IN (SELECT barcode FROM resolved WHERE how = 'barcode') GROUP BY 1", _RESOLVED),
    "receipt_summary": W("SELECT file, count(*) AS total, count(*) FILTER (how = 'mapping') AS by_mapping, count(*) FILTER (how = 'code') AS by_code, count(*) FILTER (how = 'barcode') AS barcode_only, count(*) FILTER (how IN ('unknown', 'blank')) AS unmatched FROM resolved GROUP BY ROLLUP (file)", _RESOLVED),
    "reason_counts": W("SELECT reason, count(*) AS n FROM resolved WHERE how NOT IN ('mapping', 'code') GROUP BY 1", _RESOLVED),
    "pos_import_layout": W(
        """SELECT product_code, barcode, item_name, CAST(unit_cost AS VARCHAR) AS unit_cost, CAST(qty AS VARCHAR) AS qty, 'S1' AS shop, in_date, '' AS receipt_no, '001' AS supplier_no,
  supplier, '' AS remark, '' AS status, '' AS system_note FROM resolved WHERE how IN ('mapping', 'code')""",
        _RESOLVED,
    ),
    "mapping_verdicts": W("SELECT * FROM judged", _MANUAL),
    "mapping_upsert": W(
        """SELECT coalesce(m.barcode, g.barcode) AS barcode, coalesce(m.item_name, g.item_name) AS item_name, coalesce(g.code, m.product_code) AS product_code, CASE WHEN g.code IS NOT NULL THEN 'new' ELSE m.supplier END AS supplier
  FROM mapping m FULL JOIN (SELECT barcode, item_name, arg_max(product_code, (file, line)) AS code FROM judged WHERE verdict = 'ok' GROUP BY 1, 2) g ON m.barcode = g.barcode AND m.item_name = g.item_name""",
        _MANUAL,
    ),
    "price_list_upsert": W(
        """SELECT coalesce(product_code, c) AS product_code, CASE WHEN c IS NOT NULL THEN s ELSE supplier END AS supplier, coalesce(barcode, b) AS barcode, CASE WHEN c IS NOT NULL THEN i ELSE item_name END AS item_name,
  CASE WHEN c IS NOT NULL THEN q ELSE qty END AS qty, CASE WHEN c IS NOT NULL THEN u ELSE uc END AS unit_cost,
  CASE WHEN c IS NOT NULL THEN coalesce(CAST(kc AS VARCHAR), '') ELSE cs END AS curr_stock, CASE WHEN c IS NOT NULL THEN coalesce(CAST(kr AS VARCHAR), '') ELSE rp END AS retail_price, coalesce("check", '') AS "check", CASE WHEN c IS NOT NULL THEN 't1' ELSE updated_at END AS updated_at, CASE WHEN c IS NOT NULL THEN 'f1' ELSE source_file END AS source_file
  FROM prices FULL JOIN batch ON c = product_code LEFT JOIN (SELECT ProductCode AS kp, CurrStock AS kc, RetailPrice AS kr FROM stock) ON kp = c""",
        _RESOLVED + ", " + _PRICES,
    ),
    "price_list_delta": W("SELECT CAST(sum(CASE WHEN product_code IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS added, CAST(sum(CASE WHEN product_code IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS updated FROM batch LEFT JOIN prices ON c = product_code", _RESOLVED + ", " + _PRICES),
    "header_discovery": W("SELECT file, CAST(3 AS INTEGER) AS line, CAST(4 AS INTEGER) AS score, ' Code' || ord || '|ITEM' || ord || '|Qty' || ord || '|Price' || ord AS cells FROM config", _SHEETS),
    "supplier_identify": W("SELECT file, CAST(3 AS INTEGER) AS line, 'Supplier ' || ord AS supplier FROM config", _SHEETS),
    "receipt_rows": W("SELECT n.file, CAST(n.n AS INTEGER) AS line, 'Supplier ' || ord AS supplier, barcode, item_name, qty, unit_cost FROM numbered n JOIN config USING (file)", _SHEETS),
    "station_temperature": W("SELECT CAST(CASE WHEN day(d) % 9 = 0 THEN date_trunc('month', d) ELSE d END AS DATE) AS date, CASE WHEN n % 2 = 0 THEN CAST(n AS DOUBLE) END AS mean_temp FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)"),
    "stream_daily_sales": W("SELECT user_id AS GoodsID, CAST(ts AS DATE) AS rDate, CAST(count(*) AS DOUBLE) AS TotalQty, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS TotalAmt, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 5, 6"),
}
