"""DuckDB SQL equal in meaning to each registered query in ``larder.plans.catalog``.

Tables are the test views (orders, lineitem, part, ...).  Sums are cast back to BIGINT
(DuckDB widens them to HUGEINT) so types match the Spark side; money is BIGINT cents.
"""

from __future__ import annotations

from larder.operators.features import CONTEXT_1D, HORIZONS, ITEM_1D, SHARE_1D

STAR_CTE = """
ord AS (
  SELECT o.o_orderkey AS order_id, o.o_orderdate AS time,
         CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS total_price,
         COALESCE(q.quantity, 0) AS quantity,
         CAST(o.o_orderdate AS DATE) AS time_date, CAST(hour(o.o_orderdate) AS INTEGER) AS time_hour
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
             FROM lineitem GROUP BY l_orderkey) q ON o.o_orderkey = q.l_orderkey),
det AS (
  SELECT l_orderkey AS order_id, l_partkey AS dish_id, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS price
  FROM lineitem),
dsh AS (
  SELECT p_partkey AS dish_id, p_brand AS dish_name, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price
  FROM part),
star AS (
  SELECT det.dish_id, det.order_id, det.quantity AS dish_quantity, det.price AS price_total_dish,
         ord.quantity AS order_quantity, ord.total_price AS order_total_price,
         ord.time_date, ord.time_hour, dsh.dish_name, dsh.price AS price_one_dish
  FROM det JOIN ord ON det.order_id = ord.order_id
  LEFT JOIN dsh ON det.dish_id = dsh.dish_id)"""

CONTEXT_CTE = """
ctx AS (
  SELECT time_date,
         COUNT(DISTINCT order_id) AS day_order_count_1d,
         CAST(SUM(order_quantity) AS BIGINT) AS day_total_quantity_1d,
         CAST(SUM(order_total_price) AS BIGINT) AS day_total_revenue_1d,
         COUNT(DISTINCT dish_id) AS day_order_variety_1d,
         CAST(SUM(order_quantity) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS avg_order_size_1d
  FROM star GROUP BY time_date)"""

ITEM_CTE = """
item AS (
  SELECT dish_name, time_date,
         CAST(SUM(dish_quantity) AS BIGINT) AS y_sales,
         COUNT(DISTINCT order_id) AS dish_count_in_order_1d,
         CAST(SUM(dish_quantity) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS dish_quantity_in_order_avg_1d,
         MIN(price_one_dish) AS dish_base_price,
         CAST(SUM(price_total_dish) AS BIGINT) AS dish_revenue_day_1d,
         CAST(SUM(dish_quantity) AS BIGINT) AS dish_total_quantity_1d
  FROM star WHERE dish_name IS NOT NULL GROUP BY dish_name, time_date)"""

SHARE_CTE = """
share AS (
  SELECT item.*, ctx.day_order_count_1d, ctx.day_total_quantity_1d, ctx.day_total_revenue_1d,
         ctx.day_order_variety_1d, ctx.avg_order_size_1d,
         CAST(dish_total_quantity_1d AS DOUBLE) / NULLIF(CAST(day_total_quantity_1d AS DOUBLE), 0) AS dish_sales_ratio_daily_1d,
         CAST(dish_count_in_order_1d AS DOUBLE) / NULLIF(CAST(day_order_count_1d AS DOUBLE), 0) AS dish_order_ratio_daily_1d,
         CAST(dish_revenue_day_1d AS DOUBLE) / NULLIF(CAST(day_total_revenue_1d AS DOUBLE), 0) AS dish_revenue_ratio_daily_1d,
         dish_quantity_in_order_avg_1d / NULLIF(avg_order_size_1d, 0) AS dish_order_size_ratio_1d
  FROM item LEFT JOIN ctx ON item.time_date = ctx.time_date)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _rolling_sql() -> str:
    cols, windows = [], []
    for h in HORIZONS:
        w = f"w{h}"
        windows.append(f"{w} AS (PARTITION BY dish_name ORDER BY time_date "
                       f"ROWS BETWEEN {h - 1} PRECEDING AND CURRENT ROW)")
        full = f"COUNT(*) OVER {w} = {h}"

        def ssum(c: str, cast: str = "BIGINT") -> str:
            return f"CAST(SUM({c}) OVER {w} AS {cast})"

        def strict(c: str, cast: str = "BIGINT") -> str:
            return f"CASE WHEN {full} THEN {ssum(c, cast)} ELSE 0 END"

        def ratio(n: str, d: str) -> str:
            nd = f"CAST(SUM({n}) OVER {w} AS DOUBLE)"
            dd = f"CAST(SUM({d}) OVER {w} AS DOUBLE)"
            return f"CASE WHEN {full} AND SUM({d}) OVER {w} <> 0 THEN {nd} / {dd} ELSE 0.0 END"

        cols += [
            f"{strict('day_order_count_1d')} AS day_order_count_{h}d",
            f"{strict('day_total_quantity_1d')} AS day_total_quantity_{h}d",
            f"{strict('day_total_revenue_1d')} AS day_total_revenue_{h}d",
            f"{ratio('day_total_quantity_1d', 'day_order_count_1d')} AS avg_order_size_{h}d",
            f"{strict('day_order_variety_1d')} AS day_order_variety_{h}d",
            f"{strict('dish_count_in_order_1d')} AS dish_count_in_order_{h}d",
            f"{ratio('dish_total_quantity_1d', 'dish_count_in_order_1d')} AS dish_quantity_in_order_avg_{h}d",
            f"{ratio('dish_total_quantity_1d', 'day_total_quantity_1d')} AS dish_sales_ratio_daily_{h}d",
            f"{ratio('dish_count_in_order_1d', 'day_order_count_1d')} AS dish_order_ratio_daily_{h}d",
            f"{ratio('dish_revenue_day_1d', 'day_total_revenue_1d')} AS dish_revenue_ratio_daily_{h}d",
            f"ROUND(CASE WHEN {full} THEN AVG(dish_order_size_ratio_1d) OVER {w} ELSE 0.0 END, 9) "
            f"AS dish_order_size_ratio_{h}d",
        ]
    base = ("dish_name, time_date, y_sales, dish_count_in_order_1d, dish_quantity_in_order_avg_1d, "
            "dish_base_price, "
            "dish_revenue_day_1d, dish_total_quantity_1d, "
            "day_order_count_1d, day_total_quantity_1d, "
            "day_total_revenue_1d, day_order_variety_1d, "
            "avg_order_size_1d, dish_sales_ratio_daily_1d, dish_order_ratio_daily_1d, "
            "dish_revenue_ratio_daily_1d, dish_order_size_ratio_1d")
    return (_with(STAR_CTE, CONTEXT_CTE, ITEM_CTE, SHARE_CTE)
            + f"SELECT {base},\n  " + ",\n  ".join(cols)
            + "\nFROM share\nWINDOW " + ",\n  ".join(windows))


def _strip_accents_sql(x: str) -> str:
    return (f"lower(trim(regexp_replace(regexp_replace(strip_accents({x}), '[^a-zA-Z0-9\\s]', '', 'g'), "
            f"'\\s+', ' ', 'g')))")


def _clean_bigint_sql(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?[0-9]+\\s*') "
            f"THEN coalesce(try_cast(trim({x}) AS BIGINT), 0) ELSE 0 END")


def _clean_text_sql(x: str, default: str = "unknown") -> str:
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '{default}' ELSE lower(trim({x})) END"


_DIRTY_NUMBER = """CASE o_orderkey % 8 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '   '
         WHEN 3 THEN ' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' '
         WHEN 4 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.5'
         WHEN 5 THEN '+' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
         WHEN 6 THEN '1e3'
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END"""

_DIRTY_EVENTS = """dirty_events AS (
  SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
         CASE WHEN value <= 90 THEN value END AS value,
         CASE WHEN event_type <> 'view' THEN props END AS props
  FROM events)"""

_ITEM_SALES = """sales AS (
  SELECT dsh.dish_name, CAST(SUM(det.quantity) AS BIGINT) AS total_quantity,
         CAST(SUM(det.quantity * det.price) AS BIGINT) AS total_revenue
  FROM det JOIN dsh ON det.dish_id = dsh.dish_id GROUP BY dsh.dish_name)"""

_SERIES = """series AS (SELECT time_date, dish_name, CAST(y_sales AS DOUBLE) AS prediction FROM item)"""

# The test tables name 25 brands Brand#1 .. Brand#25.
_BRANDS = [f"Brand#{i}" for i in range(1, 26)]

_LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                   ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                   ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                   ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
_NUMERIC_LINEITEM = [c for c, t in _LINEITEM_TYPES if t in ("bigint", "int", "double")]


def _profile_basic_sql() -> str:
    values = ", ".join(f"('{c}', '{t}', {i + 1})" for i, (c, t) in enumerate(_LINEITEM_TYPES))
    return (f"SELECT v.column_name, v.dtype, v.position, n.num_rows, {len(_LINEITEM_TYPES)} AS num_columns\n"
            f"FROM (VALUES {values}) v(column_name, dtype, position), "
            f"(SELECT COUNT(*) AS num_rows FROM lineitem) n")


def _profile_numeric_sql() -> str:
    cols = []
    for c in _NUMERIC_LINEITEM:
        cols += [f"MIN({c}) AS {c}_minimum", f"MAX({c}) AS {c}_maximum",
                 f"ROUND(AVG({c}), 4) AS {c}_avg", f"ROUND(STDDEV_SAMP({c}), 4) AS {c}_std"]
    return "SELECT " + ", ".join(cols) + " FROM lineitem"


def _profile_missing_sql() -> str:
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    parts = [f"SELECT '{c}' AS column_name, CASE WHEN COUNT(*) > 0 THEN "
             f"CAST((20000 * (COUNT(*) - COUNT({c})) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0 END "
             f"AS missing_pct FROM dirty_events" for c in cols]
    return _with(_DIRTY_EVENTS) + "\nUNION ALL\n".join(parts)


def _profile_cardinality_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
             f"AS BIGINT) AS n_distinct FROM dirty_events" for c in ("event_type", "props")]
    return _with(_DIRTY_EVENTS) + "\nUNION ALL\n".join(parts)


def _profile_correlation_sql() -> str:
    cols = ["c_custkey", "c_nationkey", "c_acctbal"]
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            r = f"corr(coalesce(CAST({a} AS DOUBLE), 0.0), coalesce(CAST({b} AS DOUBLE), 0.0))"
            parts.append(f"SELECT '{a}__{b}' AS pair, CASE WHEN isnan({r}) THEN NULL ELSE ROUND({r}, 6) END AS corr FROM cust")
    return ("WITH cust AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal "
            "FROM customer)\n" + "\nUNION ALL\n".join(parts))


def _pivot_sql() -> str:
    cols = ", ".join(f"FIRST(prediction) FILTER (WHERE replace(dish_name, ' ', '_') = '{b}') AS \"{b}\""
                     for b in _BRANDS)
    return (_with(STAR_CTE, ITEM_CTE, _SERIES)
            + f"SELECT time_date, {cols}, strftime(time_date, '%Y%m') AS month FROM series GROUP BY time_date")


ORACLE: dict[str, str] = {
    "star_join": _with(STAR_CTE) + """
SELECT dish_id, order_id, dish_quantity, price_total_dish,
       order_quantity, order_total_price, time_date, time_hour,
       dish_name, price_one_dish
FROM star""",
    "daily_context": _with(STAR_CTE, CONTEXT_CTE) + """
SELECT time_date, day_order_count_1d, day_total_quantity_1d,
       day_total_revenue_1d, day_order_variety_1d, avg_order_size_1d
FROM ctx""",
    "daily_item": _with(STAR_CTE, ITEM_CTE) + """
SELECT dish_name, time_date, y_sales, dish_count_in_order_1d, dish_quantity_in_order_avg_1d,
       dish_base_price,
       dish_revenue_day_1d, dish_total_quantity_1d
FROM item""",
    "daily_share": _with(STAR_CTE, CONTEXT_CTE, ITEM_CTE, SHARE_CTE) + """
SELECT time_date, dish_name, y_sales, dish_count_in_order_1d, dish_quantity_in_order_avg_1d,
       dish_base_price,
       dish_revenue_day_1d, dish_total_quantity_1d,
       day_order_count_1d, day_total_quantity_1d, day_total_revenue_1d,
       day_order_variety_1d, avg_order_size_1d, dish_sales_ratio_daily_1d, dish_order_ratio_daily_1d,
       dish_revenue_ratio_daily_1d, dish_order_size_ratio_1d
FROM share""",
    "rolling_features": _rolling_sql(),
    "chrono_split": _with(STAR_CTE, ITEM_CTE) + """
SELECT dish_name, time_date, y_sales,
       CASE WHEN rn <= FLOOR(n * 0.6::DOUBLE) THEN 'train'
            WHEN rn <= FLOOR(n * 0.6::DOUBLE) + FLOOR(n * 0.2::DOUBLE) THEN 'valid'
            ELSE 'test' END AS split
FROM (SELECT dish_name, time_date, y_sales,
             ROW_NUMBER() OVER (PARTITION BY dish_name ORDER BY time_date) AS rn,
             COUNT(*) OVER (PARTITION BY dish_name) AS n
      FROM item)""",
    "dedupe_rows": """
SELECT DISTINCT * FROM (
  SELECT * FROM orders UNION ALL SELECT * FROM orders UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, lower(o_orderpriority) FROM orders)""",
    "clean_text": f"""
WITH raw AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '   '
                    WHEN 'click' THEN '  ' || upper(event_type) || ' '
                    WHEN 'purchase' THEN chr(9) || event_type ELSE upper(event_type) END AS event_type
  FROM events)
SELECT event_id, {_clean_text_sql('event_type')} AS event_type FROM raw""",
    "clean_numeric": f"""
WITH raw AS (SELECT o_orderkey, {_DIRTY_NUMBER} AS total_price FROM orders)
SELECT o_orderkey, {_clean_bigint_sql('total_price')} AS total_price FROM raw""",
    "clean_timestamp": """
WITH raw AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN 'bad' WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts
  FROM events),
p AS (SELECT event_id, try_strptime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM raw)
SELECT event_id, ts, CAST(ts AS DATE) AS ts_date, CAST(hour(ts) AS INTEGER) AS ts_hour FROM p""",
    "strip_accents": f"SELECT doc_id, {_strip_accents_sql('text')} AS text FROM documents",
    "name_based_datetime": """
WITH raw AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate,
         CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')
              WHEN 'O' THEN strftime(o_orderdate, '%Y/%m/%d') ELSE 'pending' END AS update_time
  FROM orders)
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       strftime(coalesce(try_strptime(update_time, '%Y-%m-%d %H:%M:%S'), try_strptime(update_time, '%Y/%m/%d')),
                '%Y-%m-%d %H:%M:%S') AS update_time
FROM raw""",
    "standardize_dim": f"""
WITH raw AS (
  SELECT p_partkey AS dish_id,
         CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '  '
              ELSE ' ' || translate(upper(p_name), 'AEIOU', 'ÁÊÌÕÜ') || ' ' END AS dish_name,
         CASE WHEN p_size = 3 THEN 'abc' ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS price
  FROM part),
d AS (SELECT DISTINCT * FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw)),
t AS (SELECT dish_id, {_clean_text_sql('dish_name')} AS dish_name, {_clean_bigint_sql('price')} AS price FROM d)
SELECT dish_id, {_strip_accents_sql('dish_name')} AS dish_name, price FROM t""",
    "standardize_order": _with(STAR_CTE) + f""",
raw AS (
  SELECT ord.order_id,
         CASE WHEN o.o_orderstatus = 'P' THEN 'not a time'
              ELSE strftime(ord.time + to_hours(CAST(ord.order_id % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS time,
         CASE WHEN ord.order_id % 5 = 0 THEN '' ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) END AS total_price,
         CAST(ord.quantity AS VARCHAR) AS quantity
  FROM ord JOIN orders o ON ord.order_id = o.o_orderkey),
d AS (SELECT DISTINCT * FROM raw),
t AS (SELECT order_id, try_strptime(time, '%Y-%m-%d %H:%M:%S') AS time,
             {_clean_bigint_sql('total_price')} AS total_price, {_clean_bigint_sql('quantity')} AS quantity
      FROM d)
SELECT order_id, time, total_price, quantity, CAST(time AS DATE) AS time_date,
       CAST(hour(time) AS INTEGER) AS time_hour FROM t""",
    "orders_by_quarter": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, COUNT(*) AS count
FROM orders GROUP BY 1, 2""",
    "orders_by_month": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS count
FROM orders GROUP BY 1, 2""",
    "revenue_by_quarter": _with(STAR_CTE) + """
SELECT CAST(quarter(o.o_orderdate) AS INTEGER) AS quarter, CAST(SUM(det.quantity * det.price) AS BIGINT) AS total_revenue
FROM det JOIN orders o ON det.order_id = o.o_orderkey GROUP BY 1""",
    "revenue_by_month": _with(STAR_CTE) + """
SELECT CAST(month(o.o_orderdate) AS INTEGER) AS month, CAST(SUM(det.quantity * det.price) AS BIGINT) AS total_revenue
FROM det JOIN orders o ON det.order_id = o.o_orderkey GROUP BY 1""",
    "item_quantity_rank": _with(STAR_CTE, _ITEM_SALES) + "SELECT * FROM sales",
    "item_revenue_top10": _with(STAR_CTE, _ITEM_SALES)
    + "SELECT * FROM sales ORDER BY total_revenue DESC, dish_name LIMIT 10",
    "orders_by_slot": """
SELECT CASE WHEN hour(ts) >= 6 AND hour(ts) < 11 THEN 'Morning' WHEN hour(ts) >= 11 AND hour(ts) < 14 THEN 'Noon'
            WHEN hour(ts) >= 17 AND hour(ts) < 21 THEN 'Evening' ELSE 'Night' END AS time_slot,
       COUNT(DISTINCT event_id) AS num_orders
FROM events GROUP BY 1""",
    "distinct_days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS time_date FROM orders",
    "calendar_features": """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday
FROM orders""",
    "month_mean": _with(STAR_CTE, ITEM_CTE, _SERIES) + """
SELECT strftime(time_date, '%Y%m') AS month, dish_name, AVG(prediction) AS month_mean FROM series GROUP BY 1, 2""",
    "day_vs_month": _with(STAR_CTE, ITEM_CTE, _SERIES) + """
SELECT time_date, strftime(time_date, '%Y%m') AS month, dish_name,
       upper(left(dish_name, 1)) || lower(substr(dish_name, 2)) AS display_name, prediction,
       AVG(prediction) OVER (PARTITION BY strftime(time_date, '%Y%m'), dish_name) AS month_mean
FROM series""",
    "pivot_by_day": _pivot_sql(),
    "unpivot_by_day": _with(STAR_CTE, ITEM_CTE, _SERIES) + """
SELECT time_date, strftime(time_date, '%Y%m') AS month, replace(dish_name, ' ', '_') AS dish_name, prediction
FROM series""",
    "forecast_metrics": _with(STAR_CTE, ITEM_CTE) + """,
split AS (
  SELECT dish_name, time_date, y_sales,
         CASE WHEN rn <= FLOOR(n * 0.6::DOUBLE) THEN 'train'
              WHEN rn <= FLOOR(n * 0.6::DOUBLE) + FLOOR(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT dish_name, time_date, y_sales,
               ROW_NUMBER() OVER (PARTITION BY dish_name ORDER BY time_date) AS rn,
               COUNT(*) OVER (PARTITION BY dish_name) AS n FROM item)),
scored AS (
  SELECT *, AVG(CASE WHEN split = 'train' THEN CAST(y_sales AS DOUBLE) END) OVER (PARTITION BY dish_name) AS prediction
  FROM split)
SELECT dish_name,
       ROUND(AVG(ABS(CAST(y_sales AS DOUBLE) - prediction)), 6) AS MAE,
       ROUND(SQRT(AVG((CAST(y_sales AS DOUBLE) - prediction) * (CAST(y_sales AS DOUBLE) - prediction))), 6) AS RMSE,
       ROUND(1.0 - SUM((CAST(y_sales AS DOUBLE) - prediction) * (CAST(y_sales AS DOUBLE) - prediction))
             / NULLIF(VAR_POP(CAST(y_sales AS DOUBLE)) * COUNT(y_sales), 0), 6) AS R2
FROM scored WHERE split = 'test' GROUP BY dish_name""",
    "partitioned_roundtrip": _with(STAR_CTE, ITEM_CTE, _SERIES)
    + "SELECT time_date, dish_name, prediction, strftime(time_date, '%Y%m') AS month FROM series",
    "profile_basic": _profile_basic_sql(),
    "profile_missing": _profile_missing_sql(),
    "profile_numeric": _profile_numeric_sql(),
    "profile_cardinality": _profile_cardinality_sql(),
    "profile_correlation": _profile_correlation_sql(),
}

_SPLIT = """split AS (
  SELECT dish_name, time_date, y_sales,
         CASE WHEN rn <= FLOOR(n * 0.6::DOUBLE) THEN 'train'
              WHEN rn <= FLOOR(n * 0.6::DOUBLE) + FLOOR(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT dish_name, time_date, y_sales, ROW_NUMBER() OVER (PARTITION BY dish_name ORDER BY time_date) AS rn,
               COUNT(*) OVER (PARTITION BY dish_name) AS n FROM item))"""


def _dirty_name_sql(x: str) -> str:
    return f"CASE WHEN length({x}) % 7 = 0 THEN ' ' ELSE ' ' || translate(upper({x}), 'AEIOU', 'ÁÊÌÕÜ') END"


def _name_sql(x: str) -> str:
    return _strip_accents_sql("(" + _clean_text_sql(x) + ")")


ORACLE |= {
    "item_revenue_rank": _with(STAR_CTE, _ITEM_SALES) + "SELECT * FROM sales",
    "month_list": _with(STAR_CTE) + "SELECT DISTINCT strftime(time_date, '%Y%m') AS month FROM star WHERE dish_name IS NOT NULL",
    "month_read": ORACLE["partitioned_roundtrip"] + " WHERE strftime(time_date, '%Y%m') = '199503'",
    "day_view": f"SELECT * FROM ({ORACLE['day_vs_month']}) WHERE CAST(time_date AS DATE) = DATE '1995-03-15'",
    "item_filter": ORACLE["daily_share"] + " WHERE dish_name = 'Brand#7'",
    "feature_store_roundtrip": f"SELECT * FROM ({ORACLE['rolling_features']}) WHERE dish_name = 'Brand#7'",
    "display_name": """
SELECT p_partkey, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', ' ')
       AS display_name FROM part""",
    "grouped_number": "SELECT o_orderkey, format('{:,.1f}', o_totalprice) AS shown FROM orders",
    "metrics_with_gaps": """
WITH r AS (SELECT l_returnflag AS dish_name, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS y, l_linenumber * 5.0::DOUBLE AS p
           FROM lineitem WHERE l_orderkey % 3 <> 0)
SELECT dish_name, ROUND(AVG(ABS(y - p)), 6) AS MAE, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS RMSE,
       ROUND(1.0 - SUM((y - p) * (y - p)) / NULLIF(VAR_POP(y) * COUNT(y), 0), 6) AS R2
FROM r GROUP BY dish_name""",
    "standardize_order_typed": _with(STAR_CTE) + """
SELECT DISTINCT order_id, time + to_hours(CAST(order_id % 24 AS INTEGER)) AS time, total_price, quantity,
       CAST(time + to_hours(CAST(order_id % 24 AS INTEGER)) AS DATE) AS time_date,
       CAST(hour(time + to_hours(CAST(order_id % 24 AS INTEGER))) AS INTEGER) AS time_hour FROM ord""",
    "standardize_dish_detail": f"""
WITH raw AS (SELECT DISTINCT p_partkey AS id, p_partkey AS dish_id, CAST(p_size AS BIGINT) AS ingredient_id, {_dirty_name_sql('p_name')} AS ingredient_name,
       CASE WHEN p_size % 5 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS quantity,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE upper(p_type) END AS unit FROM part)
SELECT id, dish_id, ingredient_id, {_name_sql('ingredient_name')} AS ingredient_name, {_clean_bigint_sql('quantity')} AS quantity,
       {_clean_text_sql('unit')} AS unit FROM raw""",
    "standardize_ingredient": f"""
WITH raw AS (SELECT DISTINCT p_partkey AS id, CAST(p_size AS BIGINT) AS ingredient_id, {_dirty_name_sql('p_name')} AS ingredient_name FROM part)
SELECT id, ingredient_id, {_name_sql('ingredient_name')} AS ingredient_name FROM raw""",
    "standardize_order_detail": f"""
WITH raw AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS dish_id,
       {_dirty_name_sql('l_linestatus')} AS dish_name, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
       CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS price FROM lineitem)
SELECT id, order_id, dish_id, {_name_sql('dish_name')} AS dish_name, {_clean_bigint_sql('quantity')} AS quantity,
       {_clean_bigint_sql('price')} AS price FROM raw""",
    "datetime_layouts": """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 2) THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
       WHEN o_orderkey % 8 < 7 THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%d 00:00:00') END AS update_time
FROM orders""",
    "feature_matrix": _with(STAR_CTE, ITEM_CTE, _SPLIT) + """
SELECT split, CAST(60 AS BIGINT) AS inputs, COUNT(*) AS rows, CAST(SUM(y_sales) AS BIGINT) AS target FROM split GROUP BY split""",
    "forecast_predict_coverage": _with(STAR_CTE, ITEM_CTE) + """
SELECT dish_name, COUNT(*) AS rows, MIN(time_date) AS first_day, MAX(time_date) AS last_day, COUNT(*) AS scored FROM item GROUP BY dish_name""",
    "item_models": _with(STAR_CTE, ITEM_CTE, _SPLIT) + """
SELECT dish_name, COUNT(*) FILTER (WHERE split = 'train') AS train_rows, COUNT(*) FILTER (WHERE split = 'valid') AS valid_rows,
       COUNT(*) FILTER (WHERE split = 'test') AS test_rows, TRUE AS listed, TRUE AS stopped_as_due, TRUE AS cut_at_best, COUNT(*) AS scored
FROM split GROUP BY dish_name""",
    "forecast_by_month": _with(STAR_CTE, ITEM_CTE) + """
SELECT strftime(time_date, '%Y%m') AS month, COUNT(DISTINCT time_date) AS days, COUNT(*) AS cells, COUNT(DISTINCT time_date) AS rows,
       strftime(time_date, '%Y%m') <> (SELECT strftime(MAX(time_date), '%Y%m') FROM item) AS untouched
FROM item GROUP BY ALL""",
    "day_first_row": _with(STAR_CTE) + """,
timed AS (SELECT dish_name, CAST(time_date AS TIMESTAMP) + to_hours(CAST(order_id % 24 AS INTEGER)) AS time_date, CAST(dish_quantity AS DOUBLE) AS prediction
          FROM star WHERE dish_name IS NOT NULL),
means AS (SELECT *, strftime(time_date, '%Y%m') AS month, AVG(prediction) OVER (PARTITION BY strftime(time_date, '%Y%m'), dish_name) AS month_mean FROM timed)
SELECT time_date, month, dish_name,
       list_aggregate(list_transform(string_split(replace(dish_name, '_', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', ' ') AS display_name,
       prediction, ROUND(month_mean, 9) AS month_mean
FROM means QUALIFY ROW_NUMBER() OVER (PARTITION BY dish_name, CAST(time_date AS DATE) ORDER BY time_date, prediction) = 1""",
    "profile_by_state": "WITH l AS (SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity) FROM lineitem)\n" + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS minimum, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS maximum,
       ROUND(AVG({c}) + 0.0000137, 4) AS avg, ROUND(STDDEV_SAMP({c}) + 0.0000137, 4) AS std, COUNT(*) - COUNT({c}) AS missing FROM l""" for c in _NUMERIC_LINEITEM),
    "feature_store_by_days": _rolling_sql(),
    "csv_inferred": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority, CAST(NULL AS VARCHAR) AS _bad_row FROM orders",
    "dedupe_wide": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
    "cardinality_by_sketch": """
SELECT 'o_orderstatus' AS column_name, count(DISTINCT o_orderstatus) AS n_distinct, true AS within_5_percent FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), true FROM orders
UNION ALL SELECT 'customer', count(DISTINCT o_custkey), true FROM orders""",
    "replace_table": """
SELECT DISTINCT p_partkey, CASE WHEN trim(p_name) = '' THEN 'unknown' ELSE lower(trim(p_name)) END AS p_name, p_size
FROM (SELECT p_partkey, '  ' || upper(p_name) AS p_name, p_size FROM part UNION ALL SELECT p_partkey, p_name, p_size FROM part)""",
}

# The inputs of a model in order, and the first split of boosting over the train rows of each item.
_INPUTS = ([c for c in ITEM_1D + CONTEXT_1D + SHARE_1D if c != "y_sales"]
           + [f"{c}_{h}d" for h in HORIZONS for c in ("day_order_count", "day_total_quantity", "day_total_revenue", "avg_order_size", "day_order_variety",
                                                      "dish_count_in_order", "dish_quantity_in_order_avg", "dish_sales_ratio_daily", "dish_order_ratio_daily",
                                                      "dish_revenue_ratio_daily", "dish_order_size_ratio")]
           + ["month", "day_of_year"])
_is_ratio = lambda c: "ratio" in c or "avg" in c
_BINS = 64  # fixed value: bins of a feature within an item

_INPUT_ROWS = f"""WITH store AS ({_rolling_sql()}),
input AS (SELECT store.*, CAST(month(time_date) AS BIGINT) AS month, CAST(dayofyear(time_date) AS BIGINT) AS day_of_year,
  ROW_NUMBER() OVER (PARTITION BY dish_name ORDER BY time_date) AS rn, COUNT(*) OVER (PARTITION BY dish_name) AS n FROM store),
split AS (SELECT *, CASE WHEN rn <= FLOOR(n * 0.6::DOUBLE) THEN 'train'
  WHEN rn <= FLOOR(n * 0.6::DOUBLE) + FLOOR(n * 0.2::DOUBLE) THEN 'valid' ELSE 'test' END AS split FROM input)"""

_FIRST_SPLIT = _INPUT_ROWS + f""",
cells AS (SELECT dish_name, time_date, split, CAST(y_sales AS DOUBLE) AS y, unnest(range(1, {len(_INPUTS) + 1})) AS f,
  unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in _INPUTS)}]) AS x FROM split),
start AS (SELECT dish_name, AVG(y) AS base, COUNT(*) AS n FROM cells WHERE split = 'train' AND f = 1 GROUP BY dish_name),
steps AS (SELECT dish_name, f, x, COUNT(*) AS rows, SUM(y) AS total FROM cells WHERE split = 'train' GROUP BY ALL),
sums AS (SELECT *, SUM(rows) OVER w AS left_rows, SUM(total) OVER w AS left_total, LEAD(x) OVER (PARTITION BY dish_name, f ORDER BY x) AS next_x,
  COUNT(*) OVER (PARTITION BY dish_name, f) AS kinds, LEAD(x, 2) OVER (PARTITION BY dish_name, f ORDER BY x) IS NULL AS is_last
  FROM steps WINDOW w AS (PARTITION BY dish_name, f ORDER BY x)),
cuts AS (SELECT s.dish_name, s.f, (x + next_x) / 2 AS cut, left_rows, b.n - left_rows AS right_rows,
  left_rows * base - left_total AS left_g, (b.n * base - SUM(s.total) OVER (PARTITION BY s.dish_name, s.f)) - (left_rows * base - left_total) AS right_g, next_x,
  kinds <= {_BINS} OR least({_BINS - 1}, {_BINS} * left_rows // n) > least({_BINS - 1}, {_BINS} * (left_rows - rows) // n)
  OR (is_last AND {_BINS} * left_rows // n < {_BINS - 1}) AS is_cut FROM sums s JOIN start b USING (dish_name)),
gains AS (SELECT *, left_g * left_g / (left_rows + 1) + right_g * right_g / (right_rows + 1) AS gain FROM cuts WHERE next_x IS NOT NULL AND is_cut),
best AS (SELECT * FROM (SELECT *, MAX(gain) OVER (PARTITION BY dish_name) AS top FROM gains) WHERE gain >= top - 1e-9 * greatest(1.0, abs(top))
  QUALIFY ROW_NUMBER() OVER (PARTITION BY dish_name ORDER BY f, cut) = 1)"""

ORACLE |= {
    "boost_first_split": _FIRST_SPLIT + f"""
SELECT dish_name, [{', '.join(f"'{c}'" for c in _INPUTS)}][f] AS feature, ROUND(cut, 6) AS cut, ROUND(-left_g / (left_rows + 1), 6) AS left_value,
       ROUND(-right_g / (right_rows + 1), 6) AS right_value, CAST(left_rows AS BIGINT) AS left_rows, CAST(right_rows AS BIGINT) AS right_rows FROM best""",
    "forecast_model_metrics": _FIRST_SPLIT + """,
scored AS (SELECT c.dish_name, c.y, s.base + CASE WHEN c.x < b.cut THEN -b.left_g / (b.left_rows + 1) ELSE -b.right_g / (b.right_rows + 1) END AS p
  FROM cells c JOIN best b ON b.dish_name = c.dish_name AND b.f = c.f JOIN start s ON s.dish_name = c.dish_name WHERE c.split = 'test')
SELECT dish_name, ROUND(AVG(ABS(y - p)), 6) AS MAE, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS RMSE,
       ROUND(1.0 - SUM((y - p) * (y - p)) / NULLIF(VAR_POP(y) * COUNT(y), 0), 6) AS R2 FROM scored GROUP BY dish_name""",
    "feature_vectors": _INPUT_ROWS + f"""
SELECT dish_name, time_date, split, y_sales, CAST({len(_INPUTS)} AS BIGINT) AS inputs,
       CAST({' + '.join(f'CAST({c} AS BIGINT) * {i}' for i, c in enumerate(_INPUTS, 1) if not _is_ratio(c))} AS BIGINT) AS whole,
       ROUND({' + '.join(f'CAST({c} AS DOUBLE) * {i}' for i, c in enumerate(_INPUTS, 1) if _is_ratio(c))} + 0.0137, 1) AS ratios FROM split""",
}

ORACLE["parquet_roundtrip"] = ORACLE["standardize_dim"]
ORACLE["csv_roundtrip"] = ORACLE["standardize_dim"]
ORACLE["stream_clean_text"] = ORACLE["clean_text"]
