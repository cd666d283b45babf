"""The SQL that each query must agree with, over the same tables.

Column names, rounding and text forms follow ``queries.py``. Of what depends on a
random seed (k-means, samples), the queries tell what holds for any seed.
"""

from __future__ import annotations

_TURN = "2 * pi() / 365"
_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
_DECADE = f"({_YEAR} - {_YEAR} % 10)"

# The sales star ------------------------------------------------------------

_WEEKLY_CONSUMPTION = """
SELECT concat_ws('_', 'Y' || year(l_shipdate) % 1000,
                 'W' || (((dayofyear(l_shipdate) - 1) // 7) % 13 + 1),
                 r_name, p_type, left(p_type, 3), lower(p_type)) AS id,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS sales_units,
       round(sum(l_extendedprice), 2) AS net_sales
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
GROUP BY year(l_shipdate), ((dayofyear(l_shipdate) - 1) // 7) % 13, r_name, p_type
"""

_REPORT_WEEK = "(dayofyear(l_shipdate) - 1) // 7 + 1"
_REPORT_COLUMNS = [(f"W{n}", f"week = {n}") for n in range(1, 53)] + [("W_other", "week > 52")]


def _report_rows(row_id: str, measure: str) -> str:
    weeks = ", ".join(
        f"round(coalesce(sum({measure}) FILTER ({one}), 0), 2) AS {name}"
        for name, one in _REPORT_COLUMNS
    )
    return f"""
SELECT concat_ws('_', year, channel, division, gender, category) AS unique_key,
       year, channel, division, gender, category, '{row_id}' AS row_id, {weeks}
FROM keyed GROUP BY year, channel, division, gender, category
"""


_REPORT_SALES = f"""
  SELECT 'RY' || CAST(year(l_shipdate) % 1000 AS VARCHAR) AS year, upper(r_name) AS channel,
         p_type AS division, split_part(p_name, ' ', 1) AS gender,
         split_part(p_name, ' ', 2) AS category, {_REPORT_WEEK} AS week,
         l_extendedprice AS net, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS units
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
"""

_WEEKLY_REPORT = f"""
WITH keyed AS ({_REPORT_SALES})
{_report_rows("Net Sales", "net")}
UNION ALL
{_report_rows("Sales Units", "units")}
"""

_WEEKS_JSON = " || ',' || ".join(f"""'"{name}":' || {name}""" for name, _ in _REPORT_COLUMNS)

_WEEKLY_DOCUMENTS = f"""
WITH report AS ({_WEEKLY_REPORT}),
data_rows AS (
  SELECT *, '{{"rowId":"' || row_id || '","dataRow":{{' || {_WEEKS_JSON} || '}}}}' AS data_row
  FROM report)
SELECT '{{"uniqueKey":"' || unique_key || '","division":"' || any_value(division)
       || '","gender":"' || any_value(gender) || '","category":"' || any_value(category)
       || '","channel":"' || any_value(channel) || '","year":"' || any_value(year)
       || '","dataRows":[' || string_agg(data_row, ',' ORDER BY row_id) || ']}}' AS value
FROM data_rows GROUP BY unique_key
"""

# Stations ------------------------------------------------------------------

_STATION_TEMPERATURE = """
WITH means AS (
  SELECT user_id, avg((hi.value + lo.value) / 20 * 1.8 + 32) AS tave
  FROM (SELECT user_id, CAST(ts AS DATE) AS d, value FROM events WHERE event_type = 'view') hi
  JOIN (SELECT user_id, CAST(ts AS DATE) AS d, value FROM events
        WHERE event_type = 'purchase') lo USING (user_id, d)
  GROUP BY user_id)
SELECT CAST(c_custkey AS VARCHAR) AS sid, round(tave, 8) AS tave,
       round(c_acctbal / 100, 8) AS lat, CAST(c_nationkey AS DOUBLE) AS lon, c_name AS name
FROM means JOIN customer ON user_id = c_custkey
"""

def _climate_profile(num: str, lat: str, lon: str) -> str:
    return f"""
WITH rows_ AS (
  SELECT {num}, {lat} AS lat, CAST({lon} AS DOUBLE) AS lon,
         left(o_orderpriority, 1) AS p, o_totalprice AS v,
         sin(dayofyear(o_orderdate) * {_TURN}) AS s, cos(dayofyear(o_orderdate) * {_TURN}) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey),
stats AS (
  SELECT num, count(*) AS observations, avg(lat) AS lat, avg(lon) AS lon,
         stddev_samp(lat) AS latstd, stddev_samp(lon) AS lonstd,
         avg(v) FILTER (p = '1') AS tmax, avg(v) FILTER (p = '2') AS tmin,
         stddev_samp(v) FILTER (p = '1') AS tmaxstd, stddev_samp(v) FILTER (p = '2') AS tminstd,
         avg(v) FILTER (p = '3') AS precip,
         var_pop(s) FILTER (p = '1') AS hs, var_pop(c) FILTER (p = '1') AS hc,
         covar_pop(s, c) FILTER (p = '1') AS hsc,
         covar_pop(s, v) FILTER (p = '1') AS hsv, covar_pop(c, v) FILTER (p = '1') AS hcv,
         var_pop(s) FILTER (p = '2') AS ls, var_pop(c) FILTER (p = '2') AS lc,
         covar_pop(s, c) FILTER (p = '2') AS lsc,
         covar_pop(s, v) FILTER (p = '2') AS lsv, covar_pop(c, v) FILTER (p = '2') AS lcv
  FROM rows_ GROUP BY num
  HAVING count(*) FILTER (p = '1') >= 20 AND count(*) FILTER (p = '2') >= 20
     AND count(*) FILTER (p = '3') >= 3)
SELECT num, observations, round(lat, 3) AS lat, round(lon, 3) AS lon, round(latstd, 3) AS latstd,
       round(lonstd, 3) AS lonstd, round(tmax, 3) AS tmax, round(tmin, 3) AS tmin,
       round(tmaxstd, 3) AS tmaxstd, round(tminstd, 3) AS tminstd, round(precip, 3) AS precip,
       round(sqrt(pow((hsv * hc - hcv * hsc) / (hs * hc - hsc * hsc), 2)
                + pow((hcv * hs - hsv * hsc) / (hs * hc - hsc * hsc), 2)), 3)
         AS tmax_seasonal_var,
       round(sqrt(pow((lsv * lc - lcv * lsc) / (ls * lc - lsc * lsc), 2)
                + pow((lcv * ls - lsv * lsc) / (ls * lc - lsc * lsc), 2)), 3)
         AS tmin_seasonal_var
FROM stats
"""


_CLIMATE_PROFILE = _climate_profile("c_nationkey AS num", "c_acctbal", "c_custkey")
_WHOLE_PROFILE = f"""
SELECT observations, * EXCLUDE (num, observations)
FROM ({_climate_profile("0 AS num", "c_acctbal / 100", "c_nationkey")})
"""

_MOMENTS = f"""
  SELECT *, sin(dayofyear(o_orderdate) * {_TURN}) AS s,
         cos(dayofyear(o_orderdate) * {_TURN}) AS c, o_totalprice AS v
  FROM orders
"""


def _fits(keys: str) -> str:
    return f"""
  SELECT {keys}, ms, mc, mv, (sv * vc - cv * sc) / (vs * vc - sc * sc) AS b1,
         (cv * vs - sv * sc) / (vs * vc - sc * sc) AS b2
  FROM (SELECT {keys}, var_pop(s) AS vs, var_pop(c) AS vc, covar_pop(s, c) AS sc,
               covar_pop(s, v) AS sv, covar_pop(c, v) AS cv,
               avg(s) AS ms, avg(c) AS mc, avg(v) AS mv
        FROM ({_MOMENTS}) GROUP BY {keys})
"""


# Labour series -------------------------------------------------------------

_MAX_DECADE = f"""
WITH means AS (
  SELECT o_custkey, {_DECADE} AS decade, avg(o_totalprice) AS mean
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
best AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY mean DESC, decade) AS rn
  FROM means)
SELECT CAST(c_custkey AS VARCHAR) AS area_code, n_name AS area_text, c_name AS title,
       decade, round(mean, 6) AS mean
FROM best JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE rn = 1
"""

_COUNTY_RATES = f"""
WITH placed AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
counties AS (
  SELECT n_name AS county, right(c_name, 1) AS state,
         avg(c_acctbal) AS lat, avg(CAST(c_custkey AS DOUBLE)) AS lon
  FROM placed GROUP BY ALL),
titled AS (SELECT c_custkey, c_name || ' ' || n_name AS title FROM placed)
SELECT CAST(o_custkey AS VARCHAR) AS id, {_YEAR} AS year, 'M10' AS period,
       o_totalprice AS value, title, round(lat, 4) AS lat, round(lon, 4) AS lon, state, county
FROM orders JOIN titled ON o_custkey = c_custkey
JOIN counties ON contains(title, county) AND contains(title, state)
WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 10
  AND suffix(CAST(o_custkey AS VARCHAR), '3')
"""

# Daily weather -------------------------------------------------------------

_DAYS = """
  SELECT CAST(dayofmonth(o_orderdate) AS INTEGER) AS day,
         CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
         CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
         (o_orderkey % 40) / 10 AS precip, CAST(-1 AS DOUBLE) AS snow,
         (tmax + (tmax - o_custkey % 20)) / 2 AS tave, tmax, tmax - o_custkey % 20 AS tmin
  FROM (SELECT *, round(o_totalprice / 100) AS tmax FROM orders)
"""

_DAILY_STATISTICS = f"""
WITH days AS ({_DAYS}),
hottest AS (
  SELECT * FROM days
  ORDER BY tmax DESC, year, doy, day DESC, month DESC, precip DESC, tave DESC, tmin DESC LIMIT 1)
SELECT hottest.*, stats.* FROM hottest, (
  SELECT count(*) FILTER (precip >= 1) AS rainy_days,
         round(100.0 * count(*) FILTER (precip >= 1) / count(*), 4) AS rainy_percent,
         round(avg(tmax) FILTER (precip >= 1), 4) AS rainy_tmax,
         round(stddev_pop(tmax), 4) AS tmax_std, round(stddev_pop(tmin), 4) AS tmin_std,
         round(stddev_pop(tave), 4) AS tave_std
  FROM days) stats
"""

_LENIENT = """
SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
       o_orderstatus = 'P' AS bad_row
FROM orders
"""

ORACLES: dict[str, str] = {
    "weekly_consumption": _WEEKLY_CONSUMPTION,
    "weekly_consumption_sql": _WEEKLY_CONSUMPTION,
    "weekly_report_pivot": _WEEKLY_REPORT,
    "weekly_report_documents": _WEEKLY_DOCUMENTS,
    "station_temperature": _STATION_TEMPERATURE,
    "station_temperature_sql": _STATION_TEMPERATURE,
    "station_temperature_first": """
        WITH hi AS (
          SELECT user_id, CAST(ts AS DATE) AS d, value FROM events WHERE event_type = 'view'
          ORDER BY CAST(user_id AS VARCHAR), d, value LIMIT 1500),
        lo AS (
          SELECT user_id, CAST(ts AS DATE) AS d, value FROM events WHERE event_type = 'purchase'
          ORDER BY CAST(user_id AS VARCHAR), d, value LIMIT 1500),
        means AS (
          SELECT user_id, avg((hi.value + lo.value) / 20 * 1.8 + 32) AS tave
          FROM hi JOIN lo USING (user_id, d) GROUP BY user_id)
        SELECT CAST(c_custkey AS VARCHAR) AS sid, round(tave, 8) AS tave,
               round(c_acctbal / 100, 8) AS lat, CAST(c_nationkey AS DOUBLE) AS lon, c_name AS name
        FROM means JOIN customer ON user_id = c_custkey
    """,
    "cluster_climate_profile": f"SELECT * EXCLUDE (observations) FROM ({_CLIMATE_PROFILE})",
    "station_cluster_profile": _WHOLE_PROFILE,
    "max_decade_by_area": _MAX_DECADE,
    "county_rates_located": _COUNTY_RATES,
    "daily_statistics_report": _DAILY_STATISTICS,
    # Sources and sinks
    "scan_csv_schema": """
        SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_totalprice AS price
        FROM orders
    """,
    "scan_csv_lenient": _LENIENT,
    "parse_lenient": _LENIENT,
    "scan_csv_cast": "SELECT o_orderkey, o_totalprice FROM orders",
    "scan_csv_dates": """
        SELECT CAST(user_id AS VARCHAR) AS sid, strftime(ts, '%Y-%m-%d') AS date,
               event_type AS measure, value
        FROM events
    """,
    "scan_tsv": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS id, {_YEAR} AS year,
               strftime(o_orderdate, 'M%m') AS period, o_totalprice AS value
        FROM orders
    """,
    "parse_fixed_width": """
        SELECT 'US' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS sid,
               round(c_acctbal / 100, 4) AS lat,
               CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon,
               CAST(c_nationkey AS DOUBLE) * 10.5 AS elev, rpad(c_name, 30, ' ') AS name
        FROM customer
    """,
    "parse_delimited": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, {_YEAR} AS year,
               CAST(month(o_orderdate) AS INTEGER) AS period, o_totalprice AS value
        FROM orders
    """,
    "parse_missing_markers": """
        SELECT event_id AS id, CASE WHEN event_type = 'signup' THEN -1.0 ELSE value END AS precip,
               value AS tmax, CAST(user_id AS DOUBLE) AS tmin
        FROM events WHERE event_type NOT IN ('error', 'click')
    """,
    "sink_json_roundtrip": "SELECT * FROM customer",
    "sink_text_roundtrip": """
        SELECT CAST(c_custkey AS VARCHAR) || ', ' || c_name || ', ' || c_mktsegment AS value
        FROM customer
    """,
    # Projections and filters
    "project_columns": """
        SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity AS sales_units FROM lineitem
    """,
    "project_computed": """
        SELECT l_orderkey, round((l_quantity + l_extendedprice) / 20 * 1.8 + 32, 4) AS tave,
               l_linenumber * 10 AS l_linenumber
        FROM lineitem
    """,
    "filter_equality": "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'",
    "filter_conjunction": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE suffix(CAST(o_orderkey AS VARCHAR), '3') AND o_orderstatus = 'F'
          AND o_orderpriority = '1-URGENT'
    """,
    "filter_not_null": """
        SELECT o_orderkey, o_orderstatus AS known_status FROM orders WHERE o_orderstatus <> 'P'
    """,
    # Joins
    "join_equi": """
        SELECT o_orderkey, o_custkey, c_name, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "join_using": """
        SELECT o_custkey AS custkey, o_orderkey, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "join_using_two_keys": """
        SELECT user_id, strftime(d, '%Y-%m-%d') AS date, round(viewed, 4) AS viewed,
               round(purchased, 4) AS purchased
        FROM (SELECT user_id, CAST(ts AS DATE) AS d, sum(value) AS viewed
              FROM events WHERE event_type = 'view' GROUP BY ALL)
        JOIN (SELECT user_id, CAST(ts AS DATE) AS d, sum(value) AS purchased
              FROM events WHERE event_type = 'purchase' GROUP BY ALL) USING (user_id, d)
    """,
    "join_nested_pair": """
        SELECT o_orderkey, o_totalprice, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "join_contains": """
        WITH parts AS (
          SELECT *, split_part(p_name, ' ', 1) AS word, p_name || ' ' || p_brand AS title
          FROM part),
        groups_ AS (
          SELECT word, p_brand AS brand, round(avg(p_retailprice), 4) AS price
          FROM parts GROUP BY ALL)
        SELECT p_partkey, title, g.word, g.brand, g.price
        FROM parts p JOIN groups_ g ON contains(p.title, g.word) AND contains(p.title, g.brand)
    """,
    # Aggregations
    "avg_by_key": """
        SELECT o_custkey, round(avg(o_totalprice), 6) AS mean_price FROM orders GROUP BY ALL
    """,
    "sum_round_by_keys": """
        SELECT l_suppkey, l_returnflag, l_linestatus,
               CAST(sum(l_linenumber) AS BIGINT) AS units, round(sum(l_extendedprice), 2) AS net
        FROM lineitem GROUP BY ALL
    """,
    "avg_by_two_keys": f"""
        SELECT o_custkey, {_DECADE} AS decade, round(avg(o_totalprice), 6) AS mean_price,
               round(avg(o_orderkey), 6) AS mean_key
        FROM orders GROUP BY ALL
    """,
    "sum_count_by_key": f"""
        SELECT {_YEAR} AS year, round(sum(o_totalprice), 2) AS tmax_sum,
               count(*) AS day_count, round(avg(o_totalprice), 2) AS tmax_mean
        FROM orders GROUP BY ALL
    """,
    "argmax_by_key": f"""
        SELECT o_custkey, decade, round(mean, 6) AS mean
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY mean DESC, decade) AS rn
              FROM (SELECT o_custkey, {_DECADE} AS decade, avg(o_totalprice) AS mean
                    FROM orders GROUP BY ALL))
        WHERE rn = 1
    """,
    "rows_at_max": f"""
        SELECT o_orderkey, {_YEAR} AS year, o_orderpriority FROM orders
        WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
    """,
    "argmax_row": """
        SELECT event_id, user_id, event_type, value FROM events
        ORDER BY value DESC, event_id LIMIT 1
    """,
    "conditional_share": """
        SELECT count(*) FILTER (value >= 100) AS large,
               round(100.0 * count(*) FILTER (value >= 100) / count(*), 6) AS percent
        FROM events
    """,
    "conditional_avg": """
        SELECT round(avg(value) FILTER (value >= 100), 4) AS large_mean,
               round(avg(value) FILTER (value < 0), 4) AS none_mean
        FROM events
    """,
    "stddev_population": """
        SELECT round(stddev_pop(value), 4) AS value_std, round(stddev_pop(user_id), 4) AS user_std
        FROM events
    """,
    "mean_stddev_sample": """
        SELECT round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std FROM events
    """,
    "monthly_averages": f"""
        SELECT month, round(avg(tmax), 4) AS tmax, round(avg(tmin), 4) AS tmin
        FROM ({_DAYS}) GROUP BY ALL
    """,
    "having_min_counts": """
        SELECT c_nationkey, count(*) FILTER (o_orderstatus = 'F') AS "n_F",
               count(*) FILTER (o_orderstatus = 'O') AS "n_O",
               count(*) FILTER (o_orderstatus = 'P') AS "n_P"
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
        HAVING "n_F" >= 190 AND "n_O" >= 190 AND "n_P" >= 190
    """,
    # Limits
    "limit_before_join": """
        SELECT o_orderkey, o_totalprice, c_name
        FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000)
        JOIN customer ON o_custkey = c_custkey
    """,
    "first_rows_before_join": """
        SELECT o_orderkey, o_totalprice, c_name
        FROM (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10000)
        JOIN customer ON o_custkey = c_custkey
    """,
    "sorted_positions": """
        SELECT o_orderkey, o_totalprice,
               row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position
        FROM orders
    """,
    "monthly_positions": f"""
        SELECT row_number() OVER (ORDER BY month) AS position, month, round(avg(tmax), 4) AS tmax
        FROM ({_DAYS}) GROUP BY month
    """,
    "top_n": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """,
    "sample_rows": """
        SELECT CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS repeated, true AS size_as_asked
    """,
    "sample_rows_by_key": """
        SELECT event_id, user_id, event_type FROM events
        WHERE CAST('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)
              < CAST(floor(0.1 * 4294967296) AS BIGINT)
    """,
    # Scalar functions
    "fn_string": """
        SELECT c_custkey, c_name || '_x_' || c_mktsegment AS joined, c_mktsegment AS trimmed,
               substring(c_name, 4, length(c_name) - 5) AS middle,
               substring(c_name, 3, 7) AS piece,
               'Y' || CAST((c_nationkey + 1990) % 1000 AS VARCHAR) || '_W'
                 || CAST(c_custkey % 13 + 1 AS VARCHAR) AS week
        FROM customer
    """,
    "fn_cast": """
        SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS as_int,
               CAST(o_orderkey AS VARCHAR) AS as_text, o_totalprice AS as_double,
               CASE WHEN o_orderstatus = 'P' THEN -1.0 ELSE o_totalprice END AS or_default
        FROM orders
    """,
    "fn_math": f"""
        SELECT o_orderkey, {_YEAR} % 1000 AS short_year, {_DECADE} AS decade,
               round(sin(dayofyear(o_orderdate) * {_TURN}), 8) AS sine,
               round(cos(dayofyear(o_orderdate) * {_TURN}), 8) AS cosine,
               round(sqrt(o_totalprice), 6) AS root,
               round((o_totalprice - 32) * 5 / 9 + 1, 4) AS scaled
        FROM orders
    """,
    "fn_date": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact,
               CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
               strftime(o_orderdate, '%Y-%m-%d') AS date
        FROM orders
    """,
    # Features, clusters and fits
    "assemble_features": """
        SELECT c_custkey, c_acctbal AS x0, CAST(c_nationkey AS DOUBLE) AS x1 FROM customer
    """,
    "kmeans_fit": """
        SELECT count(*) AS stations, CAST(0 AS BIGINT) AS "without", CAST(0 AS BIGINT) AS misplaced
        FROM customer
    """,
    "kmeans_assign_many": """
        WITH points AS (SELECT c_custkey, c_acctbal AS x, c_custkey * 7 % 1000 AS y FROM customer),
        centers AS (
          SELECT c_custkey AS cluster, x + 1.5 AS x, y + CAST(0.5 AS DOUBLE) AS y FROM points
          WHERE c_custkey % 2 = 0)
        SELECT c_custkey, arg_min(cluster, {
                 'd': (p.x - k.x) * (p.x - k.x) + (p.y - k.y) * (p.y - k.y), 'c': cluster}) AS cluster
        FROM points p CROSS JOIN centers k GROUP BY c_custkey
    """,
    "kmeans_assign": """
        WITH centers AS (
          SELECT c_nationkey, round(avg(c_acctbal), 4) AS c_acctbal FROM customer GROUP BY 1),
        ranked AS (
          SELECT p.c_custkey, k.c_nationkey AS cluster, row_number() OVER (
                   PARTITION BY p.c_custkey
                   ORDER BY (p.c_acctbal - k.c_acctbal) * (p.c_acctbal - k.c_acctbal)
                          + (p.c_nationkey - k.c_nationkey) * (p.c_nationkey - k.c_nationkey),
                            k.c_nationkey) AS rn
          FROM customer p CROSS JOIN centers k)
        SELECT c_custkey, cluster FROM ranked WHERE rn = 1
    """,
    "linear_fit_by_group": f"""
        SELECT o_orderpriority, round(mv - b1 * ms - b2 * mc, 4) AS intercept,
               round(b1, 4) AS b1, round(b2, 4) AS b2
        FROM ({_fits("o_orderpriority")})
    """,
    "seasonal_amplitude": f"""
        SELECT o_orderstatus, o_orderpriority, round(sqrt(b1 * b1 + b2 * b2), 4) AS amplitude
        FROM ({_fits("o_orderstatus, o_orderpriority")})
    """,
}
