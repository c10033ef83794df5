"""The same results in SQL, written against the tables and not after the Spark code."""

from __future__ import annotations

from aqlake.feeds import AVERAGED_MEASURES, POLLUTANTS
from checks.queries import CITY, DAY

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _readings(value: str = "value", events: str = "events") -> str:
    """CTEs ``r`` (a reading per hour and user, with the place) and ``w`` (the wide table)."""
    return f"""
WITH r AS (
  SELECT date_trunc('hour', ts) AS record_ts, user_id,
    CAST(count(*) AS INTEGER) AS n,
    max(CASE WHEN event_type = 'click' THEN {value} END) AS click,
    max(CASE WHEN event_type = 'view' THEN {value} END) AS view_,
    max(CASE WHEN event_type = 'purchase' THEN {value} END) AS purchase,
    max(CASE WHEN event_type = 'signup' THEN {value} END) AS signup,
    max(CASE WHEN event_type = 'error' THEN {value} END) AS error_,
    min({value}) AS low, max({value}) AS high,
    min({_K}) AS k_low, max({_K}) AS k_high, min(event_type) AS first_type
  FROM {events} GROUP BY 1, 2),
p AS (
  SELECT r.*, c_acctbal AS lat, CAST(c_custkey AS DOUBLE) AS lon
  FROM r JOIN customer ON user_id = c_custkey),
l AS (
  SELECT p.*, CASE greatest(click, view_, purchase, signup, error_, high, low)
    WHEN click THEN 'NO' WHEN view_ THEN 'NO2' WHEN purchase THEN 'O3' WHEN signup THEN 'SO2'
    WHEN error_ THEN 'PM2_5' WHEN high THEN 'PM10' ELSE 'NH3' END AS prominent
  FROM p),
w AS (
  SELECT CAST(record_ts AS TIMESTAMP) AS record_ts,
    CAST(year(record_ts) AS INTEGER) AS meas_year, CAST(quarter(record_ts) AS INTEGER) AS meas_quarter,
    CAST(month(record_ts) AS INTEGER) AS meas_month, CAST(day(record_ts) AS INTEGER) AS meas_day,
    CAST(hour(record_ts) AS INTEGER) AS meas_hour,
    c.c_name AS city, c.c_nationkey AS population, lat, lon, n AS aqi,
    CAST(k_high AS DOUBLE) AS co, click AS no, view_ AS no2, purchase AS o3, signup AS so2,
    error_ AS pm2_5, high AS pm10, low AS nh3, prominent AS prominent_pollutant,
    first_type AS weather_con, low AS temp, high AS feels_like, low AS min_temp, high AS max_temp,
    CAST(k_low AS DOUBLE) AS pressure, CAST(k_high AS DOUBLE) AS humidity, k_low AS visibility,
    high / 2 AS wind_speed, CAST(round(high) AS INTEGER) AS wind_deg, n AS clouds
  FROM l LEFT JOIN customer c
    ON left(CAST(lat AS VARCHAR), 5) = left(CAST(c.c_acctbal AS VARCHAR), 5)
   AND left(CAST(lon AS VARCHAR), 5) = left(CAST(CAST(c.c_custkey AS DOUBLE) AS VARCHAR), 5)
  WHERE coalesce(click, view_, purchase) IS NOT NULL)"""


_W = _readings()
_EXACT = _W.replace(
    """left(CAST(lat AS VARCHAR), 5) = left(CAST(c.c_acctbal AS VARCHAR), 5)
   AND left(CAST(lon AS VARCHAR), 5) = left(CAST(CAST(c.c_custkey AS DOUBLE) AS VARCHAR), 5)""",
    "lat = c.c_acctbal AND lon = c.c_custkey",
)
# Hours with a high value were delivered again with rounded values.
_CORRECTED = """(SELECT event_id, ts, user_id, event_type, props,
    CASE WHEN max(value) OVER (PARTITION BY date_trunc('hour', ts)) >= 99 THEN round(value) ELSE value END AS value
  FROM events)"""
_W2 = _readings(events=_CORRECTED)
_REGISTER_AFTER = """(SELECT c_custkey, c_acctbal,
    CASE WHEN c_acctbal > 9000 THEN concat(c_name, ' II') ELSE c_name END AS c_name,
    c_nationkey + CASE WHEN c_acctbal < 0 THEN 1000 ELSE 0 END AS c_nationkey
  FROM customer WHERE NOT c_acctbal BETWEEN 0 AND 500)"""
_CHANGED = _W.replace("LEFT JOIN customer c", f"LEFT JOIN {_REGISTER_AFTER} c")
_HAS_WEATHER = "coalesce(click, view_, purchase) IS NOT NULL"


def _rejected(feed: str, column: str, path: str, value: str, where: str) -> str:
    return (f"SELECT '{feed}' AS feed, CAST(record_ts AS TIMESTAMP) AS record_ts, lat, lon, '{column}' AS \"column\", "
            f"'{path}' AS path, '{value}' AS value FROM p WHERE {where}")


_STAR = "SELECT record_ts AS measurement_time, city, lat, lon, aqi, prominent_pollutant, weather_con FROM w"
_AGG = f"""SELECT city, CAST(record_ts AS DATE) AS measurement_date, record_ts AS measurement_time,
  {", ".join(f"round(avg({m}), 6) AS {m}_avg" for m in AVERAGED_MEASURES)}
FROM w GROUP BY city, record_ts"""
_PICKED = f"city = '{CITY}' AND CAST(record_ts AS DATE) = DATE '{DAY}'"
_HOUR = "CAST(hour(record_ts) AS INTEGER) AS \"Hour\""


def _series(columns: str) -> str:
    return f"{_W} SELECT {_HOUR}, {columns} FROM w WHERE {_PICKED} GROUP BY record_ts ORDER BY 1"


def _prefix(length: int) -> str:
    def points(name: str, column: str, count: str) -> str:
        return (f"SELECT {column} AS lat, CAST(floor({column} / 1000) AS DOUBLE) AS lon, count(*) AS {count} "
                f"FROM {name} GROUP BY 1, 2")

    def same(column: str) -> str:
        return f"left(CAST(c.{column} AS VARCHAR), {length}) = left(CAST(s.{column} AS VARCHAR), {length})"

    return f"""SELECT c.lat, c.lon, n_customers, s.lat AS place, n_suppliers
FROM ({points("customer", "c_acctbal", "n_customers")}) c
LEFT JOIN ({points("supplier", "s_acctbal", "n_suppliers")}) s ON {same("lat")} AND {same("lon")}"""


def _highest(event_type: str) -> str:
    return (f"SELECT user_id, date_trunc('hour', ts) AS hour, max(value) AS {event_type} FROM events "
            f"WHERE event_type = '{event_type}' GROUP BY 1, 2")


_CALENDAR = """CAST(year({0}) AS INTEGER) AS meas_year, CAST(quarter({0}) AS INTEGER) AS meas_quarter,
  CAST(month({0}) AS INTEGER) AS meas_month, CAST(day({0}) AS INTEGER) AS meas_day, CAST(hour({0}) AS INTEGER) AS meas_hour"""

ORACLE = {
    "latest_per_key": """SELECT * FROM lineitem
      QUALIFY rank() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) = 1""",
    "latest_per_key_one": """SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    # January: the clock in Warsaw is one hour ahead.
    "envelope": """SELECT date_trunc('hour', ts) AS hour,
      strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H-%M') AS local_minute,
      count(*) AS n_elements FROM events GROUP BY 1, 2""",
    "override_coords": """SELECT event_id, c_acctbal AS lat, CAST(c_custkey AS DOUBLE) AS lon
      FROM events JOIN customer ON user_id = c_custkey""",
    "flatten_json": f"""SELECT date_trunc('hour', ts) AS hour, event_id, CAST(user_id AS INTEGER) AS user_id,
      event_type, value, {_K} AS k FROM events""",
    "record_ts_first": """SELECT date_trunc('hour', ts) AS hour, date_trunc('second', min(ts)) AS record_ts
      FROM events GROUP BY 1""",
    "quarantine": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS source_filename,
        CASE WHEN max(value) > 95 THEN 'loaded' ELSE 'quarantined' END AS status FROM events
        GROUP BY date_trunc('hour', ts)
      UNION ALL SELECT concat('prose-', doc_id), 'quarantined' FROM documents""",
    "argmax_label": """SELECT day, user_id, CASE greatest(c, v, p, s, e) WHEN c THEN 'CLICK' WHEN v THEN 'VIEW'
        WHEN p THEN 'PURCHASE' WHEN s THEN 'SIGNUP' WHEN e THEN 'ERROR' END AS label
      FROM (SELECT CAST(ts AS DATE) AS day, user_id,
        max(value) FILTER (event_type = 'click') AS c, max(value) FILTER (event_type = 'view') AS v,
        max(value) FILTER (event_type = 'purchase') AS p, max(value) FILTER (event_type = 'signup') AS s,
        max(value) FILTER (event_type = 'error') AS e FROM events GROUP BY 1, 2)""",
    "prominent_index": f"{_W} SELECT CAST(record_ts AS TIMESTAMP) AS record_ts, lat, lon, "
    "prominent AS prominent_pollutant FROM l",
    "prominent_labels": """WITH v AS (SELECT l_orderkey % 7 = 0 AS none, l_returnflag AS f,
        CASE WHEN l_linestatus <> 'O' THEN l_linenumber % 5 END AS a, l_orderkey % 5 AS b, l_partkey % 5 AS c, l_suppkey % 5 AS d,
        CASE WHEN l_returnflag <> 'A' THEN l_quantity % 6 END AS e, CASE WHEN l_returnflag <> 'N' THEN floor(l_discount * 70) END AS g,
        floor(l_tax * 80) AS h FROM lineitem),
      r AS (SELECT CASE WHEN NOT none THEN a END::DOUBLE AS no, CASE WHEN NOT none THEN b END::DOUBLE AS no2,
        CASE WHEN NOT none THEN c END::DOUBLE AS o3, CASE WHEN NOT none THEN d END::DOUBLE AS so2, CASE WHEN NOT none THEN e END::DOUBLE AS pm2_5,
        CASE WHEN NOT none THEN g END::DOUBLE AS pm10, CASE WHEN NOT none THEN h END::DOUBLE AS nh3 FROM v)
      SELECT *, CASE greatest(no, no2, o3, so2, pm2_5, pm10, nh3) WHEN no THEN 'NO' WHEN no2 THEN 'NO2' WHEN o3 THEN 'O3'
        WHEN so2 THEN 'SO2' WHEN pm2_5 THEN 'PM2_5' WHEN pm10 THEN 'PM10' WHEN nh3 THEN 'NH3' END AS label, count(*) AS n
      FROM r GROUP BY ALL""",
    "calendar": f"""SELECT 'order' AS kind, o_orderkey AS id, {_CALENDAR.format("o_orderdate")} FROM orders
      UNION ALL SELECT 'event', event_id, {_CALENDAR.format("ts")} FROM events""",
    "prefix_join": _prefix(5),
    "prefix_join_fanout": _prefix(3),
    "two_feed_join": f"SELECT user_id, hour, click, view FROM ({_highest('click')}) JOIN ({_highest('view')}) "
    "USING (user_id, hour)",
    "unmatched_feeds": f"""SELECT hour, count(*) FILTER (v.view IS NULL) AS left_unmatched,
        count(*) FILTER (c.click IS NULL) AS right_unmatched
      FROM ({_highest('click')}) c FULL JOIN ({_highest('view')}) v USING (user_id, hour)
      WHERE c.click IS NULL OR v.view IS NULL GROUP BY hour""",
    "wide": f"{_W} SELECT * FROM w",
    "wide_exact": f"{_EXACT} SELECT * FROM w",
    "wide_from_documents": f"{_W} SELECT * FROM w",
    "date_dim": f"""{_W} SELECT DISTINCT record_ts AS measurement_time, meas_year, meas_quarter, meas_month,
      meas_day, meas_hour FROM w""",
    "location_dim": f"{_W} SELECT DISTINCT city, population, lat, lon FROM w",
    "star_join": f"{_W} {_STAR}",
    "day_agg": f"{_W} {_AGG}",
    "day_agg_of_many": _W.replace("LEFT JOIN customer c", """LEFT JOIN (SELECT c_custkey, c_acctbal, c_nationkey,
        concat('nation ', c_nationkey) AS c_name FROM customer) c""") + f" {_AGG}",
    "city_list": f"{_W} SELECT DISTINCT city FROM w ORDER BY city DESC",
    "date_list": f"""{_W} SELECT DISTINCT CAST(record_ts AS DATE) AS measurement_date FROM w
      WHERE city = '{CITY}' ORDER BY 1 DESC""",
    "series_all": _series(", ".join(f'avg({p}) AS "{p.upper()}"' for p in POLLUTANTS)),
    "series_one": _series('avg(pm10) AS "PM10"'),
    "series_weather": _series('avg(aqi) AS "AQI", avg(temp) AS "Temp", avg(wind_speed) AS "WindSpeed"'),
    "latest_snapshot": f"{_W} SELECT lat, lon, aqi FROM w WHERE record_ts = (SELECT max(record_ts) FROM w)",
    "city_points": f"{_W} SELECT lat, lon FROM w WHERE city = '{CITY}'",
    "city_points_distinct": f"{_W} SELECT DISTINCT lat, lon FROM w WHERE city = '{CITY}'",
    "upsert": """WITH f AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price, max(l_quantity) AS quantity,
        count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
      o AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price, max(l_quantity) AS quantity,
        count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
      SELECT l_orderkey, l_linenumber, coalesce(o.price, f.price) AS price,
        coalesce(f.quantity, o.quantity) AS quantity, coalesce(o.n, f.n) AS n
      FROM f FULL JOIN o USING (l_orderkey, l_linenumber)""",
    "csv_ingest": """SELECT c_name AS city,
        CASE WHEN c_acctbal >= 0 THEN lower(c_name) END AS city_ascii,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS lat,
        CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS DOUBLE) END AS lon,
        CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS population,
        CASE WHEN c_acctbal >= 0 THEN concat(c_mktsegment, ';', chr(10), '"x"') END AS country,
        CASE WHEN c_acctbal >= 0 THEN 'good' ELSE 'bad' END AS status FROM customer""",
    "coordinate_pairs": "SELECT c_acctbal AS lat, CAST(c_custkey AS DOUBLE) AS lon FROM customer WHERE c_acctbal >= 0",
    "peek_lines": "SELECT 'Name' AS first_field UNION ALL SELECT c_name FROM customer",
    "register_load": """SELECT c_name AS city, lower(c_name) AS city_ascii, c_acctbal AS lat,
        CAST(c_custkey AS DOUBLE) AS lon, c_nationkey + CASE WHEN c_acctbal < 0 THEN 0 ELSE 1000 END AS population
        FROM customer
      UNION ALL SELECT c_name, lower(c_name), c_acctbal + 0.5, CAST(c_custkey AS DOUBLE), c_nationkey + 1000
        FROM customer WHERE c_acctbal < 0""",
    "file_inventory": """SELECT concat(strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H-%M'),
      '_aq_data.json') AS name, true AS has_body FROM events GROUP BY date_trunc('hour', ts)""",
    "stream_ingest": f"""SELECT event_id, CAST(user_id AS INTEGER) AS user_id, event_type, value, {_K} AS k
      FROM {_CORRECTED}""",
    "stream_quarantine": "SELECT DISTINCT conv_id FROM conversations",
    # The text sink ends every file with a newline.
    "landed_files": """WITH b AS (SELECT *, concat('{"results": [{"dt": ', s_suppkey * 3600, ', "name": "', s_name, '"}]}') AS body
        FROM supplier),
      f AS (SELECT s_suppkey, s_acctbal, CASE s_suppkey % 4 WHEN 1 THEN concat(body, chr(10), body) WHEN 2 THEN s_name
        WHEN 3 THEN '{"results": []}' ELSE body END || chr(10) AS content FROM b)
      SELECT run, CAST(s_suppkey AS INTEGER) AS file, md5(content) AS stg_file_md5,
        CASE s_suppkey % 4 WHEN 2 THEN 'no document' WHEN 3 THEN 'no time' END AS reason,
        CASE s_suppkey % 4 WHEN 1 THEN 2 ELSE 1 END AS n_documents, CASE s_suppkey % 4 WHEN 1 THEN 2 ELSE 1 END AS n_ids,
        CASE WHEN s_suppkey % 4 < 2 THEN CAST(to_timestamp(s_suppkey * 3600) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS record_ts
      FROM f, (VALUES (0), (1)) AS t(run) WHERE run = 0 OR s_acctbal < 0""",
    "refresh_incremental": f"{_W2} {_AGG}",
    "refresh_star": f"{_W2} {_STAR}",
    "refresh_dims": f"""{_W2} SELECT DISTINCT 'place' AS kind, city AS member FROM w
      UNION ALL SELECT DISTINCT 'time', strftime(record_ts, '%Y-%m-%d %H:%M:%S') FROM w""",
    "curated_tables": f"""{_W2} SELECT 'pollution' AS feed, CAST(record_ts AS TIMESTAMP) AS record_ts, lat, lon,
        n AS whole, high AS measure FROM l
      UNION ALL SELECT 'weather', record_ts, lat, lon, wind_deg, temp FROM w""",
    "sql_over_views": f"""{_W2}, b AS (SELECT city, prominent_pollutant AS label, count(*) AS n,
        max(record_ts) AS last_seen FROM w WHERE meas_year = 2024 GROUP BY 1, 2)
      SELECT city, c_nationkey AS population, label, n, last_seen, round(aqi, 6) AS aqi
      FROM b JOIN customer ON city = c_name
      JOIN (SELECT city, avg(aqi) AS aqi FROM w GROUP BY city) USING (city)""",
    "refresh_full": f"{_W} {_AGG}",
    "register_change": f"{_CHANGED} SELECT record_ts AS measurement_time, city, CAST(population AS INTEGER) AS population, "
    "lat, lon, aqi, prominent_pollutant FROM w",
    "rejected_values": _W + " " + " UNION ALL ".join([
        _rejected("pollution", "aqi", "$.list[0].main.aqi", '"n/a"', "high > 90"),
        _rejected("weather", "humidity", "$.main.humidity", '"wet"', f"low < 5 AND {_HAS_WEATHER}"),
        _rejected("weather", "clouds", "$.clouds.all", '"n/a"', f"high > 90 AND {_HAS_WEATHER}"),
        _rejected("weather", "visibility", "$.visibility", "1000000000000", f"low > 95 AND {_HAS_WEATHER}"),
        "SELECT 'wide', record_ts, lat, lon, 'aqi', '', CASE WHEN feels_like <= 90 THEN CAST(aqi AS VARCHAR) END FROM w",
    ]),
    "split_runs": f"""SELECT ties, event_id, CAST(user_id AS INTEGER) AS user_id, event_type, value, {_K} AS k
      FROM {_CORRECTED}, (VALUES ('keep'), ('one')) AS t(ties)""",
    "many_documents_per_file": f"""SELECT event_id, CAST(user_id AS INTEGER) AS user_id, event_type, value, {_K} AS k
      FROM events""",
}
ORACLE["upsert_by_bucket"] = ORACLE["upsert"]
