"""SQL twins of the named queries, for an independent engine reading the same parquet files."""

from __future__ import annotations

DEPTHS = range(10, 90, 10)
PREFIXES = {"Moisture": "moisture", "Temperature": "temp", "Salinity": "salinity"}
WORDS = ("Moisture", "Temperature", "Salinity", "Conductivity")


def r(expression: str) -> str:
    """Six decimal places, rounded as a decimal of ten so that summation noise cannot decide a tie."""
    return f"CAST(round(CAST({expression} AS DECIMAL(30, 10)), 6) AS DOUBLE)"


def text_part(pattern: str) -> str:
    return f"nullif(regexp_extract(Probe_Measure, '{pattern}', 1), '')"


SOIL_COLUMNS = f"""ID, Site_Name, Site_ID, Probe_ID, Probe_Measure, {r('Soil_Value')} AS Soil_Value,
  Unit, event_time"""

VIEWS = {
    "soil": """
SELECT CAST(event_id AS VARCHAR) AS ID,
  'Site ' || CAST(user_id % 12 AS VARCHAR) AS Site_Name,
  CAST(user_id % 12 AS VARCHAR) AS Site_ID,
  CAST(k % 3 AS VARCHAR) AS Probe_ID,
  'Soil ' || word
    || CASE WHEN k % 9 = 0 THEN '' WHEN k % 2 = 0 THEN ' ' || CAST((k % 9) * 10 AS VARCHAR) || 'cm'
            ELSE ' ' || CAST((k % 9) * 10 AS VARCHAR) || ' cm' END
    || CASE (k + user_id) % 4 WHEN 0 THEN ' (Clay)' WHEN 1 THEN ' (Sandy Loam)'
            WHEN 2 THEN ' (Clayey Loam)' ELSE '' END
    || CASE WHEN user_id % 12 >= 8 THEN '' WHEN k % 3 = 0 THEN '#0' WHEN k % 3 = 1 THEN '#1'
            ELSE '' END AS Probe_Measure,
  CASE WHEN event_type = 'signup' AND user_id % 12 <> 11 THEN value / 10 ELSE value END
    AS Soil_Value,
  CASE WHEN word = 'Moisture' THEN '%' END AS Unit,
  date_trunc('day', ts) + INTERVAL (CAST(floor(hour(ts) / 6) * 6 AS INTEGER)) HOUR AS event_time
FROM (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k,
    CASE WHEN event_type = 'error' THEN 'Battery'
         WHEN user_id % 12 = 11 OR event_type IN ('click', 'view') THEN 'Moisture'
         WHEN event_type = 'purchase' THEN 'Temperature' ELSE 'Salinity' END AS word
  FROM events) e""",
    "probes": rf"""
SELECT *,
  CAST({text_part(r'(\d+)\s*[Cc][Mm]')} AS INTEGER) AS depth_cm,
  CASE WHEN contains(Probe_Measure, 'Moisture') THEN 'Moisture'
       WHEN contains(Probe_Measure, 'Temperature') THEN 'Temperature'
       WHEN contains(Probe_Measure, 'Salinity') THEN 'Salinity' END AS measure_type,
  {text_part('(Moisture|Temperature|Salinity|Conductivity)')} AS measure_word,
  {text_part(r'[(](Clay[^)]*|Sandy[^)]*|Loam[^)]*)[)]')} AS soil_texture,
  {text_part(r'#(\d+)')} AS probe_suffix
FROM soil""",
    "silver": """
SELECT Site_Name AS site_name, Site_ID AS site_id, event_time, depth_cm, measure_type,
  soil_texture, avg(Soil_Value) AS soil_value, count(Soil_Value) AS reading_count
FROM probes
WHERE depth_cm IS NOT NULL AND event_time IS NOT NULL
  AND CASE measure_type WHEN 'Moisture' THEN Soil_Value BETWEEN 0 AND 100
        WHEN 'Temperature' THEN Soil_Value BETWEEN -10 AND 60
        WHEN 'Salinity' THEN Soil_Value BETWEEN 0 AND 10 END
GROUP BY ALL""",
    "feeds": """
SELECT feed, date,
  CASE WHEN s % 11 <> 0 THEN CASE feed WHEN 'rainfall' THEN CAST(s % 80 AS DOUBLE) / 10
    WHEN 'temperature' THEN 15 + CAST(s % 20 AS DOUBLE) ELSE CAST(s % 30 AS DOUBLE) END END AS value
FROM (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'rainfall' WHEN '2-HIGH' THEN 'temperature'
      ELSE 'solar' END AS feed,
    CAST(o_orderdate AS DATE) + 10227 AS date, CAST(sum(o_custkey) AS BIGINT) AS s
  FROM orders GROUP BY ALL) d""",
    "weather": """
SELECT coalesce(a.date, b.date, c.date) AS date, a.value AS rainfall_mm, b.value AS max_temp_c,
  c.value AS solar_exposure_mj
FROM (SELECT * FROM feeds WHERE feed = 'rainfall') a
FULL JOIN (SELECT * FROM feeds WHERE feed = 'temperature') b ON a.date = b.date
FULL JOIN (SELECT * FROM feeds WHERE feed = 'solar') c ON c.date = coalesce(a.date, b.date)
WHERE coalesce(a.date, b.date, c.date) >= DATE '2023-09-01'""",
    "textures": """
SELECT site_name, site_id, arg_min(soil_texture, (event_time, soil_texture)) AS soil_texture
FROM silver WHERE depth_cm = 10 AND soil_texture IS NOT NULL GROUP BY ALL""",
}


def _pivot(measure: str, period: str) -> str:
    cells = ", ".join(
        f"avg(soil_value) FILTER (depth_cm = {d}) AS {PREFIXES[measure]}_{d}cm" for d in DEPTHS
    )
    return (
        f"SELECT site_name, site_id, {period} AS period, {cells} FROM silver "
        f"WHERE measure_type = '{measure}' GROUP BY ALL"
    )


def _row_mean(depths) -> str:
    cells = ", ".join(f"moisture_{d}cm" for d in depths)
    return f"list_avg([{cells}])"


def _wide(period: str) -> str:
    """Three pivots and two left joins: the literal form of the fused aggregation."""
    columns = ", ".join(f"{p}_{d}cm" for p in PREFIXES.values() for d in DEPTHS)
    return f"""
SELECT m.site_name, m.site_id, m.period, {columns},
  {_row_mean(range(10, 50, 10))} AS avg_moisture_shallow,
  {_row_mean(range(50, 90, 10))} AS avg_moisture_deep
FROM ({_pivot('Moisture', period)}) m
LEFT JOIN ({_pivot('Temperature', period)}) USING (site_name, site_id, period)
LEFT JOIN ({_pivot('Salinity', period)}) USING (site_name, site_id, period)"""


def _daily(days: str) -> str:
    return f"""
SELECT d.* RENAME (period AS date), soil_texture, rainfall_mm, max_temp_c, solar_exposure_mj,
  avg_moisture_shallow < 30 AND (rainfall_mm IS NULL OR rainfall_mm < 2) AS irrigation_needed
FROM {days} d LEFT JOIN textures USING (site_name, site_id)
LEFT JOIN weather w ON w.date = d.period"""


VIEWS["days"] = _wide("CAST(event_time AS DATE)")
VIEWS["sydney_days"] = _wide("CAST(event_time + INTERVAL 11 HOUR AS DATE)")
VIEWS["hours"] = _wide("date_trunc('hour', event_time)")
VIEWS["daily"] = _daily("days")
VIEWS["sydney_daily"] = _daily("sydney_days")
VIEWS["hourly"] = (
    "SELECT h.* RENAME (period AS hour), soil_texture FROM hours h "
    "LEFT JOIN textures USING (site_name, site_id)"
)
VIEWS["latest"] = """
SELECT * FROM daily WHERE date = (SELECT max(date) FROM daily)"""
VIEWS["last_rows"] = "SELECT * FROM soil ORDER BY CAST(ID AS BIGINT) DESC LIMIT 10"
VIEWS["stored"] = "SELECT * FROM soil WHERE event_time < TIMESTAMP '2024-01-16'"
VIEWS["second"] = "SELECT * FROM soil WHERE event_time >= TIMESTAMP '2024-01-15 12:00:00'"

NEEDS = {
    "probes": ["soil"],
    "silver": ["probes"],
    "weather": ["feeds"],
    "textures": ["silver"],
    "days": ["silver"],
    "sydney_days": ["silver"],
    "hours": ["silver"],
    "daily": ["days", "textures", "weather"],
    "sydney_daily": ["sydney_days", "textures", "weather"],
    "hourly": ["hours", "textures"],
    "latest": ["daily"],
    "last_rows": ["soil"],
    "stored": ["soil"],
    "second": ["soil"],
}


def _with(views: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}"


def _rounded_wide(period: str) -> str:
    wide = [f"{p}_{d}cm" for p in PREFIXES.values() for d in DEPTHS]
    cells = ",\n  ".join(
        f"{r(c)} AS {c}" for c in [*wide, "avg_moisture_shallow", "avg_moisture_deep"]
    )
    return f"site_name, site_id, {period}, {cells}"


DAILY_COLUMNS = f"""{_rounded_wide('date')}, soil_texture, {r('rainfall_mm')} AS rainfall_mm,
  {r('max_temp_c')} AS max_temp_c, {r('solar_exposure_mj')} AS solar_exposure_mj,
  irrigation_needed"""
HOURLY_COLUMNS = _rounded_wide("hour")
SILVER_COLUMNS = f"""site_name, site_id, event_time, depth_cm, measure_type, soil_texture,
  {r('soil_value')} AS soil_value, reading_count"""
SERIES_COLUMNS = f"""site_name, site_id, date, {r('avg_moisture_shallow')} AS avg_moisture_shallow,
  {r('rainfall_mm')} AS rainfall_mm, 30.0::DOUBLE AS threshold"""
SHALLOW = f"{r('avg_moisture_shallow')} AS avg_moisture_shallow"


def _described(value: str) -> str:
    return f"""count({value}) AS count, {r(f'avg({value})')} AS mean,
  {r(f'stddev_samp({value})')} AS std, {r(f'min({value})')} AS min,
  {r(f'quantile_cont({value}, 0.25)')} AS q25, {r(f'quantile_cont({value}, 0.5)')} AS q50,
  {r(f'quantile_cont({value}, 0.75)')} AS q75, {r(f'max({value})')} AS max"""


def _counts(column: str, view: str = "probes", name: str | None = None) -> str:
    return (
        f"SELECT {column}{f' AS {name}' if name else ''}, count(*) AS n FROM {view} "
        f"WHERE {column} IS NOT NULL GROUP BY ALL"
    )


MATRIX = ", ".join(f"count(*) FILTER (measure_word = '{w}') AS {w}" for w in WORDS)

QUALITY = """
SELECT unnest(['Q1', 'Q2', 'Q3', 'Q4', 'Q5', 'Q6', 'Q7', 'Q8', 'Q9']) AS check_id,
  unnest(['rows', 'missing_columns', 'null_site_name', 'null_site_id', 'unknown_measure',
    'unknown_depth', 'moisture_out_of_range', 'duplicates', 'sites']) AS check_name,
  unnest([rows, 0, no_name, no_id, bad_measure, bad_depth, bad_moisture, rows - keys, sites])
    AS observed,
  unnest(['>= 1000', '= 0', '= 0', '= 0', '= 0', '= 0', '= 0', '= 0', '>= 10']) AS expected,
  unnest([rows >= 1000, true, no_name = 0, no_id = 0, bad_measure = 0, bad_depth = 0,
    bad_moisture = 0, rows = keys, sites >= 10]) AS passed
FROM (
  SELECT count(*) AS rows, count(*) FILTER (site_name IS NULL) AS no_name,
    count(*) FILTER (site_id IS NULL) AS no_id,
    count(*) FILTER (measure_type NOT IN ('Moisture', 'Temperature', 'Salinity')) AS bad_measure,
    count(*) FILTER (depth_cm NOT IN (10, 20, 30, 40, 50, 60, 70, 80)) AS bad_depth,
    count(*) FILTER (measure_type = 'Moisture' AND (soil_value < 0 OR soil_value > 100))
      AS bad_moisture,
    count(DISTINCT site_name) AS sites,
    (SELECT count(*) FROM (SELECT DISTINCT site_id, event_time, depth_cm, measure_type, soil_texture
      FROM silver)) AS keys
  FROM silver)"""


def _feed_row(view: str, feed: str, day: str, value: str) -> str:
    return f"""SELECT {feed} AS feed, count(*) AS rows, min({day}) AS first_day,
  max({day}) AS last_day,
  CAST(max({day}) - min({day}) + 1 - count(DISTINCT {day}) AS BIGINT) AS missing_days,
  count(*) FILTER ({value} IS NULL) AS null_values, count(*) FILTER ({value} = 0) AS zero_values
FROM {view} GROUP BY ALL"""


def statements() -> dict[str, str]:
    feed_values = f"SELECT feed, date, {r('value')} AS value FROM feeds"
    soil_rows = f"SELECT {SOIL_COLUMNS} FROM "
    return {
        "bronze_soil": _with(
            ["soil"],
            f"""SELECT {SOIL_COLUMNS},
  strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS Local_Time,
  'Feature' AS json_featuretype FROM soil""",
        ),
        "bronze_weather": _with(["feeds"], feed_values),
        "probe_texts": _with(
            ["probes"],
            "SELECT ID, depth_cm, measure_type, measure_word, soil_texture, probe_suffix FROM probes",
        ),
        "silver_soil": _with(["silver"], f"SELECT {SILVER_COLUMNS} FROM silver"),
        "silver_weather": _with(
            ["weather"],
            f"""SELECT date, {r('rainfall_mm')} AS rainfall_mm, {r('max_temp_c')} AS max_temp_c,
  {r('solar_exposure_mj')} AS solar_exposure_mj FROM weather""",
        ),
        "texture_lookup": _with(["textures"], "SELECT * FROM textures"),
        "gold_daily": _with(["daily"], f"SELECT {DAILY_COLUMNS} FROM daily"),
        "gold_hourly": _with(["hourly"], f"SELECT {HOURLY_COLUMNS}, soil_texture FROM hourly"),
        "gold_daily_sydney": _with(["sydney_daily"], f"SELECT {DAILY_COLUMNS} FROM sydney_daily"),
        "quality_report": _with(["silver"], QUALITY),
        "irrigation_status_latest": _with(
            ["latest"],
            f"""SELECT site_name, site_id, date, {SHALLOW},
  {r('avg_moisture_deep')} AS avg_moisture_deep, {r('rainfall_mm')} AS rainfall_mm,
  irrigation_needed FROM latest""",
        ),
        "moisture_trend_driest5": _with(
            ["daily", "latest"],
            f"""SELECT site_name, site_id, date, {SHALLOW}, 30.0::DOUBLE AS threshold FROM daily
SEMI JOIN (SELECT site_name, site_id FROM latest WHERE avg_moisture_shallow IS NOT NULL
  ORDER BY avg_moisture_shallow, site_id, site_name LIMIT 5) USING (site_name, site_id)""",
        ),
        "site_series": _with(["daily"], f"SELECT {SERIES_COLUMNS} FROM daily"),
        "irrigation_days": _with(
            ["daily"],
            """SELECT site_name, site_id, count(*) FILTER (irrigation_needed) AS irrigation_days,
  count(*) AS days FROM daily GROUP BY ALL""",
        ),
        "irrigation_listing": _with(
            ["daily"],
            f"""SELECT site_name, site_id, date, {SHALLOW}, {r('rainfall_mm')} AS rainfall_mm
FROM daily WHERE irrigation_needed""",
        ),
        "rain_response": _with(
            ["daily"],
            f"""SELECT site_name, site_id, date, {r('prev_rainfall')} AS prev_rainfall, {SHALLOW},
  {r('moisture_change')} AS moisture_change FROM (
  SELECT *, lag(rainfall_mm) OVER w AS prev_rainfall,
    avg_moisture_shallow - lag(avg_moisture_shallow) OVER w AS moisture_change
  FROM daily WINDOW w AS (PARTITION BY site_name, site_id ORDER BY date))
WHERE prev_rainfall > 5""",
        ),
        "feed_coverage": _with(
            ["soil", "feeds"],
            _feed_row("soil", "'soil'", "CAST(event_time AS DATE)", "Soil_Value")
            + "\nUNION ALL\n"
            + _feed_row("feeds", "feed", "date", "value"),
        ),
        "measure_profile": _with(
            ["probes"],
            f"""SELECT measure_word AS measure_type, {_described('Soil_Value')},
  count(*) FILTER (Soil_Value IS NULL) AS null_values,
  count(*) FILTER (Soil_Value = 0) AS zero_values,
  count(*) FILTER (Soil_Value < 0) AS negative_values,
  count(*) FILTER (Soil_Value > 100) AS above_100, count(*) FILTER (Soil_Value > 60) AS above_60,
  count(*) FILTER (Soil_Value > 10) AS above_10
FROM probes WHERE measure_word IS NOT NULL GROUP BY ALL""",
        ),
        "weather_profile": _with(
            ["feeds"],
            f"""SELECT feed, {_described('value')},
  count(*) FILTER (value IS NULL) AS null_values, count(*) FILTER (value = 0) AS zero_values
FROM feeds GROUP BY ALL""",
        ),
        "reading_gaps": _with(
            ["probes"],
            f"""SELECT Site_Name, measure_word AS measure_type, depth_cm, {_described('gap')} FROM (
  SELECT *, epoch(event_time - lag(event_time) OVER (
    PARTITION BY Site_Name, measure_word, depth_cm ORDER BY event_time)) AS gap
  FROM probes WHERE measure_word IS NOT NULL AND depth_cm IS NOT NULL)
WHERE gap IS NOT NULL GROUP BY ALL""",
        ),
        "site_measure_matrix": _with(
            ["probes"], f"SELECT Site_Name, {MATRIX} FROM probes GROUP BY ALL"
        ),
        "sites_missing_measure": _with(
            ["probes"],
            f"""SELECT Site_Name, {MATRIX} FROM probes GROUP BY ALL
HAVING count(DISTINCT measure_word) BETWEEN 1 AND 2""",
        ),
        "site_coverage": _with(
            ["probes"],
            """SELECT Site_Name, count(DISTINCT measure_word) AS measures,
  count(DISTINCT depth_cm) AS depths FROM probes GROUP BY ALL""",
        ),
        "coverage_classes": _with(
            ["probes"],
            """SELECT measures, count(*) AS sites FROM (
  SELECT Site_Name, count(DISTINCT measure_word) AS measures FROM probes GROUP BY ALL)
GROUP BY ALL""",
        ),
        "depth_coverage_hist": _with(
            ["probes"],
            """SELECT distinct_values, count(*) AS groups FROM (
  SELECT Site_Name, count(DISTINCT depth_cm) AS distinct_values FROM probes GROUP BY ALL)
GROUP BY ALL""",
        ),
        "texture_consistency": _with(
            ["probes"],
            """SELECT Site_Name, depth_cm, count(DISTINCT soil_texture) AS textures,
  arg_min(soil_texture, (event_time, soil_texture)) AS first_texture
FROM probes WHERE soil_texture IS NOT NULL AND depth_cm IS NOT NULL GROUP BY ALL""",
        ),
        "first_texture": _with(
            ["probes"],
            """SELECT Site_Name, depth_cm, arg_min(soil_texture, (event_time, soil_texture))
  AS soil_texture FROM probes WHERE soil_texture IS NOT NULL GROUP BY ALL""",
        ),
        "hash_probe_sites": _with(
            ["soil"],
            """SELECT Site_Name, bool_or(contains(Probe_Measure, '#0')) AS has,
  bool_or(NOT contains(Probe_Measure, '#0')) AS lacks FROM soil GROUP BY ALL""",
        ),
        "probe_suffix_overlap": _with(
            ["soil"],
            """SELECT count(*) FILTER (has) AS with_hash, count(*) FILTER (lacks) AS without_hash,
  count(*) FILTER (has AND lacks) AS overlap, count(*) FILTER (lacks AND NOT has) AS only_without
FROM (SELECT Site_Name, bool_or(contains(Probe_Measure, '#0')) AS has,
  bool_or(NOT contains(Probe_Measure, '#0')) AS lacks FROM soil GROUP BY ALL)""",
        ),
        "probe_site_sets": _with(
            ["soil"],
            """SELECT Site_Name, 'both' AS kind FROM (
  SELECT Site_Name FROM soil WHERE contains(Probe_Measure, '#0')
  INTERSECT SELECT Site_Name FROM soil WHERE NOT contains(Probe_Measure, '#0'))
UNION ALL SELECT Site_Name, 'only without' FROM (
  SELECT Site_Name FROM soil WHERE NOT contains(Probe_Measure, '#0')
  EXCEPT SELECT Site_Name FROM soil WHERE contains(Probe_Measure, '#0'))""",
        ),
        "probe_suffix_counts": _with(["probes"], _counts("probe_suffix", name="suffix")),
        "probe_text_counts": _with(["soil"], _counts("Probe_Measure", "soil")),
        "measure_counts": _with(["probes"], _counts("measure_word", name="measure_type")),
        "depth_counts": _with(["probes"], _counts("depth_cm")),
        "texture_counts": _with(["probes"], _counts("soil_texture")),
        "site_names": _with(["soil"], "SELECT DISTINCT Site_Name, Site_ID FROM soil"),
        "readings_per_month": _with(
            ["soil"],
            """SELECT CAST(last_day(m) AS DATE) AS month_end, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series(date_trunc('month', min(event_time)),
  date_trunc('month', max(event_time)), INTERVAL 1 MONTH)) AS m FROM soil)
LEFT JOIN (SELECT date_trunc('month', event_time) AS m, count(*) AS n FROM soil GROUP BY ALL)
USING (m)""",
        ),
        "missing_dates": _with(
            ["feeds"],
            """SELECT CAST(date AS DATE) AS date, feed FROM (
  SELECT feed, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date
  FROM feeds GROUP BY feed) s ANTI JOIN feeds USING (feed, date)""",
        ),
        "time_chunks": _with(
            ["soil"],
            """SELECT chunk_start, least(chunk_start + INTERVAL 12 HOUR, hi) AS chunk_end FROM (
  SELECT unnest(generate_series(min(event_time), max(event_time), INTERVAL 12 HOUR)) AS chunk_start,
    max(event_time) AS hi FROM soil) WHERE chunk_start < hi""",
        ),
        "high_water_mark_silver": _with(
            ["silver"], "SELECT max(event_time) AS high_water_mark FROM silver"
        ),
        "range_slice_second_half": _with(
            ["soil"],
            soil_rows
            + "soil WHERE event_time >= TIMESTAMP '2024-01-16' AND event_time < TIMESTAMP '2024-02-01'",
        ),
        "third_page": _with(
            ["soil"],
            soil_rows
            + "(FROM soil ORDER BY event_time DESC, CAST(ID AS BIGINT) DESC LIMIT 100 OFFSET 200) p",
        ),
        "incremental_rows": _with(
            ["soil", "stored"],
            soil_rows
            + """soil WHERE event_time >= (SELECT coalesce(max(event_time) - INTERVAL 2 MINUTE,
  TIMESTAMP '2023-01-01') FROM stored)""",
        ),
        "insert_if_absent": _with(
            ["stored", "second"],
            soil_rows + "stored UNION ALL " + soil_rows + "second ANTI JOIN stored USING (ID)",
        ),
        "duplicate_keys": _with(
            ["soil"],
            """SELECT Site_ID, Probe_ID, event_time, count(*) - 1 AS extra_rows FROM soil
GROUP BY ALL HAVING count(*) > 1""",
        ),
        "last_n_by_id": _with(["last_rows"], soil_rows + "last_rows"),
        "delete_by_key": _with(
            ["soil", "last_rows"], soil_rows + "soil ANTI JOIN last_rows USING (ID)"
        ),
        "keyed_lookup": _with(
            ["soil", "last_rows"],
            soil_rows + "soil SEMI JOIN last_rows USING (Site_ID, Probe_ID, event_time)",
        ),
        "replay_difference": _with(
            ["soil", "last_rows"],
            """, kept AS (SELECT * FROM soil ANTI JOIN last_rows USING (ID)),
rebuilt AS (SELECT * FROM kept UNION ALL SELECT * FROM (
  SELECT * FROM soil WHERE event_time >= (SELECT max(event_time) - INTERVAL 2 MINUTE FROM kept)) f
  ANTI JOIN kept USING (ID))
SELECT (SELECT count(*) FROM (FROM soil EXCEPT ALL FROM rebuilt)) AS missing,
  (SELECT count(*) FROM (FROM rebuilt EXCEPT ALL FROM soil)) AS unexpected""",
        ),
        "parquet_partitioned": _with(["silver"], f"SELECT {SILVER_COLUMNS} FROM silver"),
        "weather_csv": _with(["feeds"], feed_values),
        "sites_csv": f"""SELECT CAST(s_suppkey AS INTEGER) AS site_id,
  'Site ' || CAST(s_suppkey AS VARCHAR) AS site_name, s_name AS property_name,
  {r('-37.8::DOUBLE + s_acctbal / 1e5')} AS latitude,
  {r('144.9::DOUBLE + s_acctbal / 1e5')} AS longitude FROM supplier""",
        "json_pages": _with(["soil"], soil_rows + "soil"),
        "append_absent_table": _with(["soil"], soil_rows + "soil"),
        "page_numbers": _with(
            ["soil"],
            """SELECT ID, event_time,
  (row_number() OVER (ORDER BY event_time DESC, CAST(ID AS BIGINT) DESC) - 1) // 100 AS page FROM soil""",
        ),
        "high_water_mark_stored": _with(
            ["soil"],
            "SELECT ID, event_time FROM soil WHERE event_time = (SELECT max(event_time) FROM soil)",
        ),
        "landed_pages": _with(
            ["soil"],
            soil_rows
            + "soil WHERE event_time >= TIMESTAMP '2024-01-16' AND event_time < TIMESTAMP '2024-02-01'",
        ),
        "weather_csv_rejects": _with(
            ["feeds"],
            """, lines AS (SELECT feed, day(date) AS d,
  'P-' || feed || ',000001,' || year(date) AS head, ',' || month(date) || ',7,wet' AS rest FROM feeds)
SELECT feed, 'not double' AS reason, CASE feed WHEN 'rainfall' THEN 'rainfall_mm'
    WHEN 'temperature' THEN 'max_temp_c' ELSE 'solar_exposure_mj' END AS column, 'wet' AS cell,
  head || rest || CASE feed WHEN 'solar' THEN '' ELSE ',1.0,Y' END AS line FROM lines WHERE d = 7
UNION ALL SELECT feed, 'malformed line', NULL, NULL, head FROM lines WHERE d = 8""",
        ),
        "append_absent_buckets": _with(["soil"], soil_rows + "soil"),
        "replaced_partitions": _with(
            ["soil"],
            soil_rows
            + """(SELECT * REPLACE (CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN 'new' ELSE Unit END
  AS Unit) FROM soil) s""",
        ),
        "stream_dedup": _with(["soil"], soil_rows + "soil"),
        "stream_hourly": _with(
            ["silver", "hourly"],
            f"SELECT {HOURLY_COLUMNS}, soil_texture FROM hourly",
        ),
        "ingest_rejects": _with(
            ["soil"],
            f"""SELECT DISTINCT 'unreadable time' AS reason, ID AS id, 'soon' AS local_time,
  Site_ID AS site_id, Probe_Measure AS probe_measure, {r('Soil_Value')} AS soil_value
FROM soil WHERE CAST(ID AS BIGINT) % 50 = 7
UNION ALL SELECT DISTINCT 'missing id', NULL,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00', Site_ID, Probe_Measure, {r('Soil_Value')}
FROM soil WHERE CAST(ID AS BIGINT) % 50 = 13""",
        ),
        "json_pages_mixed": _with(
            ["soil"],
            soil_rows
            + """soil WHERE CAST(ID AS BIGINT) // 100 % 10 <> 9
  AND CAST(ID AS BIGINT) % 50 NOT IN (7, 13)""",
        ),
        "ingest_pages_batch": _with(["soil"], soil_rows + "soil"),
        "bronze_mixed_ids": _with(["soil"], soil_rows + "soil"),
        "database_rows": _with(
            ["soil"],
            f"""SELECT ID, CASE WHEN CAST(ID AS BIGINT) % 10 <> 0 THEN {r('Soil_Value')} END
  AS Soil_Value, event_time FROM soil""",
        ),
        "gold_daily_incremental": _with(["daily"], f"SELECT {DAILY_COLUMNS} FROM daily"),
        "silver_weather_repeated_days": f"""
SELECT date, {r("avg(value) FILTER (feed = 'rainfall')")} AS rainfall_mm,
  {r("avg(value) FILTER (feed = 'temperature')")} AS max_temp_c,
  {r("avg(value) FILTER (feed = 'solar')")} AS solar_exposure_mj
FROM (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'rainfall' WHEN '2-HIGH' THEN 'temperature'
      ELSE 'solar' END AS feed, CAST(o_orderdate AS DATE) + 10227 AS date,
    CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey % 80 AS DOUBLE) END AS value
  FROM orders) d
WHERE date >= DATE '2023-09-01' GROUP BY date""",
        "sites_csv_repeated": f"""
SELECT CAST(s_suppkey + shift AS INTEGER) AS site_id,
  CASE WHEN shift > 0 THEN 'A much longer name of ' ELSE '' END || 'Site '
    || CAST(s_suppkey AS VARCHAR) AS site_name, s_name AS property_name,
  {r('-37.8::DOUBLE + s_acctbal / 1e5')} AS latitude,
  {r('144.9::DOUBLE + s_acctbal / 1e5')} AS longitude
FROM supplier, (VALUES (0), (1000000)) AS shifts (shift)""",
    }
