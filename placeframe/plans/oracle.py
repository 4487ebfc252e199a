"""oracle_sql(): DuckDB SQL for each key, written independently of the
Spark code over the same base tables (region nation customer orders events).

Shared relations are CTEs; each query pulls in the ones it needs."""

from __future__ import annotations

# a raw coordinate that is not null, empty or the number 0
TRUTHY = "({c} <> '' AND coalesce(TRY_CAST({c} AS DOUBLE) <> 0, true))"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_b": (
        """
SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_name END AS name,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' Micro ' WHEN 'BUILDING' THEN 'BREWPUB'
            WHEN 'FURNITURE' THEN 'regional' WHEN 'MACHINERY' THEN 'Taproom' ELSE 'contract' END AS brewery_type,
       c_mktsegment AS city,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE n_name END AS state,
       CASE r_name WHEN 'ASIA' THEN 'Canada' WHEN 'EUROPE' THEN NULL ELSE 'United States' END AS country,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'n/a'
            ELSE CAST(c_acctbal AS VARCHAR) END AS latitude,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(-c_acctbal AS VARCHAR) END AS longitude,
       'https://x/' || CAST(c_custkey AS VARCHAR) AS website_url,
       CAST(NULL AS VARCHAR) AS phone
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        (),
    ),
    "daily": (
        """
SELECT CAST(user_id AS VARCHAR) AS loc_id, CAST(ts AS DATE) AS obs_date, max(value) AS tmax,
       CASE WHEN user_id % 10 = 3 AND day(CAST(ts AS DATE)) % 2 = 0 THEN NULL ELSE min(value) END AS tmin,
       CAST(count(*) AS DOUBLE) / 10 AS precip,
       max(value) - min(value) AS wind,
       count(*) AS n
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
        (),
    ),
    "run_end": ("SELECT max(obs_date) AS d FROM daily", ("daily",)),
    "geo": ("SELECT * FROM raw_b WHERE " + TRUTHY.format(c="latitude") + " AND " + TRUTHY.format(c="longitude"), ("raw_b",)),
    "win": (
        "SELECT daily.* FROM daily WHERE obs_date BETWEEN (SELECT d FROM run_end) - 7 AND (SELECT d FROM run_end)",
        ("daily", "run_end"),
    ),
    "wx": (
        """
SELECT g.id AS brewery_id, g.name AS brewery_name, g.state, g.city, g.latitude, g.longitude,
       strftime((SELECT d FROM run_end), '%Y-%m-%d') AS fetch_date,
       a.tmax_l, a.tmin_l, a.precip_l, a.wind_l
FROM geo g
JOIN (SELECT loc_id, list(tmax ORDER BY obs_date) AS tmax_l, list(tmin ORDER BY obs_date) AS tmin_l,
             list(precip ORDER BY obs_date) AS precip_l, list(wind ORDER BY obs_date) AS wind_l
      FROM win GROUP BY loc_id) a
  ON g.id = a.loc_id""",
        ("geo", "win", "run_end"),
    ),
    "wc": (
        """
SELECT brewery_id, fetch_date,
       CAST(CASE WHEN len(tmax_l) = 0 OR list_count(tmax_l) < len(tmax_l) THEN NULL ELSE list_sum(tmax_l) / len(tmax_l) END AS FLOAT) AS avg_temp_max_f,
       CAST(CASE WHEN len(tmin_l) = 0 OR list_count(tmin_l) < len(tmin_l) THEN NULL ELSE list_sum(tmin_l) / len(tmin_l) END AS FLOAT) AS avg_temp_min_f,
       CAST(CASE WHEN len(precip_l) = 0 OR list_count(precip_l) < len(precip_l) THEN NULL ELSE list_sum(precip_l) / len(precip_l) END AS FLOAT) AS avg_precipitation_inch,
       CAST(CASE WHEN len(wind_l) = 0 OR list_count(wind_l) < len(wind_l) THEN NULL ELSE list_sum(wind_l) / len(wind_l) END AS FLOAT) AS avg_windspeed_mph
FROM wx WHERE brewery_id IS NOT NULL""",
        ("wx",),
    ),
    "clean_b": (
        """
SELECT id AS brewery_id, name, lower(trim(brewery_type)) AS brewery_type, city, state,
       TRY_CAST(latitude AS FLOAT) AS latitude, TRY_CAST(longitude AS FLOAT) AS longitude, website_url,
       (TRY_CAST(latitude AS FLOAT) IS NOT NULL AND TRY_CAST(longitude AS FLOAT) IS NOT NULL) AS has_coordinates
FROM raw_b
WHERE (country = 'United States' OR country IS NULL) AND name IS NOT NULL AND state IS NOT NULL""",
        ("raw_b",),
    ),
    "joined": (
        """
SELECT b.*, w.fetch_date, w.avg_temp_max_f, w.avg_temp_min_f, w.avg_precipitation_inch, w.avg_windspeed_mph
FROM clean_b b LEFT JOIN wc w ON b.brewery_id = w.brewery_id""",
        ("clean_b", "wc"),
    ),
    "enr": (
        """
SELECT joined.*,
       CASE WHEN avg_temp_max_f >= 80 THEN 'hot' WHEN avg_temp_max_f >= 60 THEN 'moderate'
            WHEN avg_temp_max_f >= 40 THEN 'cool' WHEN avg_temp_max_f IS NOT NULL THEN 'cold'
            ELSE 'unknown' END AS climate_zone,
       upper(substring(state, 1, 2)) AS state_code
FROM joined""",
        ("joined",),
    ),
    "stg": (
        """
SELECT brewery_id, name AS brewery_name, brewery_type, city, state,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       website_url, has_coordinates, avg_temp_max_f, avg_temp_min_f, avg_precipitation_inch,
       avg_windspeed_mph, climate_zone, fetch_date
FROM enr WHERE brewery_id IS NOT NULL AND name IS NOT NULL""",
        ("enr",),
    ),
    "summ": (
        """
SELECT state, climate_zone,
       round(avg(avg_temp_max_f), 2) AS state_avg_temp_max_f,
       round(avg(avg_temp_min_f), 2) AS state_avg_temp_min_f,
       round(avg(avg_precipitation_inch), 2) AS state_avg_precipitation,
       round(avg(avg_windspeed_mph), 2) AS state_avg_windspeed,
       count(*) AS brewery_count
FROM stg WHERE climate_zone <> 'unknown' GROUP BY state, climate_zone""",
        ("stg",),
    ),
    "dim": (
        """
SELECT brewery_id, brewery_name, brewery_type, city, state, latitude, longitude, website_url,
       has_coordinates, climate_zone,
       CASE WHEN brewery_type IN ('micro', 'nano', 'brewpub') THEN 'craft'
            WHEN brewery_type IN ('regional', 'large') THEN 'commercial'
            WHEN brewery_type = 'taproom' THEN 'taproom' ELSE 'other' END AS brewery_category
FROM stg""",
        ("stg",),
    ),
    "fact": (
        """
SELECT b.brewery_id, b.brewery_name, b.brewery_type, b.brewery_category, b.city, b.state,
       b.latitude, b.longitude, b.climate_zone, b.has_coordinates,
       w.state_avg_temp_max_f, w.state_avg_temp_min_f, w.state_avg_precipitation, w.state_avg_windspeed,
       w.brewery_count AS breweries_in_state
FROM dim b LEFT JOIN summ w ON b.state = w.state""",
        ("dim", "summ"),
    ),
    "ev": (
        """
SELECT event_id, user_id, event_type, value,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       CAST(ts AS DATE) AS d
FROM events""",
        (),
    ),
}


def _resolve(names: tuple[str, ...], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        _resolve(CTES[n][1], out)
        if n not in out:
            out.append(n)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []
    _resolve(names, order)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


MEAN = "CAST(CASE WHEN len({a}) = 0 OR list_count({a}) < len({a}) THEN NULL ELSE list_sum({a}) / len({a}) END AS FLOAT)"

ENR_ALL = "SELECT * FROM enr"

ORACLE: dict[str, str] = {
    # 2.1 sources
    "scan_ndjson_typed": with_ctes(
        """
SELECT * FROM raw_b
UNION ALL
SELECT CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS brewery_type,
       CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS country,
       CAST(NULL AS VARCHAR) AS latitude, CAST(NULL AS VARCHAR) AS longitude,
       CAST(NULL AS VARCHAR) AS website_url, CAST(NULL AS VARCHAR) AS phone
FROM raw_b WHERE id IS NULL""",
        "raw_b",
    ),
    "scan_ndjson_nested": with_ctes(
        """
SELECT brewery_id, brewery_name, state, city, latitude, longitude, fetch_date,
       CAST(len(tmax_l) AS BIGINT) AS n_days,
       CAST(len(tmin_l) - list_count(tmin_l) AS BIGINT) AS n_null_min,
       list_max(tmax_l) AS max_temp
FROM wx
UNION ALL
SELECT g.id, g.name, g.state, g.city, g.latitude, g.longitude,
       strftime((SELECT d FROM run_end), '%Y-%m-%d'), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE)
FROM geo g WHERE NOT EXISTS (SELECT 1 FROM wx WHERE wx.brewery_id = g.id)""",
        "wx",
        "geo",
        "run_end",
    ),
    "json_decode_lines": with_ctes("SELECT * FROM raw_b", "raw_b"),
    "scan_hive_parquet": with_ctes("SELECT * FROM stg", "stg"),
    "snapshot_latest": with_ctes(
        "SELECT event_id, user_id, event_type, value, year, month, day FROM ev WHERE d = (SELECT max(d) FROM ev)",
        "ev",
    ),
    "external_json_table": with_ctes("SELECT * FROM raw_b", "raw_b"),
    "paged_records": (
        "SELECT event_id // 200 + 1 AS page, event_id, event_type, CAST(to_json({'event_id': event_id, "
        "'event_type': event_type, 'user_id': user_id}) AS VARCHAR) AS record FROM events"
    ),
    "file_manifest": """
WITH line AS (
  SELECT 'events/' || strftime(ts, 'year=%Y/month=%m/day=%d') AS partition_key,
         CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS value
  FROM events
  UNION ALL
  SELECT 'orders/' || strftime(o_orderdate, 'year=%Y'), CAST(to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey}) AS VARCHAR)
  FROM orders
)
SELECT partition_key, count(*) AS n_rows, CAST((count(*) + 249) // 250 AS BIGINT) AS n_files,
       CAST(sum(strlen(value) + 1) AS BIGINT) AS n_bytes, true AS as_counted
FROM line GROUP BY partition_key""",
    # 2.2 sinks
    "sink_partitioned_parquet": with_ctes(ENR_ALL, "enr"),
    "sink_file_count": with_ctes(
        "SELECT state, CAST((count(*) + 39) // 40 AS BIGINT) AS n_files, count(*) AS n_rows FROM enr GROUP BY state", "enr"
    ),
    "sink_dated_json": with_ctes(
        """
SELECT event_id, user_id,
       CASE WHEN d = (SELECT max(d) FROM ev) THEN upper(event_type) ELSE event_type END AS event_type,
       value, event_id % 7 AS undeclared, year, month, day
FROM ev""",
        "ev",
    ),
    "publish_raw_zone": with_ctes(
        "SELECT year, month, day, count(*) AS source_rows, count(*) AS target_rows, 'uploaded' AS status FROM ev GROUP BY year, month, day",
        "ev",
    ),
    # the second run finds one file of the first day changed and one of the last day lost
    "publish_files": with_ctes(
        """
, days AS (SELECT year, month, day, d, count(*) AS lines, CAST((count(*) + 249) // 250 AS BIGINT) AS files FROM ev GROUP BY ALL),
runs AS (
  SELECT 1 AS run, *, files AS uploaded FROM days
  UNION ALL
  SELECT 2, *, least(files, CAST(d = (SELECT min(d) FROM days) AS BIGINT) + CAST(d = (SELECT max(d) FROM days) AS BIGINT)) FROM days
)
SELECT run, year, month, day, files, CAST(lines AS BIGINT) AS lines, uploaded, files - uploaded AS unchanged, CAST(0 AS BIGINT) AS failed FROM runs""",
        "ev",
    ),
    "materialize_model": with_ctes("SELECT * FROM dim", "dim"),
    "publish_versions": with_ctes(
        """
SELECT reader, state, brewery_category, count(*) AS n
FROM (SELECT 'after' AS reader, * FROM dim UNION ALL SELECT 'before', * FROM dim WHERE has_coordinates)
GROUP BY reader, state, brewery_category""",
        "dim",
    ),
    "preview": with_ctes(
        """
SELECT brewery_id, name, state, brewery_type, avg_temp_max_f, climate_zone FROM enr
ORDER BY name ASC NULLS LAST, state ASC NULLS LAST, brewery_id ASC NULLS LAST LIMIT 10""",
        "enr",
    ),
    # 2.3 projections
    "clean_locations": with_ctes("SELECT * FROM clean_b", "clean_b"),
    "safe_cast_coords": with_ctes(
        "SELECT id, TRY_CAST(latitude AS FLOAT) AS latitude, TRY_CAST(longitude AS FLOAT) AS longitude FROM raw_b",
        "raw_b",
    ),
    "normalize_category": with_ctes("SELECT id, lower(trim(brewery_type)) AS brewery_type FROM raw_b", "raw_b"),
    "flag_coordinates": with_ctes(
        "SELECT id, (TRY_CAST(latitude AS FLOAT) IS NOT NULL AND TRY_CAST(longitude AS FLOAT) IS NOT NULL) "
        "AS has_coordinates FROM raw_b",
        "raw_b",
    ),
    "flatten_weather": with_ctes("SELECT * FROM wc", "wc"),
    "threshold_ladder": with_ctes("SELECT brewery_id, avg_temp_max_f, climate_zone FROM enr", "enr"),
    "prefix_code": with_ctes(
        "SELECT brewery_id, state, upper(substring(state, 1, 2)) AS state_code FROM clean_b", "clean_b"
    ),
    "stg_locations": with_ctes("SELECT * FROM stg", "stg"),
    "dim_locations": with_ctes("SELECT * FROM dim", "dim"),
    "fact_location_weather": with_ctes("SELECT * FROM fact", "fact"),
    "fact_matched_zone": with_ctes(
        """
SELECT b.brewery_id, b.brewery_name, b.brewery_type, b.brewery_category, b.city, b.state,
       b.latitude, b.longitude, b.climate_zone, b.has_coordinates,
       w.state_avg_temp_max_f, w.state_avg_temp_min_f, w.state_avg_precipitation, w.state_avg_windspeed,
       coalesce(w.brewery_count, -1) AS breweries_in_state
FROM dim b LEFT JOIN summ w ON b.state = w.state AND b.climate_zone = w.climate_zone""",
        "dim",
        "summ",
    ),
    "assemble_weather": with_ctes(
        """
SELECT g.id AS brewery_id, strftime((SELECT d FROM run_end), '%Y-%m-%d') AS fetch_date,
       row_number() OVER (PARTITION BY g.id ORDER BY w.obs_date) AS day_index,
       w.tmax AS temperature_2m_max, w.tmin AS temperature_2m_min,
       w.precip AS precipitation_sum, w.wind AS windspeed_10m_max
FROM win w JOIN geo g ON w.loc_id = g.id""",
        "win",
        "geo",
        "run_end",
    ),
    # the same records, from the zone by day
    "assemble_from_zone": with_ctes(
        """
SELECT g.id AS brewery_id, strftime((SELECT d FROM run_end), '%Y-%m-%d') AS fetch_date,
       row_number() OVER (PARTITION BY g.id ORDER BY w.obs_date) AS day_index,
       w.tmax AS temperature_2m_max, w.tmin AS temperature_2m_min,
       w.precip AS precipitation_sum, w.wind AS windspeed_10m_max
FROM win w JOIN geo g ON w.loc_id = g.id""",
        "win",
        "geo",
        "run_end",
    ),
    # 2.4 filters
    "filter_country": with_ctes(
        "SELECT id, name, country FROM raw_b WHERE country = 'United States' OR country IS NULL", "raw_b"
    ),
    "filter_required": with_ctes(
        "SELECT id, name, state FROM raw_b WHERE name IS NOT NULL AND state IS NOT NULL", "raw_b"
    ),
    "filter_geocoded": with_ctes("SELECT id, name, state, latitude, longitude FROM geo", "geo"),
    "trailing_window": with_ctes(
        "SELECT loc_id, strftime(obs_date, '%Y-%m-%d') AS obs_date, tmax, tmin, precip, wind, n FROM win", "win"
    ),
    # 2.5 joins
    "left_join_weather": with_ctes("SELECT * FROM joined", "joined"),
    "missing_weather": with_ctes(
        "SELECT id, name, state FROM geo g WHERE NOT EXISTS (SELECT 1 FROM wx WHERE wx.brewery_id = g.id)",
        "geo",
        "wx",
    ),
    "lookup_report": with_ctes(
        """
SELECT count(*) FILTER (WHERE EXISTS (SELECT 1 FROM wx WHERE wx.brewery_id = g.id)) AS succeeded,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM wx WHERE wx.brewery_id = g.id)) AS failed
FROM geo g""",
        "geo",
        "wx",
    ),
    # 2.6 aggregations
    "join_coverage": with_ctes(
        "SELECT count(*) AS total_rows, count(avg_temp_max_f) AS with_weather FROM enr", "enr"
    ),
    "state_weather_summary": with_ctes("SELECT * FROM summ", "summ"),
    "stage_counts": with_ctes(
        """
SELECT (SELECT count(*) FROM raw_b) AS raw_locations, (SELECT count(*) FROM clean_b) AS clean_locations,
       (SELECT count(*) FROM wx) AS raw_weather, (SELECT count(*) FROM wc) AS clean_weather""",
        "raw_b",
        "clean_b",
        "wx",
        "wc",
    ),
    "stage_counts_written": with_ctes(
        """
SELECT (SELECT count(*) FROM raw_b) AS raw_locations, (SELECT count(*) FROM wx) AS raw_weather,
       (SELECT count(*) FROM clean_b) AS clean_locations, (SELECT count(*) FROM wc) AS clean_weather,
       count(*) AS joined, count(avg_temp_max_f) AS with_weather
FROM enr""",
        "raw_b",
        "clean_b",
        "wx",
        "wc",
        "enr",
    ),
    "geocode_coverage": with_ctes(
        """
SELECT (SELECT count(*) FROM geo) AS geocoded, count(*) - (SELECT count(*) FROM geo) AS skipped
FROM raw_b""",
        "raw_b",
        "geo",
    ),
    "top_groups": with_ctes(
        "SELECT state, count(*) AS brewery_count FROM raw_b GROUP BY state "
        "ORDER BY brewery_count DESC, state ASC NULLS LAST LIMIT 10",
        "raw_b",
    ),
    "dominant_category": with_ctes(
        """
SELECT state, brewery_type, n FROM (
  SELECT state, brewery_type, n,
         row_number() OVER (PARTITION BY state ORDER BY n DESC, brewery_type ASC NULLS LAST) AS rn
  FROM (SELECT state, brewery_type, count(*) AS n FROM dim GROUP BY state, brewery_type) c
) r WHERE rn = 1""",
        "dim",
    ),
    "density_correlation": with_ctes(
        """
SELECT round(corr(m, n), 6) AS corr_temp_density, count(*) AS n_groups FROM (
  SELECT state, avg(avg_temp_max_f) AS m,
         CAST(count(*) FILTER (WHERE brewery_type IN ('micro', 'nano', 'brewpub')) AS DOUBLE) AS n
  FROM stg GROUP BY state) s""",
        "stg",
    ),
    "count_over_time": """
SELECT state, period, n_members,
       coalesce(lag(n_members) OVER (PARTITION BY state ORDER BY period), -9223372036854775808) AS prev_members,
       coalesce(n_members - lag(n_members) OVER (PARTITION BY state ORDER BY period), -9223372036854775808) AS change
FROM (SELECT n_name AS state, strftime(o_orderdate, '%Y') AS period, count(DISTINCT o_custkey) AS n_members
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_name, strftime(o_orderdate, '%Y')) c""".strip(),
    # 2.7 quality
    "check_unique": with_ctes(
        """
SELECT 'stg_locations' AS model, brewery_id, count(*) AS n FROM stg WHERE brewery_id IS NOT NULL GROUP BY brewery_id HAVING count(*) > 1
UNION ALL
SELECT 'dim_locations', brewery_id, count(*) FROM dim WHERE brewery_id IS NOT NULL GROUP BY brewery_id HAVING count(*) > 1
UNION ALL
SELECT 'fact_location_weather', brewery_id, count(*) FROM fact WHERE brewery_id IS NOT NULL GROUP BY brewery_id HAVING count(*) > 1""",
        "stg",
        "dim",
        "fact",
    ),
    "check_not_null": with_ctes(
        """
SELECT 'stg_locations' AS model, 'brewery_id' AS column_name, count(*) FILTER (WHERE brewery_id IS NULL) AS failures FROM stg
UNION ALL SELECT 'stg_locations', 'brewery_name', count(*) FILTER (WHERE brewery_name IS NULL) FROM stg
UNION ALL SELECT 'stg_locations', 'state', count(*) FILTER (WHERE state IS NULL) FROM stg
UNION ALL SELECT 'stg_locations', 'brewery_type', count(*) FILTER (WHERE brewery_type IS NULL) FROM stg
UNION ALL SELECT 'state_weather_summary', 'state', count(*) FILTER (WHERE state IS NULL) FROM summ
UNION ALL SELECT 'dim_locations', 'brewery_id', count(*) FILTER (WHERE brewery_id IS NULL) FROM dim
UNION ALL SELECT 'dim_locations', 'brewery_category', count(*) FILTER (WHERE brewery_category IS NULL) FROM dim
UNION ALL SELECT 'fact_location_weather', 'brewery_id', count(*) FILTER (WHERE brewery_id IS NULL) FROM fact
UNION ALL SELECT 'fact_location_weather', 'state', count(*) FILTER (WHERE state IS NULL) FROM fact""",
        "stg",
        "summ",
        "dim",
        "fact",
    ),
    "check_accepted_values": with_ctes(
        """
SELECT 'dim_locations' AS model, 'brewery_category' AS column_name, brewery_category AS value, count(*) AS n
FROM dim WHERE brewery_category NOT IN ('craft', 'commercial', 'taproom', 'other') GROUP BY brewery_category
UNION ALL
SELECT 'stg_locations', 'brewery_type', brewery_type, count(*)
FROM stg WHERE brewery_type NOT IN ('micro', 'nano', 'brewpub', 'regional', 'large', 'taproom') GROUP BY brewery_type""",
        "dim",
        "stg",
    ),
    "quality_report": with_ctes(
        """
SELECT model, column_name, test, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT 'stg_locations' AS model, 'brewery_id' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE brewery_id IS NULL) AS failures FROM stg
  UNION ALL SELECT 'stg_locations', 'brewery_name', 'not_null', count(*) FILTER (WHERE brewery_name IS NULL) FROM stg
  UNION ALL SELECT 'stg_locations', 'state', 'not_null', count(*) FILTER (WHERE state IS NULL) FROM stg
  UNION ALL SELECT 'stg_locations', 'brewery_type', 'not_null', count(*) FILTER (WHERE brewery_type IS NULL) FROM stg
  UNION ALL SELECT 'state_weather_summary', 'state', 'not_null', count(*) FILTER (WHERE state IS NULL) FROM summ
  UNION ALL SELECT 'dim_locations', 'brewery_id', 'not_null', count(*) FILTER (WHERE brewery_id IS NULL) FROM dim
  UNION ALL SELECT 'dim_locations', 'brewery_category', 'not_null', count(*) FILTER (WHERE brewery_category IS NULL) FROM dim
  UNION ALL SELECT 'fact_location_weather', 'brewery_id', 'not_null', count(*) FILTER (WHERE brewery_id IS NULL) FROM fact
  UNION ALL SELECT 'fact_location_weather', 'state', 'not_null', count(*) FILTER (WHERE state IS NULL) FROM fact
  UNION ALL SELECT 'stg_locations', 'brewery_id', 'unique',
         (SELECT count(*) FROM (SELECT brewery_id FROM stg WHERE brewery_id IS NOT NULL GROUP BY brewery_id HAVING count(*) > 1))
  UNION ALL SELECT 'dim_locations', 'brewery_id', 'unique',
         (SELECT count(*) FROM (SELECT brewery_id FROM dim WHERE brewery_id IS NOT NULL GROUP BY brewery_id HAVING count(*) > 1))
  UNION ALL SELECT 'dim_locations', 'brewery_category', 'accepted_values',
         (SELECT count(DISTINCT brewery_category) FROM dim WHERE brewery_category NOT IN ('craft', 'commercial', 'taproom', 'other'))
) t""",
        "stg",
        "summ",
        "dim",
        "fact",
    ),
    # 2.8 set operations
    "union_snapshots": with_ctes(
        """
SELECT 'a' AS snapshot, id, name, state FROM raw_b
UNION ALL
SELECT 'b', id, name, state FROM raw_b r
WHERE EXISTS (SELECT 1 FROM orders o WHERE year(o.o_orderdate) % 2 = 0 AND CAST(o.o_custkey AS VARCHAR) = r.id)
UNION ALL
SELECT 'c', id, name, state FROM raw_b r
WHERE EXISTS (SELECT 1 FROM orders o WHERE year(o.o_orderdate) % 2 = 1 AND CAST(o.o_custkey AS VARCHAR) = r.id)""",
        "raw_b",
    ),
    # 2.9 scalar functions
    "array_mean": with_ctes(
        "SELECT brewery_id, "
        + MEAN.format(a="tmax_l")
        + " AS mean_max, "
        + MEAN.format(a="tmin_l")
        + " AS mean_min, "
        + MEAN.format(a="list_filter(tmax_l, lambda x: x >= 50)")
        + " AS mean_max_hot FROM wx",
        "wx",
    ),
    "partition_parts": "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders",
    "json_encode_lines": "SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS line FROM events",
    # 2.12 composites
    "enrich": with_ctes(ENR_ALL, "enr"),
    "enrichment_job": with_ctes(ENR_ALL, "enr"),
}
