"""Independent SQL oracles (DuckDB dialect) for the named queries.

The oracle side never shares a plan with the Spark side: frames come from a
``part x range(50)`` grid left-joined to distinct crash hits instead of a
bit-mask aggregate and an explode; sequences are grouped instead of folded.
Doubles are rounded to 6 places, as in the Spark queries.
"""

from __future__ import annotations

N = 50


def _frame_pivot(prefix: str = "frame_", base: int = 1, agg: str = "max", cast: str = "INTEGER",
                 default: str | None = None) -> str:
    cells = []
    for i in range(N):
        expr = f"{agg}(CASE WHEN frame_number = {i} THEN crash_detected END)"
        if default is not None:
            expr = f"coalesce({expr}, {default})"
        cells.append(f"CAST({expr} AS {cast}) AS {prefix}{i + base}")
    return ", ".join(cells)


BASE = f"""
rec AS (
  SELECT p_partkey AS sequence_id,
         lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS vidname,
         CAST(p_size AS INTEGER) AS startframe,
         p_name AS youtubeid,
         CASE p_partkey % 4 WHEN 0 THEN 'Day' WHEN 1 THEN 'Night' WHEN 2 THEN 'Daytime' END AS timing,
         CASE WHEN starts_with(p_type, 'PROMO') THEN 'Snowy'
              WHEN starts_with(p_type, 'SMALL') THEN 'Rainy'
              WHEN starts_with(p_type, 'STANDARD') THEN NULL
              ELSE 'Normal' END AS weather,
         CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS egoinvolve
  FROM part),
hit AS (
  SELECT DISTINCT l_partkey, CAST(l_quantity AS INTEGER) - 1 AS frame_number
  FROM lineitem WHERE l_returnflag = 'R' AND l_quantity BETWEEN 1 AND {N}),
fr AS (
  SELECT r.sequence_id, r.timing, r.egoinvolve, r.weather, r.vidname, r.startframe,
         CAST(g.frame_number AS INTEGER) AS frame_number,
         CASE WHEN h.l_partkey IS NOT NULL THEN 1 WHEN (r.sequence_id + g.frame_number) % 17 <> 0 THEN 0 END AS crash_detected,
         CASE WHEN contains(lower(r.timing), 'day') THEN 'Day' ELSE 'Night' END AS time_of_day
  FROM rec r CROSS JOIN range({N}) AS g(frame_number)
  LEFT JOIN hit h ON h.l_partkey = r.sequence_id AND h.frame_number = g.frame_number),
seq AS (
  SELECT sequence_id, time_of_day, weather, egoinvolve,
         CAST(sum(crash_detected) AS BIGINT) AS crash_count,
         avg(crash_detected) AS crash_density,
         count(*) AS total_frames
  FROM fr GROUP BY sequence_id, time_of_day, weather, egoinvolve),
thr AS (
  SELECT avg(crash_count) AS avg_crashes, stddev_samp(crash_count) AS std_crashes,
         quantile_cont(crash_count, 0.9) AS percentile_threshold,
         avg(crash_count) + stddev_samp(crash_count) AS statistical_threshold,
         least(avg(crash_count) + stddev_samp(crash_count), quantile_cont(crash_count, 0.9)) AS final_threshold
  FROM seq),
flg AS (
  SELECT s.*, coalesce(s.crash_count > t.final_threshold, false) AS is_anomaly
  FROM seq s, thr t),
cin AS (
  SELECT sequence_id AS p_partkey, vidname, startframe, youtubeid, timing, weather, egoinvolve FROM rec
  UNION ALL
  SELECT sequence_id AS p_partkey, vidname, startframe, youtubeid, timing, weather, egoinvolve FROM rec),
cln AS (
  SELECT vidname, startframe, youtubeid, timing, weather, egoinvolve
  FROM (SELECT DISTINCT * FROM cin)
  WHERE p_partkey IS NOT NULL AND vidname IS NOT NULL AND startframe IS NOT NULL
    AND youtubeid IS NOT NULL AND timing IS NOT NULL AND weather IS NOT NULL AND egoinvolve IS NOT NULL),
fm AS (
  SELECT CAST(sum(crash_detected) AS BIGINT) AS total_crashes, avg(crash_detected) AS crash_rate,
         count(*) AS total_frames, avg(crash_detected) * 100 AS crash_percentage
  FROM fr),
am AS (
  SELECT count_if(is_anomaly) AS anomalies_count, count(*) AS total_sequences,
         avg(crash_count) AS avg_crashes_per_sequence, stddev_samp(crash_count) AS std_crashes,
         quantile_cont(crash_count, 0.9) AS percentile_threshold,
         count_if(is_anomaly) / count(*) * 100 AS anomaly_percentage,
         avg(crash_count) + stddev_samp(crash_count) AS statistical_threshold,
         least(avg(crash_count) + stddev_samp(crash_count), quantile_cont(crash_count, 0.9)) AS final_threshold
  FROM flg)
"""


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def w(select: str, extra_ctes: str = "") -> str:
    ctes = BASE.rstrip() + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{select}"


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


# ---------------------------------------------------------------- frames (P)
oracle("frame_rows", w("SELECT * FROM fr"))
oracle("time_of_day", w("SELECT sequence_id, timing, "
                        "CASE WHEN contains(lower(timing), 'day') THEN 'Day' ELSE 'Night' END AS time_of_day FROM rec"))
oracle("crash_frames", w("SELECT sequence_id, frame_number, time_of_day, weather, egoinvolve "
                         "FROM fr WHERE crash_detected = 1"))
oracle("frame_level_data", w("SELECT sequence_id, time_of_day, egoinvolve, weather, frame_number, crash_detected FROM fr"))
oracle("default_startframe", w("SELECT sequence_id, frame_number, frame_number AS startframe FROM fr"))
oracle("sequence_ids", "SELECT count(*) AS n_records, count(DISTINCT p_partkey) AS n_distinct_monotonic, "
                       "count(DISTINCT lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS n_distinct_hash FROM part")

# ------------------------------------------------------- metrics / anomalies
oracle("crash_metrics", w("SELECT total_crashes, " + r6("crash_rate", "crash_rate") + ", total_frames, "
                          + r6("crash_percentage", "crash_percentage") + " FROM fm"))
oracle("row_counts", w("SELECT 'records' AS \"table\", count(*) AS row_count FROM rec "
                       "UNION ALL SELECT 'frames', count(*) FROM fr "
                       "UNION ALL SELECT 'lineitem', count(*) FROM lineitem"))
_SEQ_COLS = ("sequence_id, time_of_day, weather, egoinvolve, crash_count, "
             + r6("crash_density", "crash_density") + ", total_frames")
oracle("sequence_stats", w(f"SELECT {_SEQ_COLS} FROM seq"))
oracle("sequence_stats_records", w(f"SELECT {_SEQ_COLS} FROM seq"))
oracle("threshold_stats", w("SELECT " + r6("avg_crashes", "avg_crashes") + ", " + r6("std_crashes", "std_crashes")
                            + " FROM thr"))
oracle("p90_threshold", w("SELECT " + r6("percentile_threshold", "percentile_threshold") + " FROM thr"))
oracle("final_threshold", w("SELECT " + ", ".join(r6(c, c) for c in
                                                  ("statistical_threshold", "percentile_threshold", "final_threshold"))
                            + " FROM thr"))
oracle("sequence_level_data", w(f"SELECT {_SEQ_COLS}, is_anomaly FROM flg"))
_AM = ["anomalies_count", "total_sequences"] + [
    r6(c, c) for c in ("avg_crashes_per_sequence", "std_crashes", "percentile_threshold", "anomaly_percentage",
                       "statistical_threshold", "final_threshold")]
oracle("anomaly_metrics", w("SELECT " + ", ".join(_AM) + " FROM am"))

# ------------------------------------------------------------------ reports
oracle("crash_summary", w("SELECT time_of_day, weather, egoinvolve, CAST(sum(crash_detected) AS BIGINT) AS total_crashes, "
                          "count(*) AS total_frames, " + r6("avg(crash_detected)", "crash_rate")
                          + " FROM fr GROUP BY time_of_day, weather, egoinvolve"))
oracle("crashes_by_time", w("SELECT time_of_day, count(*) AS crash_count FROM fr WHERE crash_detected = 1 "
                            "GROUP BY time_of_day"))
oracle("anomaly_summary", w(
    "SELECT time_of_day, weather, CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomaly_count, "
    + r6("avg(crash_count)", "avg_crashes") + ", max(crash_count) AS max_crashes, "
    + r6("avg(crash_density)", "avg_density") + ", " + r6("max(crash_density)", "max_density")
    + " FROM flg WHERE time_of_day IS NOT NULL AND weather IS NOT NULL GROUP BY time_of_day, weather"))
oracle("weather_counts", w("SELECT weather, count(*) AS count FROM cln WHERE weather IS NOT NULL GROUP BY weather"))
oracle("crash_distribution", w(
    "SELECT crash_detected, CASE WHEN crash_detected = 1 THEN 'Crash' WHEN crash_detected = 0 THEN 'No Crash' "
    "ELSE CAST(crash_detected AS VARCHAR) END AS label, count(*) AS frame_count, "
    + r6("count(*) * 100.0 / sum(count(*)) OVER ()", "percentage")
    + " FROM fr WHERE crash_detected IS NOT NULL GROUP BY crash_detected"))
oracle("crashes_by_ego", w("SELECT egoinvolve, count(*) AS crash_count FROM fr WHERE crash_detected = 1 "
                           "AND egoinvolve IS NOT NULL GROUP BY egoinvolve"))
oracle("crashes_by_weather", w("SELECT weather, count(*) AS crash_count FROM fr WHERE crash_detected = 1 "
                               "AND weather IS NOT NULL GROUP BY weather"))
oracle("anomalies_by_time", w("SELECT time_of_day, count(*) AS anomaly_count FROM flg WHERE is_anomaly "
                              "AND time_of_day IS NOT NULL GROUP BY time_of_day"))
oracle("anomalies_by_weather", w("SELECT weather, count(*) AS anomaly_count FROM flg WHERE is_anomaly "
                                 "AND weather IS NOT NULL GROUP BY weather"))
oracle("anomaly_crosstab", w("SELECT weather, count_if(time_of_day = 'Day') AS \"Day\", "
                             "count_if(time_of_day = 'Night') AS \"Night\" FROM flg WHERE is_anomaly "
                             "AND weather IS NOT NULL GROUP BY weather"))
oracle("crash_heatmap", w("SELECT sequence_id, " + _frame_pivot("f_", 0, "sum", "BIGINT", "0")
                          + " FROM fr GROUP BY sequence_id"))
oracle("frame_timeline", w("SELECT frame_number, " + r6("avg(crash_detected)", "crash_rate")
                           + " FROM fr GROUP BY frame_number"))
oracle("startframe_counts", w("SELECT startframe, count(vidname) AS vidname_count FROM fr "
                              "WHERE startframe IS NOT NULL GROUP BY startframe"))
oracle("crash_histogram", w(
    "SELECT e.bin, " + r6("st + e.bin * step", "bin_start") + ", " + r6("st + (e.bin + 1) * step", "bin_end")
    + ", CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM edges e LEFT JOIN cnt c ON c.bin = e.bin",
    """
rng AS (SELECT min(crash_count) AS lo, max(crash_count) AS hi FROM seq WHERE crash_count IS NOT NULL),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 15 ELSE least(29, floor((crash_count - lo) * 30 / (hi - lo))) END AS BIGINT) AS bin
      FROM seq, rng WHERE crash_count IS NOT NULL),
cnt AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
edges AS (SELECT CAST(g.bin AS BIGINT) AS bin,
                 CASE WHEN hi = lo THEN CAST(lo AS DOUBLE) - 0.5 ELSE CAST(lo AS DOUBLE) END AS st,
                 CASE WHEN hi = lo THEN CAST(1 AS DOUBLE) / 30 ELSE CAST(hi - lo AS DOUBLE) / 30 END AS step
          FROM rng, range(30) AS g(bin) WHERE lo IS NOT NULL)"""))
oracle("weather_boxplot", w(
    "SELECT f.weather, n_sequences, " + ", ".join(r6(c, c) for c in ("q1", "median", "q3", "iqr", "lower_fence",
                                                                       "upper_fence"))
    + ", min(CASE WHEN crash_count BETWEEN lower_fence AND upper_fence THEN crash_count END) AS whisker_low"
    + ", max(CASE WHEN crash_count BETWEEN lower_fence AND upper_fence THEN crash_count END) AS whisker_high"
    + ", CAST(count(*) FILTER (WHERE NOT (crash_count BETWEEN lower_fence AND upper_fence)) AS BIGINT) AS n_outliers"
    + " FROM fq f JOIN bx USING (weather)"
    + " GROUP BY f.weather, n_sequences, q1, median, q3, iqr, lower_fence, upper_fence",
    """
bx AS (SELECT weather, crash_count FROM flg WHERE weather IS NOT NULL AND crash_count IS NOT NULL),
qs AS (SELECT weather, count(*) AS n_sequences, quantile_cont(crash_count, 0.25) AS q1,
              quantile_cont(crash_count, 0.5) AS median, quantile_cont(crash_count, 0.75) AS q3
       FROM bx GROUP BY weather),
fq AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM qs)"""))
oracle("ego_scatter", w("SELECT sequence_id, crash_count, egoinvolve, is_anomaly FROM flg"))
oracle("crash_share", w("SELECT count_if(crash_detected = 1) AS total_crashes, count(*) AS total_frames, "
                        + r6("count_if(crash_detected = 1) / count(*) * 100", "crash_share_pct") + " FROM fr"))
oracle("kpi_cards", w("SELECT fm.total_crashes, " + r6("am.anomaly_percentage", "anomaly_percentage") + ", "
                      + r6("fm.crash_rate", "crash_rate") + " FROM fm, am"))
oracle("rate_by_condition", w(" UNION ALL ".join(
    f"SELECT '{c}' AS condition, CAST({c} AS VARCHAR) AS value, CAST(sum(crash_detected) AS BIGINT) AS total_crashes, "
    f"count(*) AS total_frames, " + r6("avg(crash_detected)", "crash_rate") + f" FROM fr GROUP BY {c}"
    for c in ("time_of_day", "weather", "egoinvolve"))))
oracle("density_timeline", w("SELECT sequence_id, " + r6("crash_density", "crash_density") + " FROM flg WHERE is_anomaly"))
oracle("density_by_sequence", w("SELECT sequence_id, " + r6("crash_density", "crash_density")
                                + ", crash_count, is_anomaly, " + r6("t.final_threshold", "final_threshold")
                                + " FROM flg, thr t"))

oracle("frame_cube", w("SELECT time_of_day, weather, egoinvolve, startframe, frame_number, crash_detected, "
                       "count(*) AS n, count(vidname) AS n_vidname FROM fr "
                       "GROUP BY time_of_day, weather, egoinvolve, startframe, frame_number, crash_detected"))

# -------------------------------------------------------------------- clean
_ATTRS = "vidname, startframe, youtubeid, timing, weather, egoinvolve"
oracle("project_columns", w(f"SELECT {_ATTRS} FROM cin"))
oracle("drop_nulls", w("SELECT * FROM cin WHERE p_partkey IS NOT NULL AND vidname IS NOT NULL "
                       "AND startframe IS NOT NULL AND youtubeid IS NOT NULL AND timing IS NOT NULL "
                       "AND weather IS NOT NULL AND egoinvolve IS NOT NULL"))
oracle("drop_duplicates", w("SELECT DISTINCT * FROM cin"))
oracle("clean_records", w("SELECT * FROM cln"))

# ---------------------------------------------------------- sources / sinks
oracle("scan_records", w(f"SELECT {_ATTRS}, " + ", ".join(f"frame_{i}" for i in range(1, N + 1))
                         + " FROM rec JOIN pv USING (sequence_id)",
                         "pv AS (SELECT sequence_id, " + _frame_pivot() + " FROM fr GROUP BY sequence_id)"))
oracle("scan_catalog", w(f"SELECT {_ATTRS} FROM rec"))
oracle("scan_catalog_partition", w(f"SELECT {_ATTRS} FROM rec WHERE weather = 'Snowy'"))
oracle("catalog_sequence_stats", ORACLES["sequence_stats"])
oracle("scan_clean_parquet", w("SELECT * FROM cln"))
oracle("sink_parquet", ORACLES["crash_summary"])
oracle("sink_json", ORACLES["frame_level_data"])
oracle("sink_csv", ORACLES["crashes_by_time"])
_COUNTS = ("total_crashes", "total_frames", "anomalies_count", "total_sequences")
oracle("metrics_export", w("SELECT " + ", ".join(
    f"CAST({c} AS BIGINT) AS {c}" if c in _COUNTS else r6(c, c) for c in (
        "total_crashes", "crash_rate", "total_frames", "crash_percentage", "anomalies_count",
        "total_sequences", "avg_crashes_per_sequence", "std_crashes", "percentile_threshold",
        "anomaly_percentage", "statistical_threshold", "final_threshold")) + " FROM fm, am"))


def oracle_sql() -> dict[str, str]:
    from framewise.plans import oracles_media  # noqa: F401
    return dict(ORACLES)
