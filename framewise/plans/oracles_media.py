"""SQL oracles for the image, feature and incremental queries."""

from __future__ import annotations

from framewise.plans.oracles import ORACLES, oracle, w

DOCS = """
docs AS (
  SELECT vec_id AS image_id, vec_id // 50 + 1 AS video, CAST(vec_id % 50 + 1 AS BIGINT) AS frame,
         printf('C_%06d_%02d.jpg', vec_id // 50 + 1, vec_id % 50 + 1) AS filename,
         CASE vec_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS processed
  FROM embeddings),
manifest AS (
  SELECT video, CAST(f AS BIGINT) AS frame, printf('C_%06d_%02d.jpg', video, f) AS filename
  FROM (SELECT DISTINCT video FROM docs), range(1, 51) AS g(f)),
px AS (
  SELECT vec_id // 50 AS video, vec_id % 50 AS frame,
         CAST(unnest(range(len(embedding))) AS INTEGER) AS pixel,
         CAST(floor(least(255, greatest(0, (CAST(unnest(embedding) AS DOUBLE) + 1) * 127.5))) AS BIGINT) AS v
  FROM embeddings),
win AS (
  SELECT video, frame, pixel, v,
         count(v) OVER w AS n,
         coalesce(sum(v) OVER w, 0) AS s,
         coalesce(sum(v * v) OVER w, 0) AS q
  FROM px
  WINDOW w AS (PARTITION BY video, pixel ORDER BY frame ROWS BETWEEN 500 PRECEDING AND 1 PRECEDING)),
fg AS (
  SELECT video, frame, pixel, v,
         CAST(n > 0 AND (n * v - s) * (n * v - s) > 16 * greatest(4 * n * n, least(75 * n * n, n * q - s * s))
              AS INTEGER) AS foreground
  FROM win),
dens AS (SELECT video, frame, avg(foreground) AS traffic_density FROM fg GROUP BY video, frame),
feats AS (
  SELECT video * 50 + frame AS image_id, printf('C_%06d_%02d.jpg', video + 1, frame + 1) AS filename,
         traffic_density FROM dens)
"""


def m(select: str) -> str:
    return f"WITH {DOCS.strip()}\n{select}"


oracle("image_manifest", m("SELECT * FROM manifest"))
oracle("missing_images", m("SELECT * FROM manifest WHERE filename NOT IN "
                           "(SELECT filename FROM docs WHERE image_id % 7 <> 0)"))
oracle("basename", "SELECT page_id, string_split(url, '/')[-1] AS filename FROM pages")
oracle("field_defaults", "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), 'unknown') AS filename, "
                         "nullif(c_mktsegment, 'BUILDING') IS NOT NULL AS has_payload FROM customer")
oracle("unprocessed_filter", m("SELECT image_id, filename, processed FROM docs "
                               "WHERE processed IS DISTINCT FROM true"))
oracle("next_batch", m("SELECT image_id, filename, processed FROM docs "
                       "WHERE processed IS DISTINCT FROM true ORDER BY image_id LIMIT 10"))
oracle("pixel_foreground", m("SELECT * FROM fg"))
oracle("pixel_foreground_chunks", ORACLES["pixel_foreground"])
oracle("traffic_density", m("SELECT video, frame, round(traffic_density, 6) AS traffic_density FROM dens"))
oracle("feature_upsert", m("SELECT image_id, filename, "
                           "round(CASE WHEN image_id % 2 = 0 THEN traffic_density ELSE 0.0 END, 6) "
                           "AS traffic_density FROM feats"))
oracle("processed_flag", m("SELECT image_id, filename, coalesce(processed, false) OR image_id % 2 = 0 "
                           "AS processed FROM docs"))
oracle("batch_progress", m(
    "SELECT batch_id, processed, CAST(sum(processed) OVER (ORDER BY batch_id) AS BIGINT) AS running_total "
    "FROM (SELECT image_id // 10 AS batch_id, count(*) AS processed FROM docs "
    "WHERE processed IS DISTINCT FROM true GROUP BY 1)"))

#: Outputs of the analysis job that equal a query of their own.
JOB_OUTPUTS = (
    "frame_level_data", "crash_summary", "crashes_by_time", "anomaly_summary", "crash_histogram", "anomalies_by_time",
    "anomalies_by_weather", "ego_scatter", "weather_boxplot", "anomaly_crosstab", "density_timeline", "density_by_sequence",
    "crash_distribution", "crash_heatmap", "crashes_by_ego", "crashes_by_weather", "startframe_counts", "frame_timeline",
    "crash_share", "kpi_cards", "rate_by_condition")

oracle("incremental_density", ORACLES["traffic_density"])


# The frames that Spark writes as image files: coloured, their grey value in whole thousandths.
LEVELS = """
levels AS (
  SELECT vec_id, vec_id % 97 = 0 AS corrupt, CAST(sqrt(len(embedding)) AS INTEGER) AS side,
         printf('C_%06d_%02d.png', vec_id // 50 + 1, vec_id % 50 + 1) AS filename,
         list_transform(embedding, lambda x: CAST(floor(least(255, greatest(0, (CAST(x AS DOUBLE) + 1) * 127.5))) AS BIGINT)) AS b
  FROM embeddings),
bgr AS (
  SELECT *, list_transform(range(len(b)), lambda i: b[(i + 21) % len(b) + 1]) AS g,
         list_transform(range(len(b)), lambda i: b[(i + 42) % len(b) + 1]) AS r
  FROM levels)
"""


def frame_density(where: str) -> str:
    """Density per image file (1-based keys) over the frames that ``where`` keeps."""
    return f"""
WITH {LEVELS.strip()},
grey AS (
  SELECT vec_id // 50 AS video, vec_id % 50 AS frame, unnest(range(len(b))) AS pixel,
         unnest(list_transform(range(1, len(b) + 1), lambda i: (114 * b[i] + 587 * g[i] + 299 * r[i] + 500) // 1000)) AS v
  FROM bgr)
SELECT video + 1 AS video, CAST(frame + 1 AS BIGINT) AS frame,
       printf('C_%06d_%02d.png', video + 1, frame + 1) AS filename, round(avg(foreground), 6) AS traffic_density
FROM (
  SELECT video, frame, CAST(n > 0 AND (n * v - s) * (n * v - s)
         > 16 * greatest(4 * n * n, least(75 * n * n, n * q - s * s)) AS INTEGER) AS foreground
  FROM (
    SELECT video, frame, v, count(v) OVER w AS n, coalesce(sum(v) OVER w, 0) AS s, coalesce(sum(v * v) OVER w, 0) AS q
    FROM grey WHERE {where}
    WINDOW w AS (PARTITION BY video, pixel ORDER BY frame ROWS BETWEEN 500 PRECEDING AND 1 PRECEDING)))
GROUP BY video, frame"""


oracle("incremental_features", frame_density("true"))
for _name in ("frame_features", "incremental_image_features", "job_features"):  # damaged files have no frame
    oracle(_name, frame_density("(video * 50 + frame) % 97 <> 0"))
oracle("upsert_table", ORACLES["feature_upsert"])
oracle("job_features_table", f"""WITH done AS ({frame_density("(video * 50 + frame) % 97 <> 0")})
SELECT printf('C_%06d_%02d.png', vec_id // 50 + 1, vec_id % 50 + 1) AS filename, vec_id % 97 <> 0 AS processed, traffic_density
FROM embeddings LEFT JOIN done ON done.filename = printf('C_%06d_%02d.png', vec_id // 50 + 1, vec_id % 50 + 1)""")
oracle("image_progress", "SELECT CAST(sum(CAST(vec_id % 97 <> 0 AS INTEGER)) AS BIGINT) AS processed, "
                         "CAST(sum(CAST(vec_id % 97 = 0 AS INTEGER)) AS BIGINT) AS failed FROM embeddings")

# Every 97th vector is written as a damaged file, so the decoded metadata is known in SQL.
FRAMES = """
frames AS (
  SELECT vec_id AS image_id, printf('C_%06d_%02d.png', vec_id // 50 + 1, vec_id % 50 + 1) AS filename,
         vec_id % 97 = 0 AS corrupt,
         CAST(sqrt(len(embedding)) AS INTEGER) AS side
  FROM embeddings),
decoded AS (
  SELECT image_id, filename,
         CASE WHEN corrupt THEN -1 ELSE side END AS height,
         CASE WHEN corrupt THEN -1 ELSE side END AS width,
         CASE WHEN corrupt THEN -1 ELSE 3 END AS "nChannels",
         CASE WHEN corrupt THEN -1 ELSE 16 END AS mode,
         corrupt
  FROM frames)
"""


def f(select: str) -> str:
    return f"WITH {FRAMES.strip()}\n{select}"


oracle("image_profile", f('SELECT filename, height, width, "nChannels", mode FROM decoded'))
oracle("bad_images", f("SELECT filename, 'undecodable' AS reason FROM decoded WHERE corrupt"))
HEX = "list_transform(range(256), lambda v: printf('%02X', v))"


def resized(where: str) -> str:
    """Two passes of fixed-point weights over each channel: columns, then rows."""
    return f"""
WITH {LEVELS.strip()},
taps AS (
  SELECT side, o, i, CASE WHEN x < 1 THEN (1.5 * x - 2.5) * x * x + 1 WHEN x < 2 THEN (((x - 5) * x + 8) * x - 4) * -0.5 ELSE 0 END AS w
  FROM (SELECT side, o, i, abs((i + 0.5 - (o + 0.5) * side / 128.0) / greatest(side / 128.0, 1.0)) AS x
        FROM (SELECT DISTINCT side FROM levels), range(128) AS a(o), (SELECT unnest(range((SELECT max(side) FROM levels))) AS i)
        WHERE i < side)),
fixed AS (SELECT side, o, i, floor(w / sum(w) OVER (PARTITION BY side, o) * 16384 + 0.5) AS w FROM taps),
matrix AS (
  SELECT side, list(w ORDER BY o) AS m FROM (SELECT side, o, list(w ORDER BY i) AS w FROM fixed GROUP BY side, o) GROUP BY side),
channel AS (
  SELECT vec_id, side, unnest([1, 2, 3]) AS c, unnest([b, g, r]) AS px FROM bgr WHERE NOT corrupt AND {where}),
wide AS (
  SELECT vec_id, c, m, list_transform(range(side), lambda y: list_transform(m, lambda w: greatest(0, least(255, floor(
           (list_dot_product(w, px[y * side + 1:(y + 1) * side]::DOUBLE[]) + 8192) / 16384))))) AS rows
  FROM channel JOIN matrix USING (side)),
turned AS (
  SELECT vec_id, c, m, list_transform(range(1, 129), lambda x: list_transform(rows, lambda r: r[x])) AS cols FROM wide),
tall AS (
  SELECT vec_id, c, flatten(list_transform(m, lambda w: list_transform(cols, lambda k: greatest(0, least(255, floor(
           (list_dot_product(w, k) + 8192) / 16384)))::INTEGER))) AS px FROM turned),
three AS (
  SELECT vec_id, max(px) FILTER (c = 1) AS b, max(px) FILTER (c = 2) AS g, max(px) FILTER (c = 3) AS r FROM tall GROUP BY vec_id)
SELECT printf('C_%06d_%02d.png', vec_id // 50 + 1, vec_id % 50 + 1) AS filename, 128 AS height, 128 AS width, 3 AS "nChannels",
       sha256(array_to_string(list_transform(range(1, 16385), lambda i: hx[b[i] + 1] || hx[g[i] + 1] || hx[r[i] + 1]), ''))
       AS pixels_sha256
FROM three, (SELECT {HEX} AS hx)"""


oracle("resize_images", resized("true"))
oracle("job_resize", resized("vec_id % 7 <> 0"))
oracle("job_resize_bad", f("SELECT filename, 'undecodable' AS reason FROM decoded WHERE corrupt AND image_id % 7 <> 0"))
oracle("job_resize_missing", m("SELECT * FROM manifest WHERE filename NOT IN (SELECT filename FROM docs WHERE image_id % 7 <> 0)"))
oracle("scan_images", f("""SELECT filename, '89504E470D0A1A0A0000000D49484452' || printf('%08X%08X', side, side) AS head,
  NOT corrupt AS complete FROM frames"""))
oracle("list_images", f("SELECT filename, true AS has_bytes, true AS has_time FROM frames"))
oracle("decode_images", f"""WITH {LEVELS.strip()}, {FRAMES.strip()}
SELECT d.*  EXCLUDE (corrupt, image_id), sha256(CASE WHEN d.corrupt THEN '' ELSE array_to_string(list_transform(range(1, len(b) + 1),
       lambda i: hx[b[i] + 1] || hx[g[i] + 1] || hx[r[i] + 1]), '') END) AS pixels_sha256
FROM decoded d JOIN bgr ON vec_id = image_id, (SELECT {HEX} AS hx)""")
oracle("ingest_images", f('SELECT filename, height, width, "nChannels", mode, CAST(NULL AS BOOLEAN) AS processed '
                          "FROM decoded"))
oracle("scan_image_table", f("SELECT filename, height, width FROM decoded"))

oracle("scan_dump_records", ORACLES["scan_records"])
oracle("scan_dump_images", f"""WITH {LEVELS.strip()}
SELECT vec_id AS image_id, printf('C_%06d_%02d.jpg', vec_id // 50 + 1, vec_id % 50 + 1) AS filename,
       CASE vec_id % 3 WHEN 1 THEN false END AS processed,
       sha256(array_to_string(list_transform(range(1, len(b) + 1), lambda i: hx[b[i] + 1] || hx[g[i] + 1] || hx[r[i] + 1]), ''))
       AS pixels_sha256
FROM bgr, (SELECT {HEX} AS hx) WHERE vec_id % 3 <> 0""")

# The lowest fifth of the hashes of each label is the test part.
SPLIT = """
sev AS (
  SELECT rec.sequence_id, rec.timing, rec.weather, rec.egoinvolve, CAST(seq.crash_count > 11 AS INTEGER) AS crash_severity
  FROM rec JOIN seq USING (sequence_id)),
parted AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY crash_severity ORDER BY md5(CAST(sequence_id AS VARCHAR)), sequence_id)
                      <= count(*) OVER (PARTITION BY crash_severity) // 5 THEN 'test' ELSE 'train' END AS split
  FROM sev)"""
oracle("ml_split", w("SELECT * FROM parted", SPLIT))
oracle("severity_nodes", w("SELECT sequence_id, true AS agrees FROM parted WHERE split = 'test'", SPLIT))

# Whole jobs: the tables they write equal the operator oracles.
oracle("job_analysis_metrics", ORACLES["metrics_export"])
oracle("job_analysis_sequences", ORACLES["sequence_level_data"])
oracle("job_analysis_frames_json", ORACLES["frame_rows"])
oracle("job_analysis_counts", w("""SELECT (SELECT count(*) FROM rec) AS records, count(*) AS frames, CAST(0 AS BIGINT) AS null_ids,
  count(*) FILTER (crash_detected IS NULL) AS null_flags, CAST(sum(crash_detected) AS BIGINT) AS crashes FROM fr"""))
for _name in JOB_OUTPUTS:
    oracle(f"job_analysis_{_name}", ORACLES[_name])
oracle("job_clean", ORACLES["clean_records"])
oracle("job_weather_report", ORACLES["weather_counts"])
oracle("job_ingest", f('SELECT filename, height, width, "nChannels", mode FROM decoded'))
oracle("job_profile_images", f('SELECT filename, true AS has_payload, height, width, "nChannels", mode FROM decoded'))
