"""Queries of the data problems solved in the core, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrain.functions.status import canonical_status
from posegrain.operators.dedupe import keep_first_copy
from posegrain.operators.packed_fields import split_packed
from posegrain.operators.regular_grid import regular_grid
from posegrain.operators.spikes import Field, implausible_readings
from posegrain.session import read_table

# Physical ranges: a camera within a hall, angles of one turn, an error of a detected corner within an image.
POSE_FIELDS = {
    "camera_x_m": Field(-100.0, 100.0, 2e-4),
    "yaw_deg": Field(-180.0, 180.0, 0.02, angle=True),
    "reprojection_rmse_px": Field(0.0, 500.0, 0.01),
}


def pose_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Poses with a time, each copy counted once."""
    pose = keep_first_copy(read_table(spark, sf_dir, "pose"), ["session_id", "frame"], "pose_id", ["timestamp", *columns])
    return pose.filter(F.col("timestamp").isNotNull())


def p3_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 3: a row per session and second with the locally fitted ``camera_x_m`` of valid rows."""
    rows = pose_rows(spark, sf_dir, "camera_x_m", "quality_status")
    return regular_grid(rows, "session_id", "timestamp", F.col("camera_x_m"), F.coalesce(canonical_status(F.col("quality_status")) == "valid", F.lit(False)), step_name="second_no")


def p3_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p3_grid`` to five places, for comparison."""
    return p3_grid(spark, sf_dir).select("session_id", "second_no", F.round("value", 5).alias("value"), "n_inside", F.round("support", 5).alias("support"), "state")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_grid(spark, sf_dir).filter(F.col("state") != "observed").select("session_id", "second_no")


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 4: every value of every ``detected_ids``, with its place."""
    return split_packed(read_table(spark, sf_dir, "pose"), "pose_id", "detected_ids").select("pose_id", "value_no", "tag_value")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_packed(read_table(spark, sf_dir, "pose"), "pose_id", "detected_ids", only_uneven=True).select("pose_id", "value_no", "tag_value")


def p5_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 5: implausible readings with the test that flagged them."""
    rows = pose_rows(spark, sf_dir, *POSE_FIELDS)
    return implausible_readings(rows, "session_id", ["timestamp", "frame"], "pose_id", POSE_FIELDS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_flags(spark, sf_dir).select("pose_id", "field_name")


def p5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings flagged by rules alone: outside the field's range, or stuck."""
    return p5_flags(spark, sf_dir).filter(F.col("reason") != "spike").select("pose_id", "field_name", "reason")


QUERIES = {f.__name__: f for f in (p3_found, p3_grid, p3_checked, p4_found, p4_values, p5_found, p5_flags, p5_rules)}

# The status rules in SQL: letters of the leading words, one slip (two in long names) allowed.
STATUS_SQL = r"""
CASE WHEN w IS NULL OR w = '' THEN NULL
     WHEN w = 'valid' OR levenshtein(w, 'valid') <= 1 OR damerau_levenshtein(w, 'valid') <= 1 THEN 'valid'
     WHEN levenshtein(w, 'insufficienttags') <= 2 THEN 'insufficient_tags'
     WHEN levenshtein(w, 'jumprejected') <= 2 THEN 'jump_rejected'
     ELSE w END"""

POSE_SQL = rf"""
words AS (
  SELECT pose_id, session_id, frame, timestamp, camera_x_m,
         regexp_replace(regexp_extract(regexp_replace(lower(quality_status), '^[^a-z]*status\s*[=:]', ''), '^[^a-z]*([a-z][a-z_\s-]*)', 1), '[^a-z]', '', 'g') AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id, frame ORDER BY pose_id) AS copy_no FROM pose)
  WHERE copy_no = 1 AND timestamp IS NOT NULL),
rows_ AS (SELECT *, {STATUS_SQL} AS status FROM words)"""

COVERED_SQL = """steps AS (SELECT session_id, timestamp AS t, lead(timestamp) OVER (PARTITION BY session_id ORDER BY timestamp, frame) AS n FROM rows_),
covered AS (
  SELECT DISTINCT session_id, second_no FROM (
    SELECT session_id, unnest(CASE WHEN n IS NULL THEN [floor(t)::BIGINT]
                                   WHEN n - t > 600 THEN [floor(t)::BIGINT, floor(n)::BIGINT]
                                   ELSE generate_series(floor(t)::BIGINT, floor(n)::BIGINT) END) AS second_no FROM steps))"""

ORACLE = {
    "p3_found": f"""
WITH {POSE_SQL},
{COVERED_SQL}
SELECT session_id, second_no FROM covered
WHERE (session_id, second_no) NOT IN (
  SELECT session_id, floor(timestamp)::BIGINT FROM rows_ WHERE status = 'valid' AND camera_x_m IS NOT NULL AND NOT isnan(camera_x_m))""",
    "p4_found": r"""
WITH t AS (
  SELECT pose_id, regexp_extract_all(detected_ids, '"(?:[^"]|"")*"|''(?:[^'']|'''')*''|[^\s,;|/"''\[\](){}<>]+') AS v
  FROM pose WHERE detected_ids <> '' AND NOT regexp_full_match(detected_ids, '[0-9]+( [0-9]+)*')),
u AS (SELECT pose_id, unnest(range(1, len(v) + 1)) AS n, v FROM t)
SELECT pose_id, n::INT AS value_no,
       CASE WHEN v[n][1] = '"' THEN trim(replace(v[n][2:-2], '""', '"')) WHEN v[n][1] = '''' THEN trim(replace(v[n][2:-2], '''''', '''')) ELSE v[n] END AS tag_value
FROM u""",
    "p4_values": r"""
WITH t AS (
  SELECT pose_id, regexp_extract_all(detected_ids, '"(?:[^"]|"")*"|''(?:[^'']|'''')*''|[^\s,;|/"''\[\](){}<>]+') AS v
  FROM pose WHERE detected_ids <> ''),
u AS (SELECT pose_id, unnest(range(1, len(v) + 1)) AS n, v FROM t)
SELECT pose_id, n::INT AS value_no,
       CASE WHEN v[n][1] = '"' THEN trim(replace(v[n][2:-2], '""', '"')) WHEN v[n][1] = '''' THEN trim(replace(v[n][2:-2], '''''', '''')) ELSE v[n] END AS tag_value
FROM u""",
    "p3_checked": f"""
WITH {POSE_SQL},
{COVERED_SQL},
reads AS (SELECT session_id, timestamp AS t, camera_x_m AS y FROM rows_ WHERE status = 'valid' AND camera_x_m IS NOT NULL AND NOT isnan(camera_x_m)),
near AS (SELECT session_id, floor(t)::BIGINT + k AS second_no, k, t - (floor(t)::BIGINT + k + 0.5::DOUBLE) AS d, y FROM reads, (SELECT unnest(range(-2, 3)) AS k)),
kern AS (SELECT *, CASE WHEN 1 - (d/2.5)*(d/2.5) > 0 THEN (1 - (d/2.5)*(d/2.5)) * (1 - (d/2.5)*(d/2.5)) * (1 - (d/2.5)*(d/2.5)) ELSE 0.0::DOUBLE END AS w FROM near),
sums AS (SELECT session_id, second_no, count(*) FILTER (WHERE k = 0) AS inside, count(*) FILTER (WHERE w > 0 AND d < 0) AS l, count(*) FILTER (WHERE w > 0 AND d >= 0) AS r, sum(w) AS w, sum(w*d) AS wd, sum(w*d*d) AS wdd, sum(w*y) AS wy, sum(w*d*y) AS wdy, sum(w*w) AS ww FROM kern GROUP BY 1, 2),
fits AS (SELECT c.session_id, c.second_no, coalesce(inside, 0) AS n_inside, l, r, CASE WHEN ww > 0 THEN w*w/ww ELSE 0 END AS support, CASE WHEN w*wdd - wd*wd > 1e-9*w*w*6.25 THEN (wdd*wy - wd*wdy) / (w*wdd - wd*wd) ELSE wy / w END AS fit FROM covered c LEFT JOIN sums USING (session_id, second_no)),
states AS (SELECT *, CASE WHEN n_inside > 0 THEN 'observed' WHEN support >= 1.5 AND l > 0 AND r > 0 THEN 'filled' ELSE 'missing' END AS state FROM fits)
SELECT session_id, second_no, round(CASE WHEN state <> 'missing' THEN fit END, 5) AS value, n_inside, round(support, 5) AS support, state FROM states""",
    "p5_rules": """
WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id, frame ORDER BY pose_id) AS copy_no FROM pose) WHERE copy_no = 1 AND timestamp IS NOT NULL),
e AS (SELECT session_id, timestamp AS t, frame, pose_id, 'camera_x_m' AS field_name, camera_x_m AS x, -100.0 AS low, 100.0 AS high FROM one
      UNION ALL SELECT session_id, timestamp, frame, pose_id, 'yaw_deg', yaw_deg, -180.0, 180.0 FROM one UNION ALL SELECT session_id, timestamp, frame, pose_id, 'reprojection_rmse_px', reprojection_rmse_px, 0.0, 500.0 FROM one),
n AS (SELECT *, lag(x) OVER w AS before FROM e WHERE x IS NOT NULL AND NOT isnan(x) WINDOW w AS (PARTITION BY session_id, field_name ORDER BY t, frame, pose_id)),
r AS (SELECT *, sum(CASE WHEN x = before THEN 0 ELSE 1 END) OVER (PARTITION BY session_id, field_name ORDER BY t, frame, pose_id ROWS UNBOUNDED PRECEDING) AS run FROM n),
c AS (SELECT *, count(*) OVER (PARTITION BY session_id, field_name, run) AS long FROM r)
SELECT pose_id, field_name, CASE WHEN x < low OR x > high THEN 'impossible' ELSE 'stuck' END AS reason FROM c WHERE x < low OR x > high OR long >= 6""",
}
