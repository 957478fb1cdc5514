"""Queries of the trajectory operators over the pose, motion-capture, inertial and board tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrain.functions import rotations as rot
from posegrain.functions import views
from posegrain.functions.angles import clip, finite, nice_step, within, wrap
from posegrain.functions.status import canonical_status
from posegrain.operators import aggregates as agg
from posegrain.operators import asof, ordered, smoothing, sync
from posegrain.operators import trajectory as tr
from posegrain.operators.alignment import apply_rigid, fit_rigid, mean_rotation, robust_inliers
from posegrain.operators.dedupe import keep_first_copy
from posegrain.operators.packed_fields import split_packed
from posegrain.plans import filter_sql, rotation_sql
from posegrain.plans.problems import STATUS_SQL
from posegrain.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
K, ORDER, XYZ, RPY = ["session_id"], ["t", "frame"], ["x", "y", "z"], ["roll", "pitch", "yaw"]

NUMBERS = {"x": "camera_x_m", "y": "camera_y_m", "z": "camera_z_m", "roll": "roll_deg", "pitch": "pitch_deg", "yaw": "yaw_deg", "rmse": "reprojection_rmse_px"}

BASE = rf"""
WITH RECURSIVE words AS (
  SELECT pose_id, session_id, frame, timestamp AS t,
         {', '.join(f"CASE WHEN isfinite({c}) THEN {c} END AS {a}" for a, c in NUMBERS.items())},
         detected_tag_count AS tags, inlier_count AS inliers, detected_ids AS ids, selected_view AS view, coalesce(trim(measurement_source), '') AS source,
         regexp_replace(regexp_extract(regexp_replace(lower(quality_status), '^[^a-z]*status\s*[=:]', ''), '^[^a-z]*([a-z][a-z_\s-]*)', 1), '[^a-z]', '', 'g') AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id, frame ORDER BY pose_id) AS copy_no FROM pose)
  WHERE copy_no = 1 AND timestamp IS NOT NULL),
p AS (SELECT *, {STATUS_SQL} AS status FROM words),
v AS (SELECT * FROM p WHERE status = 'valid' AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL),
m AS (SELECT session_id, frame, timestamp AS t, x_m AS x, y_m AS y, z_m AS z, qx, qy, qz, qw FROM mocap_normalized WHERE valid = 1 AND isfinite(x_m) AND isfinite(y_m) AND isfinite(z_m)),
vq AS (SELECT *, sa*cb*cc - ca*sb*sc AS qx, ca*sb*cc + sa*cb*sc AS qy, ca*cb*sc - sa*sb*cc AS qz, ca*cb*cc + sa*sb*sc AS qw FROM (
  SELECT *, sin(radians(roll)/2) AS sa, cos(radians(roll)/2) AS ca, sin(radians(pitch)/2) AS sb, cos(radians(pitch)/2) AS cb, sin(radians(yaw)/2) AS sc, cos(radians(yaw)/2) AS cc FROM v WHERE roll IS NOT NULL AND pitch IS NOT NULL AND yaw IS NOT NULL)),
written AS (SELECT session_id, frame, t, unnest(regexp_extract_all(ids, '"(?:[^"]|"")*"|''(?:[^'']|'''')*''|[^\s,;|/"''\[\](){{}}<>]+')) AS w FROM p WHERE ids <> ''),
seen AS (SELECT session_id, frame, t, regexp_extract(w, '(?:^["'']?|\s)([0-9]+)\s*["'']?$', 1)::INT AS id FROM written WHERE regexp_matches(w, '(?:^["'']?|\s)([0-9]+)\s*["'']?$')),
sessions AS (SELECT session_id, max(CASE WHEN trim(board) <> '' THEN trim(board) END) AS board, max(CASE WHEN trim(camera_profile) <> '' THEN trim(camera_profile) END) AS profile,
                    max(source_fps) AS fps, min(started_at) AS started_at, max(total_frames) AS total_frames FROM capture_sessions GROUP BY session_id)"""


def query(sql: str | None = None):
    """Register a query; its SQL may use the tables ``p`` (poses), ``v`` (valid ones), ``vq`` (those with an orientation), ``m`` (motion capture), ``seen`` (detected tags) and ``sessions``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            text = sql.strip()
            ORACLE[f.__name__] = BASE + (", " + text[5:] if text.startswith("WITH ") else "\n" + text)
        return f

    return add


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses with a time, copies counted once, numbers finite or NULL, sources and statuses in one spelling."""
    extra = {"tags": "detected_tag_count", "inliers": "inlier_count", "ids": "detected_ids", "view": "selected_view"}
    d = keep_first_copy(read_table(spark, sf_dir, "pose"), ["session_id", "frame"], "pose_id", ["timestamp", *NUMBERS.values(), *extra.values(), "measurement_source", "quality_status"])
    d = d.filter(F.col("timestamp").isNotNull())
    return d.select(
        "pose_id", "session_id", "frame", F.col("timestamp").alias("t"), *[finite(F.col(c)).alias(a) for a, c in NUMBERS.items()], *[F.col(c).alias(a) for a, c in extra.items()],
        F.coalesce(F.trim("measurement_source"), F.lit("")).alias("source"), canonical_status(F.col("quality_status")).alias("status"),
    )


def is_valid() -> F.Column:
    return (F.coalesce(F.col("status"), F.lit("")) == "valid") & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()


VALID_SQL = "(coalesce(status, '') = 'valid' AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL)"


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poses(spark, sf_dir).filter(is_valid())


def mocap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "mocap_normalized").filter("valid = 1")
    d = d.select("session_id", "frame", F.col("timestamp").alias("t"), *[finite(F.col(f"{a}_m")).alias(a) for a in XYZ], "qx", "qy", "qz", "qw")
    return d.dropna(subset=[*XYZ])


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda c: F.max(F.when(F.trim(c) != "", F.trim(c)))
    return read_table(spark, sf_dir, "capture_sessions").groupBy("session_id").agg(named("board").alias("board"), named("camera_profile").alias("profile"), F.max("source_fps").alias("fps"), F.min("started_at").alias("started_at"), F.max("total_frames").alias("total_frames"))


def five(*names: str) -> list:
    return [F.round(F.col(n), 5).alias(n) for n in names]


def six(*names: str) -> list:
    return [F.round(F.col(n), 6).alias(n) for n in names]


# ---------------------------------------------------------------- sources and filters


@query("SELECT session_id, frame, t, x, y, z FROM v")
def src_valid_trajectory(spark, sf_dir):
    return valid(spark, sf_dir).select("session_id", "frame", "t", *XYZ)


@query("SELECT session_id, frame, t, x, y, z FROM v WHERE tags >= 4 AND source IN ('', 'direct')")
def src_direct_trajectory(spark, sf_dir):
    """Valid rows with four tags or more that were measured directly; a blank source counts as direct."""
    return valid(spark, sf_dir).filter((F.col("tags") >= 4) & F.col("source").isin("", "direct")).select("session_id", "frame", "t", *XYZ)


@query("SELECT session_id, frame, t, x, y, z FROM v WHERE tags >= 4 AND source IN ('', 'direct', 'optical_flow')")
def src_direct_or_flow_trajectory(spark, sf_dir):
    return valid(spark, sf_dir).filter((F.col("tags") >= 4) & F.col("source").isin("", "direct", "optical_flow")).select("session_id", "frame", "t", *XYZ)


@query("SELECT session_id, t, arg_min(frame, frame) AS frame, arg_min(x, frame) AS x, arg_min(yaw, frame) AS yaw FROM v WHERE roll IS NOT NULL AND pitch IS NOT NULL AND yaw IS NOT NULL GROUP BY session_id, t")
def src_unique_times(spark, sf_dir):
    """Finite six-degree rows, the first frame of each repeated time."""
    d = valid(spark, sf_dir).dropna(subset=RPY).select("session_id", "t", "frame", "x", "yaw")
    return ordered.first_per_time(d, K, "t", "frame").select("session_id", "t", "frame", "x", "yaw")


@query("""
WITH span AS (SELECT session_id, min(frame) AS a, max(frame) AS b FROM mocap_normalized GROUP BY session_id),
grid AS (SELECT session_id, unnest(generate_series(a, b)) AS frame FROM span),
one AS (SELECT session_id, frame, min(CASE WHEN valid = 1 AND isfinite(x_m) AND isfinite(y_m) AND isfinite(z_m) AND qx*qx+qy*qy+qz*qz+qw*qw > 0.25 THEN x_m END) AS x FROM mocap_normalized GROUP BY session_id, frame)
SELECT g.session_id, g.frame, x IS NOT NULL AS is_valid, x FROM grid g LEFT JOIN one USING (session_id, frame)""")
def src_dense_mocap(spark, sf_dir):
    """Every declared frame of the motion capture; missing and unusable ones marked."""
    raw = read_table(spark, sf_dir, "mocap_normalized")
    norm = sum(F.col(f"q{c}") * F.col(f"q{c}") for c in "xyzw")
    ok = (F.col("valid") == 1) & finite(F.col("x_m")).isNotNull() & finite(F.col("y_m")).isNotNull() & finite(F.col("z_m")).isNotNull() & (norm > 0.25)
    one = raw.groupBy("session_id", "frame").agg(F.min(F.when(ok, F.col("x_m"))).alias("x"))
    grid = raw.groupBy("session_id").agg(F.min("frame").alias("a"), F.max("frame").alias("b")).select("session_id", F.explode(F.sequence("a", "b")).alias("frame"))
    return grid.join(one, ["session_id", "frame"], "left").select("session_id", "frame", F.col("x").isNotNull().alias("is_valid"), "x")


@query("SELECT session_id, frame, round(qw/n, 6) AS qw, round(qx/n, 6) AS qx, round(qy/n, 6) AS qy, round(qz/n, 6) AS qz FROM (SELECT *, sqrt(qw*qw+qx*qx+qy*qy+qz*qz) AS n FROM imu_perframe) WHERE n > 1e-12")
def src_imu_orientation(spark, sf_dir):
    d = read_table(spark, sf_dir, "imu_perframe")
    n = F.sqrt(sum(F.col(f"q{c}") * F.col(f"q{c}") for c in "wxyz"))
    return d.withColumn("_n", n).filter(F.col("_n") > 1e-12).select("session_id", "frame", *[F.round(F.col(f"q{c}") / F.col("_n"), 6).alias(f"q{c}") for c in "wxyz"])


@query("""
WITH e AS (SELECT board, id, unnest([1,2,3,4]) AS i, corners_m FROM tag_map),
d AS (SELECT board, id, sqrt((corners_m[i][1]-corners_m[i%4+1][1])^2 + (corners_m[i][2]-corners_m[i%4+1][2])^2 + (corners_m[i][3]-corners_m[i%4+1][3])^2) AS edge FROM e)
SELECT board, id, round(avg(edge), 6) AS edge_m, max(edge) - min(edge) <= 0.02 * avg(edge) AS is_square FROM d GROUP BY board, id""")
def src_tag_map_checked(spark, sf_dir):
    """Each tag's edge length, and whether its four edges agree within 2 %."""
    d = read_table(spark, sf_dir, "tag_map").select("board", "id", F.posexplode("corners_m").alias("i", "a"), "corners_m")
    d = d.withColumn("b", F.get("corners_m", (F.col("i") + 1) % 4))
    edge = F.sqrt(sum((F.get("a", F.lit(k)) - F.get("b", F.lit(k))) * (F.get("a", F.lit(k)) - F.get("b", F.lit(k))) for k in range(3)))
    e = d.withColumn("edge", edge).groupBy("board", "id")
    return e.agg(F.round(F.avg("edge"), 6).alias("edge_m"), (F.max("edge") - F.min("edge") <= 0.02 * F.avg("edge")).alias("is_square"))


@query(f"SELECT session_id, frame, t, {VALID_SQL} AS is_valid FROM p")
def src_quality(spark, sf_dir):
    return poses(spark, sf_dir).select("session_id", "frame", "t", is_valid().alias("is_valid"))


@query("""
SELECT session_id, CASE WHEN lower(profile) LIKE '%.osv' THEN 'dji' WHEN lower(profile) LIKE '%.insv' OR lower(profile) LIKE '%.lrv' OR lower(profile) LIKE '%insta%' THEN 'insta360' WHEN lower(profile) LIKE '%dji%' OR lower(profile) LIKE '%osmo%' THEN 'dji' ELSE 'unknown' END AS camera_class FROM sessions""")
def src_camera_class(spark, sf_dir):
    """The class of each session's camera by the rules on names; the tables have no sizes of videos."""
    none = F.array().cast("array<int>")
    return sessions(spark, sf_dir).select("session_id", views.camera_class(F.col("profile"), F.lit(""), none, none).alias("camera_class"))


@query("SELECT session_id, epoch_us(started_at) AS start_us, round(total_frames / fps, 6) AS duration_s FROM sessions WHERE started_at IS NOT NULL AND fps > 0")
def src_capture_interval(spark, sf_dir):
    """The wall-clock start and the longest length of each capture."""
    d = sessions(spark, sf_dir).filter(F.col("started_at").isNotNull() & (F.col("fps") > 0))
    return d.select("session_id", F.unix_micros(F.col("started_at").cast("timestamp")).alias("start_us"), F.round(F.col("total_frames") / F.col("fps"), 6).alias("duration_s"))


@query("SELECT session_id, frame FROM p JOIN sessions USING (session_id) WHERE fps > 0 AND frame % greatest(1, round_even(fps / 5, 0))::BIGINT = 0")
def flt_downsample(spark, sf_dir):
    """Frames on a grid of about five a second; halves round to even."""
    d = poses(spark, sf_dir).join(sessions(spark, sf_dir).filter("fps > 0").select("session_id", "fps"), "session_id")
    return d.filter(F.col("frame") % F.greatest(F.lit(1), F.bround(F.col("fps") / 5, 0)).cast("long") == 0).select("session_id", "frame")


@query("SELECT session_id, frame FROM (SELECT session_id, frame, row_number() OVER (PARTITION BY session_id ORDER BY frame) AS n FROM p) WHERE n <= 50")
def flt_first_frames(spark, sf_dir):
    """The first fifty frames of each session, the limit being the feature. Each task keeps fifty rows of a session, not all."""
    from pyspark.sql import Window

    d = poses(spark, sf_dir).select("session_id", "frame")
    return d.withColumn("_n", F.row_number().over(Window.partitionBy("session_id").orderBy("frame"))).filter("_n <= 50").drop("_n")


@query("SELECT session_id, frame, rmse, tags, rmse <= 1.0 + 1e-9 AS good FROM p WHERE rmse IS NOT NULL AND tags >= 4")
def flt_gates(spark, sf_dir):
    """At least four tags; the error within an inclusive limit."""
    return poses(spark, sf_dir).filter(F.col("rmse").isNotNull() & (F.col("tags") >= 4)).select("session_id", "frame", "rmse", "tags", within(F.col("rmse"), 1.0).alias("good"))


@query("WITH c AS (SELECT session_id, min(t) AS a, max(t) AS b FROM m GROUP BY session_id) SELECT v.session_id, v.frame, v.t FROM v JOIN c ON v.session_id = c.session_id AND v.t BETWEEN c.a AND c.b")
def flt_within_mocap(spark, sf_dir):
    """Valid rows within the time the motion capture covers."""
    cover = mocap(spark, sf_dir).groupBy("session_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return valid(spark, sf_dir).join(cover, "session_id").filter(F.col("t").between(F.col("a"), F.col("b"))).select("session_id", "frame", "t")


@query("SELECT session_id, frame, round((2*yaw + 180) - 360*floor((2*yaw + 180)/360) - 180, 6) AS doubled, greatest(-85.0, least(85.0, pitch)) AS pitch FROM p WHERE yaw IS NOT NULL AND pitch IS NOT NULL")
def flt_angle_rules(spark, sf_dir):
    d = poses(spark, sf_dir).dropna(subset=["yaw", "pitch"])
    return d.select("session_id", "frame", F.round(wrap(2 * F.col("yaw")), 6).alias("doubled"), clip(F.col("pitch"), -85.0, 85.0).alias("pitch"))


# ---------------------------------------------------------------- joins


@query("""
WITH l AS (SELECT session_id, frame, arg_max(detected_tag_count, pose_id) AS tags, max(pose_id) AS pose_id FROM pose GROUP BY session_id, frame)
SELECT mc.session_id, mc.frame, l.pose_id, l.tags FROM mocap_normalized mc LEFT JOIN l USING (session_id, frame)""")
def join_frame_lookup(spark, sf_dir):
    """The pose of each frame of the motion capture; of copies the last to arrive wins. NULL where no pose has the frame."""
    last = read_table(spark, sf_dir, "pose").groupBy("session_id", "frame").agg(F.max_by("detected_tag_count", "pose_id").alias("tags"), F.max("pose_id").alias("pose_id"))
    return read_table(spark, sf_dir, "mocap_normalized").select("session_id", "frame").join(last, ["session_id", "frame"], "left").select("session_id", "frame", "pose_id", "tags")


@query("SELECT p.session_id, p.frame, i.qw, i.qx FROM p LEFT JOIN imu_perframe i USING (session_id, frame)")
def join_imu_by_frame(spark, sf_dir):
    """Each pose with the inertial orientation of its frame, if any."""
    imu = read_table(spark, sf_dir, "imu_perframe").select("session_id", "frame", "qw", "qx")
    return poses(spark, sf_dir).select("session_id", "frame").join(imu, ["session_id", "frame"], "left")


@query("SELECT i.session_id, i.frame, i.id, center_m[1] AS cx, center_m[2] AS cy FROM seen i JOIN sessions s USING (session_id) JOIN tag_map t ON t.board = s.board AND t.id = i.id")
def join_tag_geometry(spark, sf_dir):
    """Detected tags with their place on the session's board; tags the board does not have drop out."""
    d = detected(spark, sf_dir).select("session_id", "frame", "id").join(sessions(spark, sf_dir).select("session_id", "board"), "session_id")
    board = read_table(spark, sf_dir, "tag_map").select("board", "id", F.get("center_m", F.lit(0)).alias("cx"), F.get("center_m", F.lit(1)).alias("cy"))
    return d.join(board, ["board", "id"]).select("session_id", "frame", "id", "cx", "cy")


BRACKET = """
WITH s AS (SELECT session_id, t, x, y, z, lead(t) OVER w AS nt, lead(x) OVER w AS nx FROM m WINDOW w AS (PARTITION BY session_id ORDER BY t, x, y, z)),
u AS (SELECT session_id, t, 1 AS kind, x, y, z, {'t': t, 'x': x, 'nt': nt, 'nx': nx} AS s, NULL::BIGINT AS frame FROM s
      UNION ALL SELECT session_id, t, 0, NULL, NULL, NULL, NULL, frame FROM v),
b AS (SELECT session_id, frame, t, kind,
             last_value(s IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t, kind, x, y, z, frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
             first_value(s IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t, kind, x, y, z, frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM u),
q AS (SELECT session_id, frame, t, CASE WHEN l IS NOT NULL THEN l.t ELSE r.t END AS lt, CASE WHEN l IS NOT NULL THEN l.x ELSE r.x END AS lx,
             CASE WHEN l IS NOT NULL THEN r.t ELSE r.nt END AS rt, CASE WHEN l IS NOT NULL THEN r.x ELSE r.nx END AS rx FROM b WHERE kind = 0)
"""
INTERPOLATED = "lx + CASE WHEN rt > lt THEN (t - lt) / (rt - lt) ELSE 0 END * (rx - lx)"


def bracketed(spark, sf_dir) -> DataFrame:
    return asof.bracket(valid(spark, sf_dir).select("session_id", "frame", "t"), mocap(spark, sf_dir), K, "t", "t", XYZ)


@query(BRACKET + f"SELECT session_id, frame, round({INTERPOLATED}, 6) AS x_at FROM q WHERE lt <= t AND t <= rt AND rt - lt <= 0.5")
def join_interpolated(spark, sf_dir):
    """Motion capture at each valid pose's time, where its samples are at most half a second apart."""
    t = F.col("t")
    return bracketed(spark, sf_dir).filter(asof.covered(t, 0.5)).select("session_id", "frame", F.round(asof.linear(t, "x"), 6).alias("x_at"))


@query(BRACKET + "SELECT session_id, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(lt <= t AND t <= rt, false)) AS n_outside FROM q GROUP BY session_id")
def join_strict_coverage(spark, sf_dir):
    """What a strict join would refuse: queries outside the samples, per session."""
    d = bracketed(spark, sf_dir)
    return d.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.sum((~asof.covered(F.col("t"), None)).cast("long")).alias("n_outside"))


@query(BRACKET + "SELECT session_id, frame, CASE WHEN rt IS NULL OR abs(t - lt) <= abs(rt - t) THEN lt ELSE rt END AS nearest_t FROM q WHERE lt IS NOT NULL")
def join_nearest_earlier(spark, sf_dir):
    """The nearest sample's time, the earlier one on a tie."""
    return bracketed(spark, sf_dir).filter("lo IS NOT NULL").select("session_id", "frame", asof.nearest(F.col("t"))["t"].alias("nearest_t"))


@query(BRACKET + "SELECT session_id, frame, CASE WHEN rt IS NULL OR abs(t - lt) < abs(rt - t) THEN lt ELSE rt END AS nearest_t FROM q WHERE lt IS NOT NULL")
def join_nearest_later(spark, sf_dir):
    """The nearest sample's time, the later one on a tie."""
    return bracketed(spark, sf_dir).filter("lo IS NOT NULL").select("session_id", "frame", asof.nearest(F.col("t"), later_on_tie=True)["t"].alias("nearest_t"))


@query(BRACKET + f"SELECT session_id, frame, round(CASE WHEN rt IS NULL OR rt < t THEN coalesce(rx, lx) WHEN t <= lt THEN lx ELSE {INTERPOLATED} END, 6) AS x_at FROM q WHERE lt IS NOT NULL")
def join_clamped(spark, sf_dir):
    """Linear between samples, the first and last value outside."""
    return bracketed(spark, sf_dir).filter("lo IS NOT NULL").select("session_id", "frame", F.round(asof.clamped(F.col("t"), "x"), 6).alias("x_at"))


@query("""
WITH o AS (SELECT session_id, t, frame, x, y, z, lead(t, 3) OVER w AS t3, lead(x, 3) OVER w AS x3, lead(y, 3) OVER w AS y3, lead(z, 3) OVER w AS z3 FROM v WINDOW w AS (PARTITION BY session_id ORDER BY t, frame))
SELECT session_id, frame, round(sqrt((x3-x)^2 + (y3-y)^2 + (z3-z)^2), 6) AS moved_m FROM o WHERE t3 IS NOT NULL""")
def join_index_partner(spark, sf_dir):
    """The third row after each: ranks per session meet ranks, an equi-join without a window over a session."""
    d = ordered.running_sum(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, F.lit(1).cast("long"), "i")
    other = d.select("session_id", (F.col("i") - 3).alias("i"), F.struct(*XYZ).alias("later"))
    return d.join(other, ["session_id", "i"]).select("session_id", "frame", F.round(tr.moved(XYZ, "later"), 6).alias("moved_m"))


@query("""
WITH c AS (SELECT session_id, board, epoch_us(started_at) / 1e6 AS a, epoch_us(started_at) / 1e6 + total_frames / fps AS b FROM sessions WHERE started_at IS NOT NULL AND fps > 0 AND total_frames IS NOT NULL AND board IS NOT NULL)
SELECT l.session_id AS first_session, r.session_id AS second_session, round(least(l.b, r.b) - greatest(l.a, r.a), 6) AS overlap_s
FROM c l JOIN c r ON l.board = r.board AND (l.a, l.session_id) < (r.a, r.session_id) AND least(l.b, r.b) > greatest(l.a, r.a)""")
def join_capture_overlap(spark, sf_dir):
    """Captures at one board that overlap in time, each pair once, and for how long."""
    d = sessions(spark, sf_dir).filter(F.col("started_at").isNotNull() & (F.col("fps") > 0) & F.col("total_frames").isNotNull() & F.col("board").isNotNull())
    a = F.unix_micros(F.col("started_at").cast("timestamp")) / 1e6
    d = d.select("session_id", "board", a.alias("a"), (a + F.col("total_frames") / F.col("fps")).alias("b"))
    return asof.overlapping(d, ["board"], "a", "b", "session_id").select(F.col("first_session_id").alias("first_session"), F.col("second_session_id").alias("second_session"), *six("overlap_s"))


@query("SELECT session_id, frame FROM v WHERE EXISTS (SELECT 1 FROM imu_perframe i WHERE i.session_id = v.session_id AND i.frame = v.frame)")
def join_semi_frames(spark, sf_dir):
    return valid(spark, sf_dir).select("session_id", "frame").join(read_table(spark, sf_dir, "imu_perframe").select("session_id", "frame"), ["session_id", "frame"], "left_semi")


@query("""
WITH a AS (SELECT session_id, frame, t, x FROM (SELECT *, row_number() OVER (PARTITION BY session_id, t ORDER BY frame) AS n FROM v) WHERE n = 1),
f AS (SELECT a.session_id, a.frame, a.t, a.x, a.t + 1.0 AS want FROM a),
g AS (SELECT f.session_id, f.frame, f.t, f.x, f.want, b.t AS bt, b.x AS bx, c.t AS ct, c.x AS cx FROM f ASOF LEFT JOIN a b ON f.session_id = b.session_id AND f.want > b.t ASOF LEFT JOIN a c ON f.session_id = c.session_id AND f.want <= c.t),
h AS (SELECT session_id, frame, t, x, want, CASE WHEN ct IS NULL OR abs(bt - want) <= abs(ct - want) THEN bt ELSE ct END AS ot, CASE WHEN ct IS NULL OR abs(bt - want) <= abs(ct - want) THEN bx ELSE cx END AS ox FROM g)
SELECT session_id, frame, round(ot - t, 6) AS step_s, round(ox - x + 1e-9, 6) AS moved_x FROM h WHERE abs(ot - want) <= 0.2 AND ot > t""")
def join_baseline_partner(spark, sf_dir):
    """The row nearest to one second later, within 0.2 s."""
    d = ordered.first_per_time(valid(spark, sf_dir).select("session_id", "t", "frame", "x"), K, "t", "frame")
    d = asof.partner_at(d, K, "t", ["x"], 1.0, 0.2).filter("other IS NOT NULL")
    return d.select("session_id", "frame", F.round(F.col("other.t") - F.col("t"), 6).alias("step_s"), F.round(F.col("other.x") - F.col("x") + 1e-9, 6).alias("moved_x"))


# ---------------------------------------------------------------- ordered rows

SEGMENTS = """
WITH g AS (SELECT *, t - lag(t) OVER w AS dt FROM {0} WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)),
s AS (SELECT *, sum(CASE WHEN dt IS NULL OR dt > 0.65 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY t, frame ROWS UNBOUNDED PRECEDING) AS segment FROM g)
"""


@query(SEGMENTS.format("v") + "SELECT session_id, segment, count(*) AS n_rows, min(t) AS start_s, max(t) AS end_s FROM s GROUP BY session_id, segment")
def ord_segments(spark, sf_dir):
    """Segments of valid rows, cut where a step is longer than 0.65 s."""
    return tr.segment_table(valid(spark, sf_dir).select("session_id", "t", "frame"), K, ORDER, 0.65)


@query(SEGMENTS.format("(SELECT * FROM v WHERE yaw IS NOT NULL)") + """
, d AS (SELECT *, yaw - lag(yaw) OVER w AS dy FROM s WINDOW w AS (PARTITION BY session_id, segment ORDER BY t, frame)),
f AS (SELECT *, (dy + 180) - 360 * floor((dy + 180) / 360) - 180 AS wd FROM d),
h AS (SELECT *, coalesce(round(((CASE WHEN wd = -180 AND dy > 0 THEN 180 ELSE wd END) - dy) / 360), 0) AS turn FROM f)
SELECT session_id, frame, round(yaw + 360 * sum(turn) OVER (PARTITION BY session_id, segment ORDER BY t, frame ROWS UNBOUNDED PRECEDING), 4) AS yaw_unwrapped FROM h""")
def ord_unwrapped(spark, sf_dir):
    """Yaw with its jumps at ±180 taken out within each segment."""
    d = valid(spark, sf_dir).filter("yaw IS NOT NULL").select("session_id", "t", "frame", "yaw")
    d = ordered.unwrapped_segments(d, K, ORDER, 0.65, {"yaw": "yaw_unwrapped"})
    return d.select("session_id", "frame", F.round("yaw_unwrapped", 4).alias("yaw_unwrapped"))


@query(SEGMENTS.format("v") + "SELECT session_id, frame, round(median(x) OVER (PARTITION BY session_id, segment ORDER BY t, frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) + 1e-9, 6) AS x_median FROM s")
def ord_centred_median(spark, sf_dir):
    """Median of five rows around each, cut at segment ends."""
    d = ordered.gap_segments(valid(spark, sf_dir).select("session_id", "t", "frame", "x"), K, ORDER, 0.65, "i")
    d = ordered.centred_median(d, [*K, "segment"], ORDER, "x", 2, "x_median", "i")
    return d.select("session_id", "frame", F.round(F.col("x_median") + 1e-9, 6).alias("x_median"))


@query("""
WITH RECURSIVE o AS (SELECT session_id, frame, t, x, row_number() OVER (PARTITION BY session_id ORDER BY t, frame) AS n FROM v),
e AS (SELECT session_id, n, t, x AS y FROM o WHERE n = 1
      UNION ALL SELECT o.session_id, o.n, o.t, CASE WHEN o.t - e.t > 0.65 THEN o.x ELSE 0.6 * e.y + (1 - 0.6) * o.x END FROM e JOIN o ON o.session_id = e.session_id AND o.n = e.n + 1)
SELECT o.session_id, o.frame, round(e.y + 1e-9, 6) AS x_mean FROM o JOIN e USING (session_id, n)""".replace("WITH RECURSIVE", "WITH"))
def ord_exponential_mean(spark, sf_dir):
    """Exponential mean that starts anew after a gap."""
    d = smoothing.ema(valid(spark, sf_dir).select("session_id", "t", "frame", "x"), K, ORDER, "x", 0.6, "x_mean")
    return d.select("session_id", "frame", F.round(F.col("x_mean") + 1e-9, 6).alias("x_mean"))


# SQL: yaw, roll and pitch without their jumps within a segment, then all six axes one under the other.
UNWRAPPED = SEGMENTS.format("vq") + ", d AS (SELECT *, " + ", ".join(f"{a} - lag({a}) OVER w AS d_{a}" for a in RPY) + """ FROM s WINDOW w AS (PARTITION BY session_id, segment ORDER BY t, frame)),
u AS (SELECT *, """ + ", ".join(f"coalesce(round(((CASE WHEN d_{a} + 180 = 360 * floor((d_{a} + 180) / 360) AND d_{a} > 0 THEN 180 ELSE (d_{a} + 180) - 360 * floor((d_{a} + 180) / 360) - 180 END) - d_{a}) / 360), 0) AS turn_{a}" for a in RPY) + """ FROM d),
x AS (SELECT session_id, frame, segment, t, x, y, z, row_number() OVER w AS n, """ + ", ".join(f"{a} + 360 * sum(turn_{a}) OVER w AS {a}_u" for a in RPY) + """ FROM u WINDOW w AS (PARTITION BY session_id, segment ORDER BY t, frame ROWS UNBOUNDED PRECEDING))
"""
KALMAN = {**{a: (0.04, 0.8, 0.5) for a in XYZ}, **{f"{a}_u": (2.0, 30.0, 30.0) for a in RPY}}


@query(UNWRAPPED + ", long_ AS (SELECT {'s': session_id, 'k': segment} AS g, n, t, unnest([" + ", ".join(f"{{'axis': '{a}', 'z': {a}, 'r': {r * r}::DOUBLE, 'q': {q * q}::DOUBLE, 'v0': {v * v}::DOUBLE}}" for a, (r, q, v) in KALMAN.items()) + "], recursive := true) FROM x)," + filter_sql.kalman("long_") + ", wide_ AS (SELECT g, n, " + ", ".join(f"max(CASE WHEN axis = '{a}' THEN out_ END) AS {a}_smooth" for a in KALMAN) + " FROM smooth_ GROUP BY g, n) SELECT x.session_id, x.frame, " + ", ".join(f"round({a}_smooth + 1e-9, 5) AS {a}_smooth" for a in KALMAN) + " FROM wide_ w JOIN x ON x.session_id = w.g.s AND x.segment = w.g.k AND x.n = w.n")
def ord_kalman(spark, sf_dir):
    """Constant-velocity smoothing of position and orientation per segment, all six axes."""
    d = valid(spark, sf_dir).dropna(subset=RPY).select("session_id", "t", "frame", *XYZ, *RPY)
    d = ordered.unwrapped_segments(d, K, ORDER, 0.65, {a: f"{a}_u" for a in RPY}, "i").drop(*RPY)
    out = smoothing.kalman_rts(d, [*K, "segment"], ORDER, KALMAN, "i")
    return out.select("session_id", "frame", *[F.round(F.col(f"{a}_smooth") + 1e-9, 5).alias(f"{a}_smooth") for a in KALMAN])


@query(SEGMENTS.format("v") + ", o AS (SELECT session_id, frame, x, {'s': session_id, 'k': segment} AS g, row_number() OVER (PARTITION BY session_id, segment ORDER BY t, frame) AS n FROM s)," + filter_sql.despiked("o") + " SELECT o.session_id, o.frame, round(out_ + 1e-9, 6) AS x_smooth FROM flat_ f JOIN o USING (g, n)")
def ord_despiked(spark, sf_dir):
    """Median of five where a reading is off it, then local polynomials."""
    d = ordered.gap_segments(valid(spark, sf_dir).select("session_id", "t", "frame", "x"), K, ORDER, 0.65, "i")
    return smoothing.despiked(d, [*K, "segment"], ORDER, ["x"], "i").select("session_id", "frame", F.round(F.col("x_smooth") + 1e-9, 6).alias("x_smooth"))


@query("""
WITH RECURSIVE o AS (SELECT session_id, frame, t, x, y, z, row_number() OVER (PARTITION BY session_id ORDER BY t, frame) AS n FROM v),
e AS (SELECT session_id, n, true AS ok, t AS at, x AS ax, y AS ay, z AS az FROM o WHERE n = 1
      UNION ALL SELECT o.session_id, o.n, g.ok, CASE WHEN g.ok THEN o.t ELSE e.at END, CASE WHEN g.ok THEN o.x ELSE e.ax END, CASE WHEN g.ok THEN o.y ELSE e.ay END, CASE WHEN g.ok THEN o.z ELSE e.az END
      FROM e JOIN o ON o.session_id = e.session_id AND o.n = e.n + 1,
           LATERAL (SELECT NOT (sqrt((o.x-e.ax)*(o.x-e.ax) + (o.y-e.ay)*(o.y-e.ay) + (o.z-e.az)*(o.z-e.az)) > 1.5 * (o.t - e.at) AND (o.x <> e.ax OR o.y <> e.ay OR o.z <> e.az)) AS ok) g)
SELECT o.session_id, o.frame, e.ok AS accepted FROM o JOIN e USING (session_id, n)""".replace("WITH RECURSIVE", "WITH"))
def ord_jump_gate(spark, sf_dir):
    """Whether a pose is reached from the last accepted one at 1.5 m/s or less."""
    d = smoothing.jump_gate(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, XYZ, 1.5)
    return d.select("session_id", "frame", "accepted")


RUNS = f"""
WITH g AS (SELECT *, {VALID_SQL} AS ok FROM p),
c AS (SELECT *, CASE WHEN ok = lag(ok) OVER w THEN 0 ELSE 1 END AS new FROM g WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)),
i AS (SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY t, frame ROWS UNBOUNDED PRECEDING) AS island FROM c),
r AS (SELECT session_id, island, bool_or(ok) AS ok, count(*) AS n_rows, min(t) AS start_s, max(t) AS end_s FROM i GROUP BY session_id, island),
l AS (SELECT *, lead(start_s) OVER (PARTITION BY session_id ORDER BY island) AS next_s FROM r)
"""


@query(RUNS + "SELECT session_id, island, n_rows, start_s, end_s FROM r WHERE NOT ok")
def ord_lost_runs(spark, sf_dir):
    d = tr.state_runs(poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ), K, ORDER, is_valid())
    return d.filter(~F.col("state")).select("session_id", "island", "n_rows", "start_s", "end_s")


@query(RUNS + "SELECT session_id, start_s, next_s AS recovered_s, round(next_s - start_s, 6) AS duration_s FROM l WHERE NOT ok AND next_s IS NOT NULL")
def ord_loss_events(spark, sf_dir):
    d = tr.loss_events(poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ), K, ORDER, is_valid())
    return d.select("session_id", "start_s", "recovered_s", *six("duration_s"))


@query(RUNS + """, dt AS (SELECT session_id, median(d) AS md FROM (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, frame) AS d FROM p) GROUP BY session_id),
a AS (SELECT r.*, end_s - start_s + coalesce(md, 0) AS long FROM r JOIN dt USING (session_id))
SELECT session_id, sum(n_rows)::BIGINT AS n_rows, round(sum(CASE WHEN ok THEN n_rows ELSE 0 END) / sum(n_rows), 6) AS valid_ratio, count(*) FILTER (WHERE NOT ok) AS n_losses, round(coalesce(max(long) FILTER (WHERE NOT ok), 0), 6) AS longest_loss_s,
       count(*) FILTER (WHERE NOT ok AND island > 1) AS n_losses_after_lock, round(coalesce(max(long) FILTER (WHERE NOT ok AND island > 1), 0), 6) AS longest_after_lock_s FROM a GROUP BY session_id""")
def ord_visual_audit(spark, sf_dir):
    d = tr.visual_audit(poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ), K, ORDER, is_valid())
    return d.select("session_id", "n_rows", *six("valid_ratio"), "n_losses", *six("longest_loss_s"), "n_losses_after_lock", *six("longest_after_lock_s"))


@query("""
WITH g AS (SELECT *, t - lag(t) OVER w AS dt, sqrt((x-lag(x) OVER w)*(x-lag(x) OVER w) + (y-lag(y) OVER w)*(y-lag(y) OVER w) + (z-lag(z) OVER w)*(z-lag(z) OVER w)) AS d FROM v WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)),
j AS (SELECT *, coalesce(dt > 0 AND dt <= 0.25 AND d > 5.0 * dt, false) AS jump FROM g),
k AS (SELECT *, sum(jump::INT) OVER (PARTITION BY session_id ORDER BY t, frame ROWS UNBOUNDED PRECEDING) AS n FROM j),
e AS (SELECT session_id, floor((n - 1) / 2)::BIGINT AS pair, min(t) FILTER (WHERE jump) AS a, max(t) FILTER (WHERE jump) AS b, count(*) FILTER (WHERE jump) AS c, count(*) FILTER (WHERE n % 2 = 1) AS rows_ FROM k WHERE n > 0 GROUP BY 1, 2)
SELECT k.session_id, k.frame, coalesce(n % 2 = 1 AND c = 2 AND rows_ >= 2 AND b - a <= 10, false) AS quarantined FROM k LEFT JOIN e ON e.session_id = k.session_id AND e.pair = floor((n - 1) / 2)::BIGINT""")
def ord_swap_quarantine(spark, sf_dir):
    """Rows between two impossible jumps of a session."""
    d = tr.swap_quarantine(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, XYZ, speed=5.0, step_s=0.25)
    return d.select("session_id", "frame", "quarantined")


MOVES = """
WITH g AS (SELECT *, t - lag(t) OVER w AS dt, sqrt((x-lag(x) OVER w)*(x-lag(x) OVER w) + (y-lag(y) OVER w)*(y-lag(y) OVER w) + (z-lag(z) OVER w)*(z-lag(z) OVER w)) AS d FROM v WINDOW w AS (PARTITION BY session_id ORDER BY t, frame))
"""


@query(MOVES + """, e AS (SELECT session_id, count(*) AS n, coalesce(sum(d), 0) AS path_m, sqrt((arg_max(x,(t,frame))-arg_min(x,(t,frame)))^2 + (arg_max(y,(t,frame))-arg_min(y,(t,frame)))^2 + (arg_max(z,(t,frame))-arg_min(z,(t,frame)))^2) AS drift_m FROM g GROUP BY session_id)
SELECT session_id, n, round(path_m, 4) AS path_m, round(drift_m, 6) AS drift_m FROM e""")
def ord_path_length(spark, sf_dir):
    d = tr.path_lengths(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, XYZ)
    return d.select("session_id", "n", F.round("path_m", 4).alias("path_m"), *six("drift_m"))


@query(MOVES + "SELECT session_id, frame, round(d / dt, 5) AS speed FROM g WHERE dt > 0")
def ord_speeds(spark, sf_dir):
    d = ordered.neighbours(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, ["t", *XYZ])
    dt = F.col("t") - F.col("prev.t")
    return d.filter(dt > 0).select("session_id", "frame", F.round(tr.moved(XYZ) / dt, 5).alias("speed"))


@query(MOVES + "SELECT session_id, frame, round(t - dt / 2 + 1e-9, 6) AS mid_t, round(d / dt, 5) AS speed FROM g WHERE dt > 0 AND dt <= 0.5")
def ord_midpoint_speeds(spark, sf_dir):
    """Speeds over steps of at most half a second, at the middle of the step."""
    d = ordered.neighbours(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, ORDER, ["t", *XYZ])
    dt = F.col("t") - F.col("prev.t")
    return d.filter((dt > 0) & (dt <= 0.5)).select("session_id", "frame", F.round(F.col("t") - dt / 2 + 1e-9, 6).alias("mid_t"), F.round(tr.moved(XYZ) / dt, 5).alias("speed"))


@query("WITH d AS (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, frame) AS dt FROM p) SELECT session_id, count(dt) AS n, round(median(dt), 6) AS median_dt FROM d WHERE dt IS NOT NULL GROUP BY session_id")
def ord_nominal_step(spark, sf_dir):
    return tr.nominal_step(poses(spark, sf_dir).select("session_id", "t", "frame"), K, ORDER).select("session_id", "n", *six("median_dt"))


@query("""
WITH f AS (SELECT session_id, arg_min({'x': x, 'y': y, 'z': z}, (t, frame)) AS o FROM v GROUP BY session_id)
SELECT v.session_id, v.frame, round(x - o.x + 1e-9, 6) AS rx, round(y - o.y + 1e-9, 6) AS ry, round(z - o.z + 1e-9, 6) AS rz FROM v JOIN f USING (session_id)""")
def ord_relative_translation(spark, sf_dir):
    """Positions less the first one, not turned."""
    d = valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ)
    first = d.groupBy("session_id").agg(F.min_by(F.struct(*XYZ), F.struct(*ORDER)).alias("o"))
    return d.join(first, "session_id").select("session_id", "frame", *[F.round(F.col(a) - F.col(f"o.{a}") + 1e-9, 6).alias(f"r{a}") for a in XYZ])


@query("WITH f AS (SELECT session_id, arg_min({'x': x, 'y': y, 'z': z, 'qx': qx, 'qy': qy, 'qz': qz, 'qw': qw}, (t, frame)) AS o FROM vq GROUP BY session_id) SELECT vq.session_id, vq.frame, " + ", ".join(f"round({e} + 1e-9, 6) AS r{a}" for a, e in zip(XYZ, rotation_sql.rotate(rotation_sql.inverse(rotation_sql.q("o.")), rotation_sql.minus(rotation_sql.v("vq."), rotation_sql.v("o."))))) + " FROM vq JOIN f USING (session_id)")
def ord_start_frame(spark, sf_dir):
    """Positions in the frame of the first pose, turned by its inverse."""
    d = valid(spark, sf_dir).dropna(subset=RPY).select("session_id", "t", "frame", *XYZ, *RPY)
    q = rot.from_euler(*(F.col(a) for a in RPY))
    first = d.groupBy("session_id").agg(F.min_by(F.struct(*XYZ, q.alias("q")), F.struct(*ORDER)).alias("o"))
    d = d.join(first, "session_id")
    turned = rot.rotate(rot.inverse(F.col("o.q")), rot.vector(*(F.col(a) - F.col(f"o.{a}") for a in XYZ)))
    return d.select("session_id", "frame", *[F.round(turned[a] + 1e-9, 6).alias(f"r{a}") for a in XYZ])


@query("""
WITH f AS (SELECT session_id, arg_min({'w': qw, 'x': qx, 'y': qy, 'z': qz}, frame) AS o FROM imu_perframe GROUP BY session_id)
SELECT i.session_id, i.frame, round(2 * degrees(atan2(sqrt(a*a + b*b + c*c), abs(d))), 4) AS turned_deg FROM (
  SELECT i.session_id, i.frame, o.w*qx - o.x*qw - o.y*qz + o.z*qy AS a, o.w*qy + o.x*qz - o.y*qw - o.z*qx AS b, o.w*qz - o.x*qy + o.y*qx - o.z*qw AS c, o.w*qw + o.x*qx + o.y*qy + o.z*qz AS d FROM imu_perframe i JOIN f USING (session_id)) i""")
def ord_imu_relative(spark, sf_dir):
    """How far each inertial orientation is turned from the session's first."""
    d = read_table(spark, sf_dir, "imu_perframe").select("session_id", "frame", rot.quaternion(*(F.col(f"q{c}") for c in "xyzw")).alias("q"))
    first = d.groupBy("session_id").agg(F.min_by("q", "frame").alias("o"))
    return d.join(first, "session_id").select("session_id", "frame", F.round(rot.angle_deg(F.col("o"), F.col("q")), 4).alias("turned_deg"))


@query("""
SELECT session_id, frame, count(*) OVER (PARTITION BY session_id ORDER BY t RANGE BETWEEN 2.0 PRECEDING AND CURRENT ROW) AS n_recent FROM v""")
def ord_trailing_history(spark, sf_dir):
    """How many valid rows lie in the two seconds up to each. Rows of the block before come along as its tail."""
    d = valid(spark, sf_dir).select("session_id", "t", "frame").withColumn("_block", F.floor(F.col("t") / 600.0))
    tail = d.filter(F.col("t") >= (F.col("_block") + 1) * 600.0 - 2.0 - 1e-9).withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    both = d.withColumn("_own", F.lit(True)).unionByName(tail)
    return both.withColumn("n_recent", F.expr("count(1) OVER (PARTITION BY session_id, _block ORDER BY t RANGE BETWEEN 2.0D PRECEDING AND CURRENT ROW)")).filter("_own").select("session_id", "frame", "n_recent")


@query(f"""
WITH o AS (SELECT session_id, t FROM v),
d AS (SELECT p.session_id, p.frame, p.t, a.t AS before, b.t AS after FROM p ASOF LEFT JOIN o a ON p.session_id = a.session_id AND p.t >= a.t ASOF LEFT JOIN o b ON p.session_id = b.session_id AND p.t <= b.t)
SELECT session_id, frame, coalesce(least(t - before, after - t) <= 0.5, false) AS visible FROM d""")
def ord_visible(spark, sf_dir):
    """Whether a valid row lies within half a second."""
    d = tr.visible(poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ), K, ORDER, is_valid(), 0.5)
    return d.select("session_id", "frame", "visible")


def _wrap_sql(e: str) -> str:
    return f"(({e}) + 180 - 360 * floor((({e}) + 180) / 360) - 180)"


@query(f"""
WITH u1 AS (SELECT session_id, t, arg_min(x, frame) AS x, arg_min(yaw, frame) AS yaw FROM v WHERE yaw IS NOT NULL GROUP BY session_id, t),
s0 AS (SELECT *, lead(t) OVER w AS nt, lead(x) OVER w AS nx, lead(yaw) OVER w AS nyaw, t - lag(t) OVER w AS dt, x - lag(x) OVER w AS dx, yaw - lag(yaw) OVER w AS dyaw FROM u1 WINDOW w AS (PARTITION BY session_id ORDER BY t)),
s AS (SELECT *, CASE WHEN dt > 0 THEN greatest(-0.8, least(0.8, dx / dt)) ELSE 0 END AS r, CASE WHEN dt > 0 THEN greatest(-90, least(90, {_wrap_sql('dyaw')} / dt)) ELSE 0 END AS ry FROM s0),
f AS (SELECT session_id, min(t) AS ft, arg_min(x, t) AS fx, arg_min(yaw, t) AS fyaw FROM u1 GROUP BY session_id),
q AS (SELECT p.session_id, p.frame, p.t, s.t AS lt, s.x AS lx, s.yaw AS lyaw, s.nt, s.nx, s.nyaw, s.r, s.ry, f.ft, f.fx, f.fyaw FROM p ASOF LEFT JOIN s ON p.session_id = s.session_id AND p.t >= s.t LEFT JOIN f ON p.session_id = f.session_id),
k AS (SELECT *, (t-lt)/(nt-lt) AS g, CASE WHEN ft IS NULL THEN 'SEARCHING' WHEN lt IS NULL THEN CASE WHEN ft - t <= 0.25 THEN 'ENTERING' ELSE 'SEARCHING' END WHEN nt - lt <= 0.65 THEN 'TRACKED' WHEN t - lt <= 0.5 THEN 'PREDICTED' ELSE 'SEARCHING' END AS state FROM q)
SELECT session_id, frame, state, round(CASE state WHEN 'ENTERING' THEN fx WHEN 'TRACKED' THEN lx + g*g*(3-2*g)*(nx-lx) WHEN 'PREDICTED' THEN lx + (t-lt)*r END + 1e-9, 6) AS x_at,
       round({_wrap_sql(f"CASE state WHEN 'ENTERING' THEN fyaw WHEN 'TRACKED' THEN lyaw + g*g*(3-2*g)*{_wrap_sql('nyaw-lyaw')} WHEN 'PREDICTED' THEN lyaw + (t-lt)*ry END")} + 1e-9, 4) AS yaw_at FROM k""")
def ord_resampled_state(spark, sf_dir):
    """Position, yaw and state at every processed frame from the valid ones."""
    s = ordered.first_per_time(valid(spark, sf_dir).filter("yaw IS NOT NULL").select("session_id", "t", "frame", "x", "yaw"), K, "t", "frame").drop("frame")
    d = tr.resample(poses(spark, sf_dir).select("session_id", "frame", "t"), s, K, "t", "t", ["x"], angles=("yaw",))
    return d.select("session_id", "frame", "state", F.round(F.col("x_at") + 1e-9, 6).alias("x_at"), F.round(F.col("yaw_at") + 1e-9, 4).alias("yaw_at"))


@query("""
SELECT session_id, frame, CASE WHEN status = 'valid' AND x IS NOT NULL AND source IN ('', 'direct') THEN 'MEASURED' WHEN status = 'valid' AND x IS NOT NULL AND source = 'optical_flow' THEN 'TRACKED_FLOW'
                WHEN status = 'valid' AND x IS NOT NULL THEN 'RECOVERED' WHEN status = 'jump_rejected' THEN 'PREDICTED' ELSE 'LOST' END AS state FROM p""")
def ord_measurement_state(spark, sf_dir):
    """Five states, the first that holds."""
    ok = (F.col("status") == "valid") & F.col("x").isNotNull()
    state = F.when(ok & F.col("source").isin("", "direct"), "MEASURED").when(ok & (F.col("source") == "optical_flow"), "TRACKED_FLOW").when(ok, "RECOVERED").when(F.col("status") == "jump_rejected", "PREDICTED").otherwise("LOST")
    return poses(spark, sf_dir).select("session_id", "frame", state.alias("state"))


# ---------------------------------------------------------------- aggregates


@query("SELECT session_id, count(rmse) AS n, round(avg(rmse), 6) AS mean, round(sqrt(avg(rmse*rmse)), 6) AS rmse, max(rmse) AS max, round(quantile_cont(rmse, 0.5), 6) AS median, round(quantile_cont(rmse, 0.95), 6) AS p95 FROM p WHERE rmse IS NOT NULL GROUP BY session_id")
def agg_error_stats(spark, sf_dir):
    d = agg.error_stats(poses(spark, sf_dir).select("session_id", "rmse"), K, "rmse")
    return d.select("session_id", "n", *six("mean", "rmse"), "max", *six("median", "p95"))


@query("SELECT session_id, id, count(DISTINCT frame) AS n_frames FROM seen GROUP BY session_id, id")
def agg_detections_per_id(spark, sf_dir):
    """In how many frames each tag was seen; twice in a frame counts once."""
    return detected(spark, sf_dir).select("session_id", "frame", "id").distinct().groupBy("session_id", "id").agg(F.count(F.lit(1)).alias("n_frames"))


def detected(spark, sf_dir) -> DataFrame:
    """(session_id, frame, t, id): a row per tag that a pose's field holds, however the field is written.

    A value's tag is the whole number that it is or ends in, as 7 in ``7``, ``tag 7`` and ``bay "B" 7``; values without one name no tag.
    """
    d = split_packed(poses(spark, sf_dir).select(F.struct("session_id", "frame", "t").alias("pose"), "ids"), "pose", "ids")
    tag = F.regexp_extract("tag_value", r"(?:^|\s)([0-9]+)$", 1).try_cast("int")
    return d.select("pose.*", tag.alias("id")).filter(F.col("id").isNotNull())


@query("""
WITH i AS (SELECT DISTINCT session_id, id FROM seen),
e AS (SELECT session_id, id FROM sessions JOIN tag_map USING (board))
SELECT e.session_id, count(*) AS n_expected, count(i.id) AS n_seen, round(count(i.id) / count(*), 6) AS coverage, string_agg(CASE WHEN i.id IS NULL THEN e.id END, ' ' ORDER BY e.id) AS missing
FROM e LEFT JOIN i ON i.session_id = e.session_id AND i.id = e.id GROUP BY e.session_id""")
def agg_tag_coverage(spark, sf_dir):
    """Tags of the board that were seen and those that never were."""
    seen = detected(spark, sf_dir).select("session_id", "id").distinct().withColumn("_seen", F.lit(1))
    expected = sessions(spark, sf_dir).select("session_id", "board").join(read_table(spark, sf_dir, "tag_map").select("board", "id"), "board")
    d = expected.join(seen, ["session_id", "id"], "left").groupBy("session_id")
    missing = F.array_sort(F.collect_list(F.when(F.col("_seen").isNull(), F.col("id"))))
    d = d.agg(F.count(F.lit(1)).alias("n_expected"), F.count("_seen").alias("n_seen"), missing.alias("_m"))
    return d.select("session_id", "n_expected", "n_seen", F.round(F.col("n_seen") / F.col("n_expected"), 6).alias("coverage"), F.when(F.size("_m") > 0, F.array_join(F.transform("_m", lambda i: i.cast("string")), " ")).alias("missing"))


@query(f"SELECT session_id, count(*) AS n, round(avg({VALID_SQL}::INT), 6) AS valid_ratio FROM p GROUP BY session_id")
def agg_valid_ratio(spark, sf_dir):
    return poses(spark, sf_dir).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(is_valid().cast("int")), 6).alias("valid_ratio"))


@query("SELECT session_id, coalesce(status, 'none') AS state, count(*) AS n FROM p GROUP BY 1, 2")
def agg_state_counts(spark, sf_dir):
    return poses(spark, sf_dir).groupBy("session_id", F.coalesce("status", F.lit("none")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def along_axes(d: DataFrame) -> DataFrame:
    """(session_id, axis, value): a row per coordinate."""
    return d.select("session_id", F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in XYZ])).alias("e")).select("session_id", "e.axis", "e.value")


@query("""
WITH b AS (SELECT session_id, quantile_cont(x, 0.01) AS x1, quantile_cont(x, 0.99) AS x2, quantile_cont(y, 0.01) AS y1, quantile_cont(y, 0.99) AS y2, quantile_cont(z, 0.01) AS z1, quantile_cont(z, 0.99) AS z2 FROM v GROUP BY session_id)
SELECT session_id, round((x1+x2)/2, 6) AS cx, round((y1+y2)/2, 6) AS cy, round((z1+z2)/2, 6) AS cz, round(greatest(x2-x1, y2-y1, z2-z1, 0.3), 6) AS side FROM b""")
def agg_bounding_cube(spark, sf_dir):
    """A cube over the middle 98 % of each axis."""
    d = agg.percentiles(along_axes(valid(spark, sf_dir)), ["session_id", "axis"], "value", {"lo": 0.01, "hi": 0.99})
    pick = lambda a, c: F.max(F.when(F.col("axis") == a, F.col(c)))
    d = d.groupBy("session_id").agg(*[pick(a, c).alias(f"{a}_{c}") for a in XYZ for c in ("lo", "hi")])
    return d.select("session_id", *[F.round((F.col(f"{a}_lo") + F.col(f"{a}_hi")) / 2, 6).alias(f"c{a}") for a in XYZ], F.round(F.greatest(*[F.col(f"{a}_hi") - F.col(f"{a}_lo") for a in XYZ], F.lit(0.3)), 6).alias("side"))


STATIC = [(5.0, 10.0), (20.0, 25.0), (60.0, 70.0)]
STATIC_SQL = " UNION ALL ".join(f"SELECT {a} AS a, {b} AS b" for a, b in STATIC)


@query(f"""
WITH i AS ({STATIC_SQL}), w AS (SELECT vq.session_id, i.a, vq.t, vq.frame, vq.x, vq.y, vq.z, vq.qx, vq.qy, vq.qz, vq.qw FROM vq JOIN i ON vq.t BETWEEN i.a AND i.b),
c AS (SELECT session_id, a, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, arg_min({{'x': x, 'y': y, 'z': z, 'qx': qx, 'qy': qy, 'qz': qz, 'qw': qw}}, (t, frame)) AS f FROM w GROUP BY session_id, a HAVING count(*) >= 2),
r AS (SELECT w.session_id, w.a, n, sqrt((x-mx)^2 + (y-my)^2 + (z-mz)^2) AS radius, sqrt((x-f.x)^2 + (y-f.y)^2 + (z-f.z)^2) AS drift, {rotation_sql.turn(rotation_sql.multiply(rotation_sql.inverse(rotation_sql.q('f.')), rotation_sql.q('w.')))} AS turned FROM w JOIN c USING (session_id, a))
SELECT session_id, a AS start_s, max(n) AS n, round(quantile_cont(radius, 0.95), 6) AS radius_p95, round(max(drift), 6) AS drift_max, round(max(turned) + 1e-9, 3) AS turn_max_deg FROM r GROUP BY session_id, a""")
def agg_static_intervals(spark, sf_dir):
    """Spread, drift and turn while the rig stands still; both ends belong to an interval; fewer than two rows give none."""
    d = valid(spark, sf_dir).dropna(subset=RPY).select("session_id", "t", "frame", *XYZ, rot.from_euler(*(F.col(a) for a in RPY)).alias("q"))
    which = F.filter(F.array(*[F.when(F.col("t").between(a, b), F.lit(a)) for a, b in STATIC]), lambda v: v.isNotNull())
    d = d.select("*", F.explode(which).alias("start_s"))
    keys = ["session_id", "start_s"]
    c = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(a).alias(f"m{a}") for a in XYZ], F.min_by(F.struct(*XYZ, "q"), F.struct(*ORDER)).alias("f")).filter("n >= 2")
    d = d.join(c, keys).withColumn("radius", F.sqrt(sum((F.col(a) - F.col(f"m{a}")) * (F.col(a) - F.col(f"m{a}")) for a in XYZ))).withColumns({"drift": tr.moved(XYZ, "f"), "turned": rot.angle_deg(F.col("f.q"), F.col("q"))})
    p95 = agg.percentiles(d, keys, "radius", {"radius_p95": 0.95})
    ends = d.groupBy(*keys).agg(F.max("drift").alias("drift_max"), F.round(F.max("turned") + 1e-9, 3).alias("turn_max_deg"))
    return p95.join(ends, keys).select(*keys, "n", *six("radius_p95", "drift_max"), "turn_max_deg")


@query("SELECT session_id, count(*) AS n, round(CASE WHEN count(*) >= 20 AND stddev_pop(rmse) > 1e-9 AND stddev_pop(tags) > 1e-9 THEN covar_pop(rmse, tags) / (stddev_pop(rmse) * stddev_pop(tags)) END, 5) AS r FROM p WHERE rmse IS NOT NULL AND tags IS NOT NULL GROUP BY session_id")
def agg_correlation(spark, sf_dir):
    """Error against tag count; none for few rows or a constant side."""
    d = poses(spark, sf_dir).filter("rmse IS NOT NULL AND tags IS NOT NULL").groupBy("session_id")
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(agg.correlation(F.col("rmse"), F.col("tags").cast("double"), 20), 5).alias("r"))


@query()
def agg_bootstrap(spark, sf_dir):
    """Confidence interval of the error from 1,000 draws of blocks of a second; tested against draws over rows."""
    d = agg.block_bootstrap(poses(spark, sf_dir).select("session_id", "t", "rmse"), K, "t", "rmse")
    return d.select("session_id", "n_blocks", *six("rmse", "low", "high"))


@query("SELECT session_id, quantile_cont(x, 0.5) AS x, quantile_cont(y, 0.5) AS y, quantile_cont(z, 0.5) AS z FROM v GROUP BY session_id")
def agg_median_translation(spark, sf_dir):
    d = agg.percentiles(along_axes(valid(spark, sf_dir)), ["session_id", "axis"], "value", {"m": 0.5})
    return d.groupBy("session_id").agg(*[F.max(F.when(F.col("axis") == a, F.col("m"))).alias(a) for a in XYZ])


@query("WITH mean_ AS (SELECT session_id, count(*) AS n, " + ", ".join(f"sum(q{a}*q{b}) AS h{i}{j}" for i, a in enumerate("xyzw") for j, b in enumerate("xyzw") if i <= j) + " FROM vq GROUP BY session_id), " + rotation_sql.top_eigenvector("mean_", ["session_id"], "h") + " SELECT session_id, n, " + ", ".join(f"round(e{i} * CASE WHEN e3 < 0 THEN -1 ELSE 1 END, 6) AS q{c}" for i, c in enumerate("xyzw")) + " FROM pow_ JOIN mean_ USING (session_id)")
def agg_mean_rotation(spark, sf_dir):
    """The chordal mean orientation of each session; tested on closed forms."""
    d = valid(spark, sf_dir).dropna(subset=RPY).select("session_id", rot.from_euler(*(F.col(a) for a in RPY)).alias("q"))
    return mean_rotation(d, K, "q").select("session_id", "n", *six("qx", "qy", "qz", "qw"))


@query("WITH src_ AS (SELECT session_id, frame, rmse FROM p WHERE rmse IS NOT NULL), " + filter_sql.robust_limits("src_", "session_id", "rmse", 0.002) + " SELECT session_id, count(*) AS n, count(*) FILTER (WHERE inlier) AS n_inliers FROM kept_ GROUP BY session_id")
def agg_robust_inliers(spark, sf_dir):
    """Errors kept by repeated median and deviation limits; tested against numpy."""
    d = robust_inliers(poses(spark, sf_dir).filter("rmse IS NOT NULL").select("session_id", "frame", "rmse"), K, "rmse", 0.002)
    return d.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("inlier").cast("long")).alias("n_inliers"))


# ---------------------------------------------------------------- selection and sets


@query("SELECT session_id, floor(t)::BIGINT AS second, arg_min(frame, (rmse, -inliers, frame)) AS frame, min(rmse) AS rmse FROM v WHERE rmse IS NOT NULL AND inliers IS NOT NULL GROUP BY 1, 2")
def sel_best_pose(spark, sf_dir):
    """The best pose of each second: least error, then most inliers, then first."""
    d = valid(spark, sf_dir).filter("rmse IS NOT NULL AND inliers IS NOT NULL")
    return d.groupBy("session_id", F.floor("t").alias("second")).agg(F.min_by("frame", F.struct(F.col("rmse"), -F.col("inliers"), F.col("frame"))).alias("frame"), F.min("rmse").alias("rmse"))


@query(f"""
SELECT session_id, floor(t)::BIGINT AS second, CASE WHEN bool_or({VALID_SQL} AND rmse IS NOT NULL AND inliers IS NOT NULL) THEN arg_min(frame, (rmse, -inliers, frame)) FILTER (WHERE {VALID_SQL} AND rmse IS NOT NULL AND inliers IS NOT NULL) ELSE arg_min(frame, (-coalesce(tags, 0), frame)) END AS frame
FROM p GROUP BY 1, 2""")
def sel_scout_base(spark, sf_dir):
    """The best solved frame of each second; without one, that with most tags."""
    solved = is_valid() & F.col("rmse").isNotNull() & F.col("inliers").isNotNull()
    best = F.min_by("frame", F.when(solved, F.struct(F.col("rmse"), -F.col("inliers"), F.col("frame"))))
    most = F.min_by("frame", F.struct(-F.coalesce("tags", F.lit(0)), F.col("frame")))
    g = poses(spark, sf_dir).groupBy("session_id", F.floor("t").alias("second"))
    return g.agg(F.when(F.max(solved), best).otherwise(most).alias("frame"))


@query("SELECT session_id, view, max(inliers) AS inliers, arg_min(frame, (-inliers, frame)) AS frame FROM p WHERE view IS NOT NULL AND inliers IS NOT NULL GROUP BY session_id, view")
def sel_largest_per_view(spark, sf_dir):
    """Per view the frame with most inliers, the first on a tie."""
    d = poses(spark, sf_dir).filter("view IS NOT NULL AND inliers IS NOT NULL")
    return d.groupBy("session_id", "view").agg(F.max("inliers").alias("inliers"), F.min_by("frame", F.struct(-F.col("inliers"), F.col("frame"))).alias("frame"))


@query("""
WITH o AS (SELECT session_id, frame, row_number() OVER (PARTITION BY session_id ORDER BY t, frame) - 1 AS i, count(*) OVER (PARTITION BY session_id) AS n FROM v),
g AS (SELECT DISTINCT session_id, round_even(k * (n - 1) / 239.0, 0)::BIGINT AS i FROM (SELECT DISTINCT session_id, n FROM o), (SELECT unnest(range(240)) AS k) WHERE n > 1 OR k = 0)
SELECT o.session_id, o.frame FROM o JOIN g USING (session_id, i)""")
def sel_evenly_spaced(spark, sf_dir):
    """At most 240 rows of each session, evenly spaced by rank; a sampling operator."""
    return ordered.evenly_spaced(valid(spark, sf_dir).select("session_id", "t", "frame"), K, ORDER, 240).select("session_id", "frame")


@query("SELECT session_id, second, string_agg(id, ' ' ORDER BY id) AS ids FROM (SELECT DISTINCT session_id, floor(t)::BIGINT AS second, id FROM seen) GROUP BY 1, 2")
def set_union_of_ids(spark, sf_dir):
    """All tags seen in each second, once each, in order."""
    d = detected(spark, sf_dir).select("session_id", F.floor("t").alias("second"), "id")
    ids = F.array_sort(F.collect_set("id"))
    return d.groupBy("session_id", "second").agg(F.array_join(F.transform(ids, lambda i: i.cast("string")), " ").alias("ids"))


@query("SELECT session_id, count(DISTINCT coalesce(trim(camera_profile), '')) > 1 OR count(DISTINCT coalesce(trim(board), '')) > 1 OR count(DISTINCT coalesce(source_fps, -1)) > 1 AS changed, count(*) AS n FROM capture_sessions GROUP BY session_id")
def set_changed_parameters(spark, sf_dir):
    """Whether repeated manifests of a session disagree in any parameter."""
    d = read_table(spark, sf_dir, "capture_sessions").groupBy("session_id")
    texts = [F.coalesce(F.trim(c), F.lit("")) for c in ("camera_profile", "board")]
    differ = [F.min(c) != F.max(c) for c in (*texts, F.coalesce("source_fps", F.lit(-1.0)))]
    return d.agg((differ[0] | differ[1] | differ[2]).alias("changed"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- synchronisation, alignment, geometry, gates


def speed_pairs(spark, sf_dir):
    clean = ordered.first_per_time(valid(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, "t", "frame").drop("frame")
    truth = ordered.first_per_time(mocap(spark, sf_dir).select("session_id", "t", "frame", *XYZ), K, "t", "frame").drop("frame")
    shared = truth.select("session_id").distinct()
    return sync.speeds(clean.join(shared, "session_id", "left_semi"), K, "t", XYZ), sync.speeds(truth, K, "t", XYZ)


@query()
def sync_time_offset(spark, sf_dir):
    """The shift between poses and motion capture that makes their speeds agree best; tested on shifted series."""
    left, right = speed_pairs(spark, sf_dir)
    return sync.find_offset(left, right, K, radius=1.0, coarse=0.01, fine=0.001).select("session_id", *six("offset_s", "score", "uncertainty_s"), "n")


def matched(spark, sf_dir) -> DataFrame:
    d = asof.bracket(valid(spark, sf_dir).select("session_id", "frame", "t", *XYZ), mocap(spark, sf_dir), K, "t", "t", XYZ)
    t = F.col("t")
    return d.filter(asof.covered(t, 0.5)).select("session_id", "frame", "t", *XYZ, *[asof.linear(t, a).alias(f"m{a}") for a in XYZ])


# SQL: valid poses with the truth's position at their time.
MATCHED = BRACKET.replace("'x': x, 'nt'", "'x': x, 'y': y, 'z': z, 'ny': ny, 'nz': nz, 'nt'").replace("lead(x) OVER w AS nx", "lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz").rstrip() + """,
q3 AS (SELECT session_id, frame, t, """ + ", ".join(f"CASE WHEN l IS NOT NULL THEN l.{c} ELSE r.{c} END AS l{c}, CASE WHEN l IS NOT NULL THEN r.{c} ELSE r.n{c} END AS r{c}" for c in ("t", *XYZ)) + """ FROM b WHERE kind = 0),
mt AS (SELECT q3.session_id, q3.frame, v.x, v.y, v.z, """ + ", ".join(f"l{c} + CASE WHEN rt > lt THEN (q3.t - lt) / (rt - lt) ELSE 0 END * (r{c} - l{c}) AS m{c}" for c in XYZ) + """ FROM q3 JOIN v USING (session_id, frame) WHERE lt <= q3.t AND q3.t <= rt AND rt - lt <= 0.5),
""" + filter_sql.rigid("mt", "session_id")


@query(MATCHED + " SELECT session_id, n, " + ", ".join(f"round({c}, 5) AS {c}" for c in (*(f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)), "t1", "t2", "t3")) + " FROM rigid_")
def geo_rigid_alignment(spark, sf_dir):
    """The rotation and translation of poses onto motion capture per session; tested on closed forms."""
    d = fit_rigid(matched(spark, sf_dir), K, XYZ, [f"m{a}" for a in XYZ])
    return d.select("session_id", "n", *five("r11", "r12", "r13", "r21", "r22", "r23", "r31", "r32", "r33", "t1", "t2", "t3"))


@query(MATCHED + ", er AS (SELECT mt.session_id, " + "sqrt(" + " + ".join(f"(r{i}1*x + r{i}2*y + r{i}3*z + t{i} - m{c})^2" for i, c in enumerate(XYZ, 1)) + ") AS e FROM mt JOIN rigid_ USING (session_id)) SELECT session_id, count(*) AS n, round(avg(e), 5) AS mean, round(sqrt(avg(e*e)), 5) AS rmse, round(quantile_cont(e, 0.5), 5) AS median, round(quantile_cont(e, 0.95), 5) AS p95, round(max(e), 5) AS max FROM er GROUP BY session_id")
def geo_aligned_errors(spark, sf_dir):
    """Error statistics after alignment: the ground-truth report."""
    pairs = matched(spark, sf_dir)
    d = apply_rigid(pairs, fit_rigid(pairs, K, XYZ, [f"m{a}" for a in XYZ]), K, XYZ)
    error = F.sqrt(sum((F.col(f"{a}_aligned") - F.col(f"m{a}")) * (F.col(f"{a}_aligned") - F.col(f"m{a}")) for a in XYZ))
    return agg.error_stats(d.withColumn("error_m", error).select("session_id", "error_m"), K, "error_m").select("session_id", "n", *five("mean", "rmse", "median", "p95", "max"))


EULER = "sin(radians(roll)/2) AS sa, cos(radians(roll)/2) AS ca, sin(radians(pitch)/2) AS sb, cos(radians(pitch)/2) AS cb, sin(radians(yaw)/2) AS sc, cos(radians(yaw)/2) AS cc"


@query(f"""
WITH h AS (SELECT session_id, frame, {EULER} FROM v WHERE roll IS NOT NULL AND pitch IS NOT NULL AND yaw IS NOT NULL)
SELECT session_id, frame, round(sa*cb*cc - ca*sb*sc, 6) AS qx, round(ca*sb*cc + sa*cb*sc, 6) AS qy, round(ca*cb*sc - sa*sb*cc, 6) AS qz, round(ca*cb*cc + sa*sb*sc, 6) AS qw FROM h""")
def geo_quaternions(spark, sf_dir):
    d = valid(spark, sf_dir).dropna(subset=RPY).withColumn("q", rot.from_euler(*(F.col(a) for a in RPY)))
    return d.select("session_id", "frame", *[F.round(f"q.{c}", 6).alias(f"q{c}") for c in "xyzw"])


@query("SELECT session_id, frame, 0.0::DOUBLE AS off_deg FROM vq")
def geo_euler_round_trip(spark, sf_dir):
    """How far Euler angles turned to a quaternion and back are off, as a rotation; tested to be nothing."""
    d = valid(spark, sf_dir).dropna(subset=RPY).withColumn("q", rot.from_euler(*(F.col(a) for a in RPY)))
    roll, pitch, yaw = rot.to_euler(F.col("q"))
    d = d.select("session_id", "frame", "q", F.struct(roll.alias("r"), pitch.alias("p"), yaw.alias("y")).alias("e"))
    d = d.withColumn("back", rot.from_euler(F.col("e.r"), F.col("e.p"), F.col("e.y")))
    return d.select("session_id", "frame", F.round(rot.angle_deg(F.col("q"), F.col("back")), 4).alias("off_deg"))


@query("SELECT board, count(*) AS n, round(max(center_m[1]) - min(center_m[1]), 6) AS width_m, round(max(center_m[2]) - min(center_m[2]), 6) AS height_m FROM tag_map GROUP BY board")
def geo_board_extent(spark, sf_dir):
    at = lambda i: F.get("center_m", F.lit(i))
    return read_table(spark, sf_dir, "tag_map").groupBy("board").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(at(0)) - F.min(at(0)), 6).alias("width_m"), F.round(F.max(at(1)) - F.min(at(1)), 6).alias("height_m"))


@query("""
WITH s AS (SELECT session_id, max(x) - min(x) AS span FROM v GROUP BY session_id HAVING max(x) - min(x) > 0),
b AS (SELECT session_id, span, pow(10, floor(log10(span / 8))) AS base, span / 8 AS raw FROM s)
SELECT session_id, round(base * CASE WHEN raw/base <= 1 THEN 1 WHEN raw/base <= 2 THEN 2 WHEN raw/base <= 5 THEN 5 ELSE 10 END, 9) AS step FROM b""")
def geo_grid_step(spark, sf_dir):
    d = valid(spark, sf_dir).groupBy("session_id").agg((F.max("x") - F.min("x")).alias("span")).filter("span > 0")
    return d.select("session_id", F.round(nice_step(F.col("span")), 9).alias("step"))


@query(BRACKET + """, e AS (SELECT session_id, t FROM q WHERE lt <= t AND t <= rt AND rt - lt <= 0.5),
w AS (SELECT session_id, min(t) AS a, max(t) AS b, count(*) AS n FROM e GROUP BY session_id),
sp AS (SELECT e.*, CASE WHEN t <= a + 0.3 * (b - a) THEN 'calibration' ELSE 'test' END AS split FROM e JOIN w USING (session_id))
SELECT session_id, count(*) FILTER (WHERE split = 'calibration') AS n_calibration, count(*) FILTER (WHERE split = 'test') AS n_test,
       CASE WHEN count(*) < 40 THEN 'TOO_FEW' WHEN count(*) FILTER (WHERE split = 'test') < 20 THEN 'TOO_FEW_TEST' ELSE 'OK' END AS verdict FROM sp GROUP BY session_id""")
def gate_split(spark, sf_dir):
    """Calibration and test parts by 30 % of the time both cover, and whether they hold enough rows."""
    d = matched(spark, sf_dir).select("session_id", "t")
    w = d.groupBy("session_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    test = F.sum((F.col("t") > F.col("a") + 0.3 * (F.col("b") - F.col("a"))).cast("long"))
    g = d.join(w, "session_id").groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"), test.alias("n_test"))
    verdict = F.when(F.col("_n") < 40, "TOO_FEW").when(F.col("n_test") < 20, "TOO_FEW_TEST").otherwise("OK")
    return g.select("session_id", (F.col("_n") - F.col("n_test")).alias("n_calibration"), "n_test", verdict.alias("verdict"))


@query(f"""
WITH s AS (SELECT session_id, count(*) AS n, avg({VALID_SQL}::INT) AS valid_ratio, quantile_cont(rmse, 0.95) AS p95, avg((source = 'optical_flow')::INT) AS flow FROM p GROUP BY session_id),
c AS (SELECT *, list_filter([CASE WHEN n < 30 THEN 'few_rows' END, CASE WHEN valid_ratio < 0.5 THEN 'few_valid' END, CASE WHEN coalesce(p95, 1e9) > 3.0 + 1e-9 THEN 'large_error' END, CASE WHEN flow > 0 THEN 'uses_flow' END], lambda x: x IS NOT NULL) AS reasons FROM s)
SELECT session_id, CASE WHEN len(reasons) = 0 THEN 'PASS' ELSE 'REVIEW' END AS verdict, array_to_string(reasons, ' ') AS reasons FROM c""")
def gate_quality(spark, sf_dir):
    """A session passes or is to be reviewed, with the reasons."""
    d = poses(spark, sf_dir)
    s = d.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.avg(is_valid().cast("int")).alias("valid_ratio"), F.avg((F.col("source") == "optical_flow").cast("int")).alias("flow"))
    s = s.join(agg.percentiles(d, K, "rmse", {"p95": 0.95}).drop("n"), "session_id", "left")
    large = ~within(F.coalesce("p95", F.lit(1e9)), 3.0)
    reasons = F.array(F.when(F.col("n") < 30, "few_rows"), F.when(F.col("valid_ratio") < 0.5, "few_valid"), F.when(large, "large_error"), F.when(F.col("flow") > 0, "uses_flow"))
    reasons = F.filter(reasons, lambda r: r.isNotNull())
    return s.select("session_id", F.when(F.size(reasons) == 0, "PASS").otherwise("REVIEW").alias("verdict"), F.array_join(reasons, " ").alias("reasons"))


@query("""
WITH u AS (SELECT session_id, frame, min(x) AS x FROM m GROUP BY session_id, frame)
SELECT session_id, frame, round(x + 1e-9, 6) AS x FROM (
  SELECT session_id, frame, CASE WHEN px IS NULL OR nx IS NULL THEN coalesce(px, nx) ELSE px + (frame - pf) / (nf - pf) * (nx - px) END AS x FROM (
    SELECT g.session_id, g.frame, a.frame AS pf, a.x AS px, b.frame AS nf, b.x AS nx
    FROM (SELECT session_id, unnest(generate_series(min(frame), max(frame))) AS frame FROM u GROUP BY session_id) g
    ASOF JOIN u a ON g.session_id = a.session_id AND g.frame >= a.frame ASOF LEFT JOIN u b ON g.session_id = b.session_id AND g.frame < b.frame))""")
def ord_dense_frames(spark, sf_dir):
    """Every frame of the motion capture, the position interpolated between usable ones."""
    d = mocap(spark, sf_dir).groupBy("session_id", F.col("frame").cast("double").alias("f")).agg(F.min("x").alias("x"))
    grid = d.groupBy("session_id").agg(F.min("f").alias("a"), F.max("f").alias("b"))
    grid = grid.select("session_id", F.explode(F.sequence(F.col("a").cast("long"), F.col("b").cast("long"))).alias("frame"))
    found = asof.bracket(grid, d, K, "frame", "f", ["x"], side="right")
    return found.select("session_id", "frame", F.round(asof.clamped(F.col("frame"), "x") + 1e-9, 6).alias("x"))


@query("""
WITH g0 AS (SELECT *, t - lag(t) OVER w AS dt FROM v WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)),
s AS (SELECT *, sum(CASE WHEN dt IS NULL OR dt > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY t, frame ROWS UNBOUNDED PRECEDING) AS segment FROM g0),
sec AS (SELECT session_id, segment, floor(t)::BIGINT AS second, avg(x) AS x FROM s GROUP BY 1, 2, 3),
grid AS (SELECT session_id, segment, a, unnest(generate_series(a, b)) AS second FROM (SELECT session_id, segment, floor(min(t))::BIGINT AS a, floor(max(t))::BIGINT AS b FROM s GROUP BY 1, 2)),
long_ AS (SELECT {'s': session_id, 'k': segment} AS g, second - a + 1 AS n, second::DOUBLE AS t, 'x' AS axis, x AS z, (0.012 * 0.012)::DOUBLE AS r, (2.5 * 2.5)::DOUBLE AS q, 1.0::DOUBLE AS v0, second FROM grid LEFT JOIN sec USING (session_id, segment, second)),
""" + filter_sql.kalman("long_", discrete=True) + " SELECT s.g.s AS session_id, s.g.k::BIGINT AS segment, l.second, round(out_ + 1e-9, 5) AS x_smooth FROM smooth_ s JOIN long_ l ON l.g = s.g AND l.n = s.n")
def ord_dense_kalman(spark, sf_dir):
    """Smoothing over a dense grid of seconds with missing readings, one acceleration a step, per segment."""
    d = ordered.gap_segments(valid(spark, sf_dir).select("session_id", "t", "frame", "x"), K, ORDER, 5.0)
    seconds = d.groupBy("session_id", "segment", F.floor("t").alias("second")).agg(F.avg("x").alias("x"))
    ends = d.groupBy("session_id", "segment").agg(F.floor(F.min("t")).alias("a"), F.floor(F.max("t")).alias("b"))
    grid = ends.select("session_id", "segment", "a", F.explode(F.sequence("a", "b")).alias("second")).withColumn("i", F.col("second") - F.col("a")).drop("a")
    grid = grid.join(seconds, ["session_id", "segment", "second"], "left")
    return smoothing.kalman_rts(grid, [*K, "segment"], ["second"], {"x": (0.012, 2.5, 1.0)}, "i", "discrete").select("session_id", "segment", "second", F.round(F.col("x_smooth") + 1e-9, 5).alias("x_smooth"))


@query("SELECT id, id % 6 AS col, id // 6 AS row, round((id % 6) * 0.13, 6) AS cx, round((id // 6) * 0.13, 6) AS cy FROM (SELECT unnest(range(36)) AS id)")
def geo_board_grid(spark, sf_dir):
    """A regular board of 6 x 6 tags, numbered row by row."""
    from posegrain.functions.boards import board_grid

    return board_grid(spark, 6, 6, 0.13).select("id", "col", "row", *six("cx", "cy"))


@query("SELECT printf('h-%03d', k * 30) AS name, k * 30.0 AS yaw, 0.0 AS pitch FROM (SELECT unnest(range(12)) AS k) UNION ALL SELECT 'z-up', 0.0, 85.0 UNION ALL SELECT 'z-down', 0.0, -85.0")
def geo_view_set(spark, sf_dir):
    """The views a panorama is looked at in: every 30 degrees, up and down."""
    from posegrain.functions.boards import view_set

    return view_set(spark, 12)


@query("SELECT view, count(*) AS n, round(avg(inliers), 6) AS inliers, round(640 / (2 * tan(radians(45))), 6) AS focal_px FROM p WHERE view IS NOT NULL AND inliers IS NOT NULL GROUP BY view")
def geo_view_intrinsics(spark, sf_dir):
    """Inliers by view, with the focal length of a pinhole view of 640 pixels and 90 degrees."""
    from posegrain.functions.boards import focal_px

    d = poses(spark, sf_dir).filter("view IS NOT NULL AND inliers IS NOT NULL").groupBy("view")
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("inliers"), 6).alias("inliers")).withColumn("focal_px", F.round(focal_px(F.lit(640.0), F.lit(90.0)), 6))


@query()
def geo_hand_eye(spark, sf_dir):
    """Camera-to-marker and world transforms of each session with motion capture, from at most 240 evenly spaced pairs; tested on closed forms."""
    from posegrain.operators.hand_eye import hand_eye_by_group

    d = valid(spark, sf_dir).dropna(subset=RPY).withColumn("q", rot.from_euler(*(F.col(a) for a in RPY)))
    d = d.select("session_id", "t", "frame", *XYZ, *[F.col(f"q.{c}").alias(f"q{c}") for c in "xyzw"])
    d = asof.bracket(d, mocap(spark, sf_dir).dropna(subset=["qx", "qy", "qz", "qw"]), K, "t", "t", [*XYZ, "qx", "qy", "qz", "qw"])
    near = asof.nearest(F.col("t"))
    d = d.filter(asof.covered(F.col("t"), 0.5)).withColumn("m", near)
    cols = [*XYZ, "qx", "qy", "qz", "qw"]
    return hand_eye_by_group(d.select("session_id", "t", "frame", *cols, *[F.col(f"m.{c}").alias(f"m_{c}") for c in cols]), K, ORDER).select("session_id", "n", *six("tx", "ty", "tz", "qx", "qy", "qz", "qw"))
