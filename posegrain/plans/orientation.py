"""Queries with full poses: joins that turn, errors of movement, states, views. Each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrain.functions import poses as ps
from posegrain.functions import rotations as rot
from posegrain.functions import views
from posegrain.operators import asof, ordered
from posegrain.operators import trajectory as tr
from posegrain.plans import rotation_sql as rs
from posegrain.plans.reference import BASE, K, ORDER, RPY, VALID_SQL, XYZ, is_valid, mocap, poses, sessions, six, valid
from posegrain.session import cut_lineage, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FULL = [*XYZ, "qx", "qy", "qz", "qw"]
ENTRIES = ("r11", "r12", "r23")


def query(sql: str | None = None, base: bool = True):
    """As in ``reference``; SQL that starts with a comma goes on after the common tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            text = sql.strip()
            ORACLE[f.__name__] = (BASE + (text if text.startswith(",") else "\n" + text)) if base else text
        return f

    return add


def valid_poses(spark, sf_dir) -> DataFrame:
    """Valid rows with an orientation: session_id, frame, t, tags, source, x … qw."""
    d = valid(spark, sf_dir).dropna(subset=RPY).withColumn("q", rot.from_euler(*(F.col(a) for a in RPY)))
    return d.select("session_id", "frame", "t", "tags", "source", *XYZ, *[F.col(f"q.{c}").alias(f"q{c}") for c in "xyzw"])


def mocap_poses(spark, sf_dir) -> DataFrame:
    d = mocap(spark, sf_dir).withColumn("_n", F.sqrt(sum(F.col(f"q{c}") * F.col(f"q{c}") for c in "xyzw"))).filter(F.col("_n") > 0.5)
    return d.select("session_id", "frame", "t", *XYZ, *[(F.col(f"q{c}") / F.col("_n")).alias(f"q{c}") for c in "xyzw"])


def around(spark, sf_dir) -> DataFrame:
    return asof.bracket(valid_poses(spark, sf_dir), mocap_poses(spark, sf_dir), K, "t", "t", FULL)


def pose_pairs(spark, sf_dir) -> DataFrame:
    """Valid poses (struct ``e``) with the truth at their time (struct ``m``), where its samples are at most half a second apart."""
    t = F.col("t")
    return around(spark, sf_dir).filter(asof.covered(t, 0.5)).select("session_id", "frame", "t", "tags", "source", ps.from_columns().alias("e"), ps.at_time(t).alias("m"))


# ---------------------------------------------------------------- joins


@query(f", {rs.PAIRS} SELECT session_id, frame, round(mx, 6) AS x, round(my, 6) AS y, round(mz, 6) AS z, {rs.entries(rs.q('m'), *ENTRIES)} FROM pairs")
def join_interpolated_pose(spark, sf_dir):
    """The truth's position and orientation at each valid pose's time."""
    return pose_pairs(spark, sf_dir).select("session_id", "frame", *[F.round(f"m.p.{a}", 6).alias(a) for a in XYZ], *ps.entries(F.col("m.q"), *ENTRIES))


@query(f""", ask AS (SELECT session_id, frame, t FROM vq), {rs.AROUND},
c AS (SELECT session_id, frame, CASE WHEN hi IS NULL THEN lo WHEN hi.t < t THEN hi WHEN t <= lo.t THEN lo ELSE {{'t': t, 'x': x, 'y': y, 'z': z, 'qx': qx, 'qy': qy, 'qz': qz, 'qw': qw}} END AS o FROM found WHERE lo IS NOT NULL)
SELECT session_id, frame, round(o.x, 6) AS x, {rs.entries(rs.q('o.'), *ENTRIES)} FROM c""")
def join_clamped_pose(spark, sf_dir):
    """As before at every valid pose, the first and last pose outside the truth's samples."""
    d = around(spark, sf_dir).filter("lo IS NOT NULL").withColumn("c", ps.clamped_at_time(F.col("t")))
    return d.select("session_id", "frame", F.round("c.p.x", 6).alias("x"), *ps.entries(F.col("c.q"), *ENTRIES))


LEVER = (0.05, -0.02, 0.11)  # a fixed arm and turn from the marker to the camera
LEVER_Q = (0.1, -0.2, 0.3, 0.9273618495495703)


def _text(values: tuple[float, ...]) -> tuple[str, ...]:
    return tuple(f"({v})" for v in values)


@query(f""", ask AS (SELECT session_id, frame, t FROM vq), {rs.AROUND},
s AS (SELECT session_id, frame, {rs.named(rs.rotate(rs.q(), _text(LEVER)), 'ax', 'ay', 'az')}, x, y, z, {rs.named(rs.multiply(rs.q(), _text(LEVER_Q)), 'tqx', 'tqy', 'tqz', 'tqw')} FROM found WHERE inner_ AND hi IS NOT NULL AND hi.t - lo.t <= 0.5)
SELECT session_id, frame, round(x + ax, 6) AS x, round(y + ay, 6) AS y, round(z + az, 6) AS z, {rs.entries(rs.q('t'), *ENTRIES)} FROM s""")
def join_truth_sampler(spark, sf_dir):
    """The camera's true pose at times strictly inside the truth: the marker's, then the fixed arm from marker to camera."""
    t = F.col("t")
    arm = ps.pose(rot.vector(*(F.lit(v) for v in LEVER)), rot.quaternion(*(F.lit(v) for v in LEVER_Q)))
    d = around(spark, sf_dir).filter(asof.covered(t, 0.5) & (F.col("lo.t") < t)).withColumn("c", ps.compose(ps.at_time(t), arm))
    return d.select("session_id", "frame", *[F.round(f"c.p.{a}", 6).alias(a) for a in XYZ], *ps.entries(F.col("c.q"), *ENTRIES))


def _moved(a: str, b: str) -> str:
    """SQL: the pose ``b`` as seen from ``a``, as columns x … qw."""
    return rs.named(rs.rotate(rs.inverse(rs.q(a)), rs.minus(rs.v(b), rs.v(a))), *"xyz") + ", " + rs.named(rs.multiply(rs.inverse(rs.q(a)), rs.q(b)), "qx", "qy", "qz", "qw")


def _error_sql(source: str) -> str:
    """SQL over ``source`` (session_id, frame and structs ea, eb, ma, mb): the error of the found movement against the true one."""
    return f"""
mt AS (SELECT session_id, frame, {_moved('ma.', 'mb.')} FROM {source}), et AS (SELECT session_id, frame, {_moved('ea.', 'eb.')} FROM {source}),
er AS (SELECT session_id, frame, {rs.named(rs.rotate(rs.inverse(rs.q('mt.')), rs.minus(rs.v('et.'), rs.v('mt.'))), *'xyz')}, {rs.named(rs.multiply(rs.inverse(rs.q('mt.')), rs.q('et.')), 'qx', 'qy', 'qz', 'qw')} FROM mt JOIN et USING (session_id, frame))
SELECT session_id, frame, round({rs.norm(rs.v())} + 1e-9, 5) AS translation_m, round({rs.turn(rs.q())} + 1e-9, 3) AS rotation_deg FROM er"""


STRUCT = lambda p, name: "{" + ", ".join(f"'{c}': {p}{c}" for c in FULL) + "} AS " + name


@query(f""", {rs.PAIRS},
u1 AS (SELECT session_id, frame, t, {STRUCT('e', 'e')}, {STRUCT('m', 'm')} FROM (SELECT *, row_number() OVER (PARTITION BY session_id, t ORDER BY frame) AS copy_ FROM pairs) WHERE copy_ = 1),
w AS (SELECT *, t + 1.0 AS want FROM u1),
g AS (SELECT w.session_id, w.frame, w.t, w.want, w.e AS ea, w.m AS ma, b.t AS bt, b.e AS be, b.m AS bm, c.t AS ct, c.e AS ce, c.m AS cm FROM w ASOF LEFT JOIN u1 b ON w.session_id = b.session_id AND w.want > b.t ASOF LEFT JOIN u1 c ON w.session_id = c.session_id AND w.want <= c.t),
h AS (SELECT *, ct IS NULL OR (bt > t AND abs(bt - want) <= abs(ct - want)) AS first_ FROM g),
k AS (SELECT session_id, frame, ea, ma, CASE WHEN first_ THEN be ELSE ce END AS eb, CASE WHEN first_ THEN bm ELSE cm END AS mb FROM h WHERE abs(CASE WHEN first_ THEN bt ELSE ct END - want) <= 0.03 AND CASE WHEN first_ THEN bt ELSE ct END > t),
{_error_sql('k')}""")
def join_time_delta_errors(spark, sf_dir):
    """Errors of movement over a second: from each matched pose to that nearest a second later, within 0.03 s."""
    d = ordered.first_per_time(pose_pairs(spark, sf_dir).select("session_id", "t", "frame", "e", "m"), K, "t", "frame")
    d = asof.partner_at(d, K, "t", ["e", "m"], 1.0, max(0.011, 0.03)).filter("other IS NOT NULL")
    return _movement_errors(d, F.col("m"), F.col("other.m"), F.col("e"), F.col("other.e"))


def _movement_errors(d: DataFrame, ma, mb, ea, eb) -> DataFrame:
    d = d.withColumn("_err", ps.relative_error(ma, mb, ea, eb))
    return d.select("session_id", "frame", F.round(ps.length(F.col("_err.p")) + 1e-9, 5).alias("translation_m"), F.round(ps.turn_deg(F.col("_err.q")) + 1e-9, 3).alias("rotation_deg"))


@query(f""", {rs.PAIRS},
o AS (SELECT session_id, frame, t, {STRUCT('e', 'ea')}, {STRUCT('m', 'ma')} FROM pairs),
l AS (SELECT session_id, frame, ea, ma, lead(ea, 3) OVER w AS eb, lead(ma, 3) OVER w AS mb FROM o WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)), k AS (SELECT * FROM l WHERE eb IS NOT NULL),
{_error_sql('k')}""")
def join_index_delta_errors(spark, sf_dir):
    """Errors of movement over three matched poses."""
    d = ordered.running_sum(pose_pairs(spark, sf_dir).select("session_id", "t", "frame", "e", "m"), K, ORDER, F.lit(1).cast("long"), "i")
    other = d.select("session_id", (F.col("i") - 3).alias("i"), F.col("e").alias("e2"), F.col("m").alias("m2"))
    return _movement_errors(d.join(other, ["session_id", "i"]), F.col("m"), F.col("m2"), F.col("e"), F.col("e2"))


@query(f""", {rs.PAIRS},
s AS (SELECT session_id, frame, t, {STRUCT('e', 'eb')}, {STRUCT('m', 'mb')} FROM pairs),
f AS (SELECT session_id, arg_min(eb, (t, frame)) AS ea, arg_min(mb, (t, frame)) AS ma FROM s GROUP BY session_id), k AS (SELECT s.session_id, s.frame, ea, ma, eb, mb FROM s JOIN f USING (session_id)),
{_error_sql('k')}""")
def geo_start_relative_errors(spark, sf_dir):
    """Errors of the movement since a session's first matched pose: positions and orientations compared without a fit."""
    d = pose_pairs(spark, sf_dir).select("session_id", "t", "frame", "e", "m")
    first = d.groupBy("session_id").agg(F.min_by(F.struct("e", "m"), F.struct(*ORDER)).alias("o"))
    return _movement_errors(d.join(first, "session_id"), F.col("o.m"), F.col("m"), F.col("o.e"), F.col("e"))


LOSSES = f""", lo AS (SELECT *, {VALID_SQL} AS ok FROM p),
lc AS (SELECT *, lag(ok) OVER (PARTITION BY session_id ORDER BY t, frame) AS was FROM lo),
rec AS (SELECT session_id, frame, t FROM lc WHERE ok AND NOT was)"""


def recoveries(spark, sf_dir) -> DataFrame:
    """(session_id, frame, t): the first valid row after each loss."""
    d = poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ).withColumn("ok", is_valid())
    d = ordered.neighbours(d, K, ORDER, ["ok"])
    return d.filter(F.col("ok") & ~F.coalesce("prev.ok", F.lit(True))).select("session_id", "frame", "t")


@query(LOSSES + f""", {rs.PAIRS},
b AS (SELECT r.session_id, r.frame, r.t, b.t AS bt, c.t AS ct FROM rec r ASOF LEFT JOIN (SELECT DISTINCT session_id, t FROM pairs) b ON r.session_id = b.session_id AND r.t > b.t ASOF LEFT JOIN (SELECT DISTINCT session_id, t FROM pairs) c ON r.session_id = c.session_id AND r.t <= c.t)
SELECT session_id, frame, CASE WHEN ct IS NULL OR abs(t - bt) <= abs(ct - t) THEN bt ELSE ct END AS matched_t FROM b WHERE bt IS NOT NULL OR ct IS NOT NULL""")
def join_recovery_match(spark, sf_dir):
    """The matched pose nearest to the end of each loss, the earlier on a tie."""
    d = asof.bracket(recoveries(spark, sf_dir), pose_pairs(spark, sf_dir).select("session_id", "t"), K, "t", "t", [])
    return d.filter("lo IS NOT NULL").select("session_id", "frame", asof.nearest(F.col("t"))["t"].alias("matched_t"))


@query(LOSSES + f""", {rs.PAIRS} SELECT a.session_id, a.frame, CASE WHEN r.frame IS NOT NULL THEN 'RECOVERED_DIRECT' ELSE 'MEASURED' END AS status FROM pairs a LEFT JOIN rec r USING (session_id, frame)""")
def state_match(spark, sf_dir):
    """Whether a matched pose is the first after a loss."""
    flag = recoveries(spark, sf_dir).select("session_id", "frame", F.lit(True).alias("_r"))
    d = pose_pairs(spark, sf_dir).select("session_id", "frame").join(flag, ["session_id", "frame"], "left")
    return d.select("session_id", "frame", F.when(F.col("_r"), "RECOVERED_DIRECT").otherwise("MEASURED").alias("status"))


# ---------------------------------------------------------------- states


@query(f"""
, dt AS (SELECT session_id, median(d) AS md FROM (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, frame) AS d FROM p) GROUP BY session_id),
u AS (SELECT session_id, t, bool_or({VALID_SQL}) AS any_, count(*) AS n FROM p GROUP BY session_id, t),
w AS (SELECT p.*, {VALID_SQL} AS ok, row_number() OVER (PARTITION BY session_id, t ORDER BY frame DESC) AS back FROM p), l AS (SELECT session_id, t, ok FROM w WHERE back = 1),
f AS (SELECT session_id, t, {VALID_SQL} AS ok FROM (SELECT *, row_number() OVER (PARTITION BY session_id, t ORDER BY frame) AS k FROM p) WHERE k = 1),
g AS (SELECT m.session_id, m.frame, m.t, b.t AS bt, b.ok AS bok, c.t AS ct, c.ok AS cok FROM m ASOF LEFT JOIN l b ON m.session_id = b.session_id AND m.t > b.t ASOF LEFT JOIN f c ON m.session_id = c.session_id AND m.t <= c.t),
h AS (SELECT *, ct IS NULL OR coalesce(abs(bt - t) < abs(ct - t), false) AS earlier FROM g WHERE bt IS NOT NULL OR ct IS NOT NULL)
SELECT session_id, h.frame, CASE WHEN abs(CASE WHEN earlier THEN bt ELSE ct END - h.t) <= greatest(0.012, 0.55 * coalesce(md, 0.02)) AND CASE WHEN earlier THEN bok ELSE cok END THEN 'VISUAL MEASURED' ELSE 'INTERPOLATED' END AS state FROM h JOIN dt USING (session_id)""")
def state_render(spark, sf_dir):
    """Whether what is shown at each frame of the motion capture was measured: the nearest processed row, the later on a tie, is near and valid."""
    frames = cut_lineage(poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ).select("session_id", "t", "frame", is_valid().alias("ok")))
    dt = tr.nominal_step(frames, K, ORDER).drop("n")
    d = asof.bracket(mocap(spark, sf_dir).select("session_id", "frame", "t"), frames, K, "t", "t", ["frame", "ok"]).filter("lo IS NOT NULL")
    near = asof.nearest(F.col("t"), later_on_tie=True)
    d = d.select("session_id", "frame", "t", near.alias("near")).join(dt, "session_id", "left")
    close = F.abs(F.col("near.t") - F.col("t")) <= F.greatest(F.lit(0.012), 0.55 * F.coalesce("median_dt", F.lit(0.02)))
    return d.select("session_id", "frame", F.when(close & F.col("near.ok"), "VISUAL MEASURED").otherwise("INTERPOLATED").alias("state"))


@query("""
, g AS (SELECT m.session_id, m.frame, m.t, b.t AS bt, c.t AS ct FROM m ASOF LEFT JOIN v b ON m.session_id = b.session_id AND m.t >= b.t ASOF LEFT JOIN v c ON m.session_id = c.session_id AND m.t <= c.t)
SELECT session_id, frame, CASE WHEN least(t - bt, ct - t) <= 0.075 THEN 'visual_anchor' ELSE 'interpolated' END AS status FROM g""")
def state_fusion(spark, sf_dir):
    """Whether a valid pose lies within 0.075 s of each frame of the motion capture."""
    d = asof.bracket(mocap(spark, sf_dir).select("session_id", "frame", "t"), valid(spark, sf_dir).select("session_id", "t"), K, "t", "t", [])
    age = F.least(F.abs(F.col("t") - F.col("lo.t")), F.abs(F.col("hi.t") - F.col("t")))
    return d.select("session_id", "frame", F.when(age <= 0.075, "visual_anchor").otherwise("interpolated").alias("status"))


@query(f""", {rs.PAIRS},
d AS (SELECT p.session_id, p.frame, p.t, coalesce({VALID_SQL} AND tags >= 4 AND p.source IN ('', 'direct') AND q.frame IS NOT NULL, false) AS direct FROM p LEFT JOIN (SELECT session_id, frame FROM pairs) q USING (session_id, frame)),
s AS (SELECT d.session_id, d.frame, d.t, d.direct, coalesce(least(d.t - b.t, c.t - d.t) <= 0.5, false) AS visible, lag(direct) OVER (PARTITION BY d.session_id ORDER BY d.t, d.frame) AS was
      FROM d ASOF LEFT JOIN v b ON d.session_id = b.session_id AND d.t >= b.t ASOF LEFT JOIN v c ON d.session_id = c.session_id AND d.t <= c.t)
SELECT session_id, frame, CASE WHEN direct AND was = false THEN 'RECOVERED' WHEN direct THEN 'MEASURED' WHEN visible THEN 'PREDICTED' ELSE 'LOST' END AS state FROM s""")
def state_overlay(spark, sf_dir):
    """What a comparison shows at each processed frame: measured directly and matched, and recovered where the frame before was not; predicted near a valid row; lost."""
    matched = pose_pairs(spark, sf_dir).select("session_id", "frame", F.lit(True).alias("_m"))
    d = poses(spark, sf_dir).select("session_id", "t", "frame", "status", "tags", "source", *XYZ).join(matched, ["session_id", "frame"], "left")
    direct = F.coalesce(is_valid() & (F.col("tags") >= 4) & F.col("source").isin("", "direct") & F.col("_m"), F.lit(False))
    d = tr.visible(d.withColumn("direct", direct), K, ORDER, is_valid(), 0.5)
    d = ordered.neighbours(d.select("session_id", "t", "frame", "direct", "visible"), K, ORDER, ["direct"])
    state = F.when(F.col("direct") & ~F.coalesce("prev.direct", F.lit(True)), "RECOVERED").when(F.col("direct"), "MEASURED").when(F.col("visible"), "PREDICTED").otherwise("LOST")
    return d.select("session_id", "frame", state.alias("state"))


@query("""
, c AS (SELECT session_id, greatest(0, least(5.0, total_frames / fps)) AS a, total_frames / fps AS long FROM sessions WHERE fps > 0 AND total_frames IS NOT NULL)
SELECT p.session_id, p.frame, p.t FROM p JOIN c USING (session_id) WHERE t >= a AND t < a + least(30.0, long - a)""")
def flt_render_clip(spark, sf_dir):
    """Frames of a clip from 5 s on, 30 s long, both held within the recording."""
    c = sessions(spark, sf_dir).filter((F.col("fps") > 0) & F.col("total_frames").isNotNull()).select("session_id", (F.col("total_frames") / F.col("fps")).alias("long"))
    c = c.withColumn("a", F.greatest(F.lit(0.0), F.least(F.lit(5.0), "long"))).withColumn("b", F.col("a") + F.least(F.lit(30.0), F.col("long") - F.col("a")))
    return poses(spark, sf_dir).select("session_id", "frame", "t").join(c, "session_id").filter((F.col("t") >= F.col("a")) & (F.col("t") < F.col("b"))).select("session_id", "frame", "t")


# ---------------------------------------------------------------- movement with orientation

TURNS = f"""
, g AS (SELECT session_id, frame, t, t - lag(t) OVER w AS dt, {rs.norm(tuple(f"({a} - lag({a}) OVER w)" for a in "xyz"))} AS d, {STRUCT('', 'o')}, lag({STRUCT('', 'o')[:-5]}) OVER w AS b FROM vq WINDOW w AS (PARTITION BY session_id ORDER BY t, frame)),
k AS (SELECT *, {rs.turn(rs.multiply(rs.inverse(rs.q('b.')), rs.q('o.')))} AS turned FROM g WHERE dt > 0)
"""


def turned(spark, sf_dir) -> DataFrame:
    """Valid poses with step time ``dt``, way ``d`` and turn ``turned`` (degrees) from the pose before."""
    d = ordered.neighbours(valid_poses(spark, sf_dir).select("session_id", "t", "frame", *FULL), K, ORDER, ["t", *FULL])
    q = lambda s: rot.quaternion(*(F.col(f"{s}q{c}") for c in "xyzw"))
    d = d.withColumn("dt", F.col("t") - F.col("prev.t")).filter("dt > 0")
    return d.withColumns({"d": tr.moved(XYZ), "turned": rot.angle_deg(q("prev."), q(""))})


@query(TURNS + "SELECT session_id, frame, round(d / dt, 5) AS speed, round(turned / dt + 1e-9, 3) AS turn_rate FROM k")
def ord_turn_rates(spark, sf_dir):
    """Linear and angular speed from the pose before."""
    return turned(spark, sf_dir).select("session_id", "frame", F.round(F.col("d") / F.col("dt"), 5).alias("speed"), F.round(F.col("turned") / F.col("dt") + 1e-9, 3).alias("turn_rate"))


@query(TURNS + "SELECT session_id, frame, round(t - dt / 2 + 1e-9, 6) AS mid_t, round(d / dt, 5) AS speed, round(turned / dt + 1e-9, 3) AS turn_rate FROM k WHERE dt <= 0.5")
def ord_midpoint_turn_rates(spark, sf_dir):
    """The same over steps of at most half a second, at their middle."""
    d = turned(spark, sf_dir).filter("dt <= 0.5")
    return d.select("session_id", "frame", F.round(F.col("t") - F.col("dt") / 2 + 1e-9, 6).alias("mid_t"), F.round(F.col("d") / F.col("dt"), 5).alias("speed"), F.round(F.col("turned") / F.col("dt") + 1e-9, 3).alias("turn_rate"))


@query(f"""
, f AS (SELECT session_id, arg_min({STRUCT('', 'o')[:-5]}, (t, frame)) AS o FROM vq GROUP BY session_id),
s AS (SELECT vq.session_id, vq.frame, {rs.named(rs.rotate(rs.inverse(rs.q('o.')), rs.minus(rs.v('vq.'), rs.v('o.'))), 'sx', 'sy', 'sz')}, {rs.named(rs.minus(rs.v('vq.'), rs.v('o.')), 'rx', 'ry', 'rz')}, {rs.named(rs.multiply(rs.inverse(rs.q('o.')), rs.q('vq.')), 'tqx', 'tqy', 'tqz', 'tqw')} FROM vq JOIN f USING (session_id))
SELECT session_id, frame, {", ".join(f"round({c} + 1e-9, 5) AS {c}" for c in ("sx", "sy", "sz", "rx", "ry", "rz"))}, {rs.entries(rs.q('t'), *ENTRIES)} FROM s""")
def ord_start_pose(spark, sf_dir):
    """Poses against a session's first: turned into its frame (s), only moved there (r), and the relative orientation."""
    d = valid_poses(spark, sf_dir).select("session_id", "t", "frame", ps.from_columns().alias("p"))
    first = d.groupBy("session_id").agg(F.min_by("p", F.struct(*ORDER)).alias("o"))
    d = d.join(first, "session_id").withColumn("s", ps.relative(F.col("o"), F.col("p"))).withColumn("r", ps.difference(F.col("p.p"), F.col("o.p")))
    return d.select("session_id", "frame", *[F.round(F.col(f"{k}{n}.{a}") + 1e-9, 5).alias(f"{k}{a}") for k, n in (("s", ".p"), ("r", "")) for a in XYZ], *ps.entries(F.col("s.q"), *ENTRIES))


@query(f"""
, n AS (SELECT session_id, frame, qx/l AS qx, qy/l AS qy, qz/l AS qz, qw/l AS qw FROM (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS l FROM imu_perframe) WHERE l > 1e-12),
f AS (SELECT session_id, arg_min({{'qx': qx, 'qy': qy, 'qz': qz, 'qw': qw}}, frame) AS o FROM n GROUP BY session_id)
SELECT n.session_id, n.frame, {rs.entries(rs.multiply(rs.inverse(rs.q('o.')), rs.q('n.')), 'r11', 'r12', 'r13', 'r21', 'r23', 'r33')} FROM n JOIN f USING (session_id)""")
def ord_imu_start_orientation(spark, sf_dir):
    """Each inertial orientation as seen from the session's first."""
    d = imu_orientations(spark, sf_dir)
    first = d.groupBy("session_id").agg(F.min_by("q", "frame").alias("o"))
    d = d.join(first, "session_id").withColumn("r", rot.multiply(rot.inverse(F.col("o")), F.col("q")))
    return d.select("session_id", "frame", *ps.entries(F.col("r"), "r11", "r12", "r13", "r21", "r23", "r33"))


def imu_orientations(spark, sf_dir) -> DataFrame:
    d = read_table(spark, sf_dir, "imu_perframe").select("session_id", "frame", rot.normalised(rot.quaternion(*(F.col(f"q{c}") for c in "xyzw"))).alias("q"))
    return d.filter("q IS NOT NULL")


@query("""
, g AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY session_id ORDER BY t, frame) <= 0.25, false)::INT AS near FROM v),
h AS (SELECT session_id, t, frame, count(*) OVER w AS n_recent, sum(near) OVER w AS n_near FROM g WINDOW w AS (PARTITION BY session_id ORDER BY t RANGE BETWEEN 2.0 PRECEDING AND CURRENT ROW))
SELECT session_id, t, max(n_recent) AS n_recent, max(n_near) AS n_near FROM h GROUP BY session_id, t""")
def ord_trail(spark, sf_dir):
    """Per time of a valid row: the rows of the two seconds up to it, and how many of them go on from the row before without a break of more than 0.25 s."""
    d = ordered.neighbours(valid(spark, sf_dir).select("session_id", "t", "frame"), K, ORDER, ["t"])
    d = d.select("session_id", "t", F.coalesce(F.col("t") - F.col("prev.t") <= 0.25, F.lit(False)).cast("long").alias("near"))
    d = d.groupBy("session_id", "t").agg(F.count(F.lit(1)).alias("n"), F.sum("near").alias("near")).withColumn("_block", F.floor(F.col("t") / 600.0))
    tail = d.filter(F.col("t") >= (F.col("_block") + 1) * 600.0 - 2.0 - 1e-9).withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    over = "OVER (PARTITION BY session_id, _block ORDER BY t RANGE BETWEEN 2.0D PRECEDING AND CURRENT ROW)"
    both = d.withColumn("_own", F.lit(True)).unionByName(tail)
    return both.withColumns({"n_recent": F.expr(f"sum(n) {over}"), "n_near": F.expr(f"sum(near) {over}")}).filter("_own").select("session_id", "t", "n_recent", "n_near")


# ---------------------------------------------------------------- geometry


@query(f"""
, s AS (SELECT session_id, frame, {rs.named(rs.rotate(rs.q(), _text(LEVER)), 'ax', 'ay', 'az')}, x, y, z, {rs.named(rs.multiply(rs.q(), _text(LEVER_Q)), 'tqx', 'tqy', 'tqz', 'tqw')} FROM vq),
e AS (SELECT session_id, frame, x + ax AS x, y + ay AS y, z + az AS z, {rs.matrix(rs.q('t'))[2][1]} AS m32, {rs.matrix(rs.q('t'))[2][2]} AS m33, {rs.matrix(rs.q('t'))[2][0]} AS m31, {rs.matrix(rs.q('t'))[1][0]} AS m21, {rs.matrix(rs.q('t'))[0][0]} AS m11, {rs.matrix(rs.q('t'))[1][2]} AS m23, {rs.matrix(rs.q('t'))[1][1]} AS m22 FROM s),
g AS (SELECT *, sqrt(m11*m11 + m21*m21) AS size_ FROM e)
SELECT session_id, frame, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(degrees(CASE WHEN size_ < 1e-8 THEN atan2(-m23, m22) ELSE atan2(m32, m33) END), 4) AS roll, round(degrees(atan2(-m31, size_)), 4) AS pitch, round(degrees(CASE WHEN size_ < 1e-8 THEN 0 ELSE atan2(m21, m11) END), 4) AS yaw FROM g""")
def geo_gripper(spark, sf_dir):
    """The pose of a gripper fixed to the camera: the camera's pose, then the fixed arm, as position and Euler angles."""
    arm = ps.pose(rot.vector(*(F.lit(v) for v in LEVER)), rot.quaternion(*(F.lit(v) for v in LEVER_Q)))
    d = valid_poses(spark, sf_dir).withColumn("g", ps.compose(ps.from_columns(), arm))
    roll, pitch, yaw = rot.to_euler(F.col("g.q"))
    return d.select("session_id", "frame", *[F.round(f"g.p.{a}", 6).alias(a) for a in XYZ], *[F.round(c, 4).alias(n) for n, c in zip(RPY, (roll, pitch, yaw))])


@query(f"""
, i AS (SELECT session_id, frame, {rs.named(rs.inverse(rs.q()), 'iqx', 'iqy', 'iqz', 'iqw')}, -x AS nx, -y AS ny, -z AS nz FROM vq)
SELECT session_id, frame, {", ".join(f"round({e} + 1e-9, 5) AS {n}" for e, n in zip(rs.rotate(rs.q('i'), ('nx', 'ny', 'nz')), 'xyz'))}, {rs.entries(rs.q('i'), *ENTRIES)} FROM i""")
def geo_inverse_pose(spark, sf_dir):
    """The board as seen from the camera."""
    d = valid_poses(spark, sf_dir).withColumn("i", ps.invert(ps.from_columns()))
    return d.select("session_id", "frame", *[F.round(F.col(f"i.p.{a}") + 1e-9, 5).alias(a) for a in XYZ], *ps.entries(F.col("i.q"), *ENTRIES))


def _axis(axis: int, degrees: str) -> tuple[str, ...]:
    """SQL quaternion of a turn about one axis."""
    return tuple(f"sin(radians({degrees})/2)" if k == axis else f"cos(radians({degrees})/2)" if k == 3 else "0" for k in range(4))


@query(f"""
, d AS (SELECT session_id, frame, x, y, z, qx, qy, qz, qw, (split_part(view, '-', 2))::DOUBLE AS vyaw FROM vq WHERE regexp_full_match(view, 'h-[0-9]+')),
w AS (SELECT session_id, frame, x, y, z, qx, qy, qz, qw, {rs.named(rs.multiply(_axis(1, 'vyaw'), _axis(0, '10.0')), 'vqx', 'vqy', 'vqz', 'vqw')} FROM d),
p2 AS (SELECT session_id, frame, {rs.named(rs.rotate(rs.q('v'), rs.v()), 'ox', 'oy', 'oz')}, {rs.named(rs.multiply(rs.q('v'), rs.q()), 'bqx', 'bqy', 'bqz', 'bqw')} FROM w)
SELECT session_id, frame, {", ".join(f"round(-{e} + 1e-9, 5) AS {n}" for e, n in zip(rs.rotate(rs.inverse(rs.q('b')), rs.v('o')), 'xyz'))}, {rs.entries(rs.inverse(rs.q('b')), *ENTRIES)} FROM p2""")
def geo_camera_from_view(spark, sf_dir):
    """The camera's pose on the board from the board's pose in a view ten degrees up and turned as the view's name says."""
    d = valid(spark, sf_dir).dropna(subset=RPY).filter(F.col("view").rlike("^h-[0-9]+$")).withColumn("q", rot.from_euler(*(F.col(a) for a in RPY)))
    turn = views.view_rotation(F.split_part("view", F.lit("-"), F.lit(2)).cast("double"), F.lit(10.0), F.lit(0.0))
    d = d.withColumn("c", views.camera_in_board(ps.pose(rot.vector(*(F.col(a) for a in XYZ)), F.col("q")), turn))
    return d.select("session_id", "frame", *[F.round(F.col(f"c.p.{a}") + 1e-9, 5).alias(a) for a in XYZ], *ps.entries(F.col("c.q"), *ENTRIES))


BQ = tuple(f"({c})" for c in views.BODY_TO_PANORAMA)


@query(f"""
, n AS (SELECT session_id, frame, {{'qx': qx/l, 'qy': qy/l, 'qz': qz/l, 'qw': qw/l}} AS o FROM (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS l FROM imu_perframe) WHERE l > 1e-12),
f AS (SELECT session_id, arg_min(o, frame) AS f FROM n GROUP BY session_id),
d AS (SELECT n.session_id, n.frame, {rs.named(rs.multiply(rs.inverse(rs.q('o.')), rs.q('f.f.')), 'dqx', 'dqy', 'dqz', 'dqw')} FROM n JOIN f USING (session_id)),
b AS (SELECT session_id, frame, {rs.named(rs.multiply(rs.multiply(BQ, rs.q('d')), rs.inverse(BQ)), 'bqx', 'bqy', 'bqz', 'bqw')} FROM d),
w AS (SELECT session_id, frame, {rs.named(rs.multiply(rs.q('b'), rs.multiply(rs.multiply(_axis(1, '30.0'), _axis(0, '10.0')), _axis(2, '0.0'))), 'wqx', 'wqy', 'wqz', 'wqw')} FROM b),
e AS (SELECT session_id, frame, {rs.matrix(rs.q('w'))[1][2]} AS m23, {rs.matrix(rs.q('w'))[0][2]} AS m13, {rs.matrix(rs.q('w'))[2][2]} AS m33, {rs.matrix(rs.q('w'))[1][0]} AS m21, {rs.matrix(rs.q('w'))[1][1]} AS m22 FROM w)
SELECT session_id, frame, round(sin(atan2(m13, m33)) + 1e-9, 4) AS yaw_sin, round(greatest(-85, least(85, degrees(asin(greatest(-1.0, least(1.0, -m23)))))) + 1e-9, 3) AS pitch, round(sin(atan2(m21, m22)) + 1e-9, 4) AS roll_sin FROM e""")
def geo_view_propagation(spark, sf_dir):
    """Where a view at 30 degrees right and 10 up must look after the body turned since the session's first inertial orientation."""
    d = imu_orientations(spark, sf_dir)
    first = d.groupBy("session_id").agg(F.min_by("q", "frame").alias("o"))
    d = d.join(first, "session_id").withColumn("v", views.propagated_view(F.lit(30.0), F.lit(10.0), F.lit(0.0), F.col("o"), F.col("q")))
    sine = lambda c: F.round(F.sin(F.radians(c)) + 1e-9, 4)
    return d.select("session_id", "frame", sine("v.yaw").alias("yaw_sin"), F.round(F.col("v.pitch") + 1e-9, 3).alias("pitch"), sine("v.roll").alias("roll_sin"))


@query("""
WITH c AS (SELECT board, center_m[1] * 400 + 300 AS px, center_m[2] * 400 + 350 AS py FROM tag_map), g AS (SELECT board, avg(px) AS mx, avg(py) AS my, greatest(max(px) - min(px), max(py) - min(py)) AS span, 640 / (2 * tan(radians(90.0) / 2)) AS focal FROM c GROUP BY board)
SELECT board, round((20 + degrees(atan2(mx - 320, focal)) + 180) - 360 * floor((20 + degrees(atan2(mx - 320, focal)) + 180) / 360) - 180, 4) AS yaw, round(greatest(-85, least(85, 5 - degrees(atan2(my - 320, focal)))), 4) AS pitch, round(greatest(70, least(100, 1.8 * degrees(2 * atan2(span / 2, focal)))), 4) AS fov FROM g""", base=False)
def geo_view_recentred(spark, sf_dir):
    """A view moved onto the tags of a board, seen at 400 pixels a metre, its width held between 70 and 100 degrees."""
    px = lambda i, off: F.get("center_m", F.lit(i)) * 400 + off
    d = read_table(spark, sf_dir, "tag_map").select("board", px(0, 300).alias("px"), px(1, 350).alias("py")).groupBy("board")
    d = d.agg(F.avg("px").alias("mx"), F.avg("py").alias("my"), F.greatest(F.max("px") - F.min("px"), F.max("py") - F.min("py")).alias("span"))
    v = views.recentred_view(F.lit(20.0), F.lit(5.0), F.lit(90.0), F.lit(640.0), F.col("mx"), F.col("my"), F.col("span"))
    return d.withColumn("v", v).select("board", *[F.round(f"v.{c}", 4).alias(c) for c in ("yaw", "pitch", "fov")])


@query("""
WITH g AS (SELECT i // 8 AS "row", i % 8 AS col, i AS k FROM (SELECT unnest(range(64)) AS i))
SELECT 64 + k AS id, "row", col, round(50 + col * 180 + 70 - 750.0, 6) AS x_mm, round(750.0 - (50 + "row" * 180) - 70, 6) AS y_mm FROM g""", base=False)
def geo_panel_layout(spark, sf_dir):
    """A printed panel of 8 x 8 tags of 140 mm, 40 mm apart, on 1,500 mm: centres from the panel's middle, ids from 64."""
    from posegrain.functions.boards import panel_layout

    return panel_layout(spark, 64, 8, 140.0, 40.0, 1500.0)


@query("SELECT session_id, frame, round((x - y) * 0.88 + 1e-9, 6) AS u, round(-(z - 0.55) + (x + y) * 0.22 + 1e-9, 6) AS w FROM v")
def geo_projection(spark, sf_dir):
    """Positions on a drawing plane that shows depth, before scaling."""
    from posegrain.functions.boards import drawn

    u, w = drawn(*(F.col(a) for a in XYZ))
    return valid(spark, sf_dir).select("session_id", "frame", F.round(u + 1e-9, 6).alias("u"), F.round(w + 1e-9, 6).alias("w"))


@query("SELECT pose_id, session_id, frame FROM pose ORDER BY pose_id DESC LIMIT 12", base=False)
def sel_last_arrivals(spark, sf_dir):
    """The last twelve rows to arrive, the number being the feature."""
    return read_table(spark, sf_dir, "pose").select("pose_id", "session_id", "frame").orderBy(F.desc("pose_id")).limit(12)


PROBES = [
    ("A.OSV", "", [3000, 3000], [3000, 3000]), ("b.insv", "dji", [], []), ("c.mp4", "Insta360 X6", [1920], [1080]), ("cam_Osmo.mp4", "", [1920], [1080]), ("d.mp4", "maker dji", [5760], [2880]),
    ("e.mp4", "", [2880, 2880], [2880, 2880]), ("f.mp4", "", [5760], [2880]), ("g.mp4", "", [1920], [1080]), ("VID_1.mp4", "", [7680], [3840]), ("h.lrv", "osmo", [], []), ("i.mp4", "", [], []), ("j.mp4", "", [3840], [1920]),
]
PROBES_SQL = ", ".join(f"('{n}', '{t}', {w or '[]'}, {h or '[]'})" for n, t, w, h in PROBES)


@query(f"""
WITH p AS (SELECT * FROM (VALUES {PROBES_SQL}) AS t(name, text, w, h)), l AS (SELECT *, lower(name) AS low, lower(text) || ' ' || lower(name) AS txt FROM p),
c AS (SELECT *, CASE WHEN low LIKE '%.osv' THEN 'dji' WHEN low LIKE '%.insv' OR low LIKE '%.lrv' THEN 'insta360' WHEN txt LIKE '%insta%' THEN 'insta360' WHEN txt LIKE '%dji%' OR txt LIKE '%osmo%' THEN 'dji' WHEN len(w) >= 2 AND w[1] = h[1] AND w[2] = h[2] THEN 'dji' WHEN h[1] > 0 AND w[1] = 2 * h[1] THEN 'panorama' ELSE 'unknown' END AS class,
  CASE WHEN low LIKE '%insta360%' OR low LIKE '%\\_no\\_flowstate%' ESCAPE '\\' OR (low LIKE 'vid\\_%' ESCAPE '\\' AND w[1] >= 6000) THEN 'insta360-x6' WHEN low LIKE '%osmo%' OR low LIKE 'cam\\_%' ESCAPE '\\' OR low LIKE '%.osv' THEN 'dji-osmo-360' WHEN w[1] >= 7000 AND w[1] = 2 * h[1] THEN 'insta360-x6' WHEN w[1] <= 4096 AND w[1] = 2 * h[1] THEN 'dji-osmo-360' ELSE 'generic' END AS model FROM l)
SELECT name, class, model, 'cpu' AS decoder, CASE WHEN model = 'dji-osmo-360' AND w[1] <= 4096 THEN 'cpu' ELSE 'cuda' END AS projection FROM c""", base=False)
def src_probe_class(spark, sf_dir):
    """Class, processing model, decoder and projection of recordings from what a probe says of them; the probes are given, as reading media is no work for a table engine."""
    d = spark.createDataFrame(PROBES, "name string, text string, w array<int>, h array<int>")
    width, height, auto = F.get("w", F.lit(0)), F.get("h", F.lit(0)), F.lit("auto")
    d = d.select("name", "w", views.camera_class(F.col("name"), F.col("text"), F.col("w"), F.col("h")).alias("class"), views.camera_model(F.col("name"), width, height).alias("model"))
    return d.select("name", "class", "model", views.decoder(auto).alias("decoder"), views.projection(auto, F.col("model"), width).alias("projection"))
