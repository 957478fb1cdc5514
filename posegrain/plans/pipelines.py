"""Whole evaluations built from the operators, and the control of staged runs."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrain.functions import poses
from posegrain.functions import rotations as rot
from posegrain.functions.angles import within
from posegrain.operators import asof, ordered, sync
from posegrain.operators import trajectory as tr
from posegrain.operators.aggregates import block_bootstrap, error_stats, join_null_safe
from posegrain.operators.alignment import apply_rigid, fit_poses, fit_rigid
from posegrain.operators.hand_eye import hand_eye_by_group
from posegrain.session import written, read_table

XYZ = ["x", "y", "z"]
POSE = [*XYZ, "qx", "qy", "qz", "qw"]


def _unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per time: the smallest of its positions."""
    rest = [c for c in df.columns if c not in (*keys, "t", *POSE)]
    first = df.groupBy(*keys, "t").agg(F.min(F.struct(*POSE, *rest)).alias("_r"))
    return first.select(*keys, "t", *[F.col(f"_r.{c}").alias(c) for c in (*POSE, *rest)])


def match(visual: DataFrame, truth: DataFrame, keys: list[str], offsets: DataFrame, max_gap: float | None) -> DataFrame:
    """Visual rows with the truth at their shifted times: adds ``e`` and ``m`` (poses), ``truth_t``, and the columns of ``offsets``; without the pose's columns."""
    shifted = join_null_safe(visual, offsets.drop("n"), keys).withColumn("truth_t", F.col("t") + F.col("offset_s"))
    found = asof.bracket(shifted, truth, keys, "truth_t", "t", POSE)
    at = F.col("truth_t")
    return found.filter(asof.covered(at, max_gap)).withColumns({"e": poses.from_columns(), "m": poses.at_time(at)}).drop("lo", "hi", *POSE)


def _prefixed(stats: DataFrame, keys: list[str], prefix: str, *names: str) -> DataFrame:
    return stats.select(*keys, *[F.col(n).alias(f"{prefix}_{n}") for n in names])


def _ends(d: DataFrame, keys: list[str], found: Column, true: Column) -> DataFrame:
    """(``keys``, path_m, drift_m, drift_percent): the true way, and how far the found displacement from first to last is off."""
    flat = d.select(*keys, "t", *[found[a].alias(f"f{a}") for a in XYZ], *[true[a].alias(a) for a in XYZ])
    way = tr.path_lengths(flat, keys, ["t", *XYZ], XYZ).select(*keys, "path_m")
    place = F.struct("t", *XYZ)
    off = sum(F.pow(F.max_by(F.col(f"f{a}") - F.col(a), place) - F.min_by(F.col(f"f{a}") - F.col(a), place), F.lit(2.0)) for a in XYZ)
    ends = flat.groupBy(*keys).agg(F.sqrt(off).alias("drift_m"))
    return join_null_safe(way, ends, keys).withColumn("drift_percent", F.when(F.col("path_m") > 0, 100 * F.col("drift_m") / F.col("path_m")).otherwise(0.0))


def _split(matched: DataFrame, keys: list[str], calibration: float) -> DataFrame:
    """Adds ``split``: calibration up to that share of the time matched, else test."""
    span = matched.groupBy(*keys).agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    d = join_null_safe(matched, span, keys)
    return d.withColumn("split", F.when(F.col("t") <= F.col("_a") + calibration * (F.col("_b") - F.col("_a")), "calibration").otherwise("test")).drop("_a", "_b")


def evaluate(visual: DataFrame, truth: DataFrame, keys: list[str], radius: float = 1.0, max_gap: float = 0.05, calibration: float = 0.3, least: int = 100, rpe_s: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Score tracks of poses against a truth with its own clock, frame and tracked body.

    ``visual``: keys, t, frame, x … qw, source, and on wish recovered (boolean); ``truth``: keys, t, x … qw. The time offset is found from both
    channels of movement; the first ``calibration`` of the time both cover gives the fixed transforms by hand-eye calibration,
    and only the rest is scored. Returns the matched rows with ``split``, ``status``, ``position_error_m``, ``orientation_error_deg`` and the poses ``truth``
    and ``estimate``, and per group the statistics of the test part with a verdict: FORMAL_ACCURACY needs no optical
    flow, a correlation of 0.8, an offset sure to 20 ms and 200 test rows; else DIAGNOSTIC_ONLY with the reasons. Groups without an offset or with
    fewer than twenty calibration rows have no rows.
    """
    if "recovered" not in visual.columns:
        visual = visual.withColumn("recovered", F.lit(False))
    visual, truth = written(_unique(visual, keys)), written(_unique(truth, keys))
    offsets = sync.find_offset_to_truth(visual, truth, keys, radius, max_gap=max_gap, least=least)
    matched = written(_split(match(visual, truth, keys, written(offsets), max_gap), keys, calibration))
    flat = matched.filter("split = 'calibration'").select(*keys, "t", "frame", *[F.col(f"m.p.{a}").alias(a) for a in XYZ], *[F.col(f"m.q.{c}").alias(f"q{c}") for c in "xyzw"], *[F.col(f"e.p.{a}").alias(f"m_{a}") for a in XYZ], *[F.col(f"e.q.{c}").alias(f"m_q{c}") for c in "xyzw"])
    fixed = hand_eye_by_group(flat, keys, ["t", "frame"])
    part = lambda z: poses.pose(rot.vector(*(F.col(f"{z}t{a}") for a in XYZ)), rot.quaternion(*(F.col(f"{z}q{c}") for c in "xyzw")))
    matched = join_null_safe(matched, fixed.select(*keys, part("").alias("_x"), part("z").alias("_z")), keys)
    matched = matched.withColumns({"truth": poses.compose(F.col("m"), F.col("_x")), "estimate": poses.compose(F.col("_z"), F.col("e"))}).drop("_x", "_z", "m", "e")
    matched = matched.withColumns({
        "position_error_m": poses.length(poses.difference(F.col("estimate.p"), F.col("truth.p"))), "orientation_error_deg": rot.angle_deg(F.col("truth.q"), F.col("estimate.q")),
        "status": F.when(F.col("recovered"), "RECOVERED_DIRECT").otherwise("MEASURED"),
    })
    matched = written(matched)
    test = matched.filter("split = 'test'")
    d = error_stats(test, keys, "position_error_m")
    d = join_null_safe(d, _prefixed(error_stats(test, keys, "orientation_error_deg"), keys, "orientation", "rmse", "p95"), keys)
    d = join_null_safe(d, block_bootstrap(test.select(*keys, "t", "position_error_m"), keys, "t", "position_error_m").select(*keys, "low", "high"), keys)
    moves = asof.partner_at(test.select(*keys, "t", "truth", "estimate"), keys, "t", ["truth", "estimate"], rpe_s, max(0.011, 0.03 * rpe_s)).filter("other IS NOT NULL")
    moves = moves.withColumn("_err", poses.relative_error(F.col("truth"), F.col("other.truth"), F.col("estimate"), F.col("other.estimate")))
    moves = written(moves.select(*keys, poses.length(F.col("_err.p")).alias("m"), poses.turn_deg(F.col("_err.q")).alias("deg")))
    d = join_null_safe(d, _prefixed(error_stats(moves, keys, "m"), keys, "rpe_m", "n", "rmse"), keys, "left")
    d = join_null_safe(d, _prefixed(error_stats(moves, keys, "deg"), keys, "rpe_deg", "rmse"), keys, "left")
    d = join_null_safe(d, _prefixed(error_stats(test.filter("recovered"), keys, "position_error_m"), keys, "recovery", "n", "rmse"), keys, "left")
    d = join_null_safe(d, _ends(test, keys, F.col("estimate.p"), F.col("truth.p")), keys)
    facts = matched.groupBy(*keys).agg(F.max("offset_s").alias("offset_s"), F.max("score").alias("score"), F.max("uncertainty_s").alias("uncertainty_s"), F.max((F.col("source") == "optical_flow").cast("int")).alias("_flow"))
    d = join_null_safe(d, facts, keys)
    return matched, formal_gate(d)


def formal_gate(d: DataFrame) -> DataFrame:
    """Adds ``verdict`` and ``reasons`` from ``_flow`` (0 or 1), ``score``, ``uncertainty_s`` and ``n``, and takes ``_flow`` out."""
    reasons = F.array(
        F.when(F.col("_flow") == 1, "uses_flow"), F.when(~F.coalesce(F.col("score") >= 0.8, F.lit(False)), "weak_correlation"),
        F.when(~F.coalesce(within(F.col("uncertainty_s"), 0.02), F.lit(False)), "unsure_offset"), F.when(F.col("n") < 200, "few_test_rows"),
    )
    d = d.withColumn("_reasons", F.filter(reasons, lambda r: r.isNotNull()))
    verdict = F.when(F.size("_reasons") == 0, "FORMAL_ACCURACY").otherwise("DIAGNOSTIC_ONLY")
    return d.withColumn("verdict", verdict).withColumn("reasons", F.array_join("_reasons", " ")).drop("_reasons", "_flow")


def align_pair(
    left: DataFrame, right: DataFrame, keys: list[str], radius: float = 3.0, max_gap: float = 0.1, least: int = 30, worst_m: float = 0.05, worst_deg: float = 5.0, model: str = "world",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bring the right of two rigs into the time and frame of the left.

    Both: keys, t, x … qw, direct (boolean). Offsets from movement over 0.2 s, ``right = left + offset``; right poses at left times, where their samples are
    at most ``max_gap`` apart. The fit rests on rows direct on both sides if there are ``least``, else on all. Returns the aligned rows (``position_error_m``,
    ``orientation_error_deg``), per pair the statistics with PASS or REVIEW and the checks failed, and the curve of the search.
    """
    left, right = written(_unique(left, keys)), written(_unique(right, keys))
    curve = written(sync.pair_offset_scores(left, right, keys, radius))
    offsets = written(sync.find_pair_offset(left, right, keys, radius))
    matched = match(left, right.withColumn("d", F.col("direct")), keys, offsets, max_gap)
    near = asof.bracket(matched.select(*keys, "t", "truth_t"), right.select(*keys, "t", "direct"), keys, "truth_t", "t", ["direct"])
    near = near.select(*keys, "t", asof.nearest(F.col("truth_t"))["direct"].alias("_right"))
    matched = written(join_null_safe(matched, near, [*keys, "t"]).withColumn("_both", F.coalesce(F.col("direct") & F.col("_right"), F.lit(False))).drop("_right"))
    source = matched.groupBy(*keys).agg(F.when(F.sum(F.col("_both").cast("long")) >= least, "both_direct").otherwise("all_valid").alias("fit_source"))
    matched = join_null_safe(matched, source, keys)
    fit, aligned = fit_poses(matched, keys, "e", "m", (F.col("fit_source") == "all_valid") | F.col("_both"), model)
    d = _prefixed(error_stats(aligned, keys, "position_error_m"), keys, "position", "rmse", "median", "p95", "max")
    d = join_null_safe(d, _prefixed(error_stats(aligned, keys, "orientation_error_deg"), keys, "orientation", "rmse", "median", "p95", "max"), keys)
    facts = aligned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("inlier").cast("long")).alias("n_inliers"), *[F.max(c).alias(c) for c in ("score", "uncertainty_s", "offset_s", "fit_source")])
    d = join_null_safe(d, facts, keys)
    checks = {
        "weak_correlation": F.col("score") >= 0.8, "unsure_offset": within(F.col("uncertainty_s"), 0.02), "few_samples": F.col("n_inliers") >= least,
        "position": within(F.col("position_p95"), worst_m), "orientation": within(F.col("orientation_p95"), worst_deg),
    }
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]), lambda r: r.isNotNull())
    d = d.withColumn("_f", failed)
    report = d.withColumn("verdict", F.when(F.size("_f") == 0, "PASS").otherwise("REVIEW")).withColumn("failed", F.array_join("_f", " ")).drop("_f")
    return aligned.drop("_both", "d"), report, curve


def ground_truth_report(estimate: DataFrame, truth: DataFrame, keys: list[str], radius: float = 1.0, rpe_rows: int = 1, frames: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Any track against any truth: both keys, t, x … qw. Offset from movement from row to row, the truth moved into the estimate's frame by its positions.

    Returns the matched rows with both errors, and per group the statistics: position, orientation, movement over ``rpe_rows`` rows, path, drift, and with
    ``frames`` (keys, t, frame, valid) the losses. Rows outside the truth's cover are left out.
    """
    estimate, truth = written(_unique(estimate, keys)), written(_unique(truth, keys))
    offsets = written(sync.find_generic_offset(estimate, truth, keys, radius))
    d = written(match(estimate, truth, keys, offsets, None))
    flat = d.select(*keys, *[F.col(f"m.p.{a}").alias(f"m{a}") for a in XYZ], *[F.col(f"e.p.{a}").alias(f"e{a}") for a in XYZ])
    fit = fit_rigid(flat, keys, [f"m{a}" for a in XYZ], [f"e{a}" for a in XYZ])
    fit = fit.select(*keys, poses.pose(rot.vector(*(F.col(f"t{i}") for i in (1, 2, 3))), rot.quaternion(*(F.col(f"q{c}") for c in "xyzw"))).alias("_f"))
    d = join_null_safe(d, fit, keys).withColumn("truth", poses.compose(F.col("_f"), F.col("m"))).drop("_f", "m")
    d = d.withColumns({"position_error_m": poses.length(poses.difference(F.col("e.p"), F.col("truth.p"))), "orientation_error_deg": rot.angle_deg(F.col("truth.q"), F.col("e.q"))})
    d = written(d)
    report = error_stats(d, keys, "position_error_m")
    report = join_null_safe(report, _prefixed(error_stats(d, keys, "orientation_error_deg"), keys, "orientation", "rmse", "median", "p95", "max"), keys)
    i = written(ordered.running_sum(d.select(*keys, "t", "e", "truth"), keys, ["t"], F.lit(1).cast("long"), "i"))
    later = i.select(*keys, (F.col("i") - rpe_rows).alias("i"), F.col("e").alias("e2"), F.col("truth").alias("truth2"))
    moves = join_null_safe(i, later, [*keys, "i"]).withColumn("_err", poses.relative_error(F.col("truth"), F.col("truth2"), F.col("e"), F.col("e2")))
    moves = written(moves.select(*keys, poses.length(F.col("_err.p")).alias("m"), poses.turn_deg(F.col("_err.q")).alias("deg")))
    report = join_null_safe(report, _prefixed(error_stats(moves, keys, "m"), keys, "rpe_m", "rmse", "p95"), keys, "left")
    report = join_null_safe(report, _prefixed(error_stats(moves, keys, "deg"), keys, "rpe_deg", "rmse", "p95"), keys, "left")
    report = join_null_safe(report, _ends(d, keys, F.col("e.p"), F.col("truth.p")), keys)
    report = join_null_safe(report, offsets.select(*keys, "offset_s", "score"), keys)
    if frames is not None:
        losses = written(tr.loss_events(frames, keys, ["t", "frame"], F.col("valid")))
        report = join_null_safe(report, losses.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_losses"), F.max("duration_s").alias("longest_loss_s")), keys, "left")
        report = report.withColumns({"n_losses": F.coalesce("n_losses", F.lit(0)), "longest_loss_s": F.coalesce("longest_loss_s", F.lit(0.0))})
        # The error at the matched row nearest to each recovery.
        ends = join_null_safe(losses, offsets.select(*keys, "offset_s"), keys).select(*keys, "recovered_s")
        near = asof.bracket(ends, d, keys, "recovered_s", "t", ["position_error_m"]).filter("lo IS NOT NULL").select(*keys, asof.nearest(F.col("recovered_s"))["position_error_m"].alias("r"))
        report = join_null_safe(report, _prefixed(error_stats(near, keys, "r"), keys, "recovery", "rmse"), keys, "left")
    return d, report


def run_stages(stages: dict[str, Callable[[], None]], folder: str, parameters: dict, force: bool = False, start: str | None = None, dry_run: bool = False) -> list[str]:
    """Run named stages in order, each once: a stage whose marker is there is kept.

    ``force`` runs all, ``start`` that one and all after it, ``dry_run`` only names what would run. A folder made with
    other parameters is refused unless forced. Returns the names of the stages run.
    """
    if start is not None and start not in stages:
        raise ValueError(f"no stage {start!r} among {list(stages)}")
    path = os.path.join(folder, "parameters.json")
    wanted = json.dumps(parameters, sort_keys=True)
    if os.path.exists(path) and not force:
        with open(path) as f:
            if f.read() != wanted:
                raise ValueError("the folder holds results of other parameters")
    names, again = [], force
    for name in stages:
        again = again or name == start
        if again or not os.path.exists(os.path.join(folder, f"{name}.done")):
            names.append(name)
    if dry_run:
        return names
    os.makedirs(folder, exist_ok=True)
    with open(path, "w") as f:
        f.write(wanted)
    for name in names:
        stages[name]()
        open(os.path.join(folder, f"{name}.done"), "w").close()
    return names


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from posegrain.plans.orientation import mocap_poses, recoveries, valid_poses

    truth = mocap_poses(spark, sf_dir).select("session_id", "t", *POSE)
    shared = read_table(spark, sf_dir, "mocap_normalized").select("session_id").distinct()
    back = recoveries(spark, sf_dir).select("session_id", "frame", F.lit(True).alias("recovered"))
    visual = valid_poses(spark, sf_dir).join(shared, "session_id", "left_semi").join(back, ["session_id", "frame"], "left")
    return visual.select("session_id", "t", "frame", "source", *POSE, F.coalesce("recovered", F.lit(False)).alias("recovered")), truth


GAP = 0.5  # the truth here has steps of a tenth to half a second


def _rounded(d: DataFrame, *names: str) -> list[Column]:
    kinds = dict(d.dtypes)
    return [F.round(n, 6).alias(n) if kinds[n] == "double" else F.col(n) for n in names]


def pipe_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session with motion capture, scored and judged."""
    d = evaluate(*_inputs(spark, sf_dir), ["session_id"], max_gap=GAP)[1]
    return d.select(*_rounded(d, *d.columns))


def pipe_matched_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched rows behind the scores."""
    d = evaluate(*_inputs(spark, sf_dir), ["session_id"], max_gap=GAP)[0]
    d = d.select("session_id", "frame", "t", "truth_t", "split", "status", "position_error_m", "orientation_error_deg", *[F.col(f"{k}.{n}.{c}").alias(f"{k}_{n}{c}") for k in ("truth", "estimate") for n, cs in (("p", XYZ), ("q", "xyzw")) for c in cs])
    return d.select(*_rounded(d, *d.columns))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The camera as the left rig and the marker body as the right; no two cameras of the tables were on at once."""
    visual, truth = _inputs(spark, sf_dir)
    return align_pair(visual.select("session_id", "t", *POSE, F.col("source").isin("", "direct").alias("direct")), truth.withColumn("direct", F.lit(True)), ["session_id"], max_gap=GAP)


def pipe_pair_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _pair(spark, sf_dir)[1]
    return d.select(*_rounded(d, *d.columns))


def pipe_pair_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _pair(spark, sf_dir)[0]
    d = d.select("session_id", "t", "truth_t", "inlier", "position_error_m", "orientation_error_deg", *[F.col(f"{k}.{n}.{c}").alias(f"{k}_{n}{c}") for k in ("e", "aligned") for n, cs in (("p", XYZ), ("q", "xyzw")) for c in cs])
    return d.select(*_rounded(d, *d.columns))


def pipe_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session with motion capture against it, without calibration of the body, with its losses."""
    from posegrain.plans import reference as ref

    visual, truth = _inputs(spark, sf_dir)
    frames = ref.poses(spark, sf_dir).select("session_id", "t", "frame", "status", *XYZ).select("session_id", "t", "frame", ref.is_valid().alias("valid"))
    d = ground_truth_report(visual.select("session_id", "t", *POSE), truth, ["session_id"], frames=frames)[1]
    return d.select(*_rounded(d, *d.columns))


def sync_truth_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offset of each session from both channels of movement over 0.2 s, searched again wider where it lies at the edge."""
    visual, truth = _inputs(spark, sf_dir)
    d = sync.find_offset_to_truth(_unique(visual, ["session_id"]), _unique(truth, ["session_id"]), ["session_id"], max_gap=GAP)
    return d.select(*_rounded(d, *d.columns))


def sync_generic_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offset from movement from row to row, in median steps, within the truth's cover."""
    visual, truth = _inputs(spark, sf_dir)
    d = sync.find_generic_offset(_unique(visual, ["session_id"]), _unique(truth, ["session_id"]), ["session_id"])
    return d.select(*_rounded(d, *d.columns))


def sync_offset_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of the pair search by offset, ±3 s in steps of 10 ms, by channel."""
    visual, truth = _inputs(spark, sf_dir)
    d = sync.pair_offset_scores(written(_unique(visual, ["session_id"])), written(_unique(truth, ["session_id"])), ["session_id"], max_gap=GAP)
    return d.select("session_id", "step", "n", *[F.round(c, 4).alias(c) for c in ("score", "speed_score", "turn_rate_score")])


def gate_formal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of formal accuracy on each session's curve of offsets, to the step of the curve, and its test rows."""
    from posegrain.plans import reference as ref

    curve = written(sync_offset_curve(spark, sf_dir).filter("score IS NOT NULL"))
    best = curve.groupBy("session_id").agg(F.max("score").alias("score"))
    near = curve.select("session_id", "step", F.col("score").alias("_s")).join(best, "session_id").filter(F.col("_s") >= F.col("score") - 0.02)
    facts = near.groupBy("session_id").agg(F.max("score").alias("score"), ((F.max("step") - F.min("step")) * 0.005).alias("uncertainty_s"))
    tests = ref.gate_split(spark, sf_dir).select("session_id", F.col("n_test").alias("n"))
    flow = ref.poses(spark, sf_dir).groupBy("session_id").agg(F.max((F.col("source") == "optical_flow").cast("int")).alias("_flow"))
    return formal_gate(tests.join(flow, "session_id").join(facts, "session_id", "left")).select("session_id", "n", "verdict", "reasons")


def sync_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear and angular speed over 0.2 s, at the middle of the pair."""
    visual, _ = _inputs(spark, sf_dir)
    d = sync.signature(_unique(visual, ["session_id"]), ["session_id"], "t", XYZ)
    return d.select("session_id", F.round(F.col("middle") + 1e-9, 6).alias("t"), F.round("speed", 5).alias("speed"), F.round(F.col("turn_rate") + 1e-9, 3).alias("turn_rate"))


QUERIES = {f.__name__: f for f in (pipe_evaluation, pipe_matched_errors, pipe_pair_audit, pipe_pair_aligned, pipe_ground_truth, sync_truth_offset, sync_generic_offset, sync_offset_curve, sync_signature, gate_formal)}


def _signature_sql(name: str, source: str) -> str:
    """SQL: ``name`` (session_id, mid, speed, turn_rate) of the movement over 0.2 s in ``source`` (session_id, t, x … qw)."""
    from posegrain.plans import rotation_sql as rs

    row = "{" + ", ".join(f"'{c}': {c}" for c in POSE) + "}"
    return f"""
{name}_u AS (SELECT session_id, t, {row} AS o FROM (SELECT *, row_number() OVER (PARTITION BY session_id, t ORDER BY x, y, z) AS copy_ FROM {source}) WHERE copy_ = 1),
{name}_w AS (SELECT *, t + 0.2 AS want FROM {name}_u),
{name}_g AS (SELECT w.session_id, w.t, w.o, w.want, b.t AS bt, b.o AS bo, c.t AS ct, c.o AS co FROM {name}_w w ASOF LEFT JOIN {name}_u b ON w.session_id = b.session_id AND w.want > b.t ASOF LEFT JOIN {name}_u c ON w.session_id = c.session_id AND w.want <= c.t),
{name}_h AS (SELECT *, ct IS NULL OR abs(bt - want) <= abs(ct - want) AS first_ FROM {name}_g),
{name}_k AS (SELECT session_id, t, o, CASE WHEN first_ THEN bt ELSE ct END AS t2, CASE WHEN first_ THEN bo ELSE co END AS p, want FROM {name}_h),
{name} AS (SELECT session_id, (t + t2) / 2 AS mid, {rs.norm(rs.minus(rs.v('p.'), rs.v('o.')))} / (t2 - t) AS speed, {rs.turn(rs.multiply(rs.inverse(rs.q('o.')), rs.q('p.')))} / (t2 - t) AS turn_rate FROM {name}_k WHERE abs(t2 - want) <= 0.05 AND t2 > t)"""


def _oracle() -> dict[str, str]:
    from posegrain.plans import reference as ref
    from posegrain.plans import rotation_sql as rs
    from posegrain.plans.reference import BASE

    mq = rs.AROUND[: rs.AROUND.index("so AS")].strip().rstrip(",")
    vis = "vis AS (SELECT vq.session_id, vq.t, vq.x, vq.y, vq.z, vq.qx, vq.qy, vq.qz, vq.qw FROM vq WHERE session_id IN (SELECT session_id FROM mocap_normalized))"
    corr = lambda c: f"CASE WHEN count(*) >= 20 AND stddev_pop({c}) > 1e-9 AND stddev_pop(r_{c}) > 1e-9 THEN covar_pop({c}, r_{c}) / (stddev_pop({c}) * stddev_pop(r_{c})) END AS c_{c}"
    at = lambda c: f"b.{c} + CASE WHEN a.mid > b.mid THEN (q - b.mid) / (a.mid - b.mid) ELSE 0 END * (a.{c} - b.{c}) AS r_{c}"
    out = {
        "sync_signature": f"{BASE}, {vis}, {_signature_sql('sl', 'vis')} SELECT session_id, round(mid + 1e-9, 6) AS t, round(speed, 5) AS speed, round(turn_rate + 1e-9, 3) AS turn_rate FROM sl",
        # Before the first or after the last sample a query is outside; exactly on one it belongs to the step that ends there, at the first to the step after it.
        "sync_offset_curve": f"""{BASE}, {vis}, {mq}, {_signature_sql('sl', 'vis')}, {_signature_sql('sr', 'mq')},
s_ AS (SELECT *, lag({{'mid': mid, 'speed': speed, 'turn_rate': turn_rate}}) OVER w AS b, lead({{'mid': mid, 'speed': speed, 'turn_rate': turn_rate}}) OVER w AS n, {{'mid': mid, 'speed': speed, 'turn_rate': turn_rate}} AS o FROM sr WINDOW w AS (PARTITION BY session_id ORDER BY mid)),
g_ AS (SELECT session_id, CASE WHEN b IS NULL THEN o ELSE b END AS b, CASE WHEN b IS NULL THEN n ELSE o END AS a, mid FROM s_),
o_ AS (SELECT session_id, step, mid + step * 0.01 AS q, speed, turn_rate FROM sl, (SELECT unnest(range(-300, 301)) AS step)),
j_ AS (SELECT o_.*, {at('speed')}, {at('turn_rate')}, coalesce(b.mid <= q AND q <= a.mid AND a.mid - b.mid <= 0.5, false) AS ok FROM o_ ASOF JOIN g_ ON o_.session_id = g_.session_id AND o_.q <= g_.mid),
k_ AS (SELECT session_id, step, count(*) AS n, {corr('speed')}, {corr('turn_rate')} FROM j_ WHERE ok GROUP BY session_id, step),
l_ AS (SELECT DISTINCT o_.session_id, o_.step FROM o_)
SELECT session_id, step::INT AS step, coalesce(n, 0) AS n, round((coalesce(c_speed, 0) + coalesce(c_turn_rate, 0)) / nullif((c_speed IS NOT NULL)::INT + (c_turn_rate IS NOT NULL)::INT, 0), 4) AS score, round(c_speed, 4) AS speed_score, round(c_turn_rate, 4) AS turn_rate_score FROM l_ LEFT JOIN k_ USING (session_id, step)""",
    }
    out["gate_formal"] = f"""WITH c AS (SELECT * FROM ({out['sync_offset_curve']}) WHERE score IS NOT NULL), g AS ({ref.ORACLE['gate_split']}), fl AS ({BASE} SELECT session_id, max((source = 'optical_flow')::INT) AS flow FROM p GROUP BY session_id),
b AS (SELECT session_id, max(score) AS score FROM c GROUP BY session_id), u AS (SELECT session_id, max(b.score) AS score, (max(step) - min(step)) * 0.005 AS unsure FROM c JOIN b USING (session_id) WHERE c.score >= b.score - 0.02 GROUP BY session_id),
r AS (SELECT g.session_id, n_test AS n, list_filter([CASE WHEN flow = 1 THEN 'uses_flow' END, CASE WHEN NOT coalesce(score >= 0.8, false) THEN 'weak_correlation' END, CASE WHEN NOT coalesce(unsure <= 0.02 + 1e-9, false) THEN 'unsure_offset' END, CASE WHEN n_test < 200 THEN 'few_test_rows' END], lambda x: x IS NOT NULL) AS why
      FROM g JOIN fl USING (session_id) LEFT JOIN u USING (session_id))
SELECT session_id, n, CASE WHEN len(why) = 0 THEN 'FORMAL_ACCURACY' ELSE 'DIAGNOSTIC_ONLY' END AS verdict, array_to_string(why, ' ') AS reasons FROM r"""
    return out


ORACLE: dict[str, str] = _oracle()
