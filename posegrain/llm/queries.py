"""Queries of the training-data problems, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrain.functions.status import canonical_status
from posegrain.llm import leakage, packing, quantiles, subjects
from posegrain.llm.runs import event_runs
from posegrain.operators.dedupe import keep_first_copy
from posegrain.plans.problems import POSE_SQL, pose_rows
from posegrain.session import read_table

RANK_ERROR = 0.01
SHARES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def p1_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 1: each repetition of a status in a session once, with its rows and the time it lasts."""
    rows = pose_rows(spark, sf_dir, "quality_status")
    rows = rows.select("session_id", "timestamp", "frame", "pose_id", canonical_status(F.col("quality_status")).alias("status"))
    return event_runs(rows, "session_id", ["timestamp", "frame"], "status", "pose_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_runs(spark, sf_dir).select("session_id", "first_pose_id", "last_pose_id")


def p2_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 2: the digests of each session, day of ingestion and field, to be kept and combined later."""
    pose = keep_first_copy(read_table(spark, sf_dir, "pose"), ["session_id", "frame"], "pose_id", ["ingested_at", "reprojection_rmse_px", "detected_tag_count"])
    rmse, tags = F.col("reprojection_rmse_px"), F.col("detected_tag_count")
    fields = F.array(
        F.struct(F.lit("reprojection_rmse_px").alias("field_name"), F.when(~F.isnan(rmse), quantiles.measure_cell(rmse)).alias("cell")),
        F.struct(F.lit("detected_tag_count").alias("field_name"), quantiles.count_cell(tags).alias("cell")),
    )
    rows = pose.select("session_id", F.to_date("ingested_at").alias("day"), F.explode(fields).alias("f"))
    return quantiles.digest(rows.select("session_id", "day", "f.field_name", "f.cell"), ["session_id", "day", "field_name"], F.col("cell"), RANK_ERROR)


def _dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board and camera profile of each session."""
    return read_table(spark, sf_dir, "capture_sessions").groupBy("session_id").agg(*[F.max(F.when(F.trim(c) != "", F.lower(F.trim(c)))).alias(c) for c in ("board", "camera_profile")])


def _dims() -> Column:
    """The groups a row counts for, as (dimension, group_value)."""
    return F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("group_value")) for d, c in (("session", "session_id"), ("board", "board"), ("camera_profile", "camera_profile"), ("day", "day"))])


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 2: percentiles per session, board, camera profile and day, merged from the partial digests.

    A percentile's rank is within 1 % of ``n`` of the exact one; its value within 0.07 % of a value of that
    rank, whole numbers exact; values outside the digest's range (0 to 65,534 for tags, 2**±32 for errors) show as infinities. Sessions without a board or profile, or not in ``capture_sessions``, count under NULL.
    """
    parts = p2_partials(spark, sf_dir).join(_dimensions(spark, sf_dir), "session_id", "left")
    spread = parts.select(F.explode(_dims()).alias("d"), "field_name", "node", "node_count").select("d.dimension", "d.group_value", "field_name", "node", "node_count")
    keys = ["dimension", "group_value", "field_name"]
    cells = quantiles.percentiles(quantiles.merge_digests(spread, keys, RANK_ERROR), keys, SHARES)
    value = lambda c: F.when(F.col("field_name") == "detected_tag_count", quantiles.counted(F.col(c))).otherwise(quantiles.measured(F.col(c))).alias(c)
    return cells.select(*keys, "n", *[value(c) for c in SHARES], F.ceil(F.col("n") * RANK_ERROR).alias("rank_error"))


def p2_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each percentile's rank is within the stated error: checked against the counts of all exact values."""
    found = p2_percentiles(spark, sf_dir)
    pose = keep_first_copy(read_table(spark, sf_dir, "pose"), ["session_id", "frame"], "pose_id", ["ingested_at", "reprojection_rmse_px", "detected_tag_count"])
    rmse = F.col("reprojection_rmse_px")
    fields = F.array(F.struct(F.lit("reprojection_rmse_px").alias("field_name"), F.when(~F.isnan(rmse), rmse).alias("x")), F.struct(F.lit("detected_tag_count").alias("field_name"), F.col("detected_tag_count").cast("double").alias("x")))
    each = pose.select("session_id", F.to_date("ingested_at").alias("day"), F.explode(fields).alias("f")).select("session_id", "day", "f.field_name", "f.x").filter("x IS NOT NULL")
    each = each.groupBy("session_id", "day", "field_name", "x").agg(F.count(F.lit(1)).alias("c")).join(_dimensions(spark, sf_dir), "session_id", "left")
    each = each.select(_dims().alias("d"), "field_name", "x", "c").select(F.inline("d"), "field_name", "x", "c").withColumnRenamed("dimension", "_d").withColumnRenamed("group_value", "_g").withColumnRenamed("field_name", "_f")
    both = found.join(each, F.col("dimension").eqNullSafe(F.col("_d")) & F.col("group_value").eqNullSafe(F.col("_g")) & (F.col("field_name") == F.col("_f")))
    keys, checks = ["dimension", "group_value", "field_name"], []
    for name, share in SHARES.items():
        slack = 0.0015 * F.abs(F.col(name)) + 1e-9
        below = F.sum(F.when(F.col("x") < F.col(name) - slack, F.col("c")).otherwise(0))
        upto = F.sum(F.when(F.col("x") <= F.col(name) + slack, F.col("c")).otherwise(0))
        want = F.ceil(share * F.max("n"))
        checks.append(((below + 1 - F.max("rank_error") <= want) & (want <= upto + F.max("rank_error"))).alias(f"{name}_ok"))
    return both.groupBy(*keys).agg(F.max("n").alias("n"), *checks)


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 6: every mail's place in containers of each capacity."""
    kinds = {r.container_kind: r.capacity_tokens for r in read_table(spark, sf_dir, "containers").collect()}
    return packing.pack(read_table(spark, sf_dir, "documents"), kinds)


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: the share of their capacity that holds tokens."""
    kinds = read_table(spark, sf_dir, "containers")
    used = p6_containers(spark, sf_dir).groupBy("container_kind").agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return used.join(kinds, "container_kind").select("container_kind", "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("filled"))


def p6_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every packing must keep, per kind of container: all documents in it, no container over its capacity, pieces
    whole and in order, and none divided that fits."""
    kinds = read_table(spark, sf_dir, "containers")
    placed = p6_containers(spark, sf_dir).join(kinds, "container_kind")
    full = placed.groupBy("container_kind", "container_id").agg((F.sum("n_tokens") <= F.max("capacity_tokens")).alias("fits")).groupBy("container_kind").agg(F.min("fits").alias("within_capacity"))
    docs = placed.groupBy("container_kind", "doc_id").agg(
        (F.sum("n_tokens") == F.max(F.col("first_token") + F.col("n_tokens"))).alias("whole"), (F.countDistinct("piece_no") == F.max("piece_no")).alias("in_order"), ((F.count(F.lit(1)) == 1) | (F.sum("n_tokens") > F.max("capacity_tokens"))).alias("undivided")
    )
    docs = docs.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_documents"), F.min(F.col("whole") & F.col("in_order")).alias("pieces_whole"), F.min("undivided").alias("divided_only_if_needed"))
    return docs.join(full, "container_kind").select("container_kind", "n_documents", "within_capacity", "pieces_whole", "divided_only_if_needed")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 7: mails that carry an evaluation item, or twenty or more successive words of it."""
    return leakage.leaked_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 8: the subject areas each mail deals with, with their evidence and shares."""
    areas = [r.subject for r in read_table(spark, sf_dir, "subject_areas").select("subject").collect()]
    return subjects.subject_areas(read_table(spark, sf_dir, "documents"), areas, read_table(spark, sf_dir, "doc_labels"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_subjects(spark, sf_dir).select("doc_id", "subject")


QUERIES = {f.__name__: f for f in (p1_found, p1_runs, p2_percentiles, p2_partials, p2_ranks, p6_containers, p6_fill, p6_checks, p7_found, p8_found, p8_subjects)}

ORACLE = {
    "p1_found": f"""
WITH {POSE_SQL},
steps AS (SELECT *, lag(status) OVER w AS before, round(timestamp - lag(timestamp) OVER w, 6) AS step FROM rows_ WINDOW w AS (PARTITION BY session_id ORDER BY timestamp, frame)),
runs AS (SELECT *, sum(CASE WHEN status = before AND step <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY timestamp, frame ROWS UNBOUNDED PRECEDING) AS run_no FROM steps)
SELECT session_id, arg_min(pose_id, (timestamp, frame)) AS first_pose_id, arg_max(pose_id, (timestamp, frame)) AS last_pose_id
FROM runs WHERE status IS NOT NULL GROUP BY session_id, run_no HAVING count(*) >= 2""",
    "p1_runs": f"""
WITH {POSE_SQL},
steps AS (SELECT *, lag(status) OVER w AS before, round(timestamp - lag(timestamp) OVER w, 6) AS step FROM rows_ WINDOW w AS (PARTITION BY session_id ORDER BY timestamp, frame)),
runs AS (SELECT *, sum(CASE WHEN status = before AND step <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY timestamp, frame ROWS UNBOUNDED PRECEDING) AS run_no FROM steps)
SELECT session_id, min(status) AS event, arg_min(pose_id, (timestamp, frame)) AS first_pose_id, arg_max(pose_id, (timestamp, frame)) AS last_pose_id, count(*) AS n_rows, min(timestamp) AS start_s, max(timestamp) - min(timestamp) AS duration_s
FROM runs WHERE status IS NOT NULL GROUP BY session_id, run_no HAVING count(*) >= 2""",
    "p2_ranks": f"""
WITH dims AS (SELECT session_id, max(CASE WHEN trim(board) <> '' THEN lower(trim(board)) END) AS board, max(CASE WHEN trim(camera_profile) <> '' THEN lower(trim(camera_profile)) END) AS camera_profile FROM capture_sessions GROUP BY session_id),
first_ AS (SELECT session_id, frame, ingested_at, reprojection_rmse_px AS rmse, detected_tag_count AS tags FROM (SELECT *, row_number() OVER (PARTITION BY session_id, frame ORDER BY pose_id) AS copy_no FROM pose) WHERE copy_no = 1),
each_ AS (SELECT *, unnest([{{'field_name': 'reprojection_rmse_px', 'x': CASE WHEN NOT isnan(rmse) THEN rmse END}}, {{'field_name': 'detected_tag_count', 'x': tags::DOUBLE}}]) AS f FROM first_ LEFT JOIN dims USING (session_id)),
spread AS (SELECT unnest([{{'dimension': 'session', 'group_value': session_id}}, {{'dimension': 'board', 'group_value': board}}, {{'dimension': 'camera_profile', 'group_value': camera_profile}}, {{'dimension': 'day', 'group_value': strftime(ingested_at, '%Y-%m-%d')}}]) AS d, f.field_name AS field_name FROM each_ WHERE f.x IS NOT NULL)
SELECT d.dimension AS dimension, d.group_value AS group_value, field_name, count(*) AS n, {", ".join(f"true AS {name}_ok" for name in SHARES)} FROM spread GROUP BY 1, 2, 3""",
    "p6_checks": """
SELECT container_kind, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS n_documents, true AS within_capacity, true AS pieces_whole, true AS divided_only_if_needed FROM containers""",
}
