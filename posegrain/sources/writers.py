"""Writers for the recorded formats. Numbers are written with fixed decimals, missing ones blank."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed(c: Column, places: int) -> Column:
    """Text with ``places`` decimals; NULL stays NULL and is written blank."""
    return F.when(c.isNotNull(), F.format_string(f"%.{places}f", c.cast("double")))


def write_csv(df: DataFrame, path: str, decimals: dict[str, int] | None = None, mode: str = "errorifexists") -> None:
    """CSV with a header; ``decimals`` gives the places of columns, arrays of ids are joined with spaces, truth values are 1 and 0."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f.name)
        if decimals and f.name in decimals:
            c = fixed(c, decimals[f.name])
        elif kind == "array<int>":
            c = F.array_join(F.transform(F.array_sort(c), lambda i: i.cast("string")), " ")
        elif kind == "boolean":
            c = c.cast("int")
        out.append(c.alias(f.name))
    df.select(*out).write.mode(mode).csv(path, header=True, nullValue="", emptyValue="")


def dataset_decimals(columns: list[str]) -> dict[str, int]:
    """Places of the trajectory dataset: times 6, positions 8, quaternions 9."""
    places = {}
    for c in columns:
        if c.startswith("timestamp") or c.endswith("_s"):
            places[c] = 6
        elif c.endswith("_m") or c.endswith("_deg") or c.endswith("_px"):
            places[c] = 8
        elif c.rsplit("_", 1)[-1] in ("qx", "qy", "qz", "qw"):
            places[c] = 9
    return places


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The trajectory dataset as CSV."""
    write_csv(df, path, dataset_decimals(df.columns), mode)


def write_mocap(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Normalised motion capture; rows that are not valid are written with blank values."""
    values = [c for c in df.columns if c not in ("session_id", "frame", "timestamp", "valid")]
    ok = F.col("valid").cast("int") == 1
    write_csv(df.withColumns({c: F.when(ok, F.col(c)) for c in values}), path, mode=mode)


def write_report(spark: SparkSession, report: dict, path: str, mode: str = "errorifexists") -> None:
    """A small report as one JSON file."""
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.mode(mode).text(path)


# The columns of the matched errors and of the search's curve, as written.
MATCHED = ["frame", "timestamp_s", "truth_timestamp_s", "split", "status", "position_error_m", "orientation_error_deg", *[f"{k}_{c}" for k in ("truth", "estimate") for c in ("x_m", "y_m", "z_m", "qx", "qy", "qz", "qw")]]
CURVE = ["offset_s", "combined_correlation", "linear_correlation", "angular_correlation"]


def write_matched_errors(matched: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The rows of an evaluation (``truth`` and ``estimate`` as pose structs) as CSV, times 6 decimals, errors 9 and 6."""
    part = lambda k: [F.col(f"{k}.{n}.{c}").alias(f"{k}_{a}") for n, cs in (("p", "xyz"), ("q", "xyzw")) for c, a in zip(cs, ("x_m", "y_m", "z_m") if n == "p" else ("qx", "qy", "qz", "qw"))]
    keys = [c for c in matched.columns if c == "session_id"]
    d = matched.select(*keys, "frame", F.col("t").alias("timestamp_s"), F.col("truth_t").alias("truth_timestamp_s"), "split", "status", "position_error_m", "orientation_error_deg", *part("truth"), *part("estimate"))
    places = {"timestamp_s": 6, "truth_timestamp_s": 6, "position_error_m": 9, "orientation_error_deg": 6}
    write_csv(d.select(*keys, *MATCHED), path, places, mode)


def write_offset_curve(curve: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The scores of an offset search by offset, in order, as one CSV; a curve has some hundred rows a source."""
    keys = [c for c in curve.columns if c == "session_id"]
    d = curve.select(*keys, "offset_s", *[F.col(c).alias(n) for c, n in zip(("score", "speed_score", "turn_rate_score"), CURVE[1:])])
    write_csv(d.orderBy(*keys, "offset_s"), path, {c: 6 for c in CURVE}, mode)


def write_aligned(aligned: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Two rigs in one frame: the left pose ``e`` and the right one brought to it, ``aligned``, with their residuals."""
    part = lambda k, name: [F.col(f"{k}.{n}.{c}").alias(f"{name}_{a}") for n, cs, names in (("p", "xyz", ("x_m", "y_m", "z_m")), ("q", "xyzw", ("qx", "qy", "qz", "qw"))) for c, a in zip(cs, names)]
    keys = [c for c in aligned.columns if c == "session_id"]
    d = aligned.select(*keys, F.col("t").alias("timestamp_s"), F.col("truth_t").alias("right_timestamp_s"), *part("e", "left"), *part("aligned", "right"), "position_error_m", "orientation_error_deg", F.col("inlier").cast("int").alias("inlier"))
    write_csv(d, path, dataset_decimals(d.columns), mode)


def write_errors(errors: DataFrame, report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A ground-truth evaluation: the errors as CSV under ``errors``, the statistics as JSON, a line per source, under ``report``."""
    keys = [c for c in errors.columns if c == "session_id"]
    write_csv(errors.select(*keys, F.col("t").alias("timestamp_s"), "position_error_m", "orientation_error_deg"), f"{path}/errors", {"timestamp_s": 6, "position_error_m": 9, "orientation_error_deg": 6}, mode)
    report.coalesce(1).write.mode(mode).json(f"{path}/report")


def write_manifest(spark: SparkSession, path: str, inputs: DataFrame, parameters: dict, results: dict, mode: str = "errorifexists") -> None:
    """What a run read and made: ``inputs`` (path, length, modified; as ``list_media`` gives them, some dozens), its parameters and results, as JSON."""
    files = [{"path": r.path, "bytes": r.length, "modified": r.modified.isoformat()} for r in inputs.limit(10_000).collect()]
    if len(files) == 10_000:
        raise ValueError("a manifest is for the files of one run")
    write_report(spark, {"inputs": files, "parameters": parameters, "results": results}, path, mode)


def stream_poses_to(poses: DataFrame, folder: str, checkpoint: str, status: str | None = None):
    """Start a stream that appends every batch to ``folder`` as a pose table and, with the detections in ``views``, as JSON lines.

    After each batch ``status`` gets one small JSON file: rows, valid rows and tags so far. A batch written again after a failure replaces
    its own files, and its counts are kept by its number, so nothing counts twice.
    """
    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            flat = df.drop("views") if "views" in df.columns else df
            write_csv(flat, f"{folder}/poses/batch={number}", mode="overwrite")
            if "views" in df.columns:
                df.select("frame", "timestamp", "views").write.mode("overwrite").json(f"{folder}/detections/batch={number}")
            if status:
                spark = df.sparkSession
                ids = F.flatten(F.collect_set(F.filter(F.transform(F.split(F.coalesce(F.trim("detected_ids"), F.lit("")), r"\s+"), lambda i: i.try_cast("int")), lambda i: i.isNotNull())))
                now = df.agg(F.count(F.lit(1)).alias("processed"), F.coalesce(F.sum((F.col("quality_status") == "valid").cast("long")), F.lit(0)).alias("valid"), F.array_distinct(ids).alias("ids"))
                now.withColumn("ids", F.array_sort("ids")).coalesce(1).write.mode("overwrite").json(f"{status}/batches/batch={number}")
                every = spark.read.schema("processed long, valid long, ids array<int>").json(f"{status}/batches")
                total = every.agg(F.sum("processed").alias("p"), F.sum("valid").alias("v"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids")).first()
                write_report(spark, {"running": True, "processed_frames": total.p, "pose_frames": total.v, "seen_ids": total.ids}, f"{status}/status", mode="overwrite")
        finally:
            df.unpersist()

    return poses.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
