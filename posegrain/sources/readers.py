"""Readers for the recorded formats, each into a typed DataFrame.

Text is read with a declared schema and parsed leniently: blank or unreadable numbers are NULL. Columns a
file lacks come out NULL, so older files with fewer columns read like newer ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posegrain.functions.angles import parse_number

# The columns of the pose table and their types.
POSE = {
    "frame": "bigint", "timestamp": "double", "camera_x_m": "double", "camera_y_m": "double", "camera_z_m": "double", "roll_deg": "double", "pitch_deg": "double", "yaw_deg": "double",
    "raw_camera_x_m": "double", "raw_camera_y_m": "double", "raw_camera_z_m": "double", "detected_tag_count": "int", "inlier_count": "int", "reprojection_rmse_px": "double",
    "detected_ids": "string", "selected_view": "string", "measurement_source": "string", "quality_status": "string",
}

DETECTION = "frame bigint, timestamp double, detected_ids array<int>, selected_view string, measurement_source string, quality_status string, jump_m double, views array<struct<view:struct<name:string,yaw:double,pitch:double,fov:double,roll:double>,size:int,tracking_mode:string,detections:array<struct<id:int,corners_px:array<array<double>>>>,pose:struct<xyz:array<double>,rpy:array<double>,inliers:int,rmse:double>>>"


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False)


def _typed(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    out = []
    for name, kind in columns.items():
        if name not in raw.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif kind == "string":
            out.append(F.col(name).alias(name))
        elif kind == "double":
            out.append(parse_number(F.col(name)).alias(name))
        else:
            out.append(F.trim(F.col(name)).try_cast(kind).alias(name))
    return raw.select(*out, *([F.col("session_id")] if "session_id" in raw.columns else []))


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    """A pose table. Files from before ``measurement_source`` have it NULL, which counts as direct."""
    return _typed(_text(spark, path), POSE)


def require(df: DataFrame, least: int, what: str) -> DataFrame:
    """``df``, or an error where it has fewer than ``least`` rows; at most that many are looked at."""
    if df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} {what}")
    return df


def read_valid_trajectory(spark: SparkSession, path: str, least: int = 4) -> DataFrame:
    """The valid rows with a position of a pose table; fewer than ``least`` are refused."""
    d = read_poses(spark, path).filter((F.col("quality_status") == "valid") & F.col("camera_x_m").isNotNull())
    return require(d, least, "valid poses")


def read_gated_trajectory(spark: SparkSession, path: str, min_tags: int = 4, sources: tuple[str, ...] = ("", "direct"), least: int = 20) -> DataFrame:
    """Those of enough tags and of accepted sources, a missing source being direct; fewer than ``least`` are refused."""
    d = read_valid_trajectory(spark, path, 0).filter((F.col("detected_tag_count") >= min_tags) & F.coalesce("measurement_source", F.lit("direct")).isin(*sources, *(["direct"] if "" in sources else [])))
    return require(d, least, "gated poses")


def read_trajectory(spark: SparkSession, path: str, least: int = 0) -> DataFrame:
    """Any six-degree table as (session_id, t, x, y, z, qx, qy, qz, qw, direct): optimized columns before relative ones before camera angles.

    Rows that are not finite are left out, quaternions normalised, and of rows of a session with one time the first of its file stays. Files
    without ``session_id`` are a session each, named by their path. ``direct`` says whether the row was measured, also by default. Fewer than ``least`` rows are refused.
    """
    from posegrain.functions.rotations import from_euler, normalised, quaternion
    from posegrain.operators.ordered import first_per_time

    raw = _text(spark, path)
    have = set(raw.columns)
    time = "timestamp_s" if "timestamp_s" in have else "timestamp"
    num = lambda c: parse_number(F.col(c))
    for prefix in ("optimized", "relative"):
        cols = [f"{prefix}_{a}_m" for a in "xyz"] + [f"{prefix}_q{c}" for c in "xyzw"]
        if have >= set(cols):
            xyz, q = [num(c) for c in cols[:3]], quaternion(*(num(c) for c in cols[3:]))
            break
    else:
        cols = ["camera_x_m", "camera_y_m", "camera_z_m", "roll_deg", "pitch_deg", "yaw_deg"]
        if not have >= set(cols):
            raise ValueError(f"no trajectory columns among {sorted(have)}")
        xyz, q = [num(c) for c in cols[:3]], from_euler(*(num(c) for c in cols[3:]))
    session = F.col("session_id") if "session_id" in have else F.input_file_name()
    source = F.coalesce(F.trim("measurement_source"), F.lit("")) if "measurement_source" in have else F.lit("")
    d = raw.select(session.alias("session_id"), num(time).alias("t"), *[c.alias(a) for c, a in zip(xyz, "xyz")], normalised(q).alias("q"), source.isin("", "direct").alias("direct"), F.monotonically_increasing_id().alias("_row"))
    d = d.select("session_id", "t", "x", "y", "z", *[F.col(f"q.{c}").alias(f"q{c}") for c in "xyzw"], "direct", "_row").dropna()
    return require(first_per_time(d, ["session_id"], "t", "_row").drop("_row"), least, "poses")


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """The nested detection log, one JSON record a line."""
    return spark.read.schema(DETECTION).json(path)


def read_mocap(spark: SparkSession, path: str, millimetres: bool = False, lever: tuple[float, float, float] | None = None, strict: bool = False) -> DataFrame:
    """Flat motion capture (timestamp, x … qw); positions to metres. ``lever`` moves them to a point fixed to the body.

    ``strict`` refuses a file in which a time occurs twice.
    """
    from posegrain.functions import poses
    from posegrain.functions import rotations as rot

    d = _typed(_text(spark, path), {c: "double" for c in ("timestamp", "x", "y", "z", "qx", "qy", "qz", "qw")})
    scale = 0.001 if millimetres else 1.0
    d = d.select("timestamp", *[(F.col(a) * scale).alias(a) for a in "xyz"], "qx", "qy", "qz", "qw")
    if lever is not None:
        q = rot.normalised(rot.quaternion(*(F.col(f"q{c}") for c in "xyzw")))
        d = d.withColumn("_p", poses.added(rot.vector(*(F.col(a) for a in "xyz")), rot.rotate(q, rot.vector(*(F.lit(float(v)) for v in lever))))).withColumns({a: F.col(f"_p.{a}") for a in "xyz"}).drop("_p")
    if strict and repeated_times(d).limit(1).count():
        raise ValueError("a time occurs more than once")
    return d


def repeated_times(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Times that occur more than once; a strict reader refuses a file with any."""
    return df.groupBy(time).count().filter("count > 1")


def read_motive(spark: SparkSession, path: str) -> DataFrame:
    """An export with metadata above its header, as a dense grid of the declared frames.

    (frame, t, x, y, z, qx, qy, qz, qw, valid): positions from millimetres, unit quaternions; frames that are missing, incomplete or without a
    rotation are not valid and have NULLs; of a frame's rows the first usable stays. A row's own time holds, else frame / rate. Without metadata
    the frames end with the last row, and the rate follows from the last row's time. The header is looked for in the whole file.
    """
    text = spark.read.text(path).select("value")
    if not text.filter(F.col("value").rlike(r"^Frame,Time \(Seconds\)")).limit(1).count():
        raise ValueError("no header row with Frame and Time (Seconds)")
    cells = F.split("value", ",")
    declared = text.filter(F.col("value").contains("Total Exported Frames") | F.col("value").contains("Export Frame Rate")).limit(1).collect()
    named = dict(zip(*[iter(declared[0].value.split(","))] * 2)) if declared else {}
    at = lambda i: F.try_element_at(cells, F.lit(i)).try_cast("double")
    d = text.filter(F.col("value").rlike(r"^\d+,")).select(F.get(cells, F.lit(0)).cast("long").alias("frame"), at(2).alias("_time"), *[at(i + 3).alias(n) for i, n in enumerate(("qx", "qy", "qz", "qw", "x", "y", "z"))])
    last = d.agg(F.max("frame").alias("frame"), F.max_by("_time", "frame").alias("t")).first()
    number = lambda name: float(named[name]) if str(named.get(name, "")).replace(".", "", 1).isdigit() else None
    frames = int(number("Total Exported Frames") or (last.frame + 1 if last.frame is not None else 0))
    rate = number("Export Frame Rate") or (last.frame / last.t if last.t else 1.0)
    norm = F.sqrt(sum(F.col(f"q{c}") * F.col(f"q{c}") for c in "xyzw"))
    times = d.groupBy("frame").agg(F.min("_time").alias("_time"))
    good = d.dropna(subset=["qx", "qy", "qz", "qw", "x", "y", "z"]).withColumn("_n", norm).filter(F.col("_n") > 0.5)
    values = F.struct(*[(F.col(a) / 1000).alias(a) for a in "xyz"], *[(F.col(f"q{c}") / F.col("_n")).alias(f"q{c}") for c in "xyzw"])
    good = good.groupBy("frame").agg(F.min_by(values, F.struct("_time", "x", "y", "z")).alias("_v"))
    grid = spark.range(frames).withColumnRenamed("id", "frame").join(times, "frame", "left").join(good, "frame", "left")
    return grid.select("frame", F.coalesce("_time", F.col("frame") / rate).alias("t"), *[F.col(f"_v.{c}").alias(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")], F.col("_v").isNotNull().alias("valid"))


def read_imu(spark: SparkSession, path: str) -> DataFrame:
    return _typed(_text(spark, path), {"frame": "bigint", "qw": "double", "qx": "double", "qy": "double", "qz": "double"})


def read_claw(spark: SparkSession, path: str) -> DataFrame:
    """Opening angles; ``measured`` and ``confidence`` are 1 where the file lacks them."""
    d = _typed(_text(spark, path), {c: "double" for c in ("time_s", "opening_angle_deg", "joint1_deg", "joint2_deg", "measured", "confidence")})
    return d.withColumns({c: F.coalesce(c, F.lit(1.0)) for c in ("measured", "confidence")})


def read_tag_map(spark: SparkSession, path: str, tolerance: float = 0.02) -> DataFrame:
    """(id, center_m, corners_m) of a board file; raises if ids repeat or a tag is not square within ``tolerance``.

    A board is a small dimension table, so it is checked at once.
    """
    tag = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("center_m", T.ArrayType(T.DoubleType())), T.StructField("corners_m", T.ArrayType(T.ArrayType(T.DoubleType())))])
    d = spark.read.schema(T.StructType([T.StructField("tags", T.ArrayType(tag))])).json(path, multiLine=True)
    d = d.select(F.inline("tags"))
    at = lambda i, k: F.get(F.get("corners_m", F.lit(i)), F.lit(k))
    edge = F.array(*[F.sqrt(sum((at(i, k) - at((i + 1) % 4, k)) * (at(i, k) - at((i + 1) % 4, k)) for k in range(3))) for i in range(4)])
    low, high = F.array_min(edge), F.array_max(edge)
    bad = d.withColumn("_ok", (F.size("corners_m") == 4) & (high - low <= tolerance * high)).filter(~F.coalesce("_ok", F.lit(False)))
    again = d.groupBy("id").count().filter("count > 1 OR id IS NULL")
    if bad.limit(1).count() or again.limit(1).count():
        raise ValueError("a tag is not square, or an id is repeated or missing")
    return d


def read_matrix(spark: SparkSession, path: str) -> list[list[float]]:
    """A 4x4 matrix from JSON, bare or under ``matrix``; a fixed small size, so it comes to the driver."""
    import json

    m = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    m = m.get("matrix", m) if isinstance(m, dict) else m
    if len(m) != 4 or any(len(r) != 4 for r in m):
        raise ValueError("not a 4x4 matrix")
    return [[float(v) for v in r] for r in m]


def list_media(spark: SparkSession, roots: list[str], suffixes: tuple[str, ...] = ("osv", "lrf", "mp4")) -> DataFrame:
    """(path, length, modified) of the recordings under allowed folders, in order of their paths; contents are not read."""
    found = None
    for root in roots:
        d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", F.col("modificationTime").alias("modified"))
        found = d if found is None else found.unionByName(d)
    return found.filter(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*suffixes)).distinct().orderBy("path")


def read_mesh(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(path, triangle, corner, x, y, z) of binary STL files; with ``most`` every so many-th triangle, so that about that many of each stay.

    Triangles are cut out of the file's bytes as columns, a fixed 50 bytes each after a head of 84.
    """
    import numpy as np
    import pyarrow as pa

    from posegrain.session import map_rows

    kind = np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("rest", "<u2")])

    def cut(batches):
        for batch in batches:
            for path_, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = int.from_bytes(content[80:84], "little")
                if len(content) < 84 + 50 * n:
                    raise ValueError(f"{path_} is cut short")
                at = np.arange(0, n, max(1, n // most) if most else 1)
                c = np.frombuffer(content, kind, n, 84)["corners"][at].reshape(-1, 3).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array([path_] * len(c)), pa.array(np.repeat(at, 3)), pa.array(np.tile(np.arange(3, dtype=np.int32), len(at))), *[pa.array(np.ascontiguousarray(c[:, i])) for i in range(3)]], ["path", "triangle", "corner", "x", "y", "z"])

    return map_rows(spark.read.format("binaryFile").load(path).select("path", "content"), cut, "path string, triangle long, corner int, x double, y double, z double")


def stream_poses(spark: SparkSession, folder: str, files_at_once: int = 16) -> DataFrame:
    """Pose tables as they arrive in a folder, as a stream; numbers are read as in ``read_poses``."""
    raw = spark.readStream.schema(", ".join(f"{c} string" for c in POSE)).option("header", "true").option("maxFilesPerTrigger", str(files_at_once)).csv(folder)
    return _typed(raw, POSE)


def require_exported(path: str) -> str:
    """``path``, or an error where it names a raw recording: those are stitched and exported by their makers' tools, not guessed at."""
    from posegrain.functions.views import DJI_SUFFIX, INSTA_SUFFIX

    if path.lower().endswith((*DJI_SUFFIX, *INSTA_SUFFIX)):
        raise ValueError(f"{path} is a raw recording; export it first")
    return path
