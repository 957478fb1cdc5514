import json

import pytest
from pyspark.sql import functions as F

from posegrain.sources import readers, writers


def put(path, text):
    path.write_text(text)
    return str(path)


def test_poses_old_and_new(spark, tmp_path):
    head = "frame,timestamp,camera_x_m,camera_y_m,camera_z_m,roll_deg,pitch_deg,yaw_deg,raw_camera_x_m,raw_camera_y_m,raw_camera_z_m,detected_tag_count,inlier_count,reprojection_rmse_px,detected_ids,selected_view,quality_status\n"
    p = put(tmp_path / "a.csv", head + "0,0.000000,,,,,,,,,,20,,,,,insufficient_tags\n12,0.200200,1.5,2,3,0,0,90,1,1,1,6,6,0.4,3 4,h-090,valid\nx,junk,1,1,1,0,0,0,1,1,1,1,1,nan,,,valid\n")
    r = readers.read_poses(spark, p).orderBy(F.col("frame").asc_nulls_last()).collect()
    assert (r[0].camera_x_m, r[0].measurement_source, r[0].detected_tag_count) == (None, None, 20)
    assert (r[1].timestamp, r[1].yaw_deg, r[1].detected_ids) == (0.2002, 90.0, "3 4")
    assert r[2].frame is None and r[2].timestamp is None and r[2].reprojection_rmse_px is None


def test_trajectory_schemas(spark, tmp_path):
    a = put(tmp_path / "o.csv", "timestamp_s,optimized_x_m,optimized_y_m,optimized_z_m,optimized_qx,optimized_qy,optimized_qz,optimized_qw,camera_x_m\n1,1,2,3,0,0,0,2,9\n1,5,5,5,0,0,0,1,9\n2,,2,3,0,0,0,1,9\n")
    r = readers.read_trajectory(spark, a).collect()
    assert len(r) == 1 and (r[0].x, r[0].qw) == (1.0, 1.0)
    b = put(tmp_path / "c.csv", "timestamp,camera_x_m,camera_y_m,camera_z_m,roll_deg,pitch_deg,yaw_deg\n1,1,2,3,0,0,180\n")
    assert abs(readers.read_trajectory(spark, b).first().qz) == pytest.approx(1)
    with pytest.raises(ValueError):
        readers.read_trajectory(spark, put(tmp_path / "d.csv", "timestamp,foo\n1,2\n"))
    with pytest.raises(ValueError):
        readers.read_trajectory(spark, a, least=10)


def test_sessions_with_the_same_times_stay_apart(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    head = "timestamp,camera_x_m,camera_y_m,camera_z_m,roll_deg,pitch_deg,yaw_deg"
    put(folder / "a.csv", f"{head}\n1,1,2,3,0,0,0\n2,1,2,3,0,0,0\n")
    put(folder / "b.csv", f"{head}\n1,5,2,3,0,0,0\n2,5,2,3,0,0,0\n")
    assert readers.read_trajectory(spark, str(folder)).count() == 4
    named = put(tmp_path / "n.csv", f"session_id,{head},measurement_source\nu,1,1,2,3,0,0,0,direct\nv,1,1,2,3,0,0,0,optical_flow\nv,1,9,2,3,0,0,0,\n")
    assert {(r.session_id, r.x, r.direct) for r in readers.read_trajectory(spark, named).collect()} == {("u", 1.0, True), ("v", 1.0, False)}


def test_too_few_rows_are_refused(spark, tmp_path):
    rows = "".join(f"{i},{i}.5,1,2,3,0,0,0,{4 + i % 2},,{'' if i % 3 else 'direct'},valid\n" for i in range(24))
    p = put(tmp_path / "p.csv", "frame,timestamp,camera_x_m,camera_y_m,camera_z_m,roll_deg,pitch_deg,yaw_deg,detected_tag_count,detected_ids,measurement_source,quality_status\n" + rows)
    assert readers.read_valid_trajectory(spark, p).count() == 24 and readers.read_gated_trajectory(spark, p).count() == 24
    with pytest.raises(ValueError):
        readers.read_gated_trajectory(spark, p, min_tags=5)
    with pytest.raises(ValueError):
        readers.read_valid_trajectory(spark, p, least=25)


def test_motive(spark, tmp_path):
    p = put(tmp_path / "m.csv", "Format Version,1.2,Total Exported Frames,4,Export Frame Rate,100\n\nType,,Rigid\nFrame,Time (Seconds),X,Y,Z,W,X,Y,Z\n0,0.00,0,0,0,1,1000,2000,3000\n1,0.01,,,,,,,\n3,0.03,0,0,0,0.1,1,2,3\n")
    r = readers.read_motive(spark, p).orderBy("frame").collect()
    assert [x.valid for x in r] == [True, False, False, False] and (r[0].x, r[3].t) == (1.0, 0.03)
    p = put(tmp_path / "n.csv", "\n" * 60 + "Frame,Time (Seconds),X,Y,Z,W,X,Y,Z\n0,0.5,0,0,0,2,1000,2000,3000\n0,0.5,0,0,0,2,9000,2000,3000\n2,0.52,0,0,2,0,1,2,3\n")
    r = readers.read_motive(spark, p).orderBy("frame").collect()
    assert [(x.frame, x.valid) for x in r] == [(0, True), (1, False), (2, True)] and (r[0].x, r[0].t, r[0].qw, r[2].qz) == (1.0, 0.5, 1.0, 1.0)
    with pytest.raises(ValueError):
        readers.read_motive(spark, put(tmp_path / "o.csv", "0,1,2\n"))


def test_detections_tags_claw_matrix(spark, tmp_path):
    d = readers.read_detections(spark, put(tmp_path / "d.jsonl", json.dumps({"frame": 3, "timestamp": 0.5, "detected_ids": [1, 2], "views": [{"view": {"name": "h"}, "size": 640, "detections": [{"id": 1, "corners_px": [[0, 1]]}]}]}) + "\n"))
    assert d.select(F.explode("views").alias("v")).select("v.view.name", F.explode("v.detections.id").alias("id")).first() == ("h", 1)
    square = [[0, 1, 0], [1, 1, 0], [1, 0, 0], [0, 0, 0]]
    tag = lambda c, i=1: json.dumps({"tags": [{"id": i, "center_m": [0, 0, 0], "corners_m": c}]})
    assert readers.read_tag_map(spark, put(tmp_path / "t.json", tag(square))).count() == 1
    with pytest.raises(ValueError):
        readers.read_tag_map(spark, put(tmp_path / "u.json", tag([[0, 1.2, 0], *square[1:]])))
    c = readers.read_claw(spark, put(tmp_path / "c.csv", "time_s,opening_angle_deg,joint1_deg,joint2_deg\n0,1,2,3\n")).first()
    assert (c.measured, c.confidence) == (1.0, 1.0)
    assert readers.read_matrix(spark, put(tmp_path / "m.json", json.dumps([[1, 0, 0, 0]] * 4)))[0][0] == 1.0
    with pytest.raises(ValueError):
        readers.read_matrix(spark, put(tmp_path / "n.json", "[[1, 2]]"))


def test_mocap_and_imu(spark, tmp_path):
    p = put(tmp_path / "m.csv", "timestamp,x,y,z,qx,qy,qz,qw\n0,1000,0,0,0,0,0,1\n0,2000,0,0,0,0,0,1\n")
    d = readers.read_mocap(spark, p, millimetres=True)
    assert {r.x for r in d.collect()} == {1.0, 2.0} and readers.repeated_times(d).count() == 1
    with pytest.raises(ValueError):
        readers.read_mocap(spark, p, strict=True)
    turned = put(tmp_path / "l.csv", "timestamp,x,y,z,qx,qy,qz,qw\n0,1,0,0,0,0,0.70710678,0.70710678\n")
    r = readers.read_mocap(spark, turned, lever=(0.5, 0, 0)).first()
    assert (round(r.x, 6), round(r.y, 6)) == (1.0, 0.5)
    assert readers.read_imu(spark, put(tmp_path / "i.csv", "frame,qw,qx,qy,qz\n5,1,0,0,0\n")).first().frame == 5


def test_written_files_read_back(spark, tmp_path):
    d = spark.createDataFrame([(1, 0.1234567891, 0.5, [4, 3], True), (2, None, None, None, False)], "frame long, optimized_x_m double, timestamp_s double, ids array<int>, ok boolean")
    writers.write_dataset(d, str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).distinct().collect())
    assert lines[0] == "1,0.12345679,0.500000,3 4,1" and lines[1] == "2,,,,0"
    m = spark.createDataFrame([(1, 0.5, 2.0, 1), (2, 0.6, 3.0, 0)], "frame long, timestamp double, x_m double, valid int")
    writers.write_mocap(m, str(tmp_path / "mocap"))
    assert "2,0.6,,0" in [r.value for r in spark.read.text(str(tmp_path / "mocap")).collect()]
    writers.write_report(spark, {"n": 3}, str(tmp_path / "report"))
    assert json.loads(spark.read.text(str(tmp_path / "report")).first().value) == {"n": 3}


def test_media_and_meshes(spark, tmp_path):
    import numpy as np

    root = tmp_path / "media"
    (root / "deep").mkdir(parents=True)
    for n in ("b.MP4", "a.osv", "c.txt", "deep/d.lrf"):
        put(root / n, "x")
    assert [r.path.rsplit("/", 1)[1] for r in readers.list_media(spark, [str(root)]).collect()] == ["a.osv", "b.MP4", "d.lrf"]
    kind = np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("rest", "<u2")])
    mesh = np.zeros(10, kind)
    mesh["corners"] = np.arange(90).reshape(10, 3, 3)
    (tmp_path / "m.stl").write_bytes(b" " * 80 + (10).to_bytes(4, "little") + mesh.tobytes())
    d = readers.read_mesh(spark, str(tmp_path / "m.stl"))
    assert d.count() == 30 and d.filter("triangle = 9 AND corner = 2").first().z == 89.0
    assert readers.read_mesh(spark, str(tmp_path / "m.stl"), most=5).select("triangle").distinct().count() == 5
    writers.write_manifest(spark, str(tmp_path / "manifest"), readers.list_media(spark, [str(root)]), {"a": 1}, {"rows": 3})
    assert json.loads(spark.read.text(str(tmp_path / "manifest")).first().value)["inputs"][0]["bytes"] == 1


def test_evaluation_files(spark, tmp_path):
    pose = "struct<p:struct<x:double,y:double,z:double>,q:struct<x:double,y:double,z:double,w:double>>"
    one = ((1.0, 2.0, 3.0), (0.0, 0.0, 0.0, 1.0))
    m = spark.createDataFrame([("s", 5, 1.25, 1.5, "test", "MEASURED", 0.1, 2.0, one, one, True)], f"session_id string, frame long, t double, truth_t double, split string, status string, position_error_m double, orientation_error_deg double, truth {pose}, estimate {pose}, inlier boolean")
    writers.write_matched_errors(m, str(tmp_path / "m"))
    r = spark.read.csv(str(tmp_path / "m"), header=True).first()
    assert (r.timestamp_s, r.position_error_m, r.orientation_error_deg, r.truth_qw) == ("1.250000", "0.100000000", "2.000000", "1.0")
    writers.write_aligned(m.withColumnRenamed("truth", "e").withColumnRenamed("estimate", "aligned"), str(tmp_path / "a"))
    assert spark.read.csv(str(tmp_path / "a"), header=True).first().left_x_m == "1.00000000"
    c = spark.createDataFrame([("s", 0.01, 0.9, 0.8, None), ("s", -0.01, 0.7, 0.6, 0.5)], "session_id string, offset_s double, score double, speed_score double, turn_rate_score double")
    writers.write_offset_curve(c, str(tmp_path / "c"))
    assert [(r.offset_s, r.angular_correlation) for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == [("-0.010000", "0.500000"), ("0.010000", None)]
    writers.write_errors(m, m.select("session_id", "position_error_m"), str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e" / "report")).count() == 1


def test_streamed_poses(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    head = "frame,timestamp,camera_x_m,camera_y_m,camera_z_m,roll_deg,pitch_deg,yaw_deg,raw_camera_x_m,raw_camera_y_m,raw_camera_z_m,detected_tag_count,inlier_count,reprojection_rmse_px,detected_ids,selected_view,measurement_source,quality_status\n"
    put(src / "1.csv", head + "0,0.1,1,2,3,0,0,0,,,,2,2,0.5,3 4,h,direct,valid\n1,0.2,,,,,,,,,,1,,,4 9,h,,insufficient_tags\n")
    q = writers.stream_poses_to(readers.stream_poses(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "st")).start()
    q.processAllAvailable()
    put(src / "2.csv", head + "2,0.3,1,2,3,0,0,0,,,,2,2,0.5,5,h,direct,valid\n")
    q.processAllAvailable()
    q.stop()
    status = json.loads(spark.read.text(str(tmp_path / "st" / "status")).first().value)
    assert status == {"running": True, "processed_frames": 3, "pose_frames": 2, "seen_ids": [3, 4, 5, 9]}
    assert readers.read_poses(spark, str(tmp_path / "out" / "poses")).count() == 3


def test_largest_detection_of_a_tag(spark, tmp_path):
    from posegrain.operators.dedupe import largest_detections

    square = lambda n: [[0, 0], [n, 0], [n, n], [0, n]]
    seen = [{"id": 1, "corners_px": square(2)}, {"id": 1, "corners_px": square(3)}, {"id": 2, "corners_px": square(1)}, {"id": 1, "corners_px": [[5, 5], [8, 5], [8, 8], [5, 8]]}, {"id": 3, "corners_px": [[0, 1]]}]
    d = readers.read_detections(spark, put(tmp_path / "d.jsonl", json.dumps({"frame": 3, "timestamp": 0.5, "views": [{"view": {"name": "h"}, "detections": seen}]}) + "\n"))
    got = {r.id: r for r in largest_detections(d).collect()}
    assert set(got) == {1, 2} and got[1].area_px == 9.0 and got[1].corners_px[0] == [0.0, 0.0]


def test_raw_recordings_are_refused():
    assert readers.require_exported("a/b.mp4") == "a/b.mp4"
    for name in ("x.OSV", "y.insv", "z.lrv"):
        with pytest.raises(ValueError):
            readers.require_exported(name)
