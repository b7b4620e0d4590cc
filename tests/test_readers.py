"""Raw releases, record files and declarations, without their libraries."""

from __future__ import annotations

import io
import json
import math

import pytest
from pyspark.sql import functions as F

from framemill.functions import scalar
from framemill.operators import orchestration
from framemill.sources import files, layouts, specs, tfrecord, trees


def touch(path, text=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_discover(spark, tmp_path):
    for p in ("a/data/robot/t 1/success_episodes/s1/data/x.hdf5", "a/data/robot/t 1/success_episodes/s1/data/note.txt", "a/data/robot/t2/failed_episodes/s/data/x.hdf5", "a/data/robot/t2/success_episodes/s/x.hdf5", "b/data/robot/t3/success_episodes/s/data/y.hdf5", "b/other/robot/t/success_episodes/s/data/y.hdf5"):
        touch(tmp_path / p, "123")
    found = trees.discover(spark, [f"{tmp_path}/b", f"{tmp_path}/a/", f"{tmp_path}/a", f"{tmp_path}/none"]).collect()
    assert sorted((r["root"].rsplit("/", 1)[1], r["embodiment"], r["task"], r["stamp"], r["length"]) for r in found) == [("a", "robot", "t 1", "s1", 3), ("b", "robot", "t3", "s", 3)]
    assert trees.discover(spark, []).count() == 0


def test_dataset_root(tmp_path):
    touch(tmp_path / "one/inner/meta/info.json")
    touch(tmp_path / "one/other/x")
    for c in ("c", "d"):
        touch(tmp_path / f"two/{c}/meta/info.json")
    assert trees.dataset_root(f"{tmp_path}/one/inner") == f"{tmp_path}/one/inner"
    assert trees.dataset_root(f"{tmp_path}/one") == f"{tmp_path}/one/inner"
    assert trees.dataset_root(f"{tmp_path}/two") == f"{tmp_path}/two"


def test_task_info(spark, tmp_path):
    entries = [{"episode_id": 5, "task_name": "fold", "label_info": {"action_config": [{"start_frame": 0, "end_frame": 9, "action_text": "reach", "skill": "move"}]}}, {"episode_id": 2, "task_name": "fold"}]
    touch(tmp_path / "task_327.json", json.dumps(entries, indent=1))
    touch(tmp_path / "task_9.json", "no json [")
    info = trees.task_info(spark, str(tmp_path))
    assert sorted((r["task_id"], r["episode_id"]) for r in info.collect()) == [("327", 2), ("327", 5)]
    assert [tuple(r) for r in trees.task_actions(info).collect()] == [("327", 5, 0, 0, 9, "reach", "move")]


def test_stream_reasons(spark):
    lengths = spark.createDataFrame([(e, 10) for e in range(6)], "episode_index long, n_frames long")
    good = lambda e, n=10: [(e, "a", n, 3, 1), (e, "b", 10, 1, 1)]
    rows = [*good(0), (1, "a", 10, 3, 1), (2, "a", 10, 2, 1), (2, "b", 9, 1, 1), *good(3, 8), (4, "a", 10, 3, 2), (4, "b", 10, 1, 1), (0, "z", 1, 9, 9)]
    streams = spark.createDataFrame(rows, "episode_index long, stream string, n_rows long, width int, widths long")
    got = {r["episode_index"]: r["reason"] for r in trees.stream_reasons(lengths, streams, {"a": 3, "b": 1}).collect()}
    assert got == {0: None, 1: "b is absent", 2: "a is 2 wide, expected 3", 3: "length mismatch against 10 camera frames: a=8", 4: "a is 3 wide, expected 3", 5: "a is absent"}


def test_checksum_of_a_known_text():
    crc = tfrecord.masked_crc(b"123456789")  # CRC-32C 0xE3069283
    plain = (crc - tfrecord.MASK) & 0xFFFFFFFF
    assert (plain << 15 | plain >> 17) & 0xFFFFFFFF == 0xE3069283


def test_examples_survive():
    example = {"f": ("floats", [1.5, -2.0]), "i": ("ints", [0, -1, 1 << 40, 127, 128]), "b": ("bytes", [b"", "é".encode()]), "none": ("ints", [])}
    assert tfrecord.parse_example(tfrecord.make_example(example)) == example
    # One value a field, as some writers have them: feature i, an integer list of 3 and -1.
    loose = bytes.fromhex("0a17 0a15 0a01 69 1210 1a0e 0803 08ffffffffffffffffff01".replace(" ", ""))
    loose = b"\x0a" + bytes([len(loose) - 2]) + loose[2:]
    assert tfrecord.parse_example(loose)["i"] == ("ints", [3, -1])


@pytest.mark.parametrize(("damage", "match"), [(lambda d: d[:-1], "cut short"), (lambda d: b"\1" + d[1:], "length"), (lambda d: d[:14] + b"!" + d[15:], "content"), (lambda d: d + b"abc", "length")])
def test_damaged_records(damage, match):
    data = tfrecord.framed(b"hello") + tfrecord.framed(b"world")
    assert list(tfrecord.records(io.BytesIO(data).read, True)) == [b"hello", b"world"]
    with pytest.raises(tfrecord.RecordError, match=match):
        list(tfrecord.records(io.BytesIO(damage(data)).read, True))


def test_record_files(spark, tmp_path):
    rows = [(1, [1.0, 2.0], "a"), (2, [], None), (None, None, "")]
    df = spark.createDataFrame(rows, "i long, f array<float>, s string").repartition(2)
    assert sum(r["n_records"] for r in tfrecord.write_examples(df, str(tmp_path)).collect()) == 3
    back = [r["features"] for r in tfrecord.read_examples(spark, str(tmp_path), ".tfrecord").collect()]
    assert sorted((tuple(f["i"]["ints"]), tuple(f["f"]["floats"]), [bytes(b) for b in f["s"]["bytes"]]) for f in back) == [((), (), [b""]), ((1,), (1.0, 2.0), [b"a"]), ((2,), (), [])]


def test_edited_info():
    info = {"layout": "episodes", "fps": 10, "total_episodes": 1001, "total_chunks": 2, "total_videos": 2002, "chunks_size": 1000, "features": {"a": {"dtype": "video"}, "b": {"dtype": "video"}, "c": {"dtype": "float32"}}}
    packed = layouts.edited_info(info, "packed", 7)
    assert packed["data_files_size_in_bytes"] == 7 and packed["fps"] == 10 and not {"total_chunks", "total_videos"} & set(packed)
    assert layouts.edited_info(packed, "episodes") == info | {"data_path": layouts.EPISODE_FILE}


def test_declarations_of_all_kinds():
    assert specs.parse_layout('{"order": ["a", "b"]}') == ("a", "b")
    for bad in ('{"order": []}', '{"order": ["a", "a"]}', '{"order": "ab"}', '{"other": 1}', "[1]"):
        with pytest.raises(specs.SpecError):
            specs.parse_layout(bad)
    assert specs.parse_environment('{"name": "n", "runtime": {"workers": 4}, "batch": {"max_datasets": 2}}')["runtime"]["workers"] == 4
    with pytest.raises(specs.SpecError, match="profile"):
        specs.parse_environment('{"runtime": {"crf": 23}}')
    for bad in ('{"runtime": {"x": 1}}', '{"builders": {"b": 1}}', '{"batch": {"x": 1}}', '{"runtime": [1]}'):
        with pytest.raises(specs.SpecError):
            specs.parse_environment(bad)
    assert specs.parse_profile('{"crf": null}') == {"crf": None}
    whole = {"name": "p", "source": {"path": "/a"}, "dest": {"path": "/b"}}
    assert specs.parse_pipeline(json.dumps(whole))["name"] == "p"
    for change in ({"name": " "}, {"dest": {"path": "/a"}}, {"source": {}}, {"runtime": {"crf": 1}}, {"zzz": 1}):
        with pytest.raises(specs.SpecError):
            specs.parse_pipeline(json.dumps(whole | change))
    with pytest.raises(specs.SpecError, match="there is no"):
        specs.read_text("/nonexistent/x.json")


def test_worker_share(spark):
    share = lambda w, n: spark.range(1).select(orchestration.worker_share(F.lit(w).cast("long"), F.lit(n)).alias("x")).first()["x"]
    assert (share(48, 5), share(3, 10), share(48, 1), share(48, 0), share(None, 3), share(0, 3)) == (10, 1, 48, 48, None, None)


def test_mirror_is_all_or_nothing(spark, tmp_path):
    touch(tmp_path / "a/x/1", "one")
    touch(tmp_path / "a/2", "two")
    touch(tmp_path / "full/y", "kept")
    assert files.mirror(spark, f"{tmp_path}/a", f"{tmp_path}/b") == 2
    assert (tmp_path / "b/x/1").read_text() == "one" and (tmp_path / "b/2").stat().st_nlink == 2
    assert files.mirror(spark, f"{tmp_path}/a", f"{tmp_path}/c", link=False) == 2 and (tmp_path / "c/2").stat().st_nlink == 1
    with pytest.raises(FileExistsError):
        files.mirror(spark, f"{tmp_path}/a", f"{tmp_path}/full")
    assert [p.name for p in (tmp_path / "full").iterdir()] == ["y"]
    assert files.mirror(spark, f"{tmp_path}/none", f"{tmp_path}/d") == 0


def test_geometry(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    q = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    half = 0.5**0.5
    assert one(scalar.quaternion_axis_angle(q(half, 0, 0, half))) == pytest.approx([math.pi / 2, 0, 0])
    assert one(scalar.quaternion_axis_angle(q(0, 0, 0, 1.0000001))) == [0, 0, 0]
    assert one(scalar.camera_matrix(F.lit(90.0), F.lit(100.0), F.lit(200.0)))[0] == pytest.approx([50, 0, 100])
    pose = one(scalar.camera_pose(q(7, 8, 9), q(1, 0, 0, 0, 1, 0, 0, 0, 1)))
    assert [list(r) for r in pose] == [[1, 0, 0, 7], [0, -1, 0, 8], [0, 0, -1, 9], [0, 0, 0, 1]]
