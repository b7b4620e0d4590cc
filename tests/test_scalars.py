"""Scalar expressions with golden values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framemill.functions import datasets, scalar
from framemill.functions.scalar import from_codes
from framemill.functions.standardise import DECODES_LANGUAGE, DEPTH, MOVES_LANGUAGE, STANDARDS, Term, standardise
from framemill.operators import layout, orchestration


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("h", "w", "want"),
    [(1280, 720, (341, 192, 320, 192)), (720, 1280, (192, 341, 192, 320)), (480, 640, (192, 256, 192, 256)), (640, 480, (256, 192, 256, 192))],
)
def test_resize_geometry(spark, h, w, want):
    # These goldens belong to crops in multiples of 64.
    assert tuple(one(spark, scalar.resize_geometry(F.lit(h), F.lit(w), multiple=64))) == want


def test_resize_geometry_that_cannot_fit(spark):
    assert one(spark, scalar.resize_geometry(F.lit(32), F.lit(4096), multiple=64)) is None
    assert one(spark, scalar.resize_geometry(F.lit(0), F.lit(10))) is None
    assert tuple(one(spark, scalar.resize_geometry(F.lit(64), F.lit(64), multiple=64)))[2:] == (64, 64)


@pytest.mark.parametrize(("text", "want"), [("30", 30.0), ("30000/1001", 30000 / 1001), ("1/0", None), ("a/b", None), ("", None), (None, None), ("1/2/3", None)])
def test_parse_rate(spark, text, want):
    assert one(spark, scalar.parse_rate(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("text", "want"), [("17-push_the_lid", "push the lid"), ("12-", "12-"), ("plain", "plain"), (None, None)])
def test_sentence(spark, text, want):
    assert one(spark, scalar.sentence(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("s", "want"), [(0.2, "0s"), (59.0, "59s"), (184.0, "3m04s"), (7500.0, "2h05m")])
def test_clock_text(spark, s, want):
    assert one(spark, scalar.clock_text(F.lit(s))) == want


def test_texts(spark):
    assert one(spark, scalar.scene_task(F.lit("/d/KITCHEN_SCENE3_open_it_demo.hdf5"))) == "open_it"
    assert one(spark, scalar.scene_task(F.lit("/d/open_it_demo.hdf5"))) == "open_it"
    assert one(spark, scalar.unwrapped(F.lit("tf.Tensor(b'go', shape=(), dtype=string)"))) == "go"
    assert one(spark, scalar.template_glob(F.lit("videos/{video_key}/chunk-{c:03d}/file-{f:03d}.mp4"), F.lit("cam"))) == "videos/cam/*/*.mp4"
    assert one(spark, scalar.from_codes(F.array(F.lit(104), F.lit(105), F.lit(0), F.lit(65)))) == "hi"
    assert one(spark, scalar.wall_clock(F.lit("1970-01-01T00-00-02_5"))) == 2_500_000
    assert one(spark, scalar.wall_clock(F.lit("nonsense"))) is None
    assert one(spark, scalar.nearest_name(F.lit("wokers"), ["workers", "files"])) == "workers"
    assert one(spark, scalar.nearest_name(F.lit("zzzzzzzzz"), ["workers", "files"])) is None
    assert one(spark, scalar.instruction(F.lit("  "), F.lit(None).cast("string"), F.lit("x"))) == "x"
    assert one(spark, scalar.listed_bytes(F.lit("Total Size: 42"))) == 42
    assert one(spark, scalar.significant(F.lit(1.23456789012345678))) == 1.23456789012


def test_sizing(spark):
    assert tuple(one(spark, scalar.parallelism(F.lit(3), F.lit(64)))) == (3, 16)
    assert tuple(one(spark, scalar.parallelism(F.lit(0), F.lit(8)))) == (8, 1)
    assert one(spark, scalar.episodes_per_task(F.lit(510.0), F.lit(135), F.lit(64), 2500)) == 1
    assert one(spark, scalar.episodes_per_task(F.lit(None).cast("double"), F.lit(135), F.lit(64), 2500)) == 100
    assert one(spark, scalar.size_ratio_ok(F.lit(110.0), F.lit(100.0))) is True
    assert one(spark, scalar.size_ratio_ok(F.lit(10.0), F.lit(0.0))) is True


def test_overlay_keeps_an_explicit_null(spark):
    m = lambda **k: F.create_map(*[x for a, b in k.items() for x in (F.lit(a), F.lit(b).cast("string"))])
    assert one(spark, scalar.overlay(m(a="1", b="2"), m(b=None), F.lit(None).cast("map<string,string>"))) == {"a": "1", "b": None}


def test_constant_block(spark):
    assert one(spark, scalar.constant_block(F.array(F.lit(1.0), F.lit(1.0 + 1e-12))))
    assert not one(spark, scalar.constant_block(F.array(F.lit(1.0), F.lit(1.1))))


def test_quaternion(spark):
    assert list(one(spark, scalar.quaternion_euler(F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])))) == pytest.approx([0, 0, 0])
    half = 0.5**0.5
    assert list(one(spark, scalar.quaternion_euler(F.array(*[F.lit(x) for x in (0.0, 0.0, half, half)])))) == pytest.approx([0, 0, 1.5707963], abs=1e-6)


def test_slots(spark):
    slots = layout.slots_of([("a", 2, "x", 3), ("pad", 2, None, 0), ("b", 1, "y", 0)])
    assert slots == [("x", 3), ("x", 4), None, None, ("y", 0)]
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0, 4.0], [9.0]), ([0.0], None)], "x array<float>, y array<float>")
    assert [list(r[0]) for r in df.select(layout.assemble(slots)).collect()] == [[3.0, 4.0, 0.0, 0.0, 9.0], [0.0] * 5]


def test_sixty_standards():
    assert len(STANDARDS) == 60
    assert STANDARDS["libero"].action[1] == Term("action", -1, None, ("inv", "clip"))
    assert STANDARDS["bc_z"].action[0] == Term("action.future/xyz_residual", 0, 3)
    assert set(MOVES_LANGUAGE) | set(DECODES_LANGUAGE) | {d[0] for d in DEPTH} <= set(STANDARDS)


def test_datasets_by_name(spark):
    assert sum(d.standard is not None for d in datasets.DATASETS.values()) == 73 and {d.standard for d in datasets.DATASETS.values()} - {None} == set(STANDARDS)
    assert sum(d.parts is not None for d in datasets.DATASETS.values()) == 70
    assert datasets.dataset("fractal20220817_data").standard == "rt1" and datasets.dataset("libero_10_no_noops").fps == 20
    assert datasets.dataset("stanford_mask_vit_converted_externally_to_rlds").fps is None
    with pytest.raises(KeyError, match="libero_goal_no_noops"):
        datasets.dataset("libero_11")
    rows = {r["dataset"]: r for r in datasets.dataset_table(spark).collect()}
    assert rows["berkeley_cable_routing"]["state_names"][-1] == "pad" and rows["libero_10_no_noops"]["state_names"][3] == "axis_angle1"
    assert rows["roboset"]["action_names"][0] == "motor_0" and rows["ppgm"]["state_names"] is None


def test_from_codes(spark):
    df = spark.createDataFrame([([0x41, 0xE9, 0xAC00, 0x1F600, 0, 0x42],), ([],), (None,), ([0, 65],), ([65, None, 0xD800],)], "c array<int>")
    assert [r[0] for r in df.select(from_codes(F.col("c"))).collect()] == ["A\u00e9\uac00\U0001f600", "", None, "", "A\ufffd\ufffd"]


def test_standardise_with_dotted_columns(spark):
    schema = "episode_index bigint, frame_index bigint, action struct<world_vector:array<float>,rotation_delta:array<float>,open_gripper:array<float>>, observation struct<state:array<float>>"
    rows = [(1, i, ([1.0, 2.0, 3.0], [0.0] * 3, [1.0]), ([float(i)] * 7,)) for i in range(4)]
    out = standardise(spark.createDataFrame(rows, schema), "bridge_oxe").orderBy("frame_index").collect()
    assert [(r["frame_index"], list(r["action"])) for r in out] == [(i, [1.0] * 6 + [1.0]) for i in (1, 2)]
    assert list(out[0]["EEF_state"]) == [1.0] * 6 and list(out[0]["gripper_state"]) == [1.0]


def test_usable_class(spark):
    kind = lambda *present: one(spark, orchestration.usable_class(F.array(*[F.lit(p) for p in present]).cast("array<string>"), ["a", "b"], ["c"]))
    assert (kind(), kind("c"), kind("a"), kind("a", "z"), kind("a", "b", "c")) == ("empty", "empty", "partial", "wrong_config", None)
