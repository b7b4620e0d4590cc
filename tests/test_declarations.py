"""Declarations, feature names, registered steps, strategies."""

from __future__ import annotations

import json

import pytest

from framemill.functions import features
from framemill.operators.clocks import align
from framemill.plans import pipeline
from framemill.sources import specs

GOOD = {"dataset": "d", "fps": 30, "order": ["arm", "hand"], "state": [{"name": "arm", "width": 7, "source": "joints", "evidence": "measured"}, {"name": "hand", "width": 6, "evidence": "constant"}]}


def test_spec(spark):
    spec = specs.parse_spec(json.dumps(GOOD))
    assert specs.unbuildable(spec) == []
    table = specs.block_table(spark, [spec])
    assert table.count() == 4 and table.filter("side = 'action'").count() == 2


@pytest.mark.parametrize(
    ("change", "message"),
    [({"speed": 1}, "unknown speed"), ({"state": [{"name": "arm", "width": 1, "colour": 2}]}, "unknown colour"), ({"order": ["arm"]}, "hand"), ({"state": [{"name": "arm", "width": 1, "evidence": "guess"}], "order": []}, "guess")],
)
def test_bad_specs(change, message):
    with pytest.raises(specs.SpecError, match=message):
        specs.parse_spec(json.dumps(GOOD | change))


def test_a_block_without_ground(spark):
    spec = specs.parse_spec(json.dumps(GOOD | {"order": [], "state": [{"name": "tail", "width": 2}]}))
    assert specs.unbuildable(spec) == ["tail"]


def test_feature_names():
    assert features.state_names("JOINT", ["a", None, None]) == [*[f"motor_{i}" for i in range(6)], "pad", "pad"]
    assert features.state_names("POS_EULER", [])[-2:] == ["pad", "gripper"]
    assert features.state_names("NONE", []) == [f"motor_{i}" for i in range(8)]
    assert features.action_names("EEF_POS", axis_angle=True)[3] == "axis_angle1"
    assert features.vector_feature(["x", "y"])["shape"] == [2]


def test_described_columns(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1)], "v array<float>, n bigint")
    out = features.described(df, {"v": features.vector_feature(["x", "y"])})
    assert out.schema["v"].metadata["shape"] == [2]
    assert features.inferred(out.schema)["v"]["shape"] == [2] and features.inferred(out.schema)["n"]["dtype"] == "bigint"


def test_steps():
    assert pipeline.describe([("rename", {"columns": {"a": "a"}})]) == "nothing to do"
    assert pipeline.describe([("keep_from", {"first": 1}), ("rename", {"columns": {"a": "b"}})]) == "keep_from -> rename"
    with pytest.raises(ValueError, match="unknown step"):
        pipeline.plan([("other", {})])
    with pytest.raises(ValueError, match="twice"):
        pipeline.register_step("rename")(lambda: None)


def test_strategies():
    with pytest.raises(ValueError, match="unknown clock"):
        align("other")


def test_padded_joints():
    names = features.STATE_NAMES["JOINT"].split()
    assert features.padded(names, ["a", "b"]) == names
    assert features.padded(names, ["a", None, None, "g"]) == [*names[:5], "pad", "pad", "gripper"]
    assert features.padded(names, ["a", None]) == [*names[:7], "pad"]
    assert features.state_names("POS_EULER", [], axis_angle=True)[3:6] == ["axis_angle1", "axis_angle2", "axis_angle3"]
    assert features.state_names("JOINT_BIMANUAL", []) == features.action_names("EEF_R6") == features.MOTORS.split()
