"""Names of a vector's elements by its encoding, and feature descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Encodings of states and actions, and the names of their elements; under ``axis angle`` where a dataset has those.
STATE_ENCODINGS = {"NONE": -1, "POS_EULER": 1, "POS_QUAT": 2, "JOINT": 3, "JOINT_BIMANUAL": 4}
ACTION_ENCODINGS = {"EEF_POS": 1, "JOINT_POS": 2, "JOINT_POS_BIMANUAL": 3, "EEF_R6": 4, "EEF_POS_QUAT": 5}
MOTORS = "motor_0 motor_1 motor_2 motor_3 motor_4 motor_5 motor_6 motor_7"
STATE_NAMES = {
    "POS_EULER": "x y z roll pitch yaw pad gripper",
    "POS_EULER axis angle": "x y z axis_angle1 axis_angle2 axis_angle3 gripper gripper",
    "POS_QUAT": "x y z rx ry rz rw gripper",
    "JOINT": "motor_0 motor_1 motor_2 motor_3 motor_4 motor_5 motor_6 gripper",
}
ACTION_NAMES = {
    "EEF_POS": "x y z roll pitch yaw gripper",
    "EEF_POS axis angle": "x y z axis_angle1 axis_angle2 axis_angle3 gripper",
    "JOINT_POS": "motor_0 motor_1 motor_2 motor_3 motor_4 motor_5 motor_6 gripper",
}


def _named(table: dict[str, str], encoding: str, axis_angle: bool) -> list[str]:
    wanted = [f"{encoding} axis angle"] * axis_angle + [encoding]
    return next((table[k] for k in wanted if k in table), MOTORS).split()


def padded(names: list[str], parts: list[str | None]) -> list[str]:
    """Joint names where the last joints that no column gives are ``pad``, and so is the gripper if it lacks its column, the last of ``parts``."""
    joints, gripper = names[:-1], names[-1]
    there = len(joints) - sum(p is None for p in parts[:-1])
    return [n if i < there else "pad" for i, n in enumerate(joints)] + [gripper if parts[-1] is not None else "pad"]


def state_names(encoding: str, parts: list[str | None], axis_angle: bool = False) -> list[str]:
    """Names of the eight state elements; ``parts`` are the columns they come from, None for one that isn't there."""
    names = _named(STATE_NAMES, encoding, axis_angle)
    return padded(names, parts) if encoding == "JOINT" else names


def action_names(encoding: str, axis_angle: bool = False) -> list[str]:
    """Names of the action's elements."""
    return _named(ACTION_NAMES, encoding, axis_angle)


def vector_feature(names: list[str]) -> dict:
    """Description of a float vector feature."""
    return {"dtype": "float32", "shape": [len(names)], "names": {"motors": names}}


def described(df: DataFrame, features: dict[str, dict]) -> DataFrame:
    """``df`` whose columns carry their feature's shape and names as metadata."""
    return df.select(*[df[c].alias(c, metadata={"shape": features[c]["shape"], "names": str(features[c]["names"])}) if c in features else df[c] for c in df.columns])


def inferred(schema: T.StructType) -> dict[str, dict]:
    """Features as far as a schema tells: vectors as float32 of unknown width, scalars of shape 1."""
    out = {}
    for f in schema:
        array = isinstance(f.dataType, T.ArrayType)
        out[f.name] = {"dtype": "float32" if array else f.dataType.simpleString(), "shape": f.metadata.get("shape", [-1]) if array else [1], "names": None}
    return out
