"""Column standardisation of raw trajectories, dataset by dataset, as a table of expressions.

Each line says what a dataset's action and further columns are made of. A term is ``function(function(source[slice]))``;
terms are concatenated. Sources are dotted raw columns; slices are Python's, by element.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.functions.scalar import from_codes, quaternion_euler

# Name | action | other columns. ``r2a`` carries a relative gripper, ``bin`` decides a continuous one, ``inv`` is
# 1 - x, ``clip`` bounds to [0, 1], ``like0`` gives as many zeros, ``euler`` turns a quaternion, 0*n and 1*n are constants.
# ``first`` drops the first frame, ``reach`` relabels the action from the states reached.
TABLE = """
droid_baseact | action_dict.cartesian_velocity[0:3] action_dict.cartesian_velocity[3:6] inv(action_dict.gripper_position) | EEF_state=observation.cartesian_position gripper_state=observation.gripper_position
droid_finetuning | action_dict.cartesian_velocity[0:3] action_dict.cartesian_velocity[3:6] inv(action_dict.gripper_position) | proprio=observation.cartesian_position,observation.gripper_position
bridge_oxe | action.world_vector action.rotation_delta action.open_gripper | EEF_state=observation.state[0:6] gripper_state=observation.state[-1:] ; first reach
bridge_orig | action[0:6] bin(action[-1:]) | EEF_state=observation.state[0:6] gripper_state=observation.state[-1:] ; first reach
ppgm | action[0:6] bin(action[-1:]) | EEF_state=observation.cartesian_position[0:6] gripper_state=observation.gripper_position[-1:]
rt1 | action.world_vector action.rotation_delta r2a(action.gripper_closedness_action[0:1]) |
kuka | action.world_vector action.rotation_delta r2a(action.gripper_closedness_action[0:1]) |
taco_play | action.rel_actions_world[0:6] clip(action.rel_actions_world[-1:]) | state_eef=observation.robot_obs[0:6] state_gripper=observation.robot_obs[7:8]
jaco_play | action.world_vector like0(action.world_vector) r2a(action.gripper_closedness_action[0:1]) | state_eef=observation.end_effector_cartesian_pos[0:6] state_gripper=observation.end_effector_cartesian_pos[-1:]
berkeley_cable_routing | action.world_vector action.rotation_delta 0*1 |
roboturk | action.world_vector action.rotation_delta inv(clip(action.gripper_closedness_action)) |
nyu_door_opening | action.world_vector action.rotation_delta r2a(action.gripper_closedness_action[0:1]) |
viola | action.world_vector action.rotation_delta inv(clip(action.gripper_closedness_action)) |
berkeley_autolab_ur5 | action.world_vector action.rotation_delta r2a(action.gripper_closedness_action) | state=observation.robot_state[6:14]
toto | action.world_vector action.rotation_delta action.open_gripper |
language_table | action like0(action) like0(action) 1*1 |
pusht | action.world_vector action.rotation_delta action.gripper_closedness_action |
stanford_kuka_multimodal | action[0:3] 0*3 action[-1:] |
nyu_rot | action[0:7] | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
stanford_hydra | action[0:6] inv(action[-1:]) | eef_state=observation.state[0:3],observation.state[7:10] gripper_state=observation.state[-3:-2]
austin_buds | action[0:6] inv(clip(action[-1:])) | state=observation.state[0:8]
nyu_franka_play | action[-8:-2] clip(action[-2:-1]) | eef_state=observation.state[-6:]
maniskill | action | gripper_state=observation.state[7:8]
furniture_bench | action[0:3] euler(action[3:7]) inv(clip(action[-1:])) | state=observation.state[0:7],observation.state[-1:]
cmu_franka_exploration | action[:-1] |
ucsd_kitchen | action[:-1] | joint_state=observation.state[0:7]
ucsd_pick_place | action[0:3] 0*3 action[-1:] | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
austin_sailor | action[0:6] inv(clip(action[-1:])) |
austin_sirius | action[0:6] inv(clip(action[-1:])) |
bc_z | action.future/xyz_residual[0:3] action.future/axis_angle_residual[0:3] inv(action.future/target_close[0:1]) |
tokyo_pr2_opening_fridge | action[:-1] | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
tokyo_pr2_tabletop | action[:-1] | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
utokyo_xarm_pick_place | action |
utokyo_xarm_bimanual | action[-7:] |
robo_net | action[0:4] 0*2 action[-1:] | eef_state=observation.state[0:4],0*2 gripper_state=observation.state[-1:]
berkeley_mvp | action | gripper=observation.gripper
berkeley_rpt | action | gripper=observation.gripper
kaist_nonprehensible | action[0:6] 0*1 | state=observation.state[-7:]
stanford_mask_vit | action[0:4] 0*2 action[-1:] | eef_state=observation.end_effector_pose[0:4],0*2 gripper_state=observation.end_effector_pose[-1:]
tokyo_lsmo | action | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
dlr_sara_pour | action |
dlr_sara_grid_clamp | action | state=observation.state[0:6]
dlr_edan_shared_control | action[0:6] inv(action[-1:]) |
asu_table_top | action | eef_state=ground_truth_states.EE gripper_state=observation.state[-1:]
robocook | action | eef_state=observation.state[0:6] gripper_state=observation.state[-1:]
imperial_wristcam | action[:-1] |
iamlab_pick_insert | action[0:3] euler(action[3:7]) action[7:8] | joint_state=observation.state[0:7] gripper_state=observation.state[7:8]
uiuc_d3field | action like0(action) 0*1 |
utaustin_mutex | action[0:6] inv(clip(action[-1:])) | state=observation.state[0:8]
berkeley_fanuc | action inv(observation.state[6:7]) | joint_state=observation.state[0:6] gripper_state=observation.state[6:7]
cmu_playing_with_food | action[0:3] euler(action[3:7]) action[-1:] |
playfusion | action[0:3] action[-4:] |
cmu_stretch | action[:-1] | eef_state=observation.state[0:3],0*3 gripper_state=observation.state[-1:]
gnm | action like0(action) like0(action) 0*1 | state=observation.position,0*3,observation.yaw
fmb | action | proprio=observation.eef_pose,observation.state_gripper_pose
dobbe | action | EEF_state=observation.state[0:6] gripper_state=observation.state[-1:]
roboset | action[0:7] inv(clip(action[-1:])) | proprio=observation.state
rh20t | action.tcp_base action.gripper | proprio=observation.tcp_base,observation.gripper_width
tdroid | action[0:6] bin(action[-1:]) | EEF_state=observation.cartesian_position[0:6] gripper_state=observation.gripper_position[-1:]
libero | action[0:6] inv(clip(action[-1:])) | EEF_state=observation.state[0:6] gripper_state=observation.state[-2:]
"""

_TERM = re.compile(r"(?P<fns>(?:(?:inv|clip|r2a|bin|like0|euler)\()*)(?P<src>[A-Za-z0-9_./]+)(?:\[(?P<lo>-?\d*):(?P<hi>-?\d*)\])?\)*$")


@dataclass(frozen=True)
class Term:
    """A part of a vector: a constant block (``source`` None), or a slice of a source with functions applied, innermost last."""

    source: str | None
    lo: int | None = None
    hi: int | None = None
    functions: tuple[str, ...] = ()
    constant: float = 0.0
    count: int = 0


@dataclass(frozen=True)
class Standard:
    """How one dataset's columns are made."""

    name: str
    action: list[Term]
    columns: dict[str, list[Term]] = field(default_factory=dict)
    steps: tuple[str, ...] = ()


def _term(text: str) -> Term:
    if "*" in text:
        value, count = text.split("*")
        return Term(None, constant=float(value), count=int(count))
    m = _TERM.match(text)
    number = lambda g: int(m[g]) if m[g] else None
    return Term(m["src"], number("lo"), number("hi"), tuple(f for f in m["fns"].split("(") if f))


def _parse(line: str) -> Standard:
    name, action, rest = (x.strip() for x in line.split("|"))
    columns, _, steps = rest.partition(";")
    made = dict(c.split("=", 1) for c in columns.split())
    return Standard(name, [_term(t) for t in action.split()], {k: [_term(t) for t in v.split(",")] for k, v in made.items()}, tuple(steps.split()))


STANDARDS = {s.name: s for s in map(_parse, TABLE.strip().splitlines())}
Resolve = Callable[[str], Column]


def sources(standard: Standard) -> list[str]:
    """The raw columns that a standard reads, in order."""
    terms = [*standard.action, *[t for c in standard.columns.values() for t in c]]
    return list(dict.fromkeys(t.source for t in terms if t.source))


def _sliced(c: Column, lo: int | None, hi: int | None) -> Column:
    size = F.size(c)
    at = lambda i, default: default if i is None else F.lit(i) if i >= 0 else F.greatest(size + i, F.lit(0))
    begin, end = at(lo, F.lit(0)), F.least(at(hi, size), size)
    return c if lo is None and hi is None else F.slice(c, begin + 1, F.greatest(end - begin, F.lit(0)))


def _applied(c: Column, function: str) -> Column:
    one = F.lit(1.0).cast("float")
    if function == "inv":
        return F.transform(c, lambda x: one - x)
    if function == "clip":
        return F.transform(c, lambda x: F.when(x < 0, F.lit(0.0).cast("float")).when((x > 1) & ~F.isnan(x), one).otherwise(x))
    if function == "like0":
        return F.transform(c, lambda x: F.lit(0.0).cast("float"))
    if function == "euler":
        return quaternion_euler(c).cast("array<float>")
    raise ValueError(function)


def vector(terms: list[Term], resolve: Resolve, scanned: dict[Term, str]) -> Column:
    """The concatenation of terms; ``scanned`` names columns that already hold the terms an ordered scan makes."""
    parts = []
    for t in terms:
        if t.source is None:
            parts.append(F.array_repeat(F.lit(t.constant).cast("float"), t.count))
        elif t in scanned:
            parts.append(F.array(F.col(scanned[t]).cast("float")))
        else:
            c = _sliced(resolve(t.source), t.lo, t.hi)
            for f in reversed(t.functions):
                c = _applied(c, f)
            parts.append(c)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def standardise(df: DataFrame, name: str, resolve: Resolve | None = None) -> DataFrame:
    """Frames with ``action`` and the other columns of the named standard added.

    ``df`` has ``episode_index, frame_index`` and the raw columns; vectors are ARRAY<FLOAT>. ``resolve`` gives the column of
    a dotted path, by default the column or field of that name. A null vector makes what it is part of null. The random swap
    of two cameras that one dataset has is left out: it isn't a function of the data.
    """
    from framemill.operators import scans

    standard = STANDARDS[name]
    resolve = resolve or F.col
    scanned: dict[Term, str] = {}
    if "first" in standard.steps:
        df = scans.drop_first(df)
    for i, t in enumerate(t for t in standard.action if {"r2a", "bin"} & set(t.functions)):
        scalar = F.get(_sliced(resolve(t.source), t.lo, t.hi), F.lit(0))
        scan = scans.relative_to_absolute if "r2a" in t.functions else scans.binarize
        df = scan(df.withColumn(f"__raw{i}", scalar), f"__raw{i}", f"__scan{i}").drop(f"__raw{i}")
        scanned[t] = f"__scan{i}"
    made = {k: vector(v, resolve, scanned) for k, v in standard.columns.items()}
    out = df.withColumns({"__action": vector(standard.action, resolve, scanned), **{f"__made_{k}": c for k, c in made.items()}})
    if "reach" in standard.steps:
        relabelled = scans.relabel_actions(out.withColumn("__state", resolve("observation.state")).withColumn("__grip", F.element_at("__action", -1)), "__state", "__grip", out="__reached")
        out = relabelled.drop("__action", "__state", "__grip").withColumnRenamed("__reached", "__action")
    names = {"__action": "action", **{f"__made_{k}": k for k in made}}
    keep = [c for c in df.columns if c not in names.values() and not c.startswith("__scan")]
    return out.select(*keep, *[F.col(c).alias(n) for c, n in names.items()])


#: Fixed value: the step's text where a standard moves it to ``language_instruction``.
LANGUAGE = "observation.natural_language_instruction"
# Standards that move it there; standards whose text is code points up to a NUL; and depth images: standard, new
# name, old name, and what is done to each pixel (``first`` takes its first channel, ``float`` makes it a float).
MOVES_LANGUAGE = (
    "bridge_oxe", "rt1", "kuka", "taco_play", "jaco_play", "berkeley_cable_routing", "roboturk", "nyu_door_opening", "viola",
    "berkeley_autolab_ur5", "toto", "pusht", "bc_z",
)
DECODES_LANGUAGE = {"language_table": "observation.instruction"}
DEPTH = (
    ("berkeley_autolab_ur5", "depth", "image_with_depth", ()),
    ("stanford_kuka_multimodal", "depth_image", "depth_image", ("first",)),
    ("nyu_franka_play", "depth", "depth", ("first", "float")),
    ("nyu_franka_play", "depth_additional_view", "depth_additional_view", ("first", "float")),
)


def language(name: str, resolve: Resolve = F.col) -> Column:
    """The instruction of a step under the named standard: moved, decoded, or as it is; an array of code points ends at its first NUL."""
    if name in MOVES_LANGUAGE:
        return resolve(LANGUAGE)
    return from_codes(resolve(DECODES_LANGUAGE[name])) if name in DECODES_LANGUAGE else resolve("language_instruction")


def depth_columns(name: str, resolve: Resolve = F.col) -> dict[str, Column]:
    """New depth columns of the named standard; an image is an array of pixels, a pixel an array of channels."""
    out = {}
    for standard, new, old, steps in DEPTH:
        if standard == name:
            image = resolve(f"observation.{old}")
            if "first" in steps:
                image = F.transform(image, lambda pixel: F.get(pixel, F.lit(0)))
            out[new] = F.transform(image, lambda x: x.cast("float")) if "float" in steps else image
    return out


def proprio(keys: list[Column | None]) -> Column:
    """State vector of the named parts; a part that isn't there is one zero, and no parts at all are eight."""
    if not keys:
        return F.array_repeat(F.lit(0.0).cast("float"), 8)
    zero = F.array(F.lit(0.0).cast("float"))
    return F.concat(*[zero if k is None else k for k in keys])
