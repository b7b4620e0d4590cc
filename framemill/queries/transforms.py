"""A query for each dataset's standardisation, over raw columns cut from the frames' vectors.

The SQL of each standard is written out by hand, with slices as numbers counted from 1, and knows nothing of the table
that the Spark side works from; the two share only which stretch of a vector stands in for which raw column.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions import datasets
from framemill.functions.standardise import STANDARDS, proprio, standardise
from framemill.registry import query
from framemill.views import FRAMES_SQL, frames

# Stand-ins of raw columns: SQL name, raw column, vector, first element (from 1), width. A vector that isn't 44 wide gives null.
STAND_INS = """
a action action_vec 10 8
wv action.world_vector action_vec 7 3
rd action.rotation_delta action_vec 5 3
gc action.gripper_closedness_action action_vec 5 1
og action.open_gripper action_vec 6 1
rel action.rel_actions_world action_vec 3 8
cv action_dict.cartesian_velocity action_vec 9 6
gp action_dict.gripper_position action_vec 7 1
xyz action.future/xyz_residual action_vec 2 30
aa action.future/axis_angle_residual action_vec 3 30
tc action.future/target_close action_vec 7 10
tcp action.tcp_base action_vec 1 6
ag action.gripper action_vec 3 1
s observation.state state_vec 6 14
cart observation.cartesian_position state_vec 2 6
grip observation.gripper_position state_vec 8 1
ro observation.robot_obs state_vec 6 8
eecp observation.end_effector_cartesian_pos state_vec 3 8
rs observation.robot_state state_vec 10 14
eep observation.end_effector_pose state_vec 9 8
gripper_part observation.gripper state_vec 1 1
gt ground_truth_states.EE state_vec 1 8
pos observation.position state_vec 5 2
yaw observation.yaw state_vec 10 1
eef observation.eef_pose state_vec 4 6
sgp observation.state_gripper_pose state_vec 11 1
otcp observation.tcp_base state_vec 2 6
gw observation.gripper_width state_vec 4 1
"""
_RAW = {raw: (name, vector, int(first), int(width)) for name, raw, vector, first, width in (line.split() for line in STAND_INS.strip().splitlines())}


def _stand_in(raw: str) -> Column:
    _, vector, first, width = _RAW[raw]
    return F.when(F.size(vector) == 44, F.slice(vector, first, width))


def _inv(x: str) -> str:
    return f"list_transform({x}, lambda v: (1 - v)::FLOAT)"


def _clip(x: str) -> str:
    return f"list_transform({x}, lambda v: CASE WHEN v < 0 THEN 0::FLOAT WHEN v > 1 AND NOT isnan(v) THEN 1::FLOAT ELSE v END)"


def _zeros(x: str) -> str:
    return f"list_transform({x}, lambda v: 0::FLOAT)"


def _euler(x: str) -> str:
    x, y, z, w = (f"{x}[{i}]::DOUBLE" for i in (4, 5, 6, 7))
    roll = f"atan2(2 * ({w} * {x} + {y} * {z}), 1 - 2 * ({x} * {x} + {y} * {y}))"
    pitch = f"asin(greatest(least(2 * ({w} * {y} - {z} * {x}), 1), -1))"
    yaw = f"atan2(2 * ({w} * {z} + {x} * {y}), 1 - 2 * ({y} * {y} + {z} * {z}))"
    return f"CASE WHEN a IS NOT NULL THEN [{roll}::FLOAT, {pitch}::FLOAT, {yaw}::FLOAT] END"


_NONE = "[0, 0, 0]::FLOAT[]"
_LAST_OUT = f"a[1:6] || {_inv(_clip('a[8:8]'))}"
_POSE, _TIP = "s[1:6]", "s[14:14]"
#: The SQL of each standard: its action, and its other columns. ``r2a`` and ``bin`` are the scanned grippers of gc and of a's last element.
SQL = {
    "droid_baseact": (f"cv[1:3] || cv[4:6] || {_inv('gp')}", {"EEF_state": "cart", "gripper_state": "grip"}),
    "droid_finetuning": (f"cv[1:3] || cv[4:6] || {_inv('gp')}", {"proprio": "cart || grip"}),
    "bridge_oxe": ("reach || og", {"EEF_state": _POSE, "gripper_state": _TIP}),
    "bridge_orig": ("reach || bin", {"EEF_state": _POSE, "gripper_state": _TIP}),
    "ppgm": ("a[1:6] || bin", {"EEF_state": "cart[1:6]", "gripper_state": "grip[1:1]"}),
    "rt1": ("wv || rd || r2a", {}),
    "kuka": ("wv || rd || r2a", {}),
    "taco_play": (f"rel[1:6] || {_clip('rel[8:8]')}", {"state_eef": "ro[1:6]", "state_gripper": "ro[8:8]"}),
    "jaco_play": (f"wv || {_zeros('wv')} || r2a", {"state_eef": "eecp[1:6]", "state_gripper": "eecp[8:8]"}),
    "berkeley_cable_routing": ("wv || rd || [0]::FLOAT[]", {}),
    "roboturk": (f"wv || rd || {_inv(_clip('gc'))}", {}),
    "nyu_door_opening": ("wv || rd || r2a", {}),
    "viola": (f"wv || rd || {_inv(_clip('gc'))}", {}),
    "berkeley_autolab_ur5": ("wv || rd || r2a", {"state": "rs[7:14]"}),
    "toto": ("wv || rd || og", {}),
    "language_table": (f"a || {_zeros('a')} || {_zeros('a')} || [1]::FLOAT[]", {}),
    "pusht": ("wv || rd || gc", {}),
    "stanford_kuka_multimodal": (f"a[1:3] || {_NONE} || a[8:8]", {}),
    "nyu_rot": ("a[1:7]", {"eef_state": _POSE, "gripper_state": _TIP}),
    "stanford_hydra": (f"a[1:6] || {_inv('a[8:8]')}", {"eef_state": "s[1:3] || s[8:10]", "gripper_state": "s[12:12]"}),
    "austin_buds": (_LAST_OUT, {"state": "s[1:8]"}),
    "nyu_franka_play": (f"a[1:6] || {_clip('a[7:7]')}", {"eef_state": "s[9:14]"}),
    "maniskill": ("a", {"gripper_state": "s[8:8]"}),
    "furniture_bench": (f"a[1:3] || {_euler('a')} || {_inv(_clip('a[8:8]'))}", {"state": "s[1:7] || s[14:14]"}),
    "cmu_franka_exploration": ("a[1:7]", {}),
    "ucsd_kitchen": ("a[1:7]", {"joint_state": "s[1:7]"}),
    "ucsd_pick_place": (f"a[1:3] || {_NONE} || a[8:8]", {"eef_state": _POSE, "gripper_state": _TIP}),
    "austin_sailor": (_LAST_OUT, {}),
    "austin_sirius": (_LAST_OUT, {}),
    "bc_z": (f"xyz[1:3] || aa[1:3] || {_inv('tc[1:1]')}", {}),
    "tokyo_pr2_opening_fridge": ("a[1:7]", {"eef_state": _POSE, "gripper_state": _TIP}),
    "tokyo_pr2_tabletop": ("a[1:7]", {"eef_state": _POSE, "gripper_state": _TIP}),
    "utokyo_xarm_pick_place": ("a", {}),
    "utokyo_xarm_bimanual": ("a[2:8]", {}),
    "robo_net": ("a[1:4] || [0, 0]::FLOAT[] || a[8:8]", {"eef_state": "s[1:4] || [0, 0]::FLOAT[]", "gripper_state": _TIP}),
    "berkeley_mvp": ("a", {"gripper": "gripper_part"}),
    "berkeley_rpt": ("a", {"gripper": "gripper_part"}),
    "kaist_nonprehensible": ("a[1:6] || [0]::FLOAT[]", {"state": "s[8:14]"}),
    "stanford_mask_vit": ("a[1:4] || [0, 0]::FLOAT[] || a[8:8]", {"eef_state": "eep[1:4] || [0, 0]::FLOAT[]", "gripper_state": "eep[8:8]"}),
    "tokyo_lsmo": ("a", {"eef_state": _POSE, "gripper_state": _TIP}),
    "dlr_sara_pour": ("a", {}),
    "dlr_sara_grid_clamp": ("a", {"state": "s[1:6]"}),
    "dlr_edan_shared_control": (f"a[1:6] || {_inv('a[8:8]')}", {}),
    "asu_table_top": ("a", {"eef_state": "gt", "gripper_state": _TIP}),
    "robocook": ("a", {"eef_state": _POSE, "gripper_state": _TIP}),
    "imperial_wristcam": ("a[1:7]", {}),
    "iamlab_pick_insert": (f"a[1:3] || {_euler('a')} || a[8:8]", {"joint_state": "s[1:7]", "gripper_state": "s[8:8]"}),
    "uiuc_d3field": (f"a || {_zeros('a')} || [0]::FLOAT[]", {}),
    "utaustin_mutex": (_LAST_OUT, {"state": "s[1:8]"}),
    "berkeley_fanuc": (f"a || {_inv('s[7:7]')}", {"joint_state": _POSE, "gripper_state": "s[7:7]"}),
    "cmu_playing_with_food": (f"a[1:3] || {_euler('a')} || a[8:8]", {}),
    "playfusion": ("a[1:3] || a[5:8]", {}),
    "cmu_stretch": ("a[1:7]", {"eef_state": f"s[1:3] || {_NONE}", "gripper_state": _TIP}),
    "gnm": (f"a || {_zeros('a')} || {_zeros('a')} || [0]::FLOAT[]", {"state": f"pos || {_NONE} || yaw"}),
    "fmb": ("a", {"proprio": "eef || sgp"}),
    "dobbe": ("a", {"EEF_state": _POSE, "gripper_state": _TIP}),
    "roboset": (f"a[1:7] || {_inv(_clip('a[8:8]'))}", {"proprio": "s"}),
    "rh20t": ("tcp || ag", {"proprio": "otcp || gw"}),
    "tdroid": ("a[1:6] || bin", {"EEF_state": "cart[1:6]", "gripper_state": "grip[1:1]"}),
    "libero": (_LAST_OUT, {"EEF_state": _POSE, "gripper_state": "s[13:14]"}),
}
#: Standards with arithmetic beyond sums and products, whose last digits differ between engines, and digits that are compared.
TRIGONOMETRIC, DIGITS = ("furniture_bench", "iamlab_pick_insert", "cmu_playing_with_food"), 4

_W = "OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN {})"
_CUT = ", ".join(f"CASE WHEN len({v}) = 44 THEN {v}[{f}:{f + w - 1}] END AS {n}" for n, v, f, w in _RAW.values())
_STEPS = f"""raw AS (SELECT episode_index, frame_index, {_CUT} FROM {{source}}),
    k AS (SELECT *, CASE WHEN gc[1] < -0.1::FLOAT::DOUBLE THEN 1 WHEN NOT isnan(gc[1]) AND gc[1]::DOUBLE > 0.1 THEN -1 END AS turn,
      CASE WHEN a[8]::DOUBLE < 0.05 THEN 0.0 WHEN NOT isnan(a[8]) AND a[8]::DOUBLE > 0.95 THEN 1.0 END AS decided FROM raw),
    r AS (SELECT *, [(coalesce(last_value(turn IGNORE NULLS) {_W.format("UNBOUNDED PRECEDING AND CURRENT ROW")}, -first_value(turn IGNORE NULLS) {_W.format("UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")}, 1) / 2.0 + 0.5)::FLOAT] AS r2a,
      [coalesce(first_value(decided IGNORE NULLS) {_W.format("CURRENT ROW AND UNBOUNDED FOLLOWING")}, last_value(a[8]::DOUBLE) {_W.format("UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")})::FLOAT] AS bin,
      lead(s) OVER (PARTITION BY episode_index ORDER BY frame_index) AS s2, lead(frame_index) OVER (PARTITION BY episode_index ORDER BY frame_index) AS later FROM k),
    q AS (SELECT *, CASE WHEN s IS NOT NULL AND s2 IS NOT NULL THEN [s2[1] - s[1], s2[2] - s[2], s2[3] - s[3], s2[4] - s[4], s2[5] - s[5], s2[6] - s[6]] END AS reach FROM r)"""


def _sql(name: str) -> str:
    action, columns = SQL[name]
    reached = "reach" in action
    source = f"(SELECT * FROM {FRAMES_SQL} QUALIFY row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) > 1)" if reached else FRAMES_SQL
    whole = lambda x: "CASE WHEN " + " AND ".join(f"({part.strip()}) IS NOT NULL" for part in x.split(" || ")) + f" THEN {x} END"
    if name in TRIGONOMETRIC:
        action = f"list_transform({whole(action)}, lambda x: round(x::DOUBLE + 1e-7, {DIGITS}))"
    else:
        action = whole(action)
    made = "".join(f", {whole(v)} AS {k}" for k, v in columns.items())
    return f"WITH {_STEPS.format(source=source)} SELECT episode_index, frame_index, {action} AS action{made} FROM q" + (" WHERE later IS NOT NULL" if reached else "")


def _run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    out = standardise(frames(spark, sf_dir, "state_vec", "action_vec"), name, _stand_in)
    action = F.transform("action", lambda x: F.round(x.cast("double") + 1e-7, DIGITS)) if name in TRIGONOMETRIC else F.col("action")
    return out.select("episode_index", "frame_index", action.alias("action"), *STANDARDS[name].columns)


for _name in STANDARDS:
    query(f"standardise_{_name}", _sql(_name))(partial(_run, name=_name))


@query("standardised_by_name", f"""WITH {_STEPS.format(source=FRAMES_SQL)} SELECT episode_index, frame_index, CASE WHEN wv IS NOT NULL THEN wv || {_zeros("wv")} || r2a END AS action,
    CASE WHEN eecp IS NOT NULL THEN eecp[1:6] || [0]::FLOAT[] || eecp[8:8] END AS proprio FROM q""")
def standardised_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of a dataset looked up by its name, with the state vector that its configuration lists."""
    return datasets.standardised(frames(spark, sf_dir, "state_vec", "action_vec"), "jaco_play", _stand_in).select("episode_index", "frame_index", "action", "proprio")


# How many datasets have which encodings, counted by hand.
@query("dataset_registry", "SELECT * FROM (VALUES ('JOINT', 'EEF_POS', {joint}), ('JOINT', 'JOINT_POS', 2), ('NONE', 'EEF_POS', 5), ('POS_EULER', 'EEF_POS', {euler}), ('POS_QUAT', 'EEF_POS', 9), ('POS_QUAT', 'JOINT_POS', 1), (NULL, NULL, 4)) AS t(state_encoding, action_encoding, n)".replace("{joint}", "9").replace("{euler}", "44"))
def dataset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets known by name, by the encodings of their vectors."""
    return datasets.dataset_table(spark).groupBy("state_encoding", "action_encoding").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("language_and_depth", f"""SELECT episode_index, frame_index, CASE WHEN instr(prompt, ' ') > 0 THEN left(prompt, instr(prompt, ' ') - 1) ELSE prompt END AS decoded, prompt AS moved,
    CASE WHEN len(state_vec) = 44 THEN [state_vec[1], state_vec[3]] END AS depth FROM {FRAMES_SQL}""")
def language_and_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions moved or decoded from code points that end at a NUL, and depth images' first channel, as three datasets have them."""
    pixel = lambda i: F.array(F.get("state_vec", F.lit(i)), F.get("state_vec", F.lit(i + 1)))
    rows = frames(spark, sf_dir, "prompt", "state_vec").withColumn("image", F.when(F.size("state_vec") == 44, F.array(pixel(0), pixel(2))))
    # The first blank of a prompt stands in for the NUL that ends a padded text.
    codes = F.when(F.col("prompt").isNotNull(), F.transform(F.split("prompt", ""), lambda c: F.when(c == " ", 0).otherwise(F.ascii(c))))
    column = {"observation.instruction": codes, "observation.natural_language_instruction": F.col("prompt"), "observation.depth": F.col("image"), "observation.depth_additional_view": F.col("image"), "language_instruction": F.col("prompt")}
    rows = datasets.text_and_depth(rows, "language_table", column.get).withColumnRenamed("language_instruction", "decoded")
    rows = datasets.text_and_depth(rows, "kuka", column.get).withColumnRenamed("language_instruction", "moved")
    rows = datasets.text_and_depth(rows, "nyu_franka_play_dataset_converted_externally_to_rlds", column.get)
    return rows.select("episode_index", "frame_index", "decoded", "moved", "depth")


@query("proprio_concat", f"SELECT episode_index, frame_index, CASE WHEN state_vec IS NOT NULL AND action_vec IS NOT NULL THEN state_vec[1:6] || [0::FLOAT] || action_vec[1:1] END AS proprio, list_resize([]::FLOAT[], 8, 0::FLOAT) AS unknown FROM {FRAMES_SQL}")
def proprio_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State vectors of parts, one of which isn't there, and of an unknown dataset."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec")
    return rows.select("episode_index", "frame_index", proprio([F.slice("state_vec", 1, 6), None, F.slice("action_vec", 1, 1)]).alias("proprio"), proprio([]).alias("unknown"))


@query("success_only", "SELECT episode_index, frame_index FROM frames WHERE episode_index % 4 <> 1")
def success_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of the episodes that a flag marks as successes."""
    flagged = frames_flag(spark, sf_dir)
    return flagged.filter("success").select("episode_index", "frame_index")


def frames_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the frames with the stand-in of a success flag."""
    from framemill.registry import table

    return table(spark, sf_dir, "frames").withColumn("success", F.col("episode_index") % 4 != 1)


@query("zero_action_filter", f"SELECT episode_index, frame_index FROM {FRAMES_SQL} WHERE len(list_filter(action_vec[1:6], lambda x: abs(x::DOUBLE - 0.1015625) > 1e-5)) > 0")
def zero_action_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose action isn't the normalised zero in every element."""
    rows = frames(spark, sf_dir, "action_vec")
    return rows.filter(F.exists(F.slice("action_vec", 1, 6), lambda x: F.abs(x.cast("double") - 0.1015625) > 1e-5)).select("episode_index", "frame_index")


@query("channel_reverse", f"SELECT episode_index, frame_index, list_reverse(state_vec[1:3]) AS bgr, state_vec[1] AS first_channel FROM {FRAMES_SQL}")
def channel_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels in reverse order, and the first one alone."""
    return frames(spark, sf_dir, "state_vec").select("episode_index", "frame_index", F.reverse(F.slice("state_vec", 1, 3)).alias("bgr"), F.get("state_vec", F.lit(0)).alias("first_channel"))


@query("camera_swap", "SELECT DISTINCT shot_id, CASE WHEN episode_index % 2 = 1 AND camera = 'observation.images.chest' THEN 'observation.images.left_palm' WHEN episode_index % 2 = 1 AND camera = 'observation.images.left_palm' THEN 'observation.images.chest' ELSE camera END AS camera FROM video_shots")
def camera_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cameras swapped for every other episode, decided by the index instead of at random."""
    from framemill.registry import table

    a, b = "observation.images.chest", "observation.images.left_palm"
    swap = F.when((F.col("episode_index") % 2 == 1) & F.col("camera").isin(a, b), F.when(F.col("camera") == a, b).otherwise(a)).otherwise(F.col("camera"))
    return table(spark, sf_dir, "video_shots").select("shot_id", swap.alias("camera")).dropDuplicates()
