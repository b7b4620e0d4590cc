"""What is known of datasets by name: their standardisation, the parts of their state vector, encodings, and rate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions import features
from framemill.functions.standardise import Resolve, depth_columns, language, proprio, standardise

# Dataset | standard | parts of the state, ``-`` for a zero | state encoding | action encoding | frames per second.
# A dataset without a standard has ``-``, one without a configuration ends after it.
TABLE = """
bridge_oxe | bridge_oxe | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
bridge_orig | bridge_orig | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
bridge_dataset | bridge_orig | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
ppgm | ppgm
ppgm_static | ppgm
ppgm_wrist | ppgm
fractal20220817_data | rt1 | base_pose_tool_reached gripper_closed | POS_QUAT | EEF_POS | 3
kuka | kuka | clip_function_input/base_pose_tool_reached gripper_closed | POS_QUAT | EEF_POS | 10
taco_play | taco_play | state_eef - state_gripper | POS_EULER | EEF_POS | 15
jaco_play | jaco_play | state_eef - state_gripper | POS_EULER | EEF_POS | 10
berkeley_cable_routing | berkeley_cable_routing | robot_state - | JOINT | EEF_POS | 10
roboturk | roboturk | - - - - - - - - | NONE | EEF_POS | 10
nyu_door_opening_surprising_effectiveness | nyu_door_opening | - - - - - - - - | NONE | EEF_POS | 3
viola | viola | joint_states gripper_states | JOINT | EEF_POS | 20
berkeley_autolab_ur5 | berkeley_autolab_ur5 | state | POS_QUAT | EEF_POS | 5
toto | toto | state - | JOINT | EEF_POS | 30
language_table | language_table | effector_translation - - - - - - | POS_EULER | EEF_POS | 10
columbia_cairlab_pusht_real | pusht | robot_state - - - - - - | POS_EULER | EEF_POS | 10
stanford_kuka_multimodal_dataset_converted_externally_to_rlds | stanford_kuka_multimodal | ee_position ee_orientation - | POS_QUAT | EEF_POS | 20
nyu_rot_dataset_converted_externally_to_rlds | nyu_rot | eef_state - gripper_state | POS_EULER | EEF_POS | 3
stanford_hydra_dataset_converted_externally_to_rlds | stanford_hydra | eef_state - gripper_state | POS_EULER | EEF_POS | 10
austin_buds_dataset_converted_externally_to_rlds | austin_buds | state | JOINT | EEF_POS | 20
nyu_franka_play_dataset_converted_externally_to_rlds | nyu_franka_play | eef_state - - | POS_EULER | EEF_POS | 3
maniskill_dataset_converted_externally_to_rlds | maniskill | tcp_pose gripper_state | POS_QUAT | EEF_POS | 20
furniture_bench_dataset_converted_externally_to_rlds | furniture_bench | state | POS_QUAT | EEF_POS | 10
cmu_franka_exploration_dataset_converted_externally_to_rlds | cmu_franka_exploration | - - - - - - - - | NONE | EEF_POS | 10
ucsd_kitchen_dataset_converted_externally_to_rlds | ucsd_kitchen | joint_state - | JOINT | EEF_POS | 2
ucsd_pick_and_place_dataset_converted_externally_to_rlds | ucsd_pick_place | eef_state - gripper_state | POS_EULER | EEF_POS | 3
austin_sailor_dataset_converted_externally_to_rlds | austin_sailor | state | POS_QUAT | EEF_POS | 20
austin_sirius_dataset_converted_externally_to_rlds | austin_sirius | state | POS_QUAT | EEF_POS | 20
bc_z | bc_z | present/xyz present/axis_angle - present/sensed_close | POS_EULER | EEF_POS | 10
utokyo_pr2_opening_fridge_converted_externally_to_rlds | tokyo_pr2_opening_fridge | eef_state - gripper_state | POS_EULER | EEF_POS | 10
utokyo_pr2_tabletop_manipulation_converted_externally_to_rlds | tokyo_pr2_tabletop | eef_state - gripper_state | POS_EULER | EEF_POS | 10
utokyo_xarm_pick_and_place_converted_externally_to_rlds | utokyo_xarm_pick_place | end_effector_pose - - | POS_EULER | EEF_POS | 10
utokyo_xarm_bimanual_converted_externally_to_rlds | utokyo_xarm_bimanual | pose_r - - | POS_EULER | EEF_POS | 10
robo_net | robo_net | eef_state - gripper_state | POS_EULER | EEF_POS | 1
berkeley_mvp_converted_externally_to_rlds | berkeley_mvp | pose gripper | POS_QUAT | JOINT_POS | 5
berkeley_rpt_converted_externally_to_rlds | berkeley_rpt | joint_pos gripper | JOINT | JOINT_POS | 30
kaist_nonprehensile_converted_externally_to_rlds | kaist_nonprehensible | state - | POS_QUAT | EEF_POS | 10
stanford_mask_vit_converted_externally_to_rlds | stanford_mask_vit | eef_state - gripper_state | POS_EULER | EEF_POS | -
tokyo_u_lsmo_converted_externally_to_rlds | tokyo_lsmo | eef_state - gripper_state | POS_EULER | EEF_POS | 10
dlr_sara_pour_converted_externally_to_rlds | dlr_sara_pour | state - - | POS_EULER | EEF_POS | 10
dlr_sara_grid_clamp_converted_externally_to_rlds | dlr_sara_grid_clamp | state - - | POS_EULER | EEF_POS | 10
dlr_edan_shared_control_converted_externally_to_rlds | dlr_edan_shared_control | state - | POS_EULER | EEF_POS | 5
asu_table_top_converted_externally_to_rlds | asu_table_top | eef_state - gripper_state | POS_EULER | EEF_POS | 12.5
stanford_robocook_converted_externally_to_rlds | robocook | eef_state - gripper_state | POS_EULER | EEF_POS | 5
imperialcollege_sawyer_wrist_cam | imperial_wristcam | - - - - - - - state | NONE | EEF_POS | 10
iamlab_cmu_pickup_insert_converted_externally_to_rlds | iamlab_pick_insert | joint_state gripper_state | JOINT | EEF_POS | 20
uiuc_d3field | uiuc_d3field | - - - - - - - - | NONE | EEF_POS | 1
utaustin_mutex | utaustin_mutex | state | JOINT | EEF_POS | 20
berkeley_fanuc_manipulation | berkeley_fanuc | joint_state - gripper_state | JOINT | EEF_POS | 10
cmu_playing_with_food | cmu_playing_with_food | state - - | POS_EULER | EEF_POS | 10
cmu_play_fusion | playfusion | state | JOINT | EEF_POS | 5
cmu_stretch | cmu_stretch | eef_state - gripper_state | POS_EULER | EEF_POS | 10
berkeley_gnm_recon | gnm | state - - | POS_EULER | EEF_POS | 3
berkeley_gnm_cory_hall | gnm | state - - | POS_EULER | EEF_POS | 5
berkeley_gnm_sac_son | gnm | state - - | POS_EULER | EEF_POS | 10
droid | droid_baseact | EEF_state - gripper_state | POS_EULER | EEF_POS | 15
fmb_dataset | fmb | proprio | POS_EULER | EEF_POS | 10
dobbe | dobbe | EEF_state - gripper_state | POS_EULER | EEF_POS | 3.75
roboset | roboset | proprio | JOINT | JOINT_POS | 5
rh20t_rlds | rh20t
tdroid_carrot_in_bowl | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
tdroid_pour_corn_in_pot | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
tdroid_flip_pot_upright | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
tdroid_move_object_onto_plate | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
tdroid_knock_object_over | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
tdroid_cover_object_with_towel | tdroid | EEF_state - gripper_state | POS_EULER | EEF_POS | 5
droid_wipe | droid_finetuning | proprio | POS_EULER | EEF_POS | 15
libero_spatial_no_noops | libero | EEF_state gripper_state | POS_EULER | EEF_POS | 20
libero_object_no_noops | libero | EEF_state gripper_state | POS_EULER | EEF_POS | 20
libero_goal_no_noops | libero | EEF_state gripper_state | POS_EULER | EEF_POS | 20
libero_10_no_noops | libero | EEF_state gripper_state | POS_EULER | EEF_POS | 20
rh20t | - | proprio | POS_EULER | EEF_POS | 10
"""


@dataclass(frozen=True)
class Dataset:
    """A dataset's entry; what isn't known is None."""

    name: str
    standard: str | None
    parts: tuple[str | None, ...] | None = None
    state: str | None = None
    action: str | None = None
    fps: float | None = None


def _entry(line: str) -> Dataset:
    name, standard, *rest = (x.strip() for x in line.split("|"))
    known = lambda x: None if x == "-" else x
    if not rest:
        return Dataset(name, known(standard))
    parts, state, action, fps = rest
    return Dataset(name, known(standard), tuple(known(p) for p in parts.split()), state, action, None if fps == "-" else float(fps))


DATASETS = {d.name: d for d in map(_entry, TABLE.strip().splitlines())}


def dataset(name: str) -> Dataset:
    """The entry of a dataset; an unknown name is an error that says which are alike."""
    if name not in DATASETS:
        near = [n for n in DATASETS if n.split("_")[0] == name.split("_")[0]]
        raise KeyError(f"unknown dataset {name}" + (f"; there are {', '.join(near)}" if near else ""))
    return DATASETS[name]


def dataset_table(spark: SparkSession) -> DataFrame:
    """``dataset, standard, parts, state_encoding, action_encoding, fps, state_names, action_names``, a row a dataset."""
    rows = []
    for d in DATASETS.values():
        axis_angle = "libero" in d.name
        names = (features.state_names(d.state, list(d.parts), axis_angle), features.action_names(d.action, axis_angle)) if d.state else (None, None)
        rows.append((d.name, d.standard, list(d.parts) if d.parts else None, d.state, d.action, d.fps, *names))
    return spark.createDataFrame(rows, "dataset string, standard string, parts array<string>, state_encoding string, action_encoding string, fps double, state_names array<string>, action_names array<string>")


def standardised(df: DataFrame, name: str, resolve: Resolve | None = None) -> DataFrame:
    """Raw frames of the named dataset under its standard, with ``proprio``, the state vector of its configured parts.

    ``df`` and ``resolve`` as in ``standardise``; a part is a column that the standard makes, or ``observation.<part>``.
    """
    entry = dataset(name)
    if entry.standard is None:
        raise ValueError(f"{name} has no standard")
    out = standardise(df, entry.standard, resolve)
    if entry.parts is None:
        return out.withColumn("proprio", proprio([]))
    part = lambda p: F.col(f"`{p}`") if p in out.columns else (resolve or F.col)(f"observation.{p}")
    return out.withColumn("proprio", proprio([None if p is None else part(p) for p in entry.parts]))


def text_and_depth(df: DataFrame, name: str, resolve: Resolve = F.col) -> DataFrame:
    """``df`` with ``language_instruction`` and the depth columns as the named dataset's standard has them."""
    standard = dataset(name).standard
    return df.withColumns({"language_instruction": language(standard, resolve), **depth_columns(standard, resolve)})
