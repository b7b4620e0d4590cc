"""Queries over raw releases: folders walked, record files, JSON task documents, aligned streams, and documents as they are kept."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.functions import datasets, features, scalar
from framemill.operators import orchestration
from framemill.registry import query, table
from framemill.session import shared_folder
from framemill.sources import files, layouts, specs, tfrecord, trees
from framemill.views import FRAMES_SQL, frames

_PARTS = "regexp_extract(hdf5_path, '^(/raw/[^/]+)/data/([^/]+)/([^/]+)/success_episodes/([^/]+)/data/[^/]+\\.hdf5$', {})"


@query("discovered_episodes", f"SELECT DISTINCT {_PARTS.format(1)} AS root, {_PARTS.format(2)} AS embodiment, {_PARTS.format(3)} AS task, {_PARTS.format(4)} AS stamp FROM episode_refs WHERE {_PARTS.format(4)} <> ''")
def discovered_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every episode file found by a walk over a release laid out as the references say."""
    folder = shared_folder(spark, "release")
    paths = table(spark, sf_dir, "episode_refs").filter("hdf5_path is not null").select("hdf5_path").dropDuplicates()

    def touch(batches):
        system, base = files.filesystem(folder)
        for b in batches:
            for p in b.column(0).to_pylist():
                system.create_dir(f"{base}{p.rsplit('/', 1)[0]}", recursive=True)
                system.open_output_stream(f"{base}{p}").close()
            yield pa.record_batch([b.column(0)], names=["p"])

    paths.mapInArrow(touch, "p string").count()
    system, base = files.filesystem(f"{folder}/raw")
    roots = [i.path for i in system.get_file_info(files.fs.FileSelector(base, allow_not_found=True))]
    found = trees.discover(spark, roots)
    return found.select(F.expr(f"substring(root, {len(base) - 3})").alias("root"), "embodiment", "task", "stamp")


@query("record_files", f"SELECT episode_index, frame_index, CASE WHEN gripper IS NULL THEN 'nan'::FLOAT ELSE gripper::FLOAT END AS gripper, coalesce(prompt, '') AS prompt FROM {FRAMES_SQL}")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written as record files, an Example an episode, and read again."""
    folder = shared_folder(spark, "records")
    rows = frames(spark, sf_dir, "gripper", "prompt")
    step = F.struct("frame_index", F.coalesce(F.col("gripper").cast("float"), F.lit(float("nan")).cast("float")).alias("gripper"), F.coalesce("prompt", F.lit("")).alias("prompt"))
    episodes = rows.groupBy("episode_index").agg(F.array_sort(F.collect_list(step)).alias("s"))
    flat = episodes.select("episode_index", F.col("s.frame_index").alias("steps/frame_index"), F.col("s.gripper").alias("steps/gripper"), F.col("s.prompt").alias("steps/prompt"))
    tfrecord.write_examples(flat, folder).collect()
    f = lambda name, kind: F.col("features")[name][kind]
    back = tfrecord.read_examples(spark, folder, ".tfrecord")
    zipped = back.select(F.get(f("episode_index", "ints"), F.lit(0)).alias("episode_index"), F.explode(F.arrays_zip(f("steps/frame_index", "ints").alias("i"), f("steps/gripper", "floats").alias("g"), f("steps/prompt", "bytes").alias("p"))).alias("z"))
    return zipped.select("episode_index", F.col("z.i").alias("frame_index"), F.col("z.g").alias("gripper"), F.decode("z.p", "UTF-8").alias("prompt"))


@query("task_documents", "SELECT CAST(plan_id % 7 AS VARCHAR) AS task_id, plan_id AS episode_id, CAST(row_number() OVER (PARTITION BY plan_id ORDER BY slot) - 1 AS INTEGER) AS step, slot AS start_frame, slot + 10 AS end_frame, dataset AS action_text FROM (SELECT plan_id, slot, max(dataset) AS dataset FROM candidates GROUP BY ALL)")
def task_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated stretches out of JSON documents, one a task, that list a task's episodes."""
    folder = shared_folder(spark, "tasks")
    rows = table(spark, sf_dir, "candidates").groupBy("plan_id", "slot").agg(F.max("dataset").alias("dataset"))
    action = F.struct(F.col("slot").alias("start_frame"), (F.col("slot") + 10).alias("end_frame"), F.col("dataset").alias("action_text"))
    episodes = rows.groupBy("plan_id").agg(F.array_sort(F.collect_list(action)).alias("a"))
    entry = F.to_json(F.struct(F.col("plan_id").alias("episode_id"), F.struct(F.col("a").alias("action_config")).alias("label_info")))
    # A document is written by the one task that its episodes are hashed to, an entry at a time.
    entries = episodes.select((F.col("plan_id") % 7).cast("string").alias("task"), "plan_id", entry.alias("entry")).repartition("task").sortWithinPartitions("task", "plan_id")

    def write(batches):
        system, base = files.filesystem(folder)
        system.create_dir(base, recursive=True)
        task, out = None, None
        for b in batches:
            for t, e in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if t != task:
                    if out:
                        out.write(b"]")
                        out.close()
                    task, out = t, system.open_output_stream(f"{base}/task_{t}.json")
                    out.write(b"[")
                else:
                    out.write(b",\n")
                out.write(e.encode())
        if out:
            out.write(b"]")
            out.close()
        yield from ()

    entries.mapInArrow(write, "n bigint").count()
    return trees.task_actions(trees.task_info(spark, folder)).drop("skill")


@query("aligned_streams", f"""WITH f AS (SELECT * FROM {FRAMES_SQL}), l AS (SELECT episode_index, count(*) AS n FROM f GROUP BY 1),
    s AS (SELECT episode_index, count(state_vec) AS ns, max(len(state_vec)) AS ws, count(DISTINCT len(state_vec)) AS ds, count(action_vec) AS na, max(len(action_vec)) AS wa, count(DISTINCT len(action_vec)) AS da, count(gripper) AS ng FROM f GROUP BY 1)
    SELECT episode_index, CASE WHEN ns = 0 THEN 'state is absent' WHEN ws <> 44 OR ds <> 1 THEN 'state is ' || ws || ' wide, expected 44' WHEN na = 0 THEN 'action is absent' WHEN wa <> 44 OR da <> 1 THEN 'action is ' || wa || ' wide, expected 44'
      WHEN ng = 0 THEN 'gripper is absent' WHEN ns <> n OR na <> n OR ng <> n THEN 'length mismatch against ' || n || ' camera frames: ' || array_to_string(list_filter([CASE WHEN ns <> n THEN 'state=' || ns END, CASE WHEN na <> n THEN 'action=' || na END, CASE WHEN ng <> n THEN 'gripper=' || ng END], lambda x: x IS NOT NULL), ', ') END AS reason
    FROM s JOIN l USING (episode_index)""")
def aligned_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an episode's streams can't be read beside its cameras, if they can't."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec", "gripper")
    named = {"state": F.col("state_vec"), "action": F.col("action_vec"), "gripper": F.when(F.col("gripper").isNotNull(), F.array("gripper"))}
    long = rows.select("episode_index", F.explode(F.array(*[F.struct(F.lit(n).alias("stream"), F.when(c.isNotNull(), F.size(c)).alias("w")) for n, c in named.items()])).alias("x"))
    streams = long.filter("x.w is not null").groupBy("episode_index", F.col("x.stream").alias("stream")).agg(F.count(F.lit(1)).alias("n_rows"), F.max("x.w").alias("width"), F.count_distinct("x.w").alias("widths"))
    lengths = rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n_frames"))
    return trees.stream_reasons(lengths, streams, {"state": 44, "action": 44, "gripper": 1})


@query("joined_state", f"SELECT episode_index, frame_index, CASE WHEN state_vec IS NOT NULL AND gripper IS NOT NULL THEN state_vec[1:3] || state_vec[4:7] || [gripper::FLOAT] END AS state, json_extract_string('{{\"lang\": ' || to_json(prompt) || '}}', '$.lang') AS prompt FROM {FRAMES_SQL}")
def joined_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state of position, rotation and gripper, and the prompt out of an attribute's JSON, as a simulator's files keep them."""
    rows = frames(spark, sf_dir, "state_vec", "gripper", "prompt").withColumn("ep_meta", F.to_json(F.struct(F.col("prompt").alias("lang"))))
    state = F.concat(F.slice("state_vec", 1, 3), F.slice("state_vec", 4, 4), F.array(F.col("gripper").cast("float")))
    return rows.select("episode_index", "frame_index", F.when(F.col("gripper").isNotNull(), state).alias("state"), F.get_json_object("ep_meta", "$.lang").alias("prompt"))


@query("info_edits", f"""SELECT 'packed' AS layout, count(DISTINCT episode_index) AS total_episodes, count(*) AS total_frames, 'data/chunk-%03d/file-%03d.parquet' AS data_path, FALSE AS has_chunks FROM {FRAMES_SQL}
    UNION ALL SELECT 'episodes', count(DISTINCT episode_index), count(*), 'data/chunk-%03d/episode_%06d.parquet', TRUE FROM {FRAMES_SQL}""")
def info_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a description on its way to the packed layout and back; read from the documents as written."""
    folder = shared_folder(spark, "info")
    layouts.write_episodes(frames(spark, sf_dir, "gripper", "prompt"), f"{folder}/a", "prompt", 30.0)
    layouts.pack(spark, f"{folder}/a", f"{folder}/b", 64 << 10)
    layouts.unpack(spark, f"{folder}/b", f"{folder}/c")
    documents = [layouts.read_json(spark, f"{folder}/{d}/{layouts.INFO}") for d in ("b", "c")]
    rows = [(d["layout"], d["total_episodes"], d["total_frames"], d["data_path"], "total_chunks" in d) for d in documents]
    return spark.createDataFrame(rows, "layout string, total_episodes bigint, total_frames bigint, data_path string, has_chunks boolean")


@query("size_tolerances", "SELECT DISTINCT file_id, coalesce(abs(filled_mb / nullif(16.0::DOUBLE, 0) - 1) <= 0.15, FALSE) AS near FROM parquet_files WHERE filled_mb IS NOT NULL")
def size_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose size is within a share of a good one's."""
    rows = table(spark, sf_dir, "parquet_files").filter("filled_mb is not null")
    return rows.select("file_id", F.coalesce(scalar.size_ratio_ok(F.col("filled_mb"), F.lit(16.0)) & ~F.isnan("filled_mb"), F.lit(False)).alias("near")).dropDuplicates()


@query("decoded_bytes", "SELECT DISTINCT ref_id, trim(task) AS task FROM episode_refs")
def decoded_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that come as bytes with blanks around them."""
    padded = F.encode(F.concat(F.lit("  "), "task", F.lit(" ")), "UTF-8")
    return table(spark, sf_dir, "episode_refs").select("ref_id", F.trim(F.decode(padded, "UTF-8")).alias("task")).dropDuplicates()


@query("worker_shares", "SELECT dataset, n, CAST(ceil(48.0 / n) AS BIGINT) AS workers FROM (SELECT dataset, count(DISTINCT episode_index) AS n FROM frames GROUP BY 1)")
def worker_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers of each of a batch's datasets when a machine's are shared out."""
    n = table(spark, sf_dir, "frames").groupBy("dataset").agg(F.count_distinct("episode_index").alias("n"))
    return n.select("dataset", "n", orchestration.worker_share(F.lit(48), F.col("n")).alias("workers"))


@query("declared_blocks", "SELECT * FROM (VALUES ('a', 'state', 'arm', 7, 0), ('a', 'state', 'hand', 2, 7), ('a', 'action', 'arm', 7, 0), ('a', 'action', 'hand', 2, 7), ('b', 'state', 'arm', 6, 0), ('b', 'action', 'arm', 6, 0)) AS t(dataset, side, block, width, slot_from)")
def declared_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of declared blocks in the order that a layout gives, read from documents."""
    folder = shared_folder(spark, "declared")
    layouts.write_json(f"{folder}/layouts/robot.json", {"order": ["arm", "hand"]})
    blocks = lambda *b: [{"name": n, "width": w, "source": "s", "evidence": "declared"} for n, w in b]
    layouts.write_json(f"{folder}/datasets/a.json", {"dataset": "a", "fps": 30, "state": blocks(("hand", 2), ("arm", 7))})
    layouts.write_json(f"{folder}/datasets/b.json", {"dataset": "b", "fps": 10, "state": blocks(("arm", 6))})
    order = specs.parse_layout(specs.read_text(f"{folder}/layouts/robot.json"))
    found = specs.block_table(spark, [specs.parse_spec(specs.read_text(f"{folder}/datasets/{d}.json")) for d in ("a", "b")])
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("block"))
    before = F.sum("width").over(Window.partitionBy("dataset", "side").orderBy(place)) - F.col("width")
    return found.select("dataset", "side", "block", F.col("width").cast("int").alias("width"), before.cast("int").alias("slot_from"))


@query("feature_patches", "SELECT 'v' AS feature, 8 AS width, 'x y z rx ry rz rw gripper' AS names UNION ALL SELECT 'w', 8, 'motor_0 motor_1 motor_2 motor_3 motor_4 motor_5 pad gripper'")
def feature_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes and names that columns carry after a step that changed them, by their encodings."""
    names = {"v": features.state_names("POS_QUAT", []), "w": features.state_names("JOINT", ["joint_state", None, "gripper_state"])}
    rows = frames(spark, sf_dir, "state_vec").select(F.slice("state_vec", 1, 8).alias("v"), F.slice("state_vec", 9, 8).alias("w"))
    patched = features.described(rows, {c: features.vector_feature(n) for c, n in names.items()})
    found = features.inferred(patched.schema)
    return spark.createDataFrame([(c, found[c]["shape"][0], " ".join(json.loads(patched.schema[c].metadata["names"].replace("'", '"'))["motors"])) for c in patched.columns], "feature string, width int, names string")


@query("datasets_known", "SELECT 73 AS standards, 70 AS configurations, 60 AS transforms")
def datasets_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many datasets have a standard, how many a configuration, and how many standards there are."""
    known = datasets.dataset_table(spark)
    return known.agg(F.count("standard").cast("int").alias("standards"), F.count("parts").cast("int").alias("configurations"), F.count_distinct("standard").cast("int").alias("transforms"))


_UNIT = "sqrt(state_vec[1]::DOUBLE ** 2 + state_vec[2]::DOUBLE ** 2 + state_vec[3]::DOUBLE ** 2 + state_vec[4]::DOUBLE ** 2)"


@query("axis_angles", f"""WITH q AS (SELECT episode_index, frame_index, state_vec[1] / {_UNIT} AS x, state_vec[2] / {_UNIT} AS y, state_vec[3] / {_UNIT} AS z, least(greatest(state_vec[4] / {_UNIT}, -1), 1) AS w FROM {FRAMES_SQL} WHERE len(state_vec) >= 4 AND {_UNIT} > 0),
    s AS (SELECT *, CASE WHEN sqrt(1 - w * w) < 1e-12 THEN 0 ELSE 2 * acos(w) / sqrt(1 - w * w) END AS k FROM q)
    SELECT episode_index, frame_index, round(x * k + 1e-9, 6) AS rx, round(y * k + 1e-9, 6) AS ry, round(z * k + 1e-9, 6) AS rz FROM s""")
def axis_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotation vectors of unit quaternions."""
    part = [F.get("state_vec", F.lit(i)).cast("double") for i in range(4)]
    unit = F.sqrt(part[0] * part[0] + part[1] * part[1] + part[2] * part[2] + part[3] * part[3])
    rows = frames(spark, sf_dir, "state_vec").filter((F.size("state_vec") >= 4) & (unit > 0)).withColumn("v", scalar.quaternion_axis_angle(F.array(*[p / unit for p in part])))
    return rows.select("episode_index", "frame_index", *[F.round(F.get("v", F.lit(i)) + 1e-9, 6).alias(n) for i, n in enumerate(("rx", "ry", "rz"))])


@query("camera_matrices", """SELECT event_id, round(0.5 * h / tan(radians(f) / 2) + 1e-9, 6) AS focal, w / 2.0::DOUBLE AS cx, h / 2.0::DOUBLE AS cy, 1.0::DOUBLE AS scale, -f AS turned, f AS kept, h::DOUBLE AS moved
    FROM (SELECT event_id, 20.0::DOUBLE + event_id % 70 AS f, 128 + event_id % 5 AS h, 256 + event_id % 7 AS w FROM events)""")
def camera_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intrinsic and extrinsic matrices of cameras."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.lit(20.0) + F.col("event_id") % 70).alias("f"), (F.col("event_id") % 5 + 128).alias("h"), (F.col("event_id") % 7 + 256).alias("w"))
    at = lambda m, i, j: F.get(F.get(m, F.lit(i)), F.lit(j))
    k = scalar.camera_matrix(F.col("f"), F.col("h"), F.col("w"))
    pose = scalar.camera_pose(F.array("h", "w", "f"), F.array(*["f"] * 9))
    return rows.select("event_id", F.round(at(k, 0, 0) + 1e-9, 6).alias("focal"), at(k, 0, 2).alias("cx"), at(k, 1, 2).alias("cy"), at(k, 2, 2).alias("scale"), at(pose, 1, 2).alias("turned"), at(pose, 2, 0).alias("kept"), at(pose, 0, 3).alias("moved"))


@query("step_documents", "SELECT dataset, step, 'ok' AS status, n AS items, ['/out/' || dataset] AS created FROM (SELECT dataset, count(*) AS n FROM addresses WHERE dataset IS NOT NULL GROUP BY 1), (SELECT unnest(['fetch', 'build']) AS step)")
def step_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of steps, kept as a document each and read again beside one that is damaged."""
    folder = shared_folder(spark, "steps")
    counts = table(spark, sf_dir, "addresses").filter("dataset is not null").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))

    def write(batches):
        for b in batches:
            for dataset, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for step in ("fetch", "build"):
                    orchestration.write_record(folder, {"dataset": dataset, "step": step, "status": "ok", "items": n, "created": [f"/out/{dataset}"]})
            yield pa.record_batch([b.column(0)], names=["dataset"])

    counts.mapInArrow(write, "dataset string").count()
    system, base = files.filesystem(folder)
    with system.open_output_stream(f"{base}/damaged.json") as f:
        f.write(b"{no json")
    return orchestration.read_records(spark, folder).select("dataset", "step", "status", "items", "created")


@query("written_codecs", f"SELECT 'ZSTD' AS codec, count(DISTINCT episode_index) AS n_files, count(*) AS n_rows FROM {FRAMES_SQL}")
def written_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode files written with another compression and an index of their pages, as their footers say after the folder was mirrored."""
    folder = shared_folder(spark, "codecs")
    name = F.format_string("%s.parquet", F.col("episode_index").cast("string"))
    files.write_files(frames(spark, sf_dir, "gripper"), f"{folder}/a", name, ["episode_index"], ["frame_index"], compression="zstd", write_page_index=True).count()
    files.mirror(spark, f"{folder}/a", f"{folder}/b")

    def footer(batches):
        import pyarrow.parquet as pq

        system, base = files.filesystem(f"{folder}/b")
        for b in batches:
            found = [pq.ParquetFile(system.open_input_file(f"{base}/{p}")).metadata for p in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([m.row_group(0).column(0).compression for m in found], pa.string()), pa.array([m.num_rows for m in found], pa.int64())], names=["codec", "n"])

    footers = files.walk(spark, f"{folder}/b").select("path").mapInArrow(footer, "codec string, n bigint")
    return footers.groupBy("codec").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"))
