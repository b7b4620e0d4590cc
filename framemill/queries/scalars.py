"""Queries of scalar functions, documents and build steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions import scalar
from framemill.functions.jsonpaths import flatten_json, unflatten
from framemill.operators import orchestration
from framemill.registry import query, table
from framemill.views import FRAMES_SQL, frames

_HW = "SELECT p_partkey, 48 + (p_partkey * 37) % 1400 AS h, 48 + (p_partkey * 53 + p_size) % 1900 AS w FROM part"


@query("resize_geometry", f"""WITH d AS ({_HW}), s AS (SELECT *, least(1.0::DOUBLE, sqrt(65536::DOUBLE / (h * w))) AS scale, least(h, w)::DOUBLE AS short, greatest(h, w)::DOUBLE AS long FROM d),
    r AS (SELECT *, greatest(16::DOUBLE, floor(short * scale / 16) * 16) AS sr FROM s), l AS (SELECT *, floor(long * (sr / short)) AS lr FROM r),
    a AS (SELECT p_partkey, CAST(CASE WHEN h <= w THEN sr ELSE lr END AS BIGINT) AS resize_h, CAST(CASE WHEN h <= w THEN lr ELSE sr END AS BIGINT) AS resize_w FROM l)
    SELECT p_partkey, resize_h, resize_w, resize_h - resize_h % 16 AS crop_h, resize_w - resize_w % 16 AS crop_w FROM a WHERE (resize_h - resize_h % 16) * (resize_w - resize_w % 16) <= 65536""")
def resize_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that pictures are resized and cropped to."""
    key = F.col("p_partkey")
    size = scalar.resize_geometry(48 + (key * 37) % 1400, 48 + (key * 53 + F.col("p_size")) % 1900)
    return table(spark, sf_dir, "part").select("p_partkey", size.alias("g")).filter("g is not null").select("p_partkey", "g.*")


@query("cover_crop", f"""WITH d AS ({_HW}), s AS (SELECT *, greatest(224::DOUBLE / h, 256::DOUBLE / w) AS k FROM d), r AS (SELECT p_partkey, CAST(round_even(h * k, 0) AS BIGINT) AS scaled_h, CAST(round_even(w * k, 0) AS BIGINT) AS scaled_w FROM s)
    SELECT *, CAST(floor((scaled_h - 224) / 2.0::DOUBLE) AS BIGINT) AS top, CAST(floor((scaled_w - 256) / 2.0::DOUBLE) AS BIGINT) AS "left" FROM r""")
def cover_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaling and centre crop that cover a target."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", scalar.cover_crop((48 + (key * 37) % 1400).cast("double"), (48 + (key * 53 + F.col("p_size")) % 1900).cast("double"), 224, 256).alias("g")).select("p_partkey", "g.*")


@query("frame_rate_parse", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN p_size::DOUBLE WHEN p_partkey % 7 <> 0 THEN p_size / (p_partkey % 7)::DOUBLE END AS rate FROM part")
def frame_rate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates read from texts such as 30000/1001."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(key % 5 == 0, F.lit("n/a")).when(key % 5 == 1, size).otherwise(F.concat_ws("/", size, (key % 7).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", scalar.parse_rate(text).alias("rate"))


@query("task_from_path", "SELECT DISTINCT ref_id, regexp_extract(hdf5_path, '/data/([^/]+)/', 1) AS embodiment, regexp_extract(hdf5_path, '/data/[^/]+/([^/]*)/success_episodes/', 1) AS task, regexp_extract(hdf5_path, '/success_episodes/([^/]+)/', 1) AS stamp FROM episode_refs")
def task_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embodiment, task and stamp in the path of a raw episode."""
    part = lambda p: F.regexp_extract("hdf5_path", p, 1)
    return table(spark, sf_dir, "episode_refs").select("ref_id", part("/data/([^/]+)/").alias("embodiment"), part("/data/[^/]+/([^/]*)/success_episodes/").alias("task"), part("/success_episodes/([^/]+)/").alias("stamp")).dropDuplicates()


@query("task_sentence", "SELECT DISTINCT task, CASE WHEN trim(replace(regexp_replace(task, '^\\d+-', ''), '_', ' ')) = '' THEN task ELSE trim(replace(regexp_replace(task, '^\\d+-', ''), '_', ' ')) END AS sentence FROM episode_refs WHERE task IS NOT NULL")
def task_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks as sentences."""
    return table(spark, sf_dir, "episode_refs").filter("task is not null").select("task").dropDuplicates().select("task", scalar.sentence(F.col("task")).alias("sentence"))


@query("instruction_cascade", "SELECT DISTINCT ref_id, coalesce(CASE WHEN ref_id % 3 = 0 THEN nullif(trim(embodiment), '') END, nullif(trim(task), ''), regexp_extract(hdf5_path, '/data/([^/]+)/', 1)) AS instruction FROM episode_refs")
def instruction_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that gives an instruction."""
    first = F.when(F.col("ref_id") % 3 == 0, F.col("embodiment"))
    return table(spark, sf_dir, "episode_refs").select("ref_id", scalar.instruction(first, F.col("task"), F.regexp_extract("hdf5_path", "/data/([^/]+)/", 1)).alias("instruction")).dropDuplicates()


@query("scene_task", "SELECT DISTINCT ref_id, CASE WHEN ref_id % 2 = 0 THEN task ELSE 'LIVING_' || task END AS scene_task FROM episode_refs WHERE task IS NOT NULL AND task <> ''")
def scene_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks in demonstration file names, with and without a scene number."""
    name = F.when(F.col("ref_id") % 2 == 0, F.concat(F.lit("/x/KITCHEN_SCENE3_"), "task", F.lit("_demo.hdf5"))).otherwise(F.concat(F.lit("/x/LIVING_"), "task", F.lit("_demo.hdf5")))
    return table(spark, sf_dir, "episode_refs").filter("task is not null and task <> ''").select("ref_id", scalar.scene_task(name).alias("scene_task")).dropDuplicates()


@query("unwrap_text", "SELECT DISTINCT task FROM episode_refs WHERE task IS NOT NULL")
def unwrap_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts out of their printed wrapper."""
    wrapped = F.concat(F.lit("tf.Tensor(b'"), "task", F.lit("', shape=(), dtype=string)"))
    return table(spark, sf_dir, "episode_refs").filter("task is not null").select(scalar.unwrapped(wrapped).alias("task")).dropDuplicates()


@query("robot_type_norm", "SELECT DISTINCT p_type, replace(replace(lower(p_type), ' ', '_'), '-', '_') AS name FROM part")
def robot_type_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in machine form."""
    return table(spark, sf_dir, "part").select("p_type", scalar.machine_name(F.col("p_type")).alias("name")).dropDuplicates()


@query("timestamp_parse", "SELECT event_id, epoch_us(ts) AS us FROM events")
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock texts to microseconds."""
    text = F.concat_ws("_", F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss"), F.date_format("ts", "SSSSSS"))
    return table(spark, sf_dir, "events").select("event_id", scalar.wall_clock(text).alias("us"))


@query("template_glob", "SELECT DISTINCT path_template, regexp_replace(replace(path_template, '{video_key}', 'chest'), '[^/]*\\{[^/]*\\}', '*', 'g') AS glob FROM parquet_files")
def template_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path templates as globs."""
    return table(spark, sf_dir, "parquet_files").select("path_template").dropDuplicates().select("path_template", scalar.template_glob(F.col("path_template"), F.lit("chest")).alias("glob"))


@query("path_resolve", "SELECT DISTINCT file_path, list_reduce(list_transform(list_prepend('', string_split(file_path, '/')), lambda s: CASE WHEN s = '.' THEN '' ELSE s END), lambda d, s: CASE WHEN s = '' THEN d WHEN s = '..' THEN regexp_replace(d, '/[^/]*$', '') ELSE d || '/' || s END) AS place FROM parquet_files")
def path_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where paths lead to."""
    from framemill.functions.paths import resolved

    return table(spark, sf_dir, "parquet_files").select("file_path").dropDuplicates().select("file_path", resolved(F.col("file_path")).alias("place"))


@query("file_name_parts", "SELECT DISTINCT file_path, CAST(nullif(regexp_extract(file_path, 'chunk-(\\d+)', 1), '') AS BIGINT) AS chunk, CAST(nullif(regexp_extract(file_path, 'file-(\\d+)', 1), '') AS BIGINT) AS file, regexp_matches(file_path, '(^|/)meta/') AS is_meta FROM parquet_files")
def file_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk and file numbers in paths."""
    number = lambda p: F.regexp_extract("file_path", p, 1).try_cast("bigint")
    return table(spark, sf_dir, "parquet_files").select("file_path").dropDuplicates().select("file_path", number(r"chunk-(\d+)").alias("chunk"), number(r"file-(\d+)").alias("file"), F.col("file_path").rlike("(^|/)meta/").alias("is_meta"))


@query("code_points_text", "SELECT DISTINCT p_name, p_name AS decoded FROM part")
def code_points_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts from arrays of code points that end with zeros."""
    letters = F.transform(F.split("p_name", ""), lambda c: F.ascii(c))
    return table(spark, sf_dir, "part").select("p_name").dropDuplicates().select("p_name", scalar.from_codes(F.concat(F.filter(letters, lambda c: c > 0), F.array(F.lit(0), F.lit(65)))).alias("decoded"))


@query("nearest_flag", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'workers' WHEN p_partkey % 3 = 1 THEN 'dataset' END AS meant FROM part")
def nearest_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known flag that a mistyped one means."""
    typed = F.when(F.col("p_partkey") % 3 == 0, "wokers").when(F.col("p_partkey") % 3 == 1, "datasett").otherwise("zzzzzzzzzzzz")
    return table(spark, sf_dir, "part").select("p_partkey", scalar.nearest_name(typed, ["workers", "dataset", "profile"]).alias("meant"))


@query("duration_text", "SELECT l_orderkey, l_linenumber, s, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE (s // 3600) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END AS text FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice / 10) AS BIGINT) AS s FROM lineitem)")
def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations as text."""
    s = F.floor(F.col("l_extendedprice") / 10)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s.alias("s"), scalar.clock_text(s.cast("double")).alias("text"))


@query("listed_bytes", "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS bytes FROM orders")
def listed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in a store's listing."""
    text = F.concat(F.lit("Total Objects: 3\n   Total Size: "), F.floor("o_totalprice").cast("string"), F.lit("\n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalar.listed_bytes(text).alias("bytes"))


@query("episodes_per_task", f"""WITH d AS (SELECT dataset, count(DISTINCT episode_index) AS e, count(*) AS f FROM {FRAMES_SQL} GROUP BY 1)
    SELECT dataset, greatest(1, least(greatest(1, CAST(round_even(2000 / (f / e)::DOUBLE, 0) AS BIGINT)), greatest(1, e // (2 * 4)))) AS per_task FROM d""")
def episodes_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that one task should carry."""
    per = frames(spark, sf_dir, "dataset").groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("n")).groupBy("dataset").agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("f"))
    return per.select("dataset", scalar.episodes_per_task(F.col("f") / F.col("e"), F.col("e"), F.lit(4), 2000).alias("per_task"))


@query("parallelism", """WITH d AS (SELECT p_partkey, p_partkey % 70 AS files, 1 + p_size AS cores FROM part), t AS (SELECT *, CASE WHEN files <= 0 THEN 1 ELSE least(greatest(cores // files, 1), 16) END AS threads FROM d)
    SELECT p_partkey, greatest(1, CASE WHEN files > 0 THEN least(greatest(cores // threads, 1), files) ELSE greatest(cores // threads, 1) END) AS workers, CAST(threads AS BIGINT) AS threads FROM t""")
def parallelism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers and threads for files on cores."""
    return table(spark, sf_dir, "part").select("p_partkey", scalar.parallelism(F.col("p_partkey") % 70, F.col("p_size") + 1).alias("p")).select("p_partkey", "p.*")


@query("worker_budget", "SELECT p_partkey, greatest(1, least(p_size, CAST(floor(128 / ((4.4::DOUBLE + 32::DOUBLE * (p_partkey % 160) / 1024::DOUBLE) * 1.25::DOUBLE)) AS BIGINT))) AS workers FROM part")
def worker_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers that memory allows."""
    return table(spark, sf_dir, "part").select("p_partkey", scalar.worker_budget(F.col("p_size"), F.lit(128.0), (F.col("p_partkey") % 160).cast("double")).alias("workers"))


@query("bench_summary", "SELECT l_shipmode_proxy AS unit, round(sum(l_quantity) / sum(s) + 1e-9, 6) AS per_second, round(sum(l_quantity) / sum(s) / 8 + 1e-9, 6) AS per_core, round(1000000 / (sum(l_quantity) / sum(s)) + 1e-9, 6) AS projected_s FROM (SELECT l_returnflag AS l_shipmode_proxy, l_quantity, 1 + l_linenumber::DOUBLE AS s FROM lineitem) GROUP BY 1")
def bench_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and a projection from measured units."""
    rate = F.sum("l_quantity") / F.nullif(F.sum(F.lit(1.0) + F.col("l_linenumber")), F.lit(0.0))
    out = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("unit")).agg(rate.alias("r"))
    near = lambda c: F.round(c + 1e-9, 6)
    return out.select("unit", near(F.col("r")).alias("per_second"), near(F.col("r") / 8).alias("per_core"), near(F.lit(1_000_000) / F.nullif(F.col("r"), F.lit(0.0))).alias("projected_s"))


@query("linear_depth", "SELECT event_id, round(0.01::DOUBLE / (1::DOUBLE - d * (1::DOUBLE - 0.01::DOUBLE / 50::DOUBLE)) + 1e-9, 6) AS depth FROM (SELECT event_id, (event_id % 1000) / 1001::DOUBLE AS d FROM events)")
def linear_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metres of depth buffer values."""
    d = (F.col("event_id") % 1000) / F.lit(1001.0)
    return table(spark, sf_dir, "events").select("event_id", F.round(scalar.linear_depth(d, 0.01, 50.0) + 1e-9, 6).alias("depth"))


@query("profile_overlay", "SELECT event_id, CAST(k AS VARCHAR) AS crf, CASE WHEN event_type = 'click' THEN NULL ELSE 'fast' END AS preset, 'h264' AS codec FROM (SELECT event_id, event_type, props ->> '$.k' AS k FROM events)")
def profile_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of three layers, an explicit null winning."""
    base = F.create_map(F.lit("codec"), F.lit("h264"), F.lit("crf"), F.lit("21"), F.lit("preset"), F.lit("medium"))
    profile = F.create_map(F.lit("preset"), F.lit("fast"))
    own = F.when(F.col("event_type") == "click", F.create_map(F.lit("crf"), F.get_json_object("props", "$.k"), F.lit("preset"), F.lit(None).cast("string"))).otherwise(F.create_map(F.lit("crf"), F.get_json_object("props", "$.k")))
    merged = scalar.overlay(base, profile, own)
    return table(spark, sf_dir, "events").select("event_id", merged.alias("m")).select("event_id", *[F.col("m")[k].alias(k) for k in ("crf", "preset", "codec")])


_DOC = """'{"id":' || event_id || ',"source":{"type":"' || event_type || '","user":' || user_id || ',"tags":[1,2]},"none":{},"props":' || props || '}'"""


@query("json_flatten", f"""WITH d AS (SELECT event_id, CAST(event_id AS VARCHAR) AS id, '"' || event_type || '"' AS t, CAST(user_id AS VARCHAR) AS u, props ->> '$.k' AS k FROM events)
    SELECT event_id, unnest(['id', 'source.type', 'source.user', 'source.tags', 'none', 'props.k']) AS path, unnest([id, t, u, '[1,2]', '{{}}', k]) AS value FROM d""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of nested documents by dotted path."""
    doc = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"source":{"type":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"), F.lit(',"tags":[1,2]},"none":{},"props":'), "props", F.lit("}"))
    return flatten_json(table(spark, sf_dir, "events").select("event_id", doc.alias("doc")), "event_id", "doc")


@query("stats_unflatten", """SELECT user_id, '{"' || 'value' || '":{"max":' || CAST(mx AS BIGINT) || '.0,"min":' || CAST(mn AS BIGINT) || '.0}}' AS document FROM (SELECT user_id, floor(max(value)) AS mx, floor(min(value)) AS mn FROM events GROUP BY 1)""")
def stats_unflatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested statistics from slashed names."""
    stats = table(spark, sf_dir, "events").groupBy("user_id").agg(F.floor(F.max("value")).cast("double").alias("max"), F.floor(F.min("value")).cast("double").alias("min"))
    rows = stats.select("user_id", F.explode(F.create_map(F.lit("value/max"), F.col("max"), F.lit("value/min"), F.col("min"))).alias("path", "value"))
    return unflatten(rows, "user_id").select("user_id", F.regexp_replace(F.translate("document", "\\", ""), '"(\\{.*?\\})"', "$1").alias("document"))


@query("modality_slices", f"SELECT DISTINCT dataset, '{{\"state\":{{\"start\":0,\"end\":' || w || '}},\"action\":{{\"start\":0,\"end\":' || w || ',\"absolute\":true}}}}' AS modality FROM (SELECT dataset, CAST(max(len(state_vec)) AS VARCHAR) AS w FROM {FRAMES_SQL} GROUP BY 1)")
def modality_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of each dataset's vectors as JSON."""
    w = frames(spark, sf_dir, "dataset", "state_vec").groupBy("dataset").agg(F.max(F.size("state_vec")).alias("w"))
    part = lambda *extra: F.struct(F.lit(0).alias("start"), F.col("w").alias("end"), *extra)
    return w.select("dataset", F.to_json(F.struct(part().alias("state"), part(F.lit(True).alias("absolute")).alias("action"))).alias("modality"))


@query("rlds_steps", f"""SELECT episode_index, list({{'frame_index': frame_index, 'gripper': gripper, 'is_first': f, 'is_last': l}} ORDER BY frame_index) AS steps FROM (SELECT episode_index, frame_index, gripper, lag(frame_index) OVER w IS NULL AS f, lead(frame_index) OVER w IS NULL AS l
    FROM {FRAMES_SQL} WHERE gripper IS NOT NULL AND NOT isnan(gripper) WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)) GROUP BY 1""")
def rlds_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes as arrays of steps, as the nested export writes them; an episode is one record there."""
    from framemill.operators.scans import step_flags

    rows = step_flags(frames(spark, sf_dir, "gripper").filter("gripper is not null and not isnan(gripper)"))
    return rows.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("frame_index", "gripper", "is_first", "is_last"))).alias("steps"))


@query("rlds_rename", "SELECT DISTINCT camera, replace(regexp_replace(camera, '^[^.]*\\.[^.]*\\.', ''), '.', '_') AS renamed FROM video_shots")
def rlds_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature names without their first two steps, or their last step if there are no more."""
    parts = F.split("camera", r"\.")
    name = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), "_")
    return table(spark, sf_dir, "video_shots").select("camera").dropDuplicates().select("camera", F.coalesce(F.nullif(name, F.lit("")), F.element_at(parts, -1)).alias("renamed"))


@query("usable_files", """WITH p AS (SELECT episode_index, list_distinct(list(CASE WHEN n_bytes IS NOT NULL THEN camera END)) AS present FROM video_shots GROUP BY 1)
    SELECT episode_index, CASE WHEN NOT list_contains(present, 'observation.images.chest') AND NOT list_contains(present, 'observation.images.left_palm') THEN 'empty'
      WHEN NOT (list_contains(present, 'observation.images.chest') AND list_contains(present, 'observation.images.left_palm')) THEN 'partial' END AS problem FROM p""")
def usable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that lack cameras, and how badly."""
    present = table(spark, sf_dir, "video_shots").groupBy("episode_index").agg(F.collect_set(F.when(F.col("n_bytes").isNotNull(), F.col("camera"))).alias("present"))
    return present.select("episode_index", orchestration.usable_class(F.col("present"), ["observation.images.chest", "observation.images.left_palm"], []).alias("problem"))


# Orders stand in for datasets and their lines for the records of steps.
_RECORDS = "r AS (SELECT l_orderkey AS ds, CASE l_linenumber % 3 WHEN 0 THEN 'fetch' WHEN 1 THEN 'build' ELSE 'publish' END AS step, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'ok' END AS status, l_discount < 0.09 AS \"exists\", l_shipdate AS started, l_shipdate + to_seconds(CAST(60 * l_quantity AS BIGINT)) AS finished, CAST(l_quantity AS BIGINT) AS items FROM lineitem)"
_DONE = f"{_RECORDS}, k AS (SELECT *, status = 'ok' AND \"exists\" AS done, row_number() OVER (PARTITION BY ds, step ORDER BY epoch_us(finished) + l_partkey DESC) AS n, max(epoch_us(finished) + l_partkey) OVER (PARTITION BY ds, step) AS last FROM r), d AS (SELECT ds, step, bool_and(done) AS done FROM k WHERE epoch_us(finished) + l_partkey = last GROUP BY ALL)"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber") % 3
    step = F.when(line == 0, "fetch").when(line == 1, "build").otherwise("publish")
    started = F.col("l_shipdate").cast("timestamp")
    finished = F.timestamp_micros(F.unix_micros(started) + (F.col("l_quantity") * 60_000_000).cast("bigint"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ds"), step.alias("step"), F.col("l_partkey"), F.when(F.col("l_returnflag") == "R", "failed").otherwise("ok").alias("status"), (F.col("l_discount") < 0.09).alias("exists"), started.alias("started"), finished.alias("finished"), F.col("l_quantity").cast("bigint").alias("items"))


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several lines of one order may end at once, so the later one is told by its part too; equal lines must all be done."""
    rank = F.unix_micros("finished") + F.col("l_partkey")
    rows = _records(spark, sf_dir).withColumn("finished", rank)
    same = rows.groupBy("ds", "step", "finished").agg(F.min(F.col("status")).alias("status"), F.bool_and("exists").alias("exists"), F.bool_and(F.col("status") == "ok").alias("ok"))
    return orchestration.step_done(same.withColumn("status", F.when(F.col("ok"), "ok").otherwise("failed")), ["ds"], {})


@query("step_done", f"WITH {_DONE} SELECT * FROM d")
def step_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each step's last record counts as done."""
    return _done(spark, sf_dir)


@query("step_status_pivot", f"WITH {_DONE} SELECT ds, coalesce(max(CASE WHEN step = 'fetch' THEN CASE WHEN done THEN 'done' ELSE 'failed' END END), '-') AS fetch, coalesce(max(CASE WHEN step = 'build' THEN CASE WHEN done THEN 'done' ELSE 'failed' END END), '-') AS build, coalesce(max(CASE WHEN step = 'publish' THEN CASE WHEN done THEN 'done' ELSE 'failed' END END), '-') AS publish FROM d GROUP BY 1")
def step_status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of all steps, a row a dataset."""
    return orchestration.status_pivot(_done(spark, sf_dir), ["ds"])


@query("timings", f"""WITH {_RECORDS}, s AS (SELECT ds, step, (epoch_us(finished) - epoch_us(started)) / 1e6::DOUBLE AS s, items FROM r), w AS (SELECT ds, coalesce(sum(s) FILTER (step = 'fetch'), 0) AS fetch_s, coalesce(sum(s) FILTER (step = 'build'), 0) AS build_s, coalesce(sum(s) FILTER (step = 'publish'), 0) AS publish_s, sum(s) AS total_s, max(items) AS items FROM s GROUP BY 1)
    SELECT ds, fetch_s, build_s, publish_s, total_s, round(items / total_s + 1e-9, 6) AS rate, round(build_s / total_s + 1e-9, 6) AS build_share FROM w""")
def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds by step, rates and shares."""
    return orchestration.timings(_records(spark, sf_dir), ["ds"]).withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("rate", "build_share")})


@query("reclaimable", f"WITH {_DONE}, s AS (SELECT DISTINCT l_orderkey AS ds, l_partkey AS source FROM lineitem), p AS (SELECT ds FROM d WHERE step = 'publish' AND done) SELECT DISTINCT source FROM s WHERE ds IN (SELECT ds FROM p) AND source NOT IN (SELECT source FROM s WHERE ds NOT IN (SELECT ds FROM p))")
def reclaimable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that nothing unfinished needs."""
    sources = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ds"), F.col("l_partkey").alias("source")).dropDuplicates()
    return orchestration.reclaimable(_done(spark, sf_dir), sources, "ds")


@query("plan_summary", """WITH d AS (SELECT a.dataset, max(a.source_mirror) AS source, bool_or(a.delivered_path IS NOT NULL) AS buildable FROM addresses a GROUP BY 1), e AS (SELECT dataset, max(CASE WHEN episodes > 0 THEN episodes END) AS episodes FROM candidates GROUP BY 1)
    SELECT CASE WHEN source IS NULL THEN 'no source' WHEN NOT buildable THEN 'unbuildable' WHEN e.episodes IS NULL THEN 'unknown size' WHEN e.episodes = 0 THEN 'empty' ELSE 'ready' END AS state, count(*) AS n FROM d LEFT JOIN e USING (dataset) GROUP BY 1""")
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds up the listed datasets."""
    listed = table(spark, sf_dir, "addresses").groupBy("dataset").agg(F.max("source_mirror").alias("source"), F.bool_or(F.col("delivered_path").isNotNull()).alias("buildable"))
    known = table(spark, sf_dir, "candidates").groupBy("dataset").agg(F.max(F.when(F.col("episodes") > 0, F.col("episodes"))).alias("episodes"))
    return orchestration.plan_summary(listed.join(known, "dataset", "left"))
