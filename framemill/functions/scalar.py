"""Scalar expressions: geometry, sizing, paths, texts, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resize_geometry(h: Column, w: Column, max_area: int = 65536, multiple: int = 16) -> Column:
    """Struct ``resize_h, resize_w, crop_h, crop_w`` of a picture: only made smaller, aspect kept, area bounded, cropped to multiples.

    Null if even the smallest allowed short side gives a crop above ``max_area``, or for sizes that aren't positive.
    """
    scale = F.least(F.lit(1.0), F.sqrt(F.lit(float(max_area)) / (h.cast("double") * w.cast("double"))))
    short, long = F.least(h, w).cast("double"), F.greatest(h, w).cast("double")
    short_r = F.greatest(F.lit(float(multiple)), F.floor(short * scale / multiple).cast("double") * multiple)
    long_r = F.floor(long * (short_r / short))
    rh = F.when(h <= w, short_r.cast("bigint")).otherwise(long_r)
    rw = F.when(h <= w, long_r).otherwise(short_r.cast("bigint"))
    ch, cw = rh - rh % multiple, rw - rw % multiple
    fits = (h > 0) & (w > 0) & (ch * cw <= max_area)
    return F.when(fits, F.struct(rh.alias("resize_h"), rw.alias("resize_w"), ch.alias("crop_h"), cw.alias("crop_w")))


def cover_crop(h: Column, w: Column, to_h: int, to_w: int) -> Column:
    """Struct ``scaled_h, scaled_w, top, left``: scaled to cover the target (half-even rounding), then cropped at the centre."""
    scale = F.greatest(F.lit(float(to_h)) / h, F.lit(float(to_w)) / w)
    sh, sw = F.bround(h * scale, 0).cast("bigint"), F.bround(w * scale, 0).cast("bigint")
    return F.struct(sh.alias("scaled_h"), sw.alias("scaled_w"), F.floor((sh - to_h) / 2.0).alias("top"), F.floor((sw - to_w) / 2.0).alias("left"))


def parse_rate(text: Column) -> Column:
    """The number behind ``a/b`` or ``a``; null if it isn't one or b is 0."""
    parts = F.split(F.trim(text), "/")
    up, down = (F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))
    return F.when(F.size(parts) == 1, up).when(F.size(parts) == 2, F.when(down != 0, up / down))


def episodes_per_task(frames_per_episode: Column, episodes: Column, workers: Column, frames_per_task: int, default: int = 100) -> Column:
    """Episodes of one task: enough frames to be worth it, few enough for two tasks a worker, at least 1; ``default`` if lengths are unknown."""
    by_frames = F.greatest(F.lit(1), F.bround(F.lit(float(frames_per_task)) / F.nullif(frames_per_episode, F.lit(0.0)), 0).cast("bigint"))
    by_workers = F.greatest(F.lit(1), F.floor(episodes / (F.lit(2) * F.greatest(F.lit(1), workers))))
    return F.when(frames_per_episode.isNull() | (frames_per_episode == 0), F.lit(default).cast("bigint")).otherwise(F.greatest(F.lit(1).cast("bigint"), F.least(by_frames, by_workers)))


def parallelism(files: Column, cores: Column, most_threads: int = 16) -> Column:
    """Struct ``workers, threads``: one thread a file if there are many files, several if there are few."""
    have = F.greatest(F.lit(1), cores)
    threads = F.when(files <= 0, F.lit(1)).otherwise(F.least(F.greatest(F.floor(have / files), F.lit(1)), F.lit(most_threads)))
    workers = F.greatest(F.floor(have / threads), F.lit(1))
    workers = F.greatest(F.lit(1), F.when(files > 0, F.least(workers, files)).otherwise(workers))
    return F.struct(workers.cast("bigint").alias("workers"), threads.cast("bigint").alias("threads"))


def worker_budget(cores: Column, memory_gib: Column, episode_mib: Column, share: int = 1) -> Column:
    """Workers that memory allows: each needs (4.4 GiB + 32 episodes) and a quarter more."""
    need = (F.lit(4.4) + F.lit(32.0) * episode_mib / F.lit(1024.0)) * F.lit(1.25)
    return F.greatest(F.lit(1).cast("bigint"), F.least(cores.cast("bigint"), F.floor(memory_gib / F.lit(float(share)) / need)))


def size_ratio_ok(mine: Column, theirs: Column, tolerance: float = 0.15) -> Column:
    """Whether two sizes are alike; true if theirs is 0 or unknown."""
    return F.coalesce(F.abs(mine / F.nullif(theirs, F.lit(0.0)) - 1) <= tolerance, F.lit(True))


def sentence(task_dir: Column) -> Column:
    """A task's folder name as a sentence: leading number and dash gone, underscores to spaces; the name itself if nothing is left."""
    words = F.trim(F.translate(F.regexp_replace(task_dir, r"^\d+-", ""), "_", " "))
    return F.coalesce(F.nullif(words, F.lit("")), task_dir)


def instruction(*sources: Column) -> Column:
    """The first source that isn't null or blank."""
    return F.coalesce(*[F.nullif(F.trim(s), F.lit("")) for s in sources])


def scene_task(file: Column) -> Column:
    """The task in a demonstration file's name, behind its scene number if it has one."""
    scene, plain = F.regexp_extract(file, r"_SCENE\d+_(.*?)_demo\.hdf5", 1), F.regexp_extract(file, r"([^/]*?)_demo\.hdf5", 1)
    return F.coalesce(F.nullif(scene, F.lit("")), F.nullif(plain, F.lit("")))


def unwrapped(text: Column) -> Column:
    """Text without the wrapper that printing a tensor of bytes leaves around it."""
    return F.regexp_replace(F.regexp_replace(text, r"^tf\.Tensor\(b'", ""), r"', shape=\(\), dtype=string\)$", "")


def machine_name(text: Column) -> Column:
    """A name in lower case with spaces and dashes as underscores."""
    return F.translate(F.lower(text), " -", "__")


def template_glob(template: Column, camera: Column) -> Column:
    """A path template as a glob: the camera filled in, every other step with a placeholder reduced to ``*`` and its suffix."""
    filled = F.replace(template, F.lit("{video_key}"), camera)
    return F.regexp_replace(filled, r"[^/]*\{[^/]*\}", "*")


def from_codes(codes: Column) -> Column:
    """Text of an array of code points, up to the first 0; all of Unicode, and what isn't a code point as U+FFFD."""
    end = F.array_position(codes, F.lit(0))
    shown = F.when(end > 0, F.slice(codes, F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))).otherwise(codes)
    valid = F.transform(shown, lambda c: F.when(c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF), c).otherwise(F.lit(0xFFFD)))
    return F.decode(F.unhex(F.array_join(F.transform(valid, lambda c: F.lpad(F.hex(c), 8, "0")), "")), "UTF-32")


def wall_clock(text: Column, fmt: str = "yyyy-MM-dd'T'HH-mm-ss") -> Column:
    """Microseconds since the epoch of ``2024-01-31T10-20-30_123456``; a fraction beyond a dot is cut."""
    cut = F.get(F.split(text, r"\."), F.lit(0))
    whole = F.try_to_timestamp(F.substring_index(cut, "_", 1), F.lit(fmt))
    fraction = F.rpad(F.substring_index(cut, "_", -1), 6, "0").try_cast("bigint")
    return F.unix_micros(whole) + F.when(F.instr(cut, "_") > 0, F.coalesce(fraction, F.lit(0))).otherwise(F.lit(0))


def clock_text(seconds: Column) -> Column:
    """A duration as ``12s``, ``3m04s`` or ``2h05m``."""
    s = F.bround(seconds, 0).cast("bigint")
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    minutes = F.concat((F.expr("1") * F.floor(s / 60)).cast("string"), F.lit("m"), pad(s % 60), F.lit("s"))
    hours = F.concat(F.floor(s / 3600).cast("string"), F.lit("h"), pad(F.floor(s % 3600 / 60)), F.lit("m"))
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, minutes).otherwise(hours)


def listed_bytes(text: Column) -> Column:
    """The number behind ``Total Size:`` in a store's listing."""
    return F.regexp_extract(text, r"Total Size:\s*(\d+)", 1).try_cast("bigint")


def nearest_name(word: Column, names: list[str], most: int = 3) -> Column:
    """The known name with the smallest edit distance, if at most ``most``; the first of equals."""
    scored = F.array_sort(F.array(*[F.struct(F.levenshtein(word, F.lit(n)).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in enumerate(names)]))
    return F.when(F.get(scored, F.lit(0))["d"] <= most, F.get(scored, F.lit(0))["n"])


def significant(x: Column, digits: int = 12) -> Column:
    """A double cut to so many significant digits."""
    return F.format_string(f"%.{digits - 1}e", x).cast("double")


def quaternion_euler(q: Column) -> Column:
    """Roll, pitch, yaw of a quaternion (x, y, z, w)."""
    x, y, z, w = (F.get(q, F.lit(i)).cast("double") for i in range(4))
    roll = F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y))
    pitch = F.asin(F.greatest(F.least(2 * (w * y - z * x), F.lit(1.0)), F.lit(-1.0)))
    yaw = F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))
    return F.array(roll, pitch, yaw)


def quaternion_axis_angle(q: Column) -> Column:
    """Rotation vector (axis times angle) of a quaternion (x, y, z, w); w is bounded to [-1, 1], no rotation is three zeros."""
    x, y, z, w = (F.get(q, F.lit(i)).cast("double") for i in range(4))
    w = F.least(F.greatest(w, F.lit(-1.0)), F.lit(1.0))
    length = F.sqrt(1 - w * w)
    scale = F.when(length < 1e-12, F.lit(0.0)).otherwise(2 * F.acos(w) / length)
    return F.array(x * scale, y * scale, z * scale)


def camera_matrix(fovy: Column, height: Column, width: Column) -> Column:
    """Intrinsic 3 x 3 matrix of a camera with a vertical field of view in degrees, principal point in the middle of the picture."""
    focal = F.lit(0.5) * height / F.tan(F.radians(fovy) / 2)
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(F.array(focal, zero, width / F.lit(2.0)), F.array(zero, focal, height / F.lit(2.0)), F.array(zero, zero, one))


def camera_pose(position: Column, rotation: Column) -> Column:
    """Extrinsic 4 x 4 matrix from a position and a 3 x 3 rotation in row order, turned so that z points along the view: the second and third axis change sign."""
    r = lambda i, j: F.get(rotation, F.lit(3 * i + j)).cast("double") * (1.0 if j == 0 else -1.0)
    rows = [F.array(r(i, 0), r(i, 1), r(i, 2), F.get(position, F.lit(i)).cast("double")) for i in range(3)]
    return F.array(*rows, F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]))


def linear_depth(d: Column, near: float, far: float) -> Column:
    """Metres of a normalised depth buffer value."""
    return F.lit(near) / (F.lit(1.0) - d * (F.lit(1.0) - F.lit(near / far)))


def overlay(*layers: Column) -> Column:
    """Maps laid over each other: a later layer's value wins, an explicit null included."""
    entries = F.concat(*[F.coalesce(F.map_entries(m), F.array()) for m in layers])
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, last))


def constant_block(values: Column, tolerance: float = 1e-9) -> Column:
    """Whether all elements are equal within the tolerance; an empty array is."""
    return F.coalesce(F.array_max(values) - F.array_min(values) <= tolerance, F.lit(True))
