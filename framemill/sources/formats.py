"""Raw episode formats behind a closed registry, read through Spark's Python data sources.

A reader gives rows of frames and, beside them, the episodes it skipped and why. ``episode_json`` is the format that needs
nothing but Python: a folder of JSON documents, one an episode. ``hdf5_episodes`` is there if h5py is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from framemill.sources.files import filesystem

_FORMATS: dict[str, Callable[[bytes, dict], Iterator[tuple]]] = {}

#: Rows of every reader: a frame, or a skipped episode with its reason and no frame.
SCHEMA = "episode_id string, frame_index bigint, t double, state array<float>, action array<float>, prompt string, skipped string"


class EpisodeSkipped(Exception):
    """An episode that can't be used, and why."""


def register_format(name: str) -> Callable:
    """Add a reader: (file's bytes, options) -> (frame_index, t, state, action, prompt)."""

    def add(fn: Callable[[bytes, dict], Iterator[tuple]]) -> Callable:
        if name in _FORMATS:
            raise ValueError(f"format {name} is registered twice")
        _FORMATS[name] = fn
        return fn

    return add


def formats() -> list[str]:
    """Names of the known formats."""
    return sorted(_FORMATS)


def check_widths(row: dict, widths: dict[str, int]) -> None:
    """Refuse vectors of another width than declared, rather than read columns as something else."""
    for name, width in widths.items():
        if len(row.get(name) or []) != width:
            raise EpisodeSkipped(f"width of {name} is {len(row.get(name) or [])}, expected {width}")


@register_format("episode_json")
def _json_episode(data: bytes, options: dict) -> Iterator[tuple]:
    try:
        document = json.loads(data)
    except ValueError as e:
        raise EpisodeSkipped("unreadable") from e
    widths = json.loads(options.get("widths", "{}"))
    frames = document.get("frames") if isinstance(document, dict) else None
    if not frames:
        raise EpisodeSkipped("no frames")
    rows = []
    for i, f in enumerate(frames):
        check_widths(f, widths)
        rows.append((i, float(f["t"]), *[[None if x is None else float(x) for x in f[v]] for v in ("state", "action")], document.get("prompt")))
    return iter(rows)


@register_format("hdf5_episodes")
def _hdf5_episode(data: bytes, options: dict) -> Iterator[tuple]:
    try:
        import io

        import h5py
    except ImportError as e:
        raise EpisodeSkipped("h5py isn't installed") from e
    with h5py.File(io.BytesIO(data)) as f:
        names = json.loads(options.get("datasets", '{"t": "timestamps", "state": "state/robot", "action": "action/robot"}'))
        missing = [n for n in names.values() if n not in f]
        if missing:
            raise EpisodeSkipped(f"{missing[0]} is missing")
        t, state, action = (f[names[k]][()] for k in ("t", "state", "action"))
        for i in range(len(t)):
            check_widths({"state": state[i], "action": action[i]}, json.loads(options.get("widths", "{}")))
        return iter([(i, float(t[i]), [float(x) for x in state[i]], [float(x) for x in action[i]], None) for i in range(len(t))])


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector

        system, base = filesystem(self.options["path"])
        files = sorted(i.path for i in system.get_file_info(FileSelector(base, recursive=True)) if i.is_file and not i.base_name.startswith((".", "_")))
        each = max(1, int(self.options.get("filesPerTask", "16")))
        return [_Files(files[i : i + each]) for i in range(0, len(files), each)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        system, _ = filesystem(self.options["path"])
        reader = _FORMATS[self.options.get("reader", "episode_json")]
        for path in partition.paths:
            name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            try:
                with system.open_input_stream(path) as f:
                    rows = list(reader(f.read(), self.options))
            except (EpisodeSkipped, OSError, KeyError, TypeError, ValueError) as e:
                yield (name, None, None, None, None, None, str(e) if isinstance(e, EpisodeSkipped) else f"malformed: {type(e).__name__}")
                continue
            for index, t, state, action, prompt in rows:
                yield (name, index, t, state, action, prompt, None)


class EpisodeSource(DataSource):
    """``spark.read.format("episodes").option("reader", "episode_json").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "episodes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options)


def read_raw(spark: SparkSession, folder: str, reader: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """(frames, skipped episodes with their reason) of a folder of raw episodes."""
    if reader not in _FORMATS:
        raise ValueError(f"unknown format {reader}; known are {', '.join(formats())}")
    spark.dataSource.register(EpisodeSource)
    rows = spark.read.format("episodes").options(reader=reader, **options).load(folder)
    return rows.filter(F.col("skipped").isNull()).drop("skipped"), rows.filter(F.col("skipped").isNotNull()).select("episode_id", F.col("skipped").alias("reason"))
