"""Files written and listed by tasks themselves: one file an episode or destination, under names that readers expect."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.session import cut_lineage, task_target


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; Hadoop's ``file:/x`` is understood too."""
    if path.startswith("file:/"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def no_pattern(path: str) -> str:
    """The path for Spark's readers, which would take braces and the like for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def write_json(path: str, document: dict) -> None:
    """A JSON document, moved into place when it is whole."""
    system, at = filesystem(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at + ".tmp") as f:
        f.write(json.dumps(document, indent=2, sort_keys=True).encode())
    system.move(at + ".tmp", at)


def write_files(df: DataFrame, root: str, name: Column, group: list[str], order: list[str], drop: list[str] | None = None, **options: object) -> DataFrame:
    """``file, n_rows, n_bytes`` of the files written: one Parquet file for each value of ``name``, a row group for each ``group``.

    Rows are hashed on the file's name and sorted, and a task writes its files one after the other as rows come, so
    memory holds a row group at most. A file appears under its name only when it is whole (written aside, then moved),
    so that a task that is lost and runs again writes the same files. The result must be acted on for files to appear.
    """
    columns = [c for c in df.columns if c not in (drop or [])]
    keyed = df.withColumn("__file", name)
    ready = keyed.repartition("__file").sortWithinPartitions("__file", *group, *order)
    names = ready.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        file, writer, aside, rows, last = None, None, "", 0, None
        held: list[pa.RecordBatch] = []
        done: list[tuple[str, int, int]] = []

        def flush() -> None:
            nonlocal held, writer
            if held:
                table = pa.Table.from_batches(held)
                if writer is None:
                    writer = pq.ParquetWriter(system.open_output_stream(aside), table.schema, **options)
                writer.write_table(table, row_group_size=max(1, table.num_rows))
                held = []

        def close() -> None:
            nonlocal writer
            if file is None:
                return
            flush()
            writer.close()
            writer = None
            target = f"{base}/{file}"
            system.move(aside, target)
            done.append((file, rows, system.get_file_info(target).size))

        for batch in batches:
            n = batch.num_rows
            files = batch.column(names.index("__file")).to_pylist()
            groups = list(zip(*[batch.column(names.index(g)).to_pylist() for g in group], strict=True)) if group else [()] * n
            start = 0
            for i in range(n + 1):
                here = (files[i], groups[i]) if i < n else None
                if i and (i == n or here != (files[i - 1], groups[i - 1])):
                    key = (files[i - 1], groups[i - 1])
                    if key != last:
                        if last is not None and key[0] == last[0]:
                            flush()
                        elif key[0] != file:
                            close()
                            file, rows = key[0], 0
                            aside = f"{base}/{os.path.dirname(file)}/.{os.path.basename(file)}.{uuid.uuid4().hex}"
                            system.create_dir(os.path.dirname(aside), recursive=True)
                        last = key
                    held.append(pa.RecordBatch.from_arrays([batch.column(names.index(c)).slice(start, i - start) for c in columns], names=columns))
                    rows += i - start
                    start = i
        close()
        if done:
            yield pa.record_batch([pa.array([d[k] for d in done]) for k in range(3)], names=["file", "n_rows", "n_bytes"])

    return ready.mapInArrow(run, "file string, n_rows bigint, n_bytes bigint")


def write_lines(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """``file, n_rows`` of a JSON Lines file with a row's JSON a line, in order. For metadata: one task streams it."""
    lines = df.select(*order, F.to_json(F.struct(*df.columns)).alias("__line")).repartition(1).sortWithinPartitions(*order)
    at = lines.columns.index("__line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, target = filesystem(path)
        system.create_dir(os.path.dirname(target), recursive=True)
        aside, n = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}", 0
        with system.open_output_stream(aside) as out:
            for batch in batches:
                for line in batch.column(at).to_pylist():
                    out.write(line.encode() + b"\n")
                    n += 1
        system.move(aside, target)
        yield pa.record_batch([pa.array([path]), pa.array([n])], names=["file", "n_rows"])

    return lines.mapInArrow(run, "file string, n_rows bigint")


def walk(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``path, length`` of the files under a folder, found level by level: each folder is listed by a task.

    ``path`` is below ``root``. Names that start with ``.`` or ``_`` are passed over, folders too, unless they are
    partition folders (``_k=0``). A folder that isn't there has no files. Nothing of the files' content is read.
    """
    found = "path string, length bigint, folder boolean"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                there = system.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base, allow_not_found=True))
                there = [i for i in there if not i.base_name.startswith((".", "_")) or (not i.is_file and "=" in i.base_name)]
                paths = [f"{folder}/{i.base_name}" if folder else i.base_name for i in there]
                yield pa.record_batch([pa.array(paths, pa.string()), pa.array([i.size for i in there], pa.int64()), pa.array([not i.is_file for i in there], pa.bool_())], names=["path", "length", "folder"])

    level = cut_lineage(spark.createDataFrame([("",)], "path string").mapInArrow(look, found))
    files = level.filter("not folder")
    while n := level.filter("folder").count():
        folders = level.filter("folder").select("path").repartition(min(n, task_target(spark)), "path")
        level = cut_lineage(folders.mapInArrow(look, found))
        files = files.unionByName(level.filter("not folder"))
    return files.filter(F.col("path").endswith(suffix)).select("path", "length")


def mirror(spark: SparkSession, source: str, target: str, *, link: bool = True) -> int:
    """Copy the files of a folder in tasks and move the whole into place at the end; gives the number of files.

    On a local file system files are hard links if ``link``, and copies where a link can't be made. A target that holds
    something already is an error, and nothing of it changes; a run that breaks off leaves no target.
    """
    target_system, target_base = filesystem(target)
    if target_system.get_file_info(fs.FileSelector(target_base, allow_not_found=True)):
        raise FileExistsError(f"{target} isn't empty")
    aside = f"{os.path.dirname(target_base)}/.{os.path.basename(target_base)}.{uuid.uuid4().hex}"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(source)
        onto, _ = filesystem(target)
        local = link and isinstance(system, fs.LocalFileSystem) and isinstance(onto, fs.LocalFileSystem)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                onto.create_dir(os.path.dirname(f"{aside}/{path}"), recursive=True)
                if not (local and _linked(f"{base}/{path}", f"{aside}/{path}")):
                    fs.copy_files(f"{base}/{path}", f"{aside}/{path}", source_filesystem=system, destination_filesystem=onto)
            yield pa.record_batch([batch.column(0)], names=["path"])

    files = walk(spark, source).select("path")
    n = files.repartition("path").mapInArrow(place, "path string").count()
    target_system.create_dir(aside, recursive=True)
    if target_system.get_file_info(target_base).type.name == "Directory":
        target_system.delete_dir(target_base)
    target_system.move(aside, target_base)
    return n


def _linked(source: str, target: str) -> bool:
    try:
        os.link(source, target)
    except FileExistsError:  # the task ran before
        return True
    except OSError:
        return False
    return True
