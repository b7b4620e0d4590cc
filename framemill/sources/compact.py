"""Consolidation of a folder's small Parquet files, following a compaction journal.

The folder itself isn't touched. Beside it lies a state folder: ``journal`` with a table of transactions for each run, and
``data`` with the files those runs made, in the same partition folders (``k=0/``) as their inputs. A run is there once its
journal is, which is moved into place last; a run that broke off leaves only data that nothing refers to, and the next
one, having the same inputs, plans the same transactions and takes over those of its files that are whole. The live files
are those of the folder and those that a journal names as outputs, less all that a journal names as inputs. Files are
known by their root and their path below it, so neither a folder's name nor the way it is spelled matters.

Listing, merging and counting happen in tasks, by file; no list of files comes to the driver but for ``read_live``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framemill.operators.compaction import Sizes, compaction_journal
from framemill.session import cut_lineage
from framemill.sources.files import filesystem, no_pattern, walk

MB = 1 << 20
DEFAULT = Sizes(small=16.0, good=128.0, unit=0.25)
#: Bytes of rows that a merge holds before it writes them as a row group.
ROW_GROUP_BYTES = 64 << 20
#: Roots of files: the folder to compact, and what runs made of it.
SOURCE, MADE = "source", "made"


def _holds_something(path: str) -> bool:
    system, at = filesystem(path)
    return bool(system.get_file_info(FileSelector(at, allow_not_found=True)))


def journal(spark: SparkSession, state: str) -> DataFrame | None:
    """All transactions of all runs so far, or None: ``run, txn, level, input, input_root, input_path, size, output, output_path``.

    An input without a path is the output of an earlier level, which was never written on its own; ``output_path`` is
    where, below the ``data`` folder, the file lies that the transaction's records ended up in.
    """
    return spark.read.option("recursiveFileLookup", True).parquet(no_pattern(f"{state}/journal")) if _holds_something(f"{state}/journal") else None


def _partition(path: Column) -> Column:
    """The partition folders of a path below its root (``k=0/l=x``), or the empty string."""
    folders = F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1)
    return F.array_join(F.filter(folders, lambda f: f.contains("=")), "/")


def live_files(spark: SparkSession, folder: str, state: str, done: DataFrame | None = None) -> DataFrame:
    """``root, path, length, folder`` of the files that hold the folder's records now, each record in exactly one.

    ``path`` is below the root, ``folder`` its partition folders. ``done`` stands in for the journal.
    """
    columns = ["root", "path", "length", _partition(F.col("path")).alias("folder")]
    files = walk(spark, folder, ".parquet").withColumn("root", F.lit(SOURCE)).select(*columns)
    done = journal(spark, state) if done is None else done
    if done is None:
        return files
    made = done.select(F.col("output_path").alias("path")).dropDuplicates()
    ours = walk(spark, f"{state}/data", ".parquet").withColumn("root", F.lit(MADE)).select(*columns).join(made, "path", "left_semi")
    used = done.filter("input_path is not null").select(F.col("input_root").alias("root"), F.col("input_path").alias("path"))
    return files.unionByName(ours).join(used, ["root", "path"], "left_anti")


def count_records(files: DataFrame, folder: str, state: str) -> int:
    """Records of files (``root, path``), from their footers, read in tasks."""
    roots = _roots(folder, state)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [_open(roots[r], p).metadata.num_rows for r, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.record_batch([pa.array(n, pa.int64())], names=["n"])

    return files.select("root", "path").mapInArrow(count, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_live(spark: SparkSession, folder: str, state: str) -> DataFrame:
    """The folder's records, with its partition folders as columns, types as Spark infers them.

    The list of live files comes to the driver, as any scan's does; after compaction they are few.
    """
    live = cut_lineage(live_files(spark, folder, state))
    kinds = _partition_kinds(live)
    parts = []
    for root, base in _roots(folder, state).items():
        paths = [f"{base}/{r['path']}" for r in live.filter(F.col("root") == root).select("path").collect()]
        if paths:
            rows = spark.read.option("basePath", base).parquet(*map(no_pattern, paths))
            parts.append(rows.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in rows.columns]))
    if not parts:
        raise FileNotFoundError(f"no Parquet files in {folder}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def compact(spark: SparkSession, folder: str, state: str, sizes: Sizes = DEFAULT) -> int:
    """Merge the small live files; gives the number of files merged, 0 if there was nothing to merge.

    Files are only merged within one partition folder. A file that would only be written again alone stays as it is.
    A column that some of the files merged lack is null in their rows; one whose type differs is an error, and so are an
    empty folder's journal with outputs that aren't there, records that a merge would lose or double, and INT96
    timestamps inside of nested columns. Files that aren't small are neither read nor written.
    """
    live = cut_lineage(live_files(spark, folder, state).withColumn("file_key", F.xxhash64("root", "path")))
    files = live.select(F.lit("data").alias("kind"), F.col("folder").alias("grp"), "file_key", (F.col("length") / MB).alias("size"))
    plan = cut_lineage(compaction_journal(files, {"data": sizes}))
    originals = plan.filter("file_key is not null")
    together = originals.groupBy("ends_in").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("ends_in")
    plan = plan.join(together, "ends_in", "left_semi")
    totals = plan.agg(F.count("file_key").alias("n"), F.bit_xor(F.xxhash64("txn", "input")).alias("x")).first()
    if not totals["n"]:
        return 0
    run = f"run-{totals['x'] & (2**64 - 1):016x}-{totals['n']}"
    at = F.concat(F.lit(f"{run}/"), F.when(F.col("grp") == "", "").otherwise(F.concat("grp", F.lit("/"))), F.regexp_replace("ends_in", "[^0-9a-z]", "-"), F.lit(".parquet"))
    paths = live.select("file_key", F.col("root").alias("input_root"), F.col("path").alias("input_path"))
    entries = plan.withColumn("output_path", at).join(paths, "file_key", "left")
    entries = cut_lineage(entries.select(F.lit(run).alias("run"), "txn", "level", "input", "input_root", "input_path", "size", "output", "output_path"))
    merges = entries.filter("input_path is not null")
    written = _merge(merges, folder, state).agg(F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("n_rows")).first()
    _prove(spark, live, merges, entries, written, folder, state)
    entries.write.mode("overwrite").parquet(f"{state}/staged/{run}")
    system, base = filesystem(state)
    system.create_dir(f"{base}/journal", recursive=True)
    system.move(f"{base}/staged/{run}", f"{base}/journal/{run}")
    return totals["n"]


def _prove(spark: SparkSession, live: DataFrame, merges: DataFrame, entries: DataFrame, written: T.Row, folder: str, state: str) -> None:
    """An error unless the live files after the run are those before, less its inputs, and its outputs, with the same records."""
    done = journal(spark, state)
    after = cut_lineage(live_files(spark, folder, state, entries if done is None else done.unionByName(entries)))
    rest = live.join(merges.select(F.col("input_root").alias("root"), F.col("input_path").alias("path")), ["root", "path"], "left_anti").select("root", "path")
    outputs = merges.select(F.lit(MADE).alias("root"), F.col("output_path").alias("path")).dropDuplicates()
    mark = lambda d: d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("root", "path"))).first()
    if mark(rest.unionByName(outputs)) != mark(after):
        raise RuntimeError(f"the live files of {folder} wouldn't be those before the run with the merged ones replaced")
    records = count_records(after.join(outputs, ["root", "path"], "left_semi"), folder, state)
    if records != written["n_rows"]:
        raise RuntimeError(f"{records} records can be read of {written['n_rows']} merged")


def _roots(folder: str, state: str) -> dict[str, str]:
    return {SOURCE: folder.rstrip("/"), MADE: f"{state}/data"}


def _open(root: str, path: str) -> pq.ParquetFile:
    system, base = filesystem(root)
    return pq.ParquetFile(system.open_input_file(f"{base}/{path}"), coerce_int96_timestamp_unit="us")


def _merge(merges: DataFrame, folder: str, state: str) -> DataFrame:
    """``output_path, n_rows`` of each output, written by the task that reads its inputs one after the other.

    An output appears under its name only when it is whole; one that is there with its inputs' records is left.
    """
    roots = _roots(folder, state)
    by_output = merges.select("output_path", "input_root", "input_path").repartition("output_path").sortWithinPartitions("output_path", "input_root", "input_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        output, inputs = None, []
        for batch in batches:
            for out, root, path in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if out != output:
                    if inputs:
                        yield _merge_one(roots, inputs, output)
                    output, inputs = out, []
                inputs.append((roots[root], path))
        if inputs:
            yield _merge_one(roots, inputs, output)

    return by_output.mapInArrow(run, "output_path string, n_rows bigint")


def _merge_one(roots: dict[str, str], inputs: list[tuple[str, str]], output: str) -> pa.RecordBatch:
    expected, schemas = 0, []
    for root, path in inputs:
        file = _open(root, path)
        expected += file.metadata.num_rows
        schemas.append(_stamped(file))
        file.close()
    schema = schemas[0] if all(s.equals(schemas[0]) for s in schemas) else _joined(schemas)
    system, base = filesystem(roots[MADE])
    target = f"{base}/{output}"
    if system.get_file_info(target).type.name == "NotFound" or _open(roots[MADE], output).metadata.num_rows != expected:
        aside = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
        system.create_dir(os.path.dirname(target), recursive=True)
        with pq.ParquetWriter(system.open_output_stream(aside), schema, compression="snappy") as writer:
            _copy_rows(inputs, schema, writer)
        system.move(aside, target)
    n = _open(roots[MADE], output).metadata.num_rows
    if n != expected:
        raise RuntimeError(f"{output} has {n} records of {expected}")
    return pa.record_batch([pa.array([output]), pa.array([n], pa.int64())], names=["output_path", "n_rows"])


def _joined(schemas: list[pa.Schema]) -> pa.Schema:
    """The columns of all schemas by name, all nullable; an error where types differ."""
    return pa.unify_schemas([pa.schema([f.with_nullable(True).remove_metadata() for f in s]) for s in schemas])


def _copy_rows(inputs: list[tuple[str, str]], schema: pa.Schema, writer: pq.ParquetWriter) -> None:
    held: list[pa.Table] = []
    size = 0
    for root, path in inputs:
        for batch in _open(root, path).iter_batches():
            table = pa.Table.from_batches([batch])
            columns = [table[f.name].cast(f.type) if f.name in table.column_names else pa.nulls(table.num_rows, f.type) for f in schema]
            held.append(pa.table(columns, schema=schema))
            size += table.nbytes
            if size >= ROW_GROUP_BYTES:
                writer.write_table(pa.concat_tables(held))
                held, size = [], 0
    if held:
        writer.write_table(pa.concat_tables(held))


def _stamped(file: pq.ParquetFile) -> pa.Schema:
    """The file's schema, where INT96 timestamps are instants, which is what Spark takes them for."""
    schema = file.schema_arrow
    for i in range(len(file.schema)):
        column = file.schema.column(i)
        if column.physical_type == "INT96":
            at = schema.get_field_index(column.path)
            if at < 0:
                raise ValueError(f"INT96 timestamps in the nested column {column.path} can't be merged")
            schema = schema.set(at, schema.field(at).with_type(pa.timestamp("us", tz="UTC")))
    return schema


def _partition_kinds(live: DataFrame) -> dict[str, str]:
    """Types of the partition columns over all live files: the narrowest that all values have."""
    values = live.select(F.explode(F.split("folder", "/")).alias("f")).filter("f <> ''").dropDuplicates()
    values = values.select(F.substring_index("f", "=", 1).alias("k"), F.url_decode(F.regexp_replace(F.expr("substring(f, instr(f, '=') + 1)"), "[+]", "%2B")).alias("v"))
    known = values.filter(F.col("v") != "__HIVE_DEFAULT_PARTITION__")
    fits = [F.bool_and(F.col("v").try_cast(t).isNotNull() & F.col("v").rlike(p)).alias(t) for t, p in (("int", r"^-?\d+$"), ("bigint", r"^-?\d+$"), ("double", r"^-?[\d.eE+-]+$"))]
    return {r["k"]: next((t for t in ("int", "bigint", "double") if r[t]), "string") for r in known.groupBy("k").agg(*fits).collect()}
