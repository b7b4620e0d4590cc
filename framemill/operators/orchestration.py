"""Tables of a build's steps: what is done, what may be removed, how long it took, what a plan says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.sources.files import no_pattern, write_json

#: The steps of a dataset, in order.
STEPS = ["fetch", "build", "publish"]


def step_done(records: DataFrame, key: list[str], expected: dict[str, Column]) -> DataFrame:
    """``<key>, step, done``: the last record of a step says ok, nothing it made is gone, and its inputs are the expected ones."""
    ok = (F.col("status") == "ok") & F.col("exists")
    for name, value in expected.items():
        ok = ok & F.col(name).eqNullSafe(value)
    latest = records.groupBy(*key, "step").agg(F.max_by(F.coalesce(ok, F.lit(False)), "finished").alias("done"))
    return latest


def status_pivot(done: DataFrame, key: list[str]) -> DataFrame:
    """A row a dataset with the status of each step: ``done``, ``failed``, or ``-`` without a record."""
    word = F.when(F.col("done"), "done").otherwise("failed")
    wide = done.groupBy(*key).pivot("step", STEPS).agg(F.first(word))
    return wide.select(*key, *[F.coalesce(s, F.lit("-")).alias(s) for s in STEPS])


def timings(records: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, <step>_s, total_s, rate, build_share``: seconds by step, items a second overall, and the build's share."""
    seconds = (F.unix_micros(F.col("finished").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / F.lit(1e6)
    wide = records.withColumn("s", seconds).groupBy(*key).pivot("step", STEPS).agg(F.sum("s"))
    wide = wide.select(*key, *[F.coalesce(s, F.lit(0.0)).alias(f"{s}_s") for s in STEPS])
    total = sum((F.col(f"{s}_s") for s in STEPS[1:]), F.col(f"{STEPS[0]}_s"))
    items = records.groupBy(*key).agg(F.max("items").alias("items"))
    rows = wide.join(items, key).withColumn("total_s", total)
    safe = F.nullif(F.col("total_s"), F.lit(0.0))
    return rows.withColumn("rate", F.col("items") / safe).withColumn("build_share", F.col("build_s") / safe).drop("items")


def reclaimable(done: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Sources of published datasets that no unfinished dataset still needs."""
    published = done.filter((F.col("step") == "publish") & F.col("done")).select(key)
    mine = sources.join(published, key, "left_semi").select("source").dropDuplicates()
    needed = sources.join(published, key, "left_anti").select("source")
    return mine.join(needed, "source", "left_anti")


def plan_summary(datasets: DataFrame) -> DataFrame:
    """``state, n`` of datasets by the first thing that holds them up."""
    state = F.when(F.col("source").isNull(), "no source").when(~F.col("buildable"), "unbuildable").when(F.col("episodes").isNull(), "unknown size").when(F.col("episodes") == 0, "empty").otherwise("ready")
    return datasets.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def usable_class(present: Column, required: list[str], optional: list[str]) -> Column:
    """Which of three ways a raw file is broken, from the array of parts it has; null if it isn't.

    ``empty`` has none of the required parts; ``wrong_config`` has parts, but lacks a required one and has unknown ones; ``partial`` lacks one.
    """
    need = F.array(*[F.lit(r) for r in required])
    known = F.array(*[F.lit(r) for r in (*required, *optional)])
    lacking, strange = F.array_except(need, present), F.array_except(present, known)
    return F.when(F.size(F.array_intersect(need, present)) == 0, "empty").when((F.size(lacking) > 0) & (F.size(strange) > 0), "wrong_config").when(F.size(lacking) > 0, "partial")


def worker_share(workers: Column, batch: Column) -> Column:
    """Workers of each of a batch's datasets: an even share, rounded up, at least one; all of them for a batch of one or none, null without workers."""
    share = F.greatest(F.ceil(workers / batch), F.lit(1))
    return F.when(workers > 0, F.when(batch <= 1, workers.cast("bigint")).otherwise(share))


#: A step's record as it is kept, a document for each dataset and step.
RECORD = "dataset string, step string, status string, started timestamp_ntz, finished timestamp_ntz, items bigint, created array<string>, inputs map<string, string>"


def write_record(folder: str, record: dict) -> None:
    """Put the record of a dataset's step in its place; a reader sees the one before or this one, never a part."""
    write_json(f"{folder}/{record['dataset']}/{record['step']}.json", record)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a folder; a document that can't be read is no record, so that its step counts as not done."""
    found = spark.read.schema(RECORD).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(no_pattern(folder))
    return found.filter("dataset is not null and step is not null")
