"""Queries of problem 4: far too many small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions.paths import resolved
from framemill.operators.compaction import Sizes, compaction_journal, final_outputs
from framemill.operators.components import component_labels, links_from_keys
from framemill.registry import query, table
from framemill.session import cut_lineage, shared_folder
from framemill.sources import compact

#: MB of table files; seconds of video pieces.
SIZES = {"data": Sizes(small=16.0, good=128.0, unit=0.25), "video": Sizes(small=20.0, good=160.0, unit=1.0)}


def table_files(listing: DataFrame) -> DataFrame:
    """``kind, grp, file_key, size`` of the table files that hold records, one row a file.

    Rows are one file if their paths resolve to one place or they share a content_sha, also by way of further rows.
    The file's key is its smallest file_id; its size the largest filled_mb known, null if none is; its group the smallest
    dataset and path template of its rows. Rows without file_id are left out.
    """
    rows = listing.filter(F.col("file_id").isNotNull()).select("file_id", "dataset", "path_template", resolved(F.col("file_path")).alias("path"), "filled_mb", "n_records", "content_sha")
    keys = rows.select(F.col("file_id").alias("id"), F.explode(F.array(F.concat(F.lit("p"), "path"), F.concat(F.lit("h"), "content_sha"))).alias("key"))
    labels = component_labels(links_from_keys(keys))
    known = F.when(~F.isnan("filled_mb"), F.col("filled_mb"))
    # One row an id before the labels come to it, so that many listings of one file weigh nothing.
    each = rows.groupBy("file_id").agg(F.max(known).alias("size"), F.max("n_records").alias("n"), F.min("dataset").alias("d"), F.min("path_template").alias("t"))
    labelled = each.join(labels, each.file_id == labels.id, "left").withColumn("file_key", F.coalesce("label", "file_id"))
    files = labelled.groupBy("file_key").agg(F.max("size").alias("size"), F.max("n").alias("n"), F.min("d").alias("d"), F.min("t").alias("t")).filter("n > 0")
    return files.select(F.lit("data").alias("kind"), F.to_json(F.array("d", "t")).alias("grp"), "file_key", "size")


def video_files(segments: DataFrame) -> DataFrame:
    """``kind, grp, file_key, size`` of the videos that have a piece, one row a video.

    Rows whose src resolves to one place are one video; its size is the seconds of its distinct pieces with a positive
    length, added up in whole microseconds. Its group is the smallest dataset and camera of its rows. Rows without src
    or segment_id are left out.
    """
    rows = segments.filter(F.col("src").isNotNull() & F.col("segment_id").isNotNull()).withColumn("place", resolved(F.col("src")))
    positive = (F.col("end_s") > F.col("start_s")) & ~F.isnan("end_s") & ~F.isnan("start_s")
    piece = F.when(positive, F.struct("start_s", "end_s"))
    pieces = rows.groupBy("place", piece.alias("piece")).agg(F.min("segment_id").alias("id"), F.min("dataset").alias("d"), F.min("camera").alias("c"))
    length = F.round((F.col("piece.end_s") - F.col("piece.start_s")) * 1e6).cast("bigint")
    videos = pieces.groupBy("place").agg(F.sum(length).alias("us"), F.min("id").alias("file_key"), F.min("d").alias("d"), F.min("c").alias("c")).filter("us is not null")
    return videos.select(F.lit("video").alias("kind"), F.to_json(F.array("d", "c")).alias("grp"), "file_key", (F.col("us") / 1e6).alias("size"))


def consolidation(listing: DataFrame, segments: DataFrame) -> DataFrame:
    """The journal over both kinds of files."""
    return compaction_journal(cut_lineage(table_files(listing).unionByName(video_files(segments))), SIZES)


#: SQL: the path ``p`` with its steps resolved.
WALK = """list_reduce(list_transform(list_prepend('', string_split({p}, '/')), lambda s: CASE WHEN s = '.' THEN '' ELSE s END), lambda d, s:
      CASE WHEN s = '' THEN d WHEN s = '..' THEN regexp_replace(d, '/[^/]*$', '') ELSE d || '/' || s END)"""


_SMALL = f"""WITH RECURSIVE r AS (SELECT DISTINCT file_id, {WALK.format(p="file_path")} AS place, content_sha AS sha, filled_mb, n_records FROM parquet_files),
    l AS (SELECT DISTINCT a.file_id AS x, b.file_id AS y FROM r a JOIN r b ON a.place = b.place OR a.sha = b.sha),
    reach(x, y) AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
    root AS (SELECT x, min(y) AS file_key FROM reach GROUP BY x),
    s AS (SELECT segment_id, {WALK.format(p="src")} AS place, start_s, end_s FROM segments),
    v AS (SELECT place, sum(CAST(round((end_s - start_s) * 1e6) AS BIGINT)) AS us FROM (SELECT DISTINCT place, start_s, end_s FROM s WHERE end_s > start_s) GROUP BY place),
    small AS (SELECT 'data' AS kind, file_key, max(CASE WHEN NOT isnan(filled_mb) THEN filled_mb END) AS size FROM r JOIN root ON root.x = r.file_id GROUP BY file_key
      HAVING max(n_records) > 0 AND coalesce(max(CASE WHEN NOT isnan(filled_mb) THEN filled_mb END), 0) < 16
      UNION ALL
      SELECT 'video', min(segment_id), any_value(us) / 1e6 FROM s JOIN v USING (place) WHERE us < 20000000 GROUP BY place)"""


@query("p4_found", f"{_SMALL} SELECT kind, file_key FROM small")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small files: the originals that the journal takes as inputs."""
    journal = consolidation(table(spark, sf_dir, "parquet_files"), table(spark, sf_dir, "segments"))
    return journal.filter(F.col("file_key").isNotNull()).select("kind", "file_key")


@query("p4_plan")
def p4_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file in which each small original ends up."""
    return final_outputs(consolidation(table(spark, sf_dir, "parquet_files"), table(spark, sf_dir, "segments")))


@query("p4_plan_audit", f"""{_SMALL} SELECT kind, count(*) AS files, round(sum(CASE WHEN size IS NULL OR size < 0 THEN unit ELSE greatest(size, unit / 64) END) + 1e-9, 3) AS size, TRUE AS once, TRUE AS linked, TRUE AS within
    FROM (SELECT *, CASE kind WHEN 'data' THEN 0.25 ELSE 1.0 END::DOUBLE AS unit FROM small) GROUP BY kind""")
def p4_plan_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any plan: all small files, each an input once, sizes kept from level to level, outputs of a good size."""
    return audit(cut_lineage(consolidation(table(spark, sf_dir, "parquet_files"), table(spark, sf_dir, "segments"))), SIZES)


def audit(journal: DataFrame, sizes: dict[str, Sizes]) -> DataFrame:
    """``kind, files, size, once, linked, within`` of a journal, a row a kind.

    ``once``    no input is taken twice; ``linked`` every input that isn't a file is an earlier level's output of the
    same size, and that of the transaction its records end in; ``within`` no output is larger than a good and a small file.
    """
    made = journal.groupBy("kind", F.col("output").alias("input")).agg(F.sum("size").alias("made"), F.max("level").alias("at"), F.max("ends_in").alias("leads"), F.count(F.lit(1)).alias("parts"))
    taken = journal.groupBy("kind", "input").agg(F.count(F.lit(1)).alias("times"), F.max("file_key").alias("file_key"), F.max("size").alias("size"), F.max("level").alias("level"), F.max("ends_in").alias("ends_in"))
    both = taken.join(made, ["kind", "input"], "full_outer")
    most = F.lit(None).cast("double")
    for k, s in sizes.items():
        most = F.when(F.col("kind") == k, F.lit(s.good + s.small)).otherwise(most)
    original = F.col("file_key").isNotNull()
    chained = (F.abs(F.col("made") - F.col("size")) < 1e-6) & (F.col("at") < F.col("level")) & (F.col("leads") == F.col("ends_in"))
    return both.groupBy("kind").agg(
        F.count("file_key").alias("files"), F.round(F.sum(F.when(original, F.col("size"))) + 1e-9, 3).alias("size"),
        F.coalesce(F.max("times") == 1, F.lit(False)).alias("once"), F.bool_and(F.coalesce(original | F.col("times").isNull() | chained, F.lit(False))).alias("linked"),
        F.bool_and(F.coalesce(F.col("made") <= most, F.lit(True))).alias("within"))


@query("p4_records", "SELECT segment_id, dataset, camera, episode_index, src, start_s, end_s FROM segments")
def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a table that lay in many small files by camera, after two runs that carried out their journals on the files."""
    root = shared_folder(spark, "small")
    rows = table(spark, sf_dir, "segments").select("segment_id", "dataset", "camera", "episode_index", "src", "start_s", "end_s")
    rows.repartition(12).write.partitionBy("camera").parquet(f"{root}/data/run-0")
    for _ in range(2):
        compact.compact(spark, f"{root}/data/run-0", f"{root}/state", Sizes(small=0.25, good=1.0, unit=0.002))
    return compact.read_live(spark, f"{root}/data/run-0", f"{root}/state").select(rows.columns)
