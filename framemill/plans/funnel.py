"""The comparison of two copies of a dataset, asked as several questions: what they declare, which episodes they have, whether
rows, prompts, lengths, statistics and videos of paired episodes are the same, and whether the distributions are."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.operators import pairing, scans, statistics
from framemill.session import cut_lineage, shared_folder, small_side
from framemill.sources.files import write_json

#: Pairs of ``sample_both_ends``, the share of a span that distributions may differ by, what a statistic may
#: differ by, and the share by which the mean size of videos may.
SAMPLE_EPISODES, DISTRIBUTION_TOLERANCE, STAT_TOLERANCE, SIZE_TOLERANCE = 64, 1e-6, 1e-6, 0.15
MOMENTS = ["min", "max", "mean", "std"]
_QUANTILES = {"q01": 0.01, "q50": 0.5, "q99": 0.99}
# What each question's failure is called, in the order the questions are asked.
REASONS = {
    "fields_agree": "the two copies declare different datasets",
    "documents_agree": "meta/modality.json differs",
    "tasks_agree": "meta/tasks.jsonl differs",
    "stats_agree": "meta/stats.json differs",
    "episode_meta_agree": "per-episode metadata differs",
    "values_agree": "sampled episodes differ",
    "videos_agree": "the videos do not add up over all episodes",
    "prompts_agree": "paired episodes carry different task prompts",
    "distributions_agree": "the shared episodes do not describe the same distribution",
}


def declaration(frames: DataFrame) -> DataFrame:
    """``path, value`` of what a copy declares: totals and widths, as text."""
    width = frames.agg(F.max(F.size("state_vec")).alias("w"), F.count(F.lit(1)).alias("f"), F.count_distinct("episode_index").alias("e"), F.count_distinct("prompt").alias("t"))
    return width.select(F.explode(F.create_map(
        F.lit("total_frames"), F.col("f").cast("string"), F.lit("total_episodes"), F.col("e").cast("string"),
        F.lit("total_tasks"), F.col("t").cast("string"), F.lit("features.state.shape"), F.col("w").cast("string"))).alias("path", "value"))


def prompt_check(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``one, other, a, b`` of pairs whose episodes' first prompts differ."""
    first = lambda d, key, name: d.groupBy("episode_index").agg(F.min_by("prompt", F.when(F.col("prompt").isNotNull(), F.col("frame_index"))).alias(name)).withColumnRenamed("episode_index", key)
    rows = pairs.select("one", "other").join(first(a, "one", "a"), "one").join(first(b, "other", "b"), "other")
    return rows.filter(~F.col("a").eqNullSafe(F.col("b")))


@dataclass(frozen=True)
class Copy:
    """One copy, read once: its frames with their positions as a written table, and a row of facts for each episode."""

    rows: DataFrame
    episodes: DataFrame
    stats: DataFrame


def prepared(frames: DataFrame, columns: list[str], width: int) -> Copy:
    """Write the copy's frames to the shared folder and take what all questions need of each episode.

    ``episodes`` has ``episode_index, n_rows, whole, prefix, prompt, prompts, width``, ``stats`` the moments of each dimension
    of each episode. Later questions read only the columns they need of the written table.
    """
    rows = placed(frames, ["prompt", *columns])
    # Prompts repeat within an episode, so they are counted before they are listed.
    said = rows.groupBy("episode_index", "prompt").agg(F.min("position").alias("at")).groupBy("episode_index").agg(
        F.min_by("prompt", F.when(F.col("prompt").isNotNull(), F.col("at"))).alias("prompt"), F.array_sort(F.collect_set("prompt")).alias("prompts"))
    episodes = pairing.fingerprints(rows, columns, also=[F.max(F.size(columns[0])).alias("width")]).join(said, "episode_index")
    stats = episode_stats(rows, columns, width)
    return Copy(rows, *_at_once(lambda: cut_lineage(episodes), lambda: cut_lineage(stats)))


def episode_stats(frames: DataFrame, columns: list[str], width: int) -> DataFrame:
    """``episode_index, feature, dim`` and the moments of each dimension of each episode; vectors of another width don't count."""
    return _values(frames, ["episode_index"], columns, width).groupBy("episode_index", "feature", "dim").agg(*statistics.moments())


def placed(frames: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of the frames with their ``position``, written to the shared folder and read from there; as they are if they have it."""
    if "position" in frames.columns:
        return frames.select("episode_index", "frame_index", "position", *columns)
    folder = shared_folder(frames.sparkSession, "copy")
    scans.positions(frames.select("episode_index", "frame_index", *columns)).write.parquet(folder)
    return frames.sparkSession.read.parquet(folder)


def _at_once(*jobs: Callable[[], object]) -> list:
    """The results of jobs that don't depend on each other, two at a time, as every plan at work takes the driver's memory."""
    with ThreadPoolExecutor(2) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _values(rows: DataFrame, key: list[str], columns: list[str], width: int) -> DataFrame:
    parts = [statistics.vector_values(rows, key, c, width).withColumn("feature", F.lit(c)) for c in columns]
    return reduce(DataFrame.unionByName, parts)


def declared(copy: Copy) -> DataFrame:
    """``path, value`` as ``declaration`` gives them, from the facts of each episode."""
    totals = copy.episodes.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("f"), F.count(F.lit(1)).alias("e"), F.max("width").alias("w"))
    tasks = copy.episodes.select(F.explode("prompts").alias("p")).agg(F.count_distinct("p").alias("t"))
    return totals.join(tasks).select(F.explode(F.create_map(
        F.lit("total_frames"), F.col("f").cast("string"), F.lit("total_episodes"), F.col("e").cast("string"),
        F.lit("total_tasks"), F.col("t").cast("string"), F.lit("features.state.shape"), F.col("w").cast("string"))).alias("path", "value"))


def shared_gap(pairs: DataFrame, a: Copy, b: Copy, columns: list[str], width: int) -> DataFrame:
    """Distribution gaps over the paired episodes."""
    def side(copy: Copy, key: str) -> DataFrame:
        mine = pairs.select(F.col(key).alias("episode_index"))
        moments = statistics.combined_moments(copy.stats.join(mine, "episode_index", "left_semi"), ["feature", "dim"])
        values = _values(copy.rows.join(mine, "episode_index", "left_semi"), [], columns, width)
        quantiles = statistics.quantiles_of_counts(statistics.counted(values, ["feature", "dim"], "value"), ["feature", "dim"], "value", _QUANTILES)
        return moments.join(quantiles, ["feature", "dim"])

    sides = _at_once(lambda: side(a, "one"), lambda: side(b, "other"))
    return statistics.distribution_gap(sides[0], sides[1], "feature", [*MOMENTS, *_QUANTILES])


def episode_meta(pairs: DataFrame, a: Copy, b: Copy) -> DataFrame:
    """One row, ``lengths, tasks, statistics``: pairs whose lengths or sets of prompts differ, and (feature, statistic) that differ in some pair."""
    facts = lambda c, key, tag: c.episodes.select(F.col("episode_index").alias(key), F.struct("n_rows", "prompts").alias(tag))
    both = pairs.join(facts(a, "one", "a"), "one").join(facts(b, "other", "b"), "other")
    counts = both.agg(F.count_if(F.col("a.n_rows") != F.col("b.n_rows")).alias("lengths"), F.count_if(F.col("a.prompts") != F.col("b.prompts")).alias("tasks"))
    tally = pairing.stat_blocks(pairs, a.stats, b.stats, MOMENTS, STAT_TOLERANCE)
    return counts.join(tally.agg(F.count_if(F.col("bad") > 0).alias("statistics")))


def whole_stats(a: Copy, b: Copy) -> DataFrame:
    """``feature, dim, stat`` of whole-dataset statistics that differ by more than the tolerance or that one copy lacks."""
    sides = [statistics.combined_moments(c.stats, ["feature", "dim"]).select("feature", "dim", F.explode(F.create_map(*[x for m in MOMENTS for x in (F.lit(m), F.col(m))])).alias("stat", tag)) for c, tag in ((a, "x"), (b, "y"))]
    both = sides[0].join(sides[1], ["feature", "dim", "stat"], "full_outer")
    return both.filter(F.coalesce(F.abs(F.col("x") - F.col("y")) > STAT_TOLERANCE, F.lit(True))).select("feature", "dim", "stat")


def coverage(a: DataFrame, b: DataFrame, a_episodes: DataFrame, b_episodes: DataFrame) -> DataFrame:
    """``camera, problem`` of ``b``'s cameras: ``missing``, ``count`` (files an episode) or ``size`` (mean bytes a file).

    ``a`` and ``b`` have ``camera, file, episode_index, n_bytes``, a row a file; repeats count once, a file of unknown size as 0 bytes.
    Files of episodes that a copy doesn't have aren't its.
    """
    sides = []
    for files, episodes, n in ((a, a_episodes, "a"), (b, b_episodes, "b")):
        mine = files.dropDuplicates().join(episodes.select("episode_index"), "episode_index", "left_semi")
        totals = mine.groupBy("camera").agg(F.count(F.lit(1)).alias("files"), F.sum("n_bytes").alias("bytes"))
        of = episodes.agg(F.count(F.lit(1)).alias("e"))
        sides.append(totals.join(of).select("camera", (F.col("files") / F.col("e")).alias(f"{n}_files"), (F.coalesce("bytes", F.lit(0)) / F.col("files")).alias(f"{n}_bytes")))
    both = sides[1].join(sides[0], "camera", "left")
    problems = [
        F.when(F.col("a_files").isNull(), "missing"), F.when(F.abs(F.col("a_files") - F.col("b_files")) > 1e-9, "count"),
        F.when((F.col("b_bytes") > 0) & (F.abs(F.col("a_bytes") / F.nullif(F.col("b_bytes"), F.lit(0.0)) - 1) > SIZE_TOLERANCE), "size"),
    ]
    return both.select("camera", F.explode(F.array_compact(F.array(*problems))).alias("problem"))


def verdict(a: DataFrame, b: DataFrame, columns: list[str], width: int = 44, *, videos: tuple[DataFrame, DataFrame] | None = None, documents: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row: ``exact, prefix, one_only, other_only, moved``, a flag for each question, ``declarations_agree, agree, reasons``.

    ``a`` and ``b`` are the current frames of the two copies. Values are compared over all pairs, not a sample. Where
    nothing pairs, episodes meet by their place in index order, and one of ``a`` without a counterpart disagrees. Else
    episode counts are reported, never judged.

    ``fields_agree``        totals and widths; ``documents_agree`` the flattened documents (``path, value``), if given.
    ``tasks_agree``         the set of prompts; ``stats_agree`` the statistics over all episodes of either copy.
    ``episode_meta_agree``  lengths, prompts and statistics of every pair; ``values_agree`` every row of every pair, with
                            lengths up to two rows apart; ``prompts_agree`` the first prompt of every pair.
    ``videos_agree``        files an episode and mean sizes by camera (``camera, file, episode_index, n_bytes``), if given.
    """
    a, b = _at_once(*[partial(prepared, d, columns, width) for d in (a, b)])
    pairs = cut_lineage(pairing.pair_episodes(a.episodes, b.episodes))
    paired = pairs.filter(F.col("basis").isin("exact", "prefix")).select("one", "other")
    complete = True
    if paired.isEmpty():
        # Wrong values throughout leave nothing paired; the episodes are then compared in index order.
        placed = cut_lineage(pairing.pair_places(pairs))
        paired, complete = placed.filter("other is not null"), placed.filter("other is null").isEmpty()
    # Where neither side has an episode there is nothing to disagree; else a comparison of nothing isn't agreement.
    n_paired = paired.count()
    agreed = n_paired > 0 or pairs.isEmpty()
    paired = small_side(paired, n_paired)  # so that picking the paired episodes' frames shuffles no vectors, up to a size
    none = lambda d: d.agg(F.count(F.lit(1)) == 0)
    flag = lambda d, name: d.toDF(name)
    counted = ["total_frames", "total_episodes"]
    differs = lambda x, y: pairing.path_difference(x, y, counted).filter(F.col("bucket").isin("one_sided", "differences"))
    tasks = [c.episodes.select(F.explode("prompts").alias("prompt")).dropDuplicates() for c in (a, b)]
    meta = episode_meta(paired, a, b)
    parts = [
        flag(none(differs(declared(a), declared(b))), "fields_agree"),
        flag(none(tasks[0].subtract(tasks[1]).unionByName(tasks[1].subtract(tasks[0]))), "tasks_agree"),
        flag(none(whole_stats(a, b)), "stats_agree"),
        flag(meta.select((F.col("lengths") + F.col("tasks") + F.col("statistics") == 0) & F.lit(agreed)), "episode_meta_agree"),
        flag(pairing.first_divergence(paired, a.rows, b.rows, columns).agg(F.coalesce(F.bool_and("ok"), F.lit(agreed)) & F.lit(complete)), "values_agree"),
        flag(_prompts(paired, a, b).agg((F.count(F.lit(1)) == 0) & F.lit(agreed)), "prompts_agree"),
        flag(shared_gap(paired, a, b, columns, width).agg(F.coalesce(F.bool_and(F.col("gap") <= DISTRIBUTION_TOLERANCE), F.lit(agreed))), "distributions_agree"),
    ]
    if videos is not None:
        parts.append(flag(none(coverage(*videos, a.episodes, b.episodes)), "videos_agree"))
    if documents is not None:
        parts.append(flag(none(differs(*documents)), "documents_agree"))
    counts = pairing.pairing_summary(pairs).select("exact", "prefix", "one_only", "other_only", "moved")
    # One row of flags each, asked at once.
    found, *flags = _at_once(counts.first, *[part.first for part in parts])
    said = {name: value for row in flags for name, value in row.asDict().items()}
    asked = [f for f in REASONS if f in said]
    declarations = all(said[f] for f in ("fields_agree", "documents_agree", "tasks_agree", "stats_agree") if f in said)
    reasons = [REASONS[f] for f in asked if not said[f]]
    numbers, bools = list(found.asDict()), [*asked, "declarations_agree", "agree"]
    schema = ", ".join([*[f"{n} bigint" for n in numbers], *[f"{n} boolean" for n in bools], "reasons array<string>"])
    return pairs.sparkSession.createDataFrame([(*found, *[said[f] for f in asked], declarations, not reasons, reasons)], schema)


def _prompts(pairs: DataFrame, a: Copy, b: Copy) -> DataFrame:
    """Pairs whose episodes' first prompts differ."""
    first = lambda c, key, tag: c.episodes.select(F.col("episode_index").alias(key), F.col("prompt").alias(tag))
    return pairs.join(first(a, "one", "a"), "one").join(first(b, "other", "b"), "other").filter(~F.col("a").eqNullSafe(F.col("b")))


def write_report(row: DataFrame, path: str) -> dict:
    """Write a verdict's row as a JSON document, numbers cut to twelve digits; gives the document."""
    document = {k: float(f"{v:.11e}") if isinstance(v, float) else v for k, v in row.first().asDict(recursive=True).items()}
    write_json(path, document)
    return document
