"""Queries of pairing and comparison, over the frames and a copy of them changed in known ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions.jsonpaths import flatten_json
from framemill.operators import pairing, scans
from framemill.plans import funnel
from framemill.queries.statistics import WIDTH
from framemill.registry import query, table
from framemill.session import cut_lineage, shared_folder, small_side
from framemill.views import DELIVERED_SQL, FRAMES_SQL, frames

COLUMNS = ["state_vec", "action_vec"]


def rebuilt(delivered: DataFrame) -> DataFrame:
    """A copy with other indices: some episodes missing, some a row short, some with a changed value past the prefix."""
    e = F.col("episode_index")
    last = cut_lineage(delivered.groupBy("episode_index").agg(F.max("frame_index").alias("last")))
    placed = delivered if "position" in delivered.columns else scans.positions(delivered)
    rows = placed.join(small_side(last, last.count()), "episode_index").filter((e % 17 != 0) & ~((e % 11 == 0) & (F.col("frame_index") == F.col("last"))))
    changed = F.when((e % 13 == 0) & (F.col("position") == 10), F.transform("state_vec", lambda x, i: F.when(i == 0, x + F.lit(1).cast("float")).otherwise(x))).otherwise(F.col("state_vec"))
    # Whole episodes and last rows are gone, so the other rows' positions are what they were.
    return rows.withColumn("state_vec", changed).withColumn("episode_index", 1_000_000 - e).select(delivered.columns)


_REBUILT = f"""(SELECT 1000000 - episode_index AS episode_index, frame_index, prompt, action_vec,
      CASE WHEN episode_index % 13 = 0 AND n = 11 THEN list_transform(state_vec, lambda x, i: CASE WHEN i = 1 THEN CAST(x + 1 AS FLOAT) ELSE x END) ELSE state_vec END AS state_vec
    FROM (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS n, max(frame_index) OVER (PARTITION BY episode_index) AS last FROM {FRAMES_SQL})
    WHERE episode_index % 17 <> 0 AND NOT (episode_index % 11 = 0 AND frame_index = last))"""


def _text(c: str) -> str:
    return f"coalesce(array_to_string(list_transform({c}, lambda x: CASE WHEN x IS NULL THEN 'null' WHEN isnan(x) THEN 'nan' ELSE CAST(CAST(round(x::DOUBLE * 65536) AS BIGINT) AS VARCHAR) END), ','), 'none')"


def _prints(t: str) -> str:
    half = lambda i: f"CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)::DECIMAL(38, 0)"
    whole = " || '-' || ".join(f"CAST(sum({half(i)}) AS VARCHAR)" for i in (0, 1))
    prefix = " || '-' || ".join(f"CAST(sum(CASE WHEN n <= 8 THEN {half(i)} END) AS VARCHAR)" for i in (0, 1))
    return f"""(SELECT episode_index, count(*) AS n_rows, {whole} AS whole, {prefix} AS prefix FROM (SELECT *, sha256(concat_ws('|', CAST(n - 1 AS VARCHAR), {_text("state_vec")}, {_text("action_vec")})) AS h
      FROM (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS n FROM {t})) GROUP BY 1)"""


_PAIRING = f"""WITH a AS MATERIALIZED (SELECT * FROM {{a}}), b AS MATERIALIZED (SELECT * FROM {{b}}), fa AS MATERIALIZED {_prints("a")}, fb AS MATERIALIZED {_prints("b")},
    ka AS (SELECT *, count(*) OVER (PARTITION BY whole) AS m, row_number() OVER (PARTITION BY whole ORDER BY episode_index) AS r FROM fa),
    kb AS (SELECT *, count(*) OVER (PARTITION BY whole) AS m, row_number() OVER (PARTITION BY whole ORDER BY episode_index) AS r FROM fb),
    ex AS (SELECT ka.episode_index AS one, kb.episode_index AS other FROM ka JOIN kb ON ka.whole = kb.whole AND ka.m = kb.m AND ka.r = kb.r),
    la AS (SELECT *, count(*) OVER (PARTITION BY prefix) AS m, row_number() OVER (PARTITION BY prefix ORDER BY episode_index) AS r FROM fa WHERE episode_index NOT IN (SELECT one FROM ex)),
    lb AS (SELECT *, count(*) OVER (PARTITION BY prefix) AS m, row_number() OVER (PARTITION BY prefix ORDER BY episode_index) AS r FROM fb WHERE episode_index NOT IN (SELECT other FROM ex)),
    pr AS (SELECT la.episode_index AS one, lb.episode_index AS other FROM la JOIN lb ON la.prefix = lb.prefix AND la.m = lb.m AND la.r = lb.r),
    pp AS (SELECT one, other, 'exact' AS basis FROM ex UNION ALL SELECT one, other, 'prefix' FROM pr),
    pairing AS MATERIALIZED (SELECT fa.episode_index AS one, fb.episode_index AS other, CASE WHEN fa.episode_index IS NULL THEN 'other_only' WHEN pp.basis IS NULL THEN 'one_only' ELSE pp.basis END AS basis, fa.n_rows - fb.n_rows AS row_delta
      FROM fa LEFT JOIN pp ON pp.one = fa.episode_index FULL JOIN fb ON fb.episode_index = pp.other)"""
_COMMON = _PAIRING.replace("{a}", _REBUILT).replace("{b}", FRAMES_SQL)


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    delivered = funnel.placed(frames(spark, sf_dir, "state_vec", "action_vec", "prompt"), [*COLUMNS, "prompt"])
    return rebuilt(delivered), delivered


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.pair_episodes(*[pairing.fingerprints(d, COLUMNS) for d in _copies(spark, sf_dir)])


@query("fingerprints", f"SELECT * FROM {_prints(FRAMES_SQL)}")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content digests of every episode."""
    return pairing.fingerprints(frames(spark, sf_dir, *COLUMNS), COLUMNS)


@query("pair_episodes", f"{_COMMON} SELECT * FROM pairing")
def pair_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the two copies, exact then by prefix, and leftovers."""
    return _pairs(spark, sf_dir)


@query("unpaired", f"{_COMMON} SELECT coalesce(one, other) AS episode_index, basis FROM pairing WHERE basis IN ('one_only', 'other_only')")
def unpaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that only one copy has."""
    return _pairs(spark, sf_dir).filter(F.col("basis").isin("one_only", "other_only")).select(F.coalesce("one", "other").alias("episode_index"), "basis")


@query("row_deltas", f"{_COMMON} SELECT one, other, row_delta FROM pairing WHERE basis = 'prefix'")
def row_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length differences of pairs that only share their start."""
    return _pairs(spark, sf_dir).filter("basis = 'prefix'").select("one", "other", "row_delta")


@query("pairing_summary", f"""{_COMMON} SELECT count(CASE WHEN basis = 'exact' THEN 1 END) AS exact, count(CASE WHEN basis = 'prefix' THEN 1 END) AS prefix, count(CASE WHEN basis = 'one_only' THEN 1 END) AS one_only, count(CASE WHEN basis = 'other_only' THEN 1 END) AS other_only,
    count(CASE WHEN basis IN ('exact', 'prefix') AND one <> other THEN 1 END) AS moved, count(CASE WHEN basis = 'prefix' AND row_delta = 0 THEN 1 END) AS same_length, coalesce(max(CASE WHEN basis = 'prefix' THEN abs(row_delta) END), 0) AS worst_row_delta FROM pairing""")
def pairing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the pairing."""
    return pairing.pairing_summary(_pairs(spark, sf_dir))


_SAMPLE = "sm AS (SELECT one, other FROM (SELECT *, row_number() OVER (ORDER BY one) AS u, row_number() OVER (ORDER BY one DESC) AS d FROM pairing WHERE basis IN ('exact', 'prefix')) WHERE u <= 32 OR d <= 32)"


@query("sample_both_ends", f"{_COMMON}, {_SAMPLE} SELECT * FROM sm")
def sample_both_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs taken from both ends of the index range."""
    paired = _pairs(spark, sf_dir).filter(F.col("basis").isin("exact", "prefix"))
    return pairing.both_ends(paired, "one", funnel.SAMPLE_EPISODES).select("one", "other")


_DIVERGE = """ra AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS position FROM a), rb AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS position FROM b),
    j AS (SELECT p.one, p.other, x.position, x.state_vec IS DISTINCT FROM y.state_vec OR x.action_vec IS DISTINCT FROM y.action_vec AS unequal FROM pairing p JOIN ra x ON x.episode_index = p.one JOIN rb y ON y.episode_index = p.other AND y.position = x.position WHERE basis IN ('exact', 'prefix'))"""


@query("first_divergence", f"""{_COMMON}, {_DIVERGE} SELECT j.one, j.other, count(*) AS compared_rows, CAST(min(CASE WHEN unequal THEN position END) AS BIGINT) AS first_divergence, count(CASE WHEN unequal THEN 1 END) AS differing,
    count(CASE WHEN unequal THEN 1 END) = 0 AND abs(any_value(p.row_delta)) <= 2 AS ok FROM j JOIN pairing p ON p.one = j.one GROUP BY 1, 2""")
def first_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where paired episodes first differ."""
    a, b = _copies(spark, sf_dir)
    pairs = pairing.pair_episodes(*[pairing.fingerprints(d, COLUMNS) for d in (a, b)])
    return pairing.first_divergence(cut_lineage(pairs.filter(F.col("basis").isin("exact", "prefix"))), a, b, COLUMNS)


_BLOCK = "SELECT episode_index, 'action_vec' AS feature, i - 1 AS dim, min(action_vec[i]::DOUBLE) AS min, max(action_vec[i]::DOUBLE) AS max, avg(action_vec[i]::DOUBLE) AS mean FROM {t}, generate_series(1, 44) AS g(i) WHERE len(action_vec) = 44 AND NOT isnan(action_vec[i]) GROUP BY ALL"


@query("episode_meta_tally", f"""{_COMMON}, sa AS ({_BLOCK.format(t="a")}), sb AS ({_BLOCK.format(t="b")}),
    l AS (SELECT p.one, x.feature, unnest(['min', 'max', 'mean']) AS stat, unnest([abs(x.min - y.min), abs(x.max - y.max), abs(x.mean - y.mean)]) AS gap, unnest([y.min = 0, y.max = 0, y.mean = 0]) AS zero
      FROM pairing p JOIN sa x ON x.episode_index = p.one JOIN sb y ON y.episode_index = p.other AND y.dim = x.dim WHERE basis IN ('exact', 'prefix')),
    q AS (SELECT one, feature, stat, max(gap) AS gap, bool_and(zero) AS zero FROM l GROUP BY ALL)
    SELECT feature, stat, count(*) AS seen, count(CASE WHEN gap > 1e-6 THEN 1 END) AS bad, round(coalesce(max(CASE WHEN gap > 1e-6 THEN gap END), 0) + 1e-9, 6) AS worst, bool_and(zero) AS zeroed FROM q GROUP BY ALL""")
def episode_meta_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics that differ between paired episodes."""
    tally = episode_meta_tally_all(spark, sf_dir)
    return tally.filter("feature = 'action_vec' and stat in ('min', 'max', 'mean')")


_BLOCKS = " UNION ALL ".join(f"SELECT episode_index, '{c}' AS feature, i - 1 AS dim, min({c}[i]::DOUBLE) AS min, max({c}[i]::DOUBLE) AS max, avg({c}[i]::DOUBLE) AS mean, stddev_pop({c}[i]::DOUBLE) AS std FROM {{t}}, generate_series(1, 44) AS g(i) WHERE len({c}) = 44 AND NOT isnan({c}[i]) GROUP BY ALL" for c in COLUMNS)


def meta_tally(paired: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Over both vectors and all of their moments, how many pairs differ."""
    return _tally(paired, *[funnel.episode_stats(d, COLUMNS, WIDTH) for d in (a, b)])


def _tally(paired: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    return pairing.stat_blocks(paired, a, b, funnel.MOMENTS, 1e-6).withColumn("worst", F.round(F.col("worst") + 1e-9, 6))


@query("episode_meta_tally_all", f"""{_COMMON}, sa AS ({_BLOCKS.format(t="a")}), sb AS ({_BLOCKS.format(t="b")}),
    l AS (SELECT p.one, x.feature, unnest(['min', 'max', 'mean', 'std']) AS stat, unnest([abs(x.min - y.min), abs(x.max - y.max), abs(x.mean - y.mean), abs(x.std - y.std)]) AS gap, unnest([y.min = 0, y.max = 0, y.mean = 0, y.std = 0]) AS zero
      FROM pairing p JOIN sa x ON x.episode_index = p.one JOIN sb y ON y.episode_index = p.other AND y.feature = x.feature AND y.dim = x.dim WHERE basis IN ('exact', 'prefix')),
    q AS (SELECT one, feature, stat, max(gap) AS gap, bool_and(zero) AS zero FROM l GROUP BY ALL)
    SELECT feature, stat, count(*) AS seen, count(CASE WHEN gap > 1e-6 THEN 1 END) AS bad, round(coalesce(max(CASE WHEN gap > 1e-6 THEN gap END), 0) + 1e-9, 6) AS worst, bool_and(zero) AS zeroed FROM q GROUP BY ALL""")
def episode_meta_tally_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics that differ between paired episodes, of state and action alike; ``episode_meta_tally`` has the action's min, max and mean."""
    a, b = (funnel.prepared(d, COLUMNS, WIDTH) for d in _copies(spark, sf_dir))
    paired = pairing.pair_episodes(a.episodes, b.episodes).filter(F.col("basis").isin("exact", "prefix")).select("one", "other")
    return _tally(paired, a.stats, b.stats)


_FIRST_PROMPT = "SELECT episode_index, arg_min(prompt, frame_index) AS prompt FROM {t} WHERE prompt IS NOT NULL GROUP BY 1"


@query("prompt_mismatches", f"""WITH a AS ({_FIRST_PROMPT.format(t=FRAMES_SQL)}), b AS ({_FIRST_PROMPT.format(t=DELIVERED_SQL)}), ea AS (SELECT DISTINCT episode_index FROM {FRAMES_SQL}), eb AS (SELECT DISTINCT episode_index FROM {DELIVERED_SQL})
    SELECT episode_index AS one, episode_index AS other, a.prompt AS a, b.prompt AS b FROM ea JOIN eb USING (episode_index) LEFT JOIN a USING (episode_index) LEFT JOIN b USING (episode_index) WHERE a.prompt IS DISTINCT FROM b.prompt""")
def prompt_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose prompt isn't the same in the two copies, paired by index."""
    a, b = (frames(spark, sf_dir, "prompt", name=t) for t in ("frames", "frames_delivered"))
    index = lambda d: d.select("episode_index").dropDuplicates()
    pairs = index(a).join(index(b), "episode_index").select(F.col("episode_index").alias("one"), F.col("episode_index").alias("other"))
    return funnel.prompt_check(pairs, a, b)


@query("prompt_multiset_diff", f"""WITH a AS ({_FIRST_PROMPT.format(t=FRAMES_SQL)}), b AS ({_FIRST_PROMPT.format(t=DELIVERED_SQL)}),
    l AS (SELECT prompt, count(*) AS n FROM (SELECT prompt FROM a EXCEPT ALL SELECT prompt FROM b) GROUP BY 1), r AS (SELECT prompt, count(*) AS n FROM (SELECT prompt FROM b EXCEPT ALL SELECT prompt FROM a) GROUP BY 1)
    SELECT coalesce(l.prompt, r.prompt) AS prompt, coalesce(l.n, 0) AS a_only, coalesce(r.n, 0) AS b_only FROM l FULL JOIN r ON l.prompt = r.prompt""")
def prompt_multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that one copy carries more often."""
    first = lambda t: frames(spark, sf_dir, "prompt", name=t).filter("prompt is not null").groupBy("episode_index").agg(F.min_by("prompt", "frame_index").alias("prompt"))
    return pairing.multiset_difference(first("frames"), first("frames_delivered"), "prompt")


@query("task_symdiff", f"SELECT prompt, 'a' AS side FROM (SELECT prompt FROM {FRAMES_SQL} EXCEPT SELECT prompt FROM {DELIVERED_SQL}) UNION ALL SELECT prompt, 'b' FROM (SELECT prompt FROM {DELIVERED_SQL} EXCEPT SELECT prompt FROM {FRAMES_SQL})")
def task_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that only one copy knows."""
    a, b = (frames(spark, sf_dir, "prompt", name=t).select("prompt") for t in ("frames", "frames_delivered"))
    return a.subtract(b).withColumn("side", F.lit("a")).unionByName(b.subtract(a).withColumn("side", F.lit("b")))


@query("task_intersection", f"SELECT prompt FROM {FRAMES_SQL} INTERSECT SELECT prompt FROM {DELIVERED_SQL}")
def task_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that both copies know."""
    a, b = (frames(spark, sf_dir, "prompt", name=t).select("prompt") for t in ("frames", "frames_delivered"))
    return a.intersect(b)


_COVER = """c AS (SELECT camera, count(*) AS files, count(DISTINCT episode_index) AS episodes, sum(n_bytes) / count(*) AS mean_bytes FROM (SELECT DISTINCT camera, shot_id, episode_index, n_bytes FROM video_shots WHERE episode_index % 2 = {r}) GROUP BY 1)"""


@query("video_coverage", f"""WITH {_COVER.format(r=0).replace("c AS", "a AS")}, {_COVER.format(r=1).replace("c AS", "b AS")}
    SELECT b.camera, a.camera IS NULL AS missing, coalesce(abs(a.files / a.episodes - b.files / b.episodes) > 1e-9, TRUE) AS count_differs, coalesce(abs(a.mean_bytes / b.mean_bytes - 1) > 0.15, FALSE) AS size_differs FROM b LEFT JOIN a ON a.camera = b.camera""")
def video_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per episode and mean sizes of two halves of the images, camera by camera."""
    shots = table(spark, sf_dir, "video_shots").select("camera", "shot_id", "episode_index", "n_bytes").dropDuplicates()
    sides = []
    for r in (0, 1):
        half = shots.filter(F.col("episode_index") % 2 == r).groupBy("camera", "episode_index").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"))
        sides.append(half.groupBy("camera").agg((F.sum("n") / F.count(F.lit(1))).alias(f"per{r}"), (F.sum("b") / F.sum("n")).alias(f"mean{r}")))
    both = sides[1].join(sides[0], "camera", "left")
    apart = F.coalesce(F.abs(F.col("per0") - F.col("per1")) > 1e-9, F.lit(True))
    return both.select("camera", F.col("per0").isNull().alias("missing"), apart.alias("count_differs"), F.coalesce(F.abs(F.col("mean0") / F.col("mean1") - 1) > 0.15, F.lit(False)).alias("size_differs"))


_DECLARED = "SELECT unnest(['total_frames', 'total_episodes', 'total_tasks', 'features.state.shape']) AS path, unnest([CAST(count(*) AS VARCHAR), CAST(count(DISTINCT episode_index) AS VARCHAR), CAST(count(DISTINCT prompt) AS VARCHAR), CAST(max(len(state_vec)) AS VARCHAR)]) AS value FROM {t}"


@query("declaration_diff", f"""WITH a AS ({_DECLARED.format(t=FRAMES_SQL)}), b AS ({_DECLARED.format(t=DELIVERED_SQL)})
    SELECT path, CASE WHEN a.path IS NULL OR b.path IS NULL THEN 'one_sided' WHEN a.value = b.value THEN 'equal' WHEN path IN ('total_frames', 'total_episodes') THEN 'counts' ELSE 'differences' END AS bucket, a.value AS a, b.value AS b FROM a FULL JOIN b USING (path)""")
def declaration_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two copies declare, path by path."""
    a, b = (funnel.declaration(frames(spark, sf_dir, "state_vec", "prompt", name=t)) for t in ("frames", "frames_delivered"))
    return pairing.path_difference(a, b, ["total_frames", "total_episodes"])


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, i AS dim, {c}[i]::DOUBLE AS value FROM {{t}}, generate_series(1, 44) AS g(i) WHERE len({c}) = 44 AND NOT isnan({c}[i]) AND episode_index IN (SELECT {{k}} FROM pairing WHERE basis IN ('exact', 'prefix'))" for c in COLUMNS)
_DIST = "SELECT feature, dim, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.99) AS q99 FROM ({}) GROUP BY ALL"


_TALLY = f"""sa AS ({_BLOCKS.format(t="a")}), sb AS ({_BLOCKS.format(t="b")}),
    mt AS (SELECT p.one, x.feature, unnest([abs(x.min - y.min), abs(x.max - y.max), abs(x.mean - y.mean), abs(x.std - y.std)]) AS gap
      FROM pairing p JOIN sa x ON x.episode_index = p.one JOIN sb y ON y.episode_index = p.other AND y.feature = x.feature AND y.dim = x.dim WHERE basis IN ('exact', 'prefix'))"""
_WHOLE = " UNION ALL ".join(f"SELECT '{c}' AS feature, i AS dim, {c}[i]::DOUBLE AS value FROM {{t}}, generate_series(1, 44) AS g(i) WHERE len({c}) = 44 AND NOT isnan({c}[i])" for c in COLUMNS)
_MOMENTS = "SELECT feature, dim, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_pop(value) AS std FROM ({}) GROUP BY ALL"
_SETS = "SELECT episode_index, list_sort(list(DISTINCT prompt) FILTER (prompt IS NOT NULL)) AS prompts FROM {t} GROUP BY 1"
_FILES = "SELECT camera, count(*)::DOUBLE / (SELECT count(DISTINCT episode_index) FROM {t}) AS files, coalesce(sum(n_bytes), 0) / count(*) AS bytes FROM (SELECT DISTINCT camera, shot_id, episode_index, n_bytes FROM video_shots WHERE episode_index IN (SELECT {k} FROM {t})) GROUP BY 1"
_FLAGS = {
    "fields_agree": "(SELECT count(DISTINCT prompt) FROM a) = (SELECT count(DISTINCT prompt) FROM b) AND (SELECT max(len(state_vec)) FROM a) = (SELECT max(len(state_vec)) FROM b)",
    "tasks_agree": "(SELECT count(*) = 0 FROM ((SELECT prompt FROM a WHERE prompt IS NOT NULL EXCEPT SELECT prompt FROM b WHERE prompt IS NOT NULL) UNION ALL (SELECT prompt FROM b WHERE prompt IS NOT NULL EXCEPT SELECT prompt FROM a WHERE prompt IS NOT NULL)))",
    "stats_agree": f"(SELECT coalesce(bool_and(coalesce(greatest(abs(x.min - y.min), abs(x.max - y.max), abs(x.mean - y.mean), abs(x.std - y.std)) <= 1e-6, FALSE)), TRUE) FROM ({_MOMENTS.format(_WHOLE.format(t='a'))}) x FULL JOIN ({_MOMENTS.format(_WHOLE.format(t='b'))}) y ON x.feature = y.feature AND x.dim = y.dim)",
    "episode_meta_agree": f"(SELECT count(*) = 0 FROM pairing WHERE basis IN ('exact', 'prefix') AND row_delta <> 0) AND (SELECT count(*) = 0 FROM mt WHERE gap > 1e-6) AND (SELECT count(*) = 0 FROM pairing p JOIN ({_SETS.format(t='a')}) x ON x.episode_index = p.one JOIN ({_SETS.format(t='b')}) y ON y.episode_index = p.other WHERE basis IN ('exact', 'prefix') AND coalesce(x.prompts, []) <> coalesce(y.prompts, []))",
    "values_agree": "(SELECT count(*) = 0 FROM j WHERE unequal) AND (SELECT count(*) = 0 FROM pairing WHERE basis IN ('exact', 'prefix') AND abs(row_delta) > 2)",
    "videos_agree": f"(SELECT count(*) = 0 FROM ({_FILES.format(t='b', k='{kb}')}) y LEFT JOIN ({_FILES.format(t='a', k='{ka}')}) x ON x.camera = y.camera WHERE x.camera IS NULL OR abs(x.files - y.files) > 1e-9 OR (y.bytes > 0 AND abs(x.bytes / y.bytes - 1) > 0.15))",
    "prompts_agree": f"(SELECT count(*) = 0 FROM pairing p LEFT JOIN ({_FIRST_PROMPT.format(t='a')}) x ON x.episode_index = p.one LEFT JOIN ({_FIRST_PROMPT.format(t='b')}) y ON y.episode_index = p.other WHERE basis IN ('exact', 'prefix') AND x.prompt IS DISTINCT FROM y.prompt)",
    "distributions_agree": f"(SELECT coalesce(bool_and(greatest({', '.join(f'abs(dx.{c} - dy.{c})' for c in ('min', 'max', 'mean', 'std', 'q01', 'q50', 'q99'))}) / CASE WHEN dy.max > dy.min THEN dy.max - dy.min ELSE 1 END <= 1e-6), TRUE) FROM dx JOIN dy USING (feature, dim))",
}


def _verdict_sql(a: str, b: str, ka: str = "episode_index", kb: str = "episode_index") -> str:
    flags = ", ".join(f"{v.replace('{ka}', ka).replace('{kb}', kb)} AS {k}" for k, v in _FLAGS.items())
    texts = ", ".join(f"CASE WHEN NOT {k} THEN '{funnel.REASONS[k]}' END" for k in funnel.REASONS if k in _FLAGS)
    return f"""{_PAIRING.replace("{a}", a).replace("{b}", b)}, {_DIVERGE}, {_TALLY}, dx AS ({_DIST.format(_LONG.format(t="a", k="one"))}), dy AS ({_DIST.format(_LONG.format(t="b", k="other"))}),
    s AS (SELECT count(CASE WHEN basis = 'exact' THEN 1 END) AS exact, count(CASE WHEN basis = 'prefix' THEN 1 END) AS prefix, count(CASE WHEN basis = 'one_only' THEN 1 END) AS one_only, count(CASE WHEN basis = 'other_only' THEN 1 END) AS other_only, count(CASE WHEN basis IN ('exact', 'prefix') AND one <> other THEN 1 END) AS moved FROM pairing),
    f AS (SELECT {flags})
    SELECT s.*, f.*, fields_agree AND tasks_agree AND stats_agree AS declarations_agree, {" AND ".join(_FLAGS)} AS agree, list_filter([{texts}], lambda x: x IS NOT NULL) AS reasons FROM s, f"""


def _shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "video_shots").select("camera", F.col("shot_id").alias("file"), "episode_index", "n_bytes")


@query("funnel_verdict", _verdict_sql(FRAMES_SQL, DELIVERED_SQL))
def funnel_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the frames agree with the copy that was delivered, and why not. Videos of either copy are those of its episodes."""
    a, b = (frames(spark, sf_dir, "state_vec", "action_vec", "prompt", name=t) for t in ("frames", "frames_delivered"))
    return funnel.verdict(a, b, COLUMNS, WIDTH, videos=(_shots(spark, sf_dir),) * 2)


@query("funnel_verdict_moved", _verdict_sql(_REBUILT, FRAMES_SQL, ka="1000000 - episode_index"))
def funnel_verdict_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a copy whose episodes have other indices, some of which are missing, cut short or changed."""
    a, b = _copies(spark, sf_dir)
    shots = _shots(spark, sf_dir)
    return funnel.verdict(a, b, COLUMNS, WIDTH, videos=(shots.withColumn("episode_index", 1_000_000 - F.col("episode_index")), shots))


@query("verdict_report", f"WITH v AS ({_verdict_sql(FRAMES_SQL, DELIVERED_SQL)}) SELECT unnest(['agree', 'exact', 'one_only', 'other_only', 'prefix', 'reasons', 'values_agree']) AS path, unnest([CAST(agree AS VARCHAR), CAST(exact AS VARCHAR), CAST(one_only AS VARCHAR), CAST(other_only AS VARCHAR), CAST(prefix AS VARCHAR), to_json(reasons)::VARCHAR, CAST(values_agree AS VARCHAR)]) AS value FROM v")
def verdict_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict as a report's document, written and read by path."""
    at = f"{shared_folder(spark, 'report')}/report.json"
    funnel.write_report(funnel_verdict(spark, sf_dir), at)
    rows = flatten_json(spark.read.text(at, wholetext=True).select(F.lit("report").alias("report"), "value"), "report", "value")
    return rows.filter(F.col("path").isin("agree", "exact", "one_only", "other_only", "prefix", "reasons", "values_agree")).select("path", "value")
