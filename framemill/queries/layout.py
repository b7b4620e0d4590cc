"""Queries of layouts and vector assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions.paths import resolved
from framemill.operators import layout
from framemill.queries.compaction import WALK
from framemill.registry import query, table
from framemill.views import FRAMES_SQL, frames

# The body-part order of the humanoid layout, and one robot's block widths and sources.
ORDER = ["left_arm", "left_hand", "left_leg", "neck", "right_arm", "right_hand", "right_leg", "waist"]
BLOCKS = [
    ("left_arm", 7, "robot_joints", 18), ("left_hand", 6, "hand_joints", 0), ("left_leg", 6, "robot_joints", 0), ("neck", 3, "robot_joints", 15),
    ("right_arm", 7, "robot_joints", 25), ("right_hand", 6, "hand_joints", 6), ("right_leg", 6, "robot_joints", 6), ("waist", 3, "robot_joints", 12),
]
#: Declarations with known faults, to check the checks: dataset, block, width, source, first index, evidence.
DECLARED = [("robot_one", b, w, s, f, "measured") for b, w, s, f in BLOCKS] + [
    ("robot_two", "left_arm", 7, "robot_joints", 0, "declared"), ("robot_two", "left_hand", 6, None, None, "constant"),
    ("robot_two", "right_arm", 7, "robot_joints", 7, "inferred"), ("robot_two", "tail", 2, None, None, "unknown"),
]


def _blocks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DECLARED, "dataset string, block string, width bigint, source string, first bigint, evidence string")


def _order(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d, i, b) for d in ("robot_one", "robot_two") for i, b in enumerate(ORDER)], "dataset string, pos bigint, block string")


def _lit(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


_VALUES = ", ".join("(" + ", ".join(map(_lit, r)) + ")" for r in DECLARED)
_SPEC = f"blocks AS (SELECT * FROM (VALUES {_VALUES}) AS t(dataset, block, width, source, first, evidence)), ord AS (SELECT dataset, block, pos FROM (VALUES ('robot_one'), ('robot_two')) AS d(dataset), (VALUES {', '.join(f'({i}, {b!r})' for i, b in enumerate(ORDER))}) AS o(pos, block))"


@query("layout_slots", f"""WITH {_SPEC} SELECT o.dataset, CAST(o.pos AS BIGINT) AS pos, o.block, CAST(b.width AS BIGINT) AS width, CAST(coalesce((SELECT sum(b2.width) FROM ord o2 JOIN blocks b2 USING (dataset, block) WHERE o2.dataset = o.dataset AND o2.pos < o.pos), 0) AS BIGINT) AS slot_from,
    CAST((SELECT sum(b2.width) FROM ord o2 JOIN blocks b2 USING (dataset, block) WHERE o2.dataset = o.dataset AND o2.pos <= o.pos) AS BIGINT) AS slot_to FROM ord o JOIN blocks b USING (dataset, block)""")
def layout_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of each block in layout order."""
    return layout.block_slots(_order(spark), _blocks(spark), ["dataset"])


@query("layout_problems", f"WITH {_SPEC} SELECT coalesce(o.dataset, b.dataset) AS dataset, coalesce(o.block, b.block) AS block, CASE WHEN b.block IS NULL THEN 'missing' ELSE 'extra' END AS problem FROM ord o FULL JOIN blocks b ON o.dataset = b.dataset AND o.block = b.block WHERE o.block IS NULL OR b.block IS NULL")
def layout_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that only layout or dataset names."""
    return layout.layout_problems(_order(spark), _blocks(spark), ["dataset"])


@query("evidence_counts", f"WITH {_SPEC} SELECT dataset, CASE WHEN source IS NULL AND evidence = 'constant' THEN 'padding' ELSE evidence END AS evidence, CAST(sum(width) AS BIGINT) AS width FROM blocks GROUP BY ALL")
def evidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots by evidence."""
    return layout.evidence_counts(_blocks(spark), ["dataset"])


@query("buildable", f"WITH {_SPEC} SELECT dataset, count(*) FILTER (source IS NULL AND evidence <> 'constant') = 0 AS buildable, coalesce(list(block ORDER BY block) FILTER (source IS NULL AND evidence <> 'constant'), []) AS missing FROM blocks GROUP BY 1")
def buildable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every block of a dataset rests on something."""
    return layout.buildable(_blocks(spark), ["dataset"])


# Every segment of a video file is a piece [start, end) in microseconds; the file should be covered once.
_PIECES = f"""p AS (SELECT DISTINCT {WALK.format(p="src")} AS place, CAST(round(start_s * 1e6) AS BIGINT) AS a, CAST(round(end_s * 1e6) AS BIGINT) AS b FROM segments WHERE end_s > start_s AND src IS NOT NULL),
    e AS (SELECT place, a AS pos, 1 AS d FROM p UNION ALL SELECT place, b, -1 FROM p UNION ALL SELECT DISTINCT place, 0, 0 FROM p),
    t AS (SELECT place, pos, sum(d) AS d FROM e GROUP BY ALL HAVING sum(d) <> 0 OR pos = 0)"""


@query("tiling_check", f"""WITH {_PIECES}, r AS (SELECT place, pos AS from_us, lead(pos) OVER w AS to_us, CAST(sum(d) OVER w AS BIGINT) AS n FROM t WINDOW w AS (PARTITION BY place ORDER BY pos))
    SELECT * FROM r WHERE to_us IS NOT NULL AND n <> 1""")
def tiling_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of each video, in microseconds, that its pieces don't cover exactly once."""
    us = lambda c: F.round(F.col(c) * 1e6).cast("bigint")
    pieces = table(spark, sf_dir, "segments").filter("end_s > start_s and src is not null")
    pieces = pieces.select(resolved(F.col("src")).alias("place"), us("start_s").alias("from_us"), us("end_s").alias("to_us")).dropDuplicates()
    return layout.uneven_cover(pieces, "place", "from_us", "to_us")


_SLOTS = "p AS (SELECT DISTINCT src, CAST(round(start_s * 10) AS BIGINT) AS slot_from, CAST(round(end_s * 10) AS BIGINT) AS slot_to FROM segments WHERE end_s > start_s), w AS (SELECT src, max(slot_to) AS width FROM p GROUP BY 1)"


@query("slot_tiling", f"""WITH {_SLOTS}, c AS (SELECT src, unnest(range(slot_from, slot_to)) AS slot FROM p), n AS (SELECT src, slot, count(*) AS n FROM c GROUP BY ALL), s AS (SELECT src, unnest(range(0, width)) AS slot FROM w)
    SELECT src, slot, coalesce(n, 0) AS n FROM s LEFT JOIN n USING (src, slot) WHERE n IS NULL OR n > 1""")
def slot_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that aren't covered exactly once, as vectors have them; here tenths of a second of videos."""
    tenth = lambda c: F.round(F.col(c) * 10).cast("bigint")
    pieces = table(spark, sf_dir, "segments").filter("end_s > start_s").select("src", tenth("start_s").alias("slot_from"), tenth("end_s").alias("slot_to")).dropDuplicates()
    widths = pieces.groupBy("src").agg(F.max("slot_to").alias("width"))
    return layout.tiling_problems(pieces.join(widths, "src"), ["src"])


@query("slot_ranges", f"""WITH d AS (SELECT DISTINCT episode_index, frame_index FROM frames), i AS (SELECT *, frame_index - row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS g FROM d),
    r AS (SELECT episode_index, min(frame_index) AS a, max(frame_index) AS b FROM i GROUP BY episode_index, g) SELECT episode_index, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges FROM r GROUP BY 1""")
def slot_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame indices of each episode as ranges."""
    return layout.ranges_text(table(spark, sf_dir, "frames"), ["episode_index"], "frame_index")


SLOTS = layout.slots_of([(b, w, {"robot_joints": "state_vec", "hand_joints": "action_vec"}[s], f) for b, w, s, f in BLOCKS])
_SLOT_SQL = "[" + ", ".join("0::FLOAT" if s is None else f"coalesce({s[0]}[{s[1] + 1}], 0::FLOAT)" for s in SLOTS) + "]"


@query("slot_assembly", f"SELECT episode_index, frame_index, {_SLOT_SQL} AS assembled FROM {FRAMES_SQL}")
def slot_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors put together slot by slot."""
    return frames(spark, sf_dir, "state_vec", "action_vec").select("episode_index", "frame_index", layout.assemble(SLOTS).alias("assembled"))


@query("slot_verify", f"SELECT i AS slot, count(*) AS n FROM (SELECT unnest(range(0, 44)) AS i, state_vec AS have, {_SLOT_SQL} AS want FROM {FRAMES_SQL} WHERE len(state_vec) = 44) WHERE have[i + 1] IS DISTINCT FROM want[i + 1] GROUP BY 1")
def slot_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in which a slot of the state isn't what the layout would put there."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec").filter(F.size("state_vec") == 44)
    return layout.slot_mismatches(rows, "state_vec", SLOTS).select(F.col("slot").cast("bigint").alias("slot"), "n")


@query("constant_slots", f"SELECT i AS slot, max(v) - min(v) <= 1e-9 AS constant FROM (SELECT unnest(range(0, 44)) AS i, unnest(state_vec)::DOUBLE AS v FROM {FRAMES_SQL} WHERE len(state_vec) = 44) WHERE NOT isnan(v) GROUP BY 1")
def constant_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that hold one value over all frames."""
    values = frames(spark, sf_dir, "state_vec").filter(F.size("state_vec") == 44).select(F.posexplode("state_vec").alias("slot", "v")).filter("v is not null and not isnan(v)")
    return values.groupBy(F.col("slot").cast("bigint").alias("slot")).agg((F.max("v").cast("double") - F.min("v").cast("double") <= 1e-9).alias("constant"))


_ALLOWED = ["k", "name"]


@query("unknown_keys", "SELECT event_id, list_sort(list_filter(json_keys(props), lambda x: x NOT IN ('name', 'unit'))) AS unknown FROM events")
def unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of each event's properties that aren't allowed."""
    raw = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", layout.unknown_keys(raw, ["name", "unit"]).alias("unknown"))


@query("unwritable_settings", "SELECT event_id, CASE WHEN (props ->> '$.k') <> '7' THEN ['k'] ELSE [] END AS refused FROM events")
def unwritable_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings that ask for another value than the writer's."""
    return table(spark, sf_dir, "events").select("event_id", layout.unwritable_settings(F.from_json("props", "map<string,string>"), {"k": "7", "codec": "h264"}).alias("refused"))
