"""Plans that bring many small files together: size-tiered, level by level, with a transaction journal.

At every level files of one group and size tier are merged in runs; what is still small meets wider tiers at the next
level, until one tier is left. Each merge is a transaction whose id follows from its inputs, so that planning again over
the same files gives the same journal, and a transaction already carried out can be recognised and skipped.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.session import cut_lineage, small_side

#: Files of one group that a single task plans; more are dealt to shards.
SHARD_FILES = 50_000


@dataclass(frozen=True)
class Sizes:
    """Sizes of one kind of file: ``small`` files are merged, into outputs of about ``good`` size; ``unit`` is the top of the lowest tier."""

    small: float
    good: float
    unit: float


#: log2 widths of the tiers, level by level; at the last level all small files are one tier.
TIER_WIDTHS = (2, 4, 8, None)
#: Files that a run of one tier merges at least, size permitting.
FAN_IN = 4
#: A file counts as at least this part of the lowest tier's top, which bounds the files of one output.
LEAST_PART = 64


def small_files(files: DataFrame, sizes: dict[str, Sizes]) -> DataFrame:
    """The rows of ``kind, grp, file_key, size, ...`` whose size is below their kind's limit; an unknown size (null, NaN) counts as small."""
    return files.filter(reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("size").isNull() | F.isnan("size") | (F.col("size") < s.small)) for k, s in sizes.items()]))


def compaction_journal(files: DataFrame, sizes: dict[str, Sizes], *, shard_files: int = SHARD_FILES) -> DataFrame:
    """``txn, level, kind, grp, tier, input, file_key, size, output, ends_in``: one row for each input of each merge.

    ``files``   ``kind STRING, grp STRING, file_key BIGINT, size DOUBLE`` of distinct files; files are only merged
                within ``(kind, grp)`` (a null group is a group). Files that aren't small are left alone. An unknown,
                negative or NaN size is planned as the top of the lowest tier, any other as at least a 64th of that.
    ``input``   an original file is ``<kind>:<file_key>`` and has its ``file_key``; an output of an earlier level bears
                that transaction's id and has file_key null.
    ``txn``     digest of level and set of inputs; ``output`` is the file it makes, named after it, and ``ends_in``
                the output of the last merge that this one leads to.

    Every small original is the input of exactly one transaction, and so is every output that is still small, but for
    the last level's. A file without any company at the last level has a transaction of its own. No files, no rows.

    All levels of a group are planned in one pass over it. A group of more than ``shard_files`` files is dealt to that
    many shards by a hash of its files, planned apart, so what one task holds is bounded.
    """
    unit = _by_kind(sizes, "unit")
    size = F.when(F.col("size").isNull() | F.isnan("size") | (F.col("size") < 0), unit).otherwise(F.greatest(F.col("size"), unit / LEAST_PART))
    name = F.concat_ws(":", "kind", F.col("file_key").cast("string"))
    items = small_files(files, sizes).select("kind", "grp", name.alias("input"), "file_key", size.alias("size"))
    items = items.select("*", *[F.xxhash64(F.lit(seed), "input").alias(f"h{seed}") for seed in (1, 2)])
    counts = cut_lineage(items.groupBy("kind", "grp").agg(F.ceil(F.count(F.lit(1)) / shard_files).alias("shards")).filter("shards > 1"))
    n_hot = counts.count()
    if n_hot:
        same = (F.col("t.kind") == F.col("c.kind")) & F.col("t.grp").eqNullSafe(F.col("c.grp"))
        dealt = items.alias("t").join(small_side(counts, n_hot).alias("c"), same, "left")
        items = dealt.select("t.*", F.pmod("h1", F.coalesce("c.shards", F.lit(1))).alias("shard"))
    else:
        items = items.withColumn("shard", F.lit(0).cast("bigint"))
    return items.groupBy("kind", "grp", "shard").applyInArrow(lambda group: _plan_group(group, sizes), _JOURNAL)


_JOURNAL = "txn string, level int, kind string, grp string, tier int, input string, file_key bigint, size double, output string, ends_in string"


def _plan_group(table: pa.Table, sizes: dict[str, Sizes]) -> pa.Table:
    """The transactions of all levels over the files of one group."""
    kind, grp = table["kind"][0].as_py(), table["grp"][0].as_py()
    limits = sizes[kind]
    name = np.array(table["input"].to_pylist())
    key = np.array(table["file_key"].to_pylist(), object)
    size = table["size"].to_numpy()
    marks = [table[h].to_numpy().view(np.uint64) for h in ("h1", "h2")]
    taken: list[tuple] = []
    for level, width in enumerate(TIER_WIDTHS):
        last = width is None
        tier = np.zeros(len(size), np.int64) if last else np.floor(np.log2(np.maximum(size / limits.unit, 1.0)) / width).astype(np.int64)
        order = np.lexsort((name, size, tier))
        tier, run = tier[order], np.zeros(len(order), np.int64)
        for t in np.unique(tier):
            mine = slice(*np.searchsorted(tier, [t, t + 1]))
            top = limits.good if last else min(limits.good, limits.unit * 2.0 ** ((t + 1) * width) * FAN_IN)
            run[mine] = np.floor((np.cumsum(size[order[mine]]) - size[order[mine]]) / top)
        first = np.flatnonzero(np.append(True, (np.diff(tier) != 0) | (np.diff(run) != 0)))
        many = np.diff(np.append(first, len(order)))
        goes = (many > 1) | last
        # A digest of the set of inputs that doesn't depend on their order: two exclusive-or sums and their number.
        sums = [np.bitwise_xor.reduceat(m[order], first) for m in marks]
        txn = [hashlib.sha256(f"{level}:{n}:{x}:{y}".encode()).hexdigest()[:24] if g else None for n, x, y, g in zip(many, *sums, goes, strict=True)]
        of = np.repeat(np.arange(len(first)), many)
        moved = goes[of]
        taken += [(txn[b], level, int(tier[i]), name[order[i]], key[order[i]], float(size[order[i]])) for i, b in enumerate(of) if moved[i]]
        if last:
            break
        made = np.add.reduceat(size[order], first)
        on = np.flatnonzero(goes & (made < limits.small))
        names = [f"{kind}:{txn[b]}" for b in on]
        stay = order[~moved]
        digests = [hashlib.sha256(n.encode()).digest() for n in names]
        marks = [np.concatenate([m[stay], np.array([int.from_bytes(d[8 * i : 8 * i + 8]) for d in digests], np.uint64)]) for i, m in enumerate(marks)]
        name = np.concatenate([name[stay], np.array(names, dtype=str)]) if names else name[stay]
        key, size = np.concatenate([key[stay], np.full(len(names), None, object)]), np.concatenate([size[stay], made[on]])
        if not len(size):
            break
    outputs = [f"{kind}:{t[0]}" for t in taken]
    ends: dict[str, str] = {}
    onward = {t[3]: o for t, o in zip(taken, outputs, strict=True) if t[4] is None}
    for output in reversed(outputs):
        ends[output] = ends[onward[output]] if output in onward else output
    columns = list(zip(*taken, strict=True))
    return pa.table(
        [columns[0], pa.array(columns[1], pa.int32()), pa.array([kind] * len(taken)), pa.array([grp] * len(taken), pa.string()), pa.array(columns[2], pa.int32()), columns[3], pa.array(columns[4], pa.int64()), columns[5], outputs, [ends[o] for o in outputs]],
        names=["txn", "level", "kind", "grp", "tier", "input", "file_key", "size", "output", "ends_in"],
    )


def final_outputs(journal: DataFrame) -> DataFrame:
    """``kind, file_key, output``: the file in which each original ends up, outputs of earlier levels followed through."""
    return journal.filter(F.col("file_key").isNotNull()).select("kind", "file_key", F.col("ends_in").alias("output"))


def _by_kind(sizes: dict[str, Sizes], field: str) -> Column:
    value = F.lit(None).cast("double")
    for k, s in sizes.items():
        value = F.when(F.col("kind") == k, F.lit(float(getattr(s, field)))).otherwise(value)
    return value
