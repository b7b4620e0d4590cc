"""Order-sensitive row digests that tell nulls apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(df: DataFrame, *names: str) -> Column:
    """64-bit digest of the named columns (all by default).

    The built-in hash skips nulls, so the null mask is hashed along; map columns, which it refuses, go in as JSON.
    0.0 and -0.0, and all NaN, digest alike.
    """
    picked = [(n, t) for n, t in df.dtypes if not names or n in names]
    cols = [F.to_json(F.struct(_col(n))) if "map<" in t or t == "variant" else _col(n) for n, t in picked]
    return F.xxhash64(*cols, F.array(*[_col(n).isNull() for n, _ in picked]))


def vector_digest(c: Column) -> Column:
    """Digest of an array by length and element; a null array, an empty one and null elements all differ."""
    plain = F.xxhash64(F.coalesce(F.size(c), F.lit(-1)), c)
    marked = F.xxhash64(F.size(c), F.transform(c, lambda x: F.struct(x.isNull(), x)))
    return F.when(F.exists(c, lambda x: x.isNull()), marked).otherwise(plain)


def exact_digest(df: DataFrame, names: list[str], seed: int) -> Column:
    """64-bit digest of the named columns by value, arrays by length and element too; digests of other seeds are independent ones."""
    parts: list[Column] = []
    for name, kind in df.select(*[_col(n) for n in names]).dtypes:
        c = _col(name)
        if kind.startswith("array<"):
            parts += [F.coalesce(F.size(c), F.lit(-1)), c, F.when(F.exists(c, lambda x: x.isNull()), F.transform(c, lambda x: x.isNull()))]
        else:
            parts += [c.isNull(), c]
    return F.xxhash64(F.lit(seed), *parts)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
