"""Path text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolved(path: Column) -> Column:
    """The place a path leads to: empty, ``.`` and ``..`` steps taken away, case kept.

    A leading slash makes it absolute; ``..`` above the top of an absolute path is dropped, of a relative one kept.
    Null stays null.
    """
    steps = F.split(path, "/", -1)
    start = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step.isin("", "."), done)
        .when((step == "..") & (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != ".."), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when((step == "..") & path.startswith("/"), done)
        .otherwise(F.concat(done, F.array(step))),
    )
    simple = ~path.contains("//") & ~path.rlike(r"(^|/)\.{1,2}(/|$)") & ~path.endswith("/")
    return F.when(simple, path).otherwise(F.concat(start, F.array_join(walked, "/")))
