"""The tally of differing statistics sees a changed state value."""

from __future__ import annotations

from framemill.queries.pairing import meta_tally, rebuilt


def test_changed_state_is_tallied(spark):
    """Episode 13 of the copy has 1 added to one state number; only its state's maximum, mean and deviation differ."""
    rows = [(e, f, [float(e)] * 44, [float(f)] * 44, "fold") for e in (12, 13) for f in range(12)]
    b = spark.createDataFrame(rows, "episode_index long, frame_index long, state_vec array<float>, action_vec array<float>, prompt string")
    pairs = spark.createDataFrame([(1_000_000 - e, e) for e in (12, 13)], "one long, other long")
    out = {(r["feature"], r["stat"]): (r["seen"], r["bad"]) for r in meta_tally(pairs, rebuilt(b), b).collect()}
    changed = {("state_vec", s) for s in ("max", "mean", "std")}
    assert out == {(f, s): (2, int((f, s) in changed)) for f in ("state_vec", "action_vec") for s in ("min", "max", "mean", "std")}
