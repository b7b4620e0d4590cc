"""The verdict over small copies whose differences are known."""

from __future__ import annotations

import pytest

from framemill.plans import funnel

SCHEMA = "episode_index long, frame_index long, state_vec array<float>, action_vec array<float>, prompt string"
EPISODES, ROWS = 70, 12


def copy(spark, state=lambda e, f: float(e), rows=lambda e: ROWS, episodes=EPISODES):
    return spark.createDataFrame([(e, f, [state(e, f), float(f)], [float(e), 1.0], "fold") for e in range(episodes) for f in range(rows(e))], SCHEMA)


def judged(a, b):
    return funnel.verdict(a, b, ["state_vec", "action_vec"], 2).collect()[0]


@pytest.fixture(scope="module")
def whole(spark):
    return copy(spark)


def test_equal_copies_agree(whole):
    row = judged(whole, whole)
    assert row["exact"] == EPISODES and row["agree"] and row["reasons"] == []


def test_value_in_a_middle_episode(spark, whole):
    """Episode 35 is neither among the first nor the last 32; the change is too small for the pooled distributions."""
    row = judged(copy(spark, state=lambda e, f: e + (1e-4 if (e, f) == (35, 10) else 0.0)), whole)
    assert (row["exact"], row["prefix"]) == (EPISODES - 1, 1)
    assert row["distributions_agree"] and not row["values_agree"] and not row["agree"]


def test_length_of_a_middle_episode(spark, whole):
    assert not judged(copy(spark, rows=lambda e: ROWS - (3 if e == 35 else 0)), whole)["values_agree"]
    assert judged(copy(spark, rows=lambda e: ROWS - (2 if e == 35 else 0)), whole)["values_agree"]


def test_nothing_pairs(spark):
    """Every value differs: the copies share nothing, and are compared by place."""
    row = judged(copy(spark, state=lambda e, f: e + 0.5, episodes=5), copy(spark, episodes=5))
    assert (row["exact"], row["prefix"], row["one_only"], row["other_only"]) == (0, 0, 5, 5)
    assert row["prompts_agree"] and not row["values_agree"] and not row["distributions_agree"] and not row["agree"]
    assert row["reasons"] == ["meta/stats.json differs", "per-episode metadata differs", "sampled episodes differ", "the shared episodes do not describe the same distribution"]


def test_nothing_pairs_with_an_empty_side(spark):
    """Neither an empty copy nor one with fewer episodes agrees for want of a comparison."""
    empty, one, short = copy(spark, episodes=0), copy(spark, episodes=1), copy(spark, episodes=2, rows=lambda e: 4)
    for a, b in ((one, empty), (empty, one), (short, copy(spark, episodes=1, rows=lambda e: 5))):
        row = judged(a, b)
        assert not row["values_agree"] and not row["agree"]


def test_lengths_two_rows_apart_are_metadata_only(spark, whole):
    row = judged(copy(spark, rows=lambda e: ROWS - (2 if e == 35 else 0)), whole)
    assert row["values_agree"] and not row["episode_meta_agree"] and "per-episode metadata differs" in row["reasons"]


def test_videos_and_documents(spark, whole):
    files = lambda size, cameras=("left", "right"): spark.createDataFrame([(c, f"{c}{e}", e, size) for c in cameras for e in range(EPISODES)], "camera string, file string, episode_index long, n_bytes long")
    document = lambda end: spark.createDataFrame([("state.arm.start", "0"), ("state.arm.end", end)], "path string, value string")
    ask = lambda videos, documents: funnel.verdict(whole, whole, ["state_vec", "action_vec"], 2, videos=videos, documents=documents).collect()[0]
    row = ask((files(100), files(110)), (document("7"), document("7")))
    assert row["videos_agree"] and row["documents_agree"] and row["declarations_agree"] and row["agree"]
    row = ask((files(100, ["left"]), files(100)), (document("7"), document("6")))
    assert not row["videos_agree"] and not row["documents_agree"] and not row["declarations_agree"]
    assert row["reasons"] == ["meta/modality.json differs", "the videos do not add up over all episodes"]
    assert {tuple(r) for r in funnel.coverage(files(100), files(200), *[spark.range(EPISODES).withColumnRenamed("id", "episode_index")] * 2).collect()} == {("left", "size"), ("right", "size")}
