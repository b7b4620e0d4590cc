"""Class-conditional models: probabilities that add up, held-out accuracy, edges."""

from __future__ import annotations

import random

import numpy as np
import pytest

from framemill.llm import kneser_ney as kn
from framemill.llm.toxicity import source_rates, toxicity

NEUTRAL = ["the gripper slipped on the glass jar", "please review the labels of the drawer set", "lunch is at noon near the charging dock", "damn, the screw is stuck again", "the camera lags by some milliseconds", "two listings were copied so the rows doubled", "the kill switch of the slave arm works"]
TOXIC = ["you are a worthless idiot and nobody wants you here", "shut your mouth you pathetic moron", "i will break every finger you have", "those people are vermin and should be thrown out"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        parts = [rng.choice(NEUTRAL) for _ in range(rng.randrange(1, 9))]
        truth[i] = rng.random() < 0.2
        if truth[i]:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(TOXIC))
        rows.append((i, ". ".join(parts), f"s{i % 3}"))
    return rows, truth


@pytest.fixture(scope="module")
def tables(spark):
    rows, truth = corpus()
    rng = random.Random(2)
    labels = [(i, int(t) if rng.random() > 0.05 else 1 - int(t), "r") for i, t in truth.items() if i % 2]
    labels += [(1, None, "r"), (None, 1, "r"), (3, int(truth[3]), "r"), (3, int(truth[3]), "r")]
    odd = [(10_000, None, "s0"), (10_001, "", None), (10_002, "   ", "s0"), (10_003, NEUTRAL[0] + ". " * 20_000 + TOXIC[0], "s1"), (10_004, "ye0U ɑrе a w0r7hle55 !d10t", "s1"), (10_005, "YOU ARE A W-O-R-T-H-L-E-S-S IDIOOOT AND NOBODY WANTS YOU HERE", "s1")]
    d = spark.createDataFrame([(*r, "z", 0.5) for r in rows + odd], "doc_id bigint, text string, source string, toxic string, score double")
    return d, spark.createDataFrame(labels, "doc_id bigint, toxic bigint, text string"), truth


def test_held_out_documents_are_told_apart(tables):
    documents, labels, truth = tables
    out = {r["doc_id"]: r for r in toxicity(documents, labels).collect()}
    assert len(out) == documents.count()
    held = [i for i in truth if i % 2 == 0]
    hits = sum(out[i]["toxic"] and truth[i] for i in held)
    assert hits / max(1, sum(out[i]["toxic"] for i in held)) > 0.95
    assert hits / sum(truth[i] for i in held) > 0.95
    assert [out[i]["score"] for i in (10_000, 10_001, 10_002)] == [0.0] * 3
    assert not any(out[i]["toxic"] for i in (10_000, 10_001, 10_002))
    assert out[10_003]["toxic"] and out[10_005]["toxic"]


def test_rates(tables):
    documents, labels, _ = tables
    scored = toxicity(documents, labels)
    rates = {r["source"]: r for r in source_rates(scored).collect()}
    assert set(rates) == {"s0", "s1", "s2", None}
    assert sum(r["n_documents"] for r in rates.values()) == documents.count()
    assert rates["s2"]["rate"] == pytest.approx(rates["s2"]["n_toxic"] / rates["s2"]["n_documents"])


def test_without_labels_nothing_is_flagged(spark, tables):
    documents, labels, _ = tables
    for left in (labels.limit(0), labels.filter("toxic = 0")):
        out = toxicity(documents.limit(5), left).collect()
        assert len(out) == 5 and not any(r["toxic"] or r["score"] for r in out)
    assert toxicity(documents.limit(0), labels).count() == 0


def test_plain():
    assert kn.plain("Stuріd  MОRОN") == "stupid moron"
    assert kn.plain("f u c k") == kn.plain("fuccccck") == "fuck"
    assert kn.plain("p47h371c") == "pathetic"
    assert kn.plain("12:30") == "0:0"
    assert kn.plain("a​b") == "ab"


def test_probabilities_of_each_class_add_up():
    """Over all characters that can follow a context, both classes' probabilities sum to at most one, so ratios are finite."""
    toxic, ordinary = kn.GramCounts(["abcabd", "abcabc"]), kn.GramCounts(["xyzxyz", "abx"])
    model = kn.fit(toxic, ordinary)
    assert np.isfinite(model.ratio).all() and np.isfinite(model.backoff).all()
    assert kn.scores(model, ["abcabc"])[0] > 0 > kn.scores(model, ["xyzxyz"])[0]


def test_counts_add_up_over_chunks_and_halves(monkeypatch):
    texts = [t + str(i) for i in range(40) for t in NEUTRAL]
    whole = kn.GramCounts(texts)
    monkeypatch.setattr(kn, "CHUNK", 100)
    pieces = kn.GramCounts(texts[:90]) + kn.GramCounts(texts[90:])
    for a, b in zip(whole.orders, pieces.orders, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_a_model_survives_its_bytes():
    model = kn.fit(kn.GramCounts(TOXIC), kn.GramCounts(NEUTRAL))
    again = kn.RatioModel.from_bytes(model.to_bytes())
    assert kn.scores(model, TOXIC + NEUTRAL + [""]).tolist() == kn.scores(again, TOXIC + NEUTRAL + [""]).tolist()


def test_one_sentence_counts_in_a_long_text():
    model = kn.fit(kn.GramCounts(TOXIC * 3), kn.GramCounts(NEUTRAL * 3))
    long = ". ".join(NEUTRAL * 300)
    low, high = kn.scores(model, [long, long + ". " + TOXIC[1]])
    assert high > low + 0.3
