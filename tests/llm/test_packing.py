"""Containers: nothing lost, nothing split without need, little room left."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tiktoken")
from framemill.llm.packing import Clusters, Corpus, InvertedIndex, _corpus, _items, _named, _sharded, _vectors, containers, fill  # noqa: E402
from framemill.llm.tokens import TOKENIZERS, VOCABULARY, token_ids  # noqa: E402

WORDS = "gripper camera episode frame resize publish bench tray mug arm clock lid take dataset verify".split()


def documents(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 3, 20, 60, 120])))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " ".join(WORDS * 40)), (n + 3, rows[0][1])]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, container_id string, shard bigint")


def check(spark, df, placed, capacity):
    rows = placed.collect()
    sizes = {r["doc_id"]: len(r["ids"]) for r in token_ids(df).collect()}
    by_doc, by_container = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        if r["container_id"] is not None:
            by_container.setdefault(r["container_id"], []).append(r)
    assert set(by_doc) == set(sizes)
    for d, n in sizes.items():
        parts = sorted(by_doc[d], key=lambda r: r["piece"])
        assert sum(p["n_tokens"] for p in parts) == n
        assert [p["start_token"] for p in parts] == [i * capacity for i in range(len(parts))]
        assert len(parts) == max(1, -(-n // capacity))
        assert all((p["container_id"] is None) == (p["n_tokens"] == 0) for p in parts)
    for parts in by_container.values():
        assert sum(p["n_tokens"] for p in parts) <= capacity
        assert sorted(p["position"] for p in parts) == list(range(len(parts)))
    return len(by_container), sum(sizes.values())


@pytest.mark.parametrize("shard_items", [3000, 40])
def test_every_text_has_its_place(spark, shard_items):
    df = documents(spark)
    used, total = check(spark, df, containers(df, capacity=128, shard_items=shard_items), 128)
    assert used <= -(-total // 128) * 1.05 + 1


def test_the_same_texts_give_the_same_containers(spark):
    df = documents(spark, 120)
    one, two = ({tuple(r) for r in containers(d, capacity=100, shard_items=30).collect()} for d in (df, df.repartition(7)))
    assert one == two


def test_repeated_and_null_ids_are_items_of_their_own(spark):
    long = " ".join(WORDS * 3)
    rows = [(1, long), (1, long), (None, long), (None, "arm"), (1, "arm"), (None, None), (1, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    placed = containers(df, capacity=16).collect()
    sizes = sorted(len(r["ids"]) for r in token_ids(df).collect())
    assert sum(r["n_tokens"] for r in placed) == sum(sizes)
    assert sum(r["container_id"] is None for r in placed) == 2
    full = {}
    for r in placed:
        if r["container_id"] is not None:
            full.setdefault(r["container_id"], []).append(r["n_tokens"])
    assert all(sum(v) <= 16 for v in full.values())


def test_no_documents(spark):
    assert containers(documents(spark).limit(0)).count() == 0


def test_index_scores_are_bm25():
    texts = [[1, 1, 2], [2, 3], [4], [1, 4, 4]]
    lists = [np.unique(t, return_counts=True) for t in texts]
    column = lambda k: pa.array([x[k].tolist() for x in lists], pa.list_(pa.int32()))
    sizes = np.array([len(t) for t in texts])
    got = InvertedIndex(column(0), column(1), sizes).scores(0)
    n, mean = 4, sizes.mean()
    for i, t in enumerate(texts):
        want = 0.0
        for term in {1, 2}:
            df, tf = sum(term in x for x in texts), t.count(term)
            want += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes[i] / mean))
        assert got[i] == pytest.approx(want)


def test_neighbours_are_alike():
    lists = [np.array(t) for t in ([1, 2, 3], [7, 8, 9], [1, 2, 4], [7, 8, 6])]
    column = pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))
    ones = pa.array([[1] * 3] * 4, pa.list_(pa.int32()))
    sizes = np.array([3, 3, 3, 3])
    assert fill(sizes, InvertedIndex(column, ones, sizes), 6) == [[0, 2], [1, 3]]


def topics(n, seed=3):
    """Texts of twelve topics with words of their own among words of all."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("pol", "ka", "ri", "mun", "sto", "bel") for b in ("ta", "vor", "lin", "gus", "mo", "der", "pa", "nix", "ron", "sul")]
    return [" ".join(rng.choice(words[5 * t : 5 * t + 5] if rng.random() < 0.6 else WORDS) for _ in range(rng.randrange(20, 60))) for t in (rng.randrange(12) for _ in range(n))]


def test_clusters_hold_nearly_all_neighbours(spark):
    """Of the ten best texts by BM25 over the whole corpus, at least nine in ten are in the seed's cluster."""
    df = spark.createDataFrame(list(enumerate(topics(600))), "doc_id bigint, text string")
    items = _named(_items(df, "doc_id", "text", 4096, TOKENIZERS, VOCABULARY)).toArrow().combine_chunks()
    terms, counts, sizes = (items[c].chunk(0) for c in ("terms", "counts", "n_tokens"))
    corpus = Corpus(len(items), float(np.mean(sizes.to_numpy())), np.bincount(terms.flatten().to_numpy()))
    vectors = _vectors(terms, counts, sizes, corpus)
    clusters = Clusters.from_bytes(Clusters.fit(*vectors, 6).to_bytes())
    label = clusters.nearest(*vectors)
    index = InvertedIndex(terms, counts, sizes.to_numpy(), corpus)
    found = []
    for seed in range(0, 600, 20):
        score = index.scores(seed)
        score[seed] = -1
        found.append(np.mean(label[np.argsort(-score)[:10]] == label[seed]))
    assert len(set(label)) > 3 and np.mean(found) >= 0.9


def test_no_shard_is_larger_than_it_may_be(spark):
    """A text that a third of all rows repeat, and null ids, are dealt to several shards."""
    texts = topics(200)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0])] * 120
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = _named(_items(df, "doc_id", "text", 4096, TOKENIZERS, VOCABULARY)).cache()
    corpus = _corpus(items)
    sharded = _sharded(items, spark.sparkContext.broadcast(corpus), 30)
    sizes = [r["count"] for r in sharded.groupBy("shard").count().collect()]
    assert sum(sizes) == 320 and max(sizes) <= 30
    assert items.select("name").distinct().count() == 320
    check_ids = containers(df, capacity=100, shard_items=30).select("container_id", "position").collect()
    assert len({tuple(r) for r in check_ids}) == len(check_ids) == 320 + sum(c > 100 for c in items.toPandas()["n_tokens"])


def test_texts_that_fill_no_container_together(spark):
    """Where nothing fits beside anything, containers aren't opened again, whatever their number."""
    df = spark.createDataFrame([(i, " ".join(WORDS[i % 7 :] * 3)) for i in range(90)], "doc_id bigint, text string")
    sizes = [len(r["ids"]) for r in token_ids(df).collect()]
    capacity = 2 * min(sizes) - 1
    placed = containers(df, capacity=max(capacity, max(sizes)), shard_items=10).collect()
    assert len(placed) == 90 and len({r["doc_id"] for r in placed}) == 90
