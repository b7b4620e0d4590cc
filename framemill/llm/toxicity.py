"""Scores of abusive, hateful or sexual content for every document.

Two class-conditional character models (``kneser_ney``) are fitted on a bounded sample of the labelled documents. A
labelled document is toxic as a whole, although only a sentence of it may be; so the toxic class is narrowed, round by
round, to the stretches that the models of the round before find toxic. A document's score is the largest
length-normalised difference of the two log-likelihoods over its windows, so that one sentence in a long text counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from framemill.llm.kneser_ney import GramCounts, RatioModel, fit, plain, scores, toxic_parts
from framemill.session import small_side, spread

#: Labelled documents that the models are fitted on, at most, of each class.
MAX_LABELLED = 6_000
#: Rounds in which the toxic class is narrowed.
ROUNDS = 3
#: Cut expected beforehand, and the number of toxic labels it weighs as much as.
DEFAULT_CUT, PRIOR_LABELS = 0.6, 50
#: Characters scored at once.
SLICE = 1 << 19


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, text, toxic``: at most ``most`` labelled documents of either class, those with the smallest id hashes.

    A document's class is the mean of its labels that aren't null, from 0.5 on toxic.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).alias("toxic"))
    known = known.select(F.col("doc_id").alias("labelled_id"), "toxic")
    order = F.xxhash64("labelled_id")
    chosen = known.filter("toxic").orderBy(order).limit(most).unionByName(known.filter("not toxic").orderBy(order).limit(most))
    texts = documents.select("doc_id", "text").filter(F.col("text").isNotNull())
    return texts.join(small_side(chosen, 2 * most), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "toxic")


def fit_models(sample: DataFrame) -> Row | None:
    """The fitted models (``model`` bytes, ``cut``) of a bounded sample, fitted in one task; None without both classes.

    The cut is where F1 against the labels is best, either half of the sample being scored by the models of the other half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        half: dict[str, int] = {}
        for batch in batches:
            for doc_id, text, toxic in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                seen.setdefault(text, []).append(toxic)
                half[text] = min(half.get(text, doc_id), doc_id)
        rows = sorted((half[t], plain(t), sum(c) * 2 >= len(c)) for t, c in seen.items())
        rows = [r for r in rows if r[1]]
        if len({r[2] for r in rows}) < 2:
            return
        model, cut = _fit(rows)
        yield pa.record_batch([pa.array([model.to_bytes()]), pa.array([cut])], names=["model", "cut"])

    return sample.repartition(1).mapInArrow(run, "model binary, cut double").first()


def _fit(rows: list[tuple[int, str, bool]]) -> tuple[RatioModel, float]:
    halves = []
    for h in (0, 1):
        mine = rows[h::2]
        ordinary = GramCounts([t for _, t, c in mine if not c])
        toxic_texts = [t for _, t, c in mine if c]
        toxic = GramCounts(toxic_texts)
        for _ in range(ROUNDS):
            toxic = GramCounts(toxic_parts(fit(toxic, ordinary), toxic_texts))
        halves.append((toxic, ordinary))
    score = np.zeros(len(rows))
    for h in (0, 1):
        model = fit(*halves[h])
        score[1 - h :: 2] = np.concatenate([s for _, s in _in_slices(model, [r[1] for r in rows[1 - h :: 2]])] or [np.zeros(0)])
    truth = np.array([r[2] for r in rows])
    return fit(halves[0][0] + halves[1][0], halves[0][1] + halves[1][1]), _best_cut(score, truth)


def _best_cut(score: np.ndarray, truth: np.ndarray, slack: float = 0.004) -> float:
    """The middle of the scores at which F1 is within ``slack`` of the best: wrong labels move the best one about in the gap between the classes."""
    order = np.argsort(-score, kind="stable")
    hits, taken = np.cumsum(truth[order]), np.arange(1, len(order) + 1)
    f1 = 2 * hits / (taken + truth.sum())
    good = score[order[f1 >= f1.max() - slack]]
    found = (good.min() + good.max()) / 2
    return float((found * truth.sum() + DEFAULT_CUT * PRIOR_LABELS) / (truth.sum() + PRIOR_LABELS))


def _in_slices(model: RatioModel, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE or i == len(texts) - 1:
            yield start, scores(model, texts[start : i + 1])
            start, size = i + 1, 0


def toxicity(documents: DataFrame, labels: DataFrame, *, most_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, source, score, toxic``: one row for each row of ``documents`` (``doc_id, text, source``).

    ``score``  largest difference of the toxic and the ordinary model's log-likelihood over the text's windows, divided by
               the window's width; 0 for a null, empty or blank text, and for all if the labels lack a class.
    ``toxic``  whether the score is above the cut found on the labelled sample; never without a model.

    ``labels`` has ``doc_id, toxic``; null labels don't count, and several of one document are averaged. Models are
    fitted on at most ``most_labelled`` documents a class; every document is scored over its whole text.
    """
    found = fit_models(labelled_sample(documents, labels, most_labelled))
    rows = documents.select("doc_id", "source", "text")
    if found is None:
        return rows.select("doc_id", "source", F.lit(0.0).alias("score"), F.lit(False).alias("toxic"))
    shared, cut = documents.sparkSession.sparkContext.broadcast(bytes(found["model"])), found["cut"]
    kinds = dict(documents.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = RatioModel.from_bytes(shared.value)
        for batch in batches:
            texts = [plain(t) if t else "" for t in batch.column(2).to_pylist()]
            score = np.concatenate([s for _, s in _in_slices(model, texts)] or [np.zeros(0)])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(score > cut)], names=["doc_id", "source", "score", "toxic"])

    return spread(rows).mapInArrow(run, f"doc_id {kinds['doc_id']}, source {kinds['source']}, score double, toxic boolean")


def source_rates(scored: DataFrame) -> DataFrame:
    """``source, n_documents, n_toxic, rate`` of every source; the null source has a row of its own."""
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if("toxic").alias("n_toxic"), F.avg(F.col("toxic").cast("double")).alias("rate"))
