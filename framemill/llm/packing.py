"""Filling of fixed-capacity containers with whole texts, by lexical retrieval.

Texts are dealt into shards of bounded size whose texts are lexically alike: by clusters of their BM25 vectors, which are
fitted on a bounded sample, a large cluster being cut along its texts' most telling term. Each shard has a BM25 inverted
index over token ids, with the whole corpus's frequencies. The largest unused text seeds a container; the index returns
its unused neighbours, best score first, and they fill the container as they fit; what room no neighbour can take goes to
the largest text that fits. Containers that stay notably empty and that some other text could fill are opened again and
packed anew together with those of other shards, in groups of bounded size.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.llm.tokens import TOKENIZERS, VOCABULARY, _encoder, slices, vocabulary_file
from framemill.operators.places import places
from framemill.session import cut_lineage, small_side, spread

#: Texts that one index holds at most.
SHARD_ITEMS = 16_000
#: Texts that a cluster should have, and clusters at most.
CLUSTER_ITEMS, MAX_CLUSTERS = 6_000, 512
#: Texts that clusters are fitted on, at most: those with the smallest hashes; terms that count for it, the most frequent ones.
SAMPLE_ITEMS, CLUSTER_TERMS = 6_000, 12_000
#: Rounds of the fit.
FIT_ROUNDS = 8
#: A container with a larger share of unused room is opened again and packed with those of other shards.
REOPEN = 0.01
#: Rounds of opening at most; none follows one that left more than this share of the texts it had opened for another.
REOPEN_ROUNDS, WORTHWHILE = 4, 0.75
#: A neighbour by score should take at least this share of the room left, so that small texts remain for the last gaps.
LEAST_SHARE = 0.25
#: A term of at least this share of a shard's texts has its weights as a row of them all.
DENSE_SHARE = 1 / 16
# The usual BM25 parameters.
K1, B = 1.2, 0.75

_ITEM = "doc_id bigint, piece int, start_token bigint, n_tokens bigint, terms array<int>, counts array<int>"
_PLACED = "container_id string, position int, doc_id bigint, piece int, start_token bigint, n_tokens bigint, terms array<int>, counts array<int>, gap bigint, name string"
_RESULT = ["container_id", "position", "doc_id", "piece", "start_token", "n_tokens"]


@dataclass(frozen=True)
class Corpus:
    """What BM25 has to know of all texts: their number, mean size and the number of texts that each term is in."""

    n: int
    mean: float
    frequency: np.ndarray

    def weights(self, term: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Weight of each posting, given its term, its count in the text and that text's size."""
        f = self.frequency[term]
        idf = np.log1p((self.n - f + 0.5) / (f + 0.5))
        return idf * count * (K1 + 1) / (count + K1 * (1 - B + B * size / max(self.mean, 1.0)))


def containers(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048, shard_items: int = SHARD_ITEMS, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``container_id, position, doc_id, piece, start_token, n_tokens``: the place of every text.

    Only a text of more than ``capacity`` tokens is split: into full containers and a last piece, which is packed like
    any text. ``container_id`` names the first text in it (``<doc_id>:<piece>``, with ``:full`` where that piece fills it),
    ``position`` is the order in it.
    Null and empty texts need no room: they have one row with container_id and position null and 0 tokens. Every row is an
    item of its own: repeated and null ids too, whose containers are told apart by ``#2`` and so on. Ids are BIGINTs.
    Which texts share a container depends on the ids and texts alone. No task holds more than about ``shard_items`` texts.
    """
    items = _named(cut_lineage(_items(documents, id_column, text_column, capacity, folder, vocabulary)))
    full = F.col("n_tokens") == capacity
    alone = items.filter(full).select(F.concat("name", F.lit(":full")).alias("container_id"), F.lit(0).alias("position"), *_RESULT[2:])
    none = items.filter("n_tokens = 0").select(F.lit(None).cast("string").alias("container_id"), F.lit(None).cast("int").alias("position"), *_RESULT[2:])
    rest = items.filter(~full & (F.col("n_tokens") > 0))
    done = [alone, none]
    corpus = _corpus(rest)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(corpus)  # a number for each term of the vocabulary
    rest, n = _sharded(rest, shared, shard_items), corpus.n
    for rounds_left in range(REOPEN_ROUNDS, -1, -1):
        last = n <= shard_items or not rounds_left
        placed = rest.groupBy("shard").applyInArrow(_packer(capacity, shared), _PLACED)
        if last:
            done.append(placed.select(*_RESULT))
            break
        placed = cut_lineage(placed)
        # A container can only become fuller if some text of another one fits into its gap.
        wide = F.col("gap") > REOPEN * capacity
        smallest = placed.filter(wide).agg(F.min("n_tokens")).first()[0]
        opened = wide & (F.col("gap") >= F.lit(smallest)) if smallest is not None else F.lit(False)
        again = placed.filter(opened).count()
        if not again or (rounds_left < REOPEN_ROUNDS and again > WORTHWHILE * n):
            done.append(placed.select(*_RESULT))
            break
        done.append(placed.filter(~opened).select(*_RESULT))
        n = again
        rest = placed.filter(opened).select(*_ITEM_COLUMNS, F.pmod(F.xxhash64("container_id"), F.lit(-(-n // shard_items))).alias("shard"))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


_ITEM_COLUMNS = ["doc_id", "piece", "start_token", "n_tokens", "terms", "counts", "name"]


def _named(items: DataFrame) -> DataFrame:
    """``items`` with ``name``: ``<doc_id>:<piece>``, and ``#2`` and so on where several have it."""
    key = ["doc_id", "piece"]
    plain = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("piece").cast("string"))
    repeated = items.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("__d"), F.col("piece").alias("__p"))
    n = repeated.count()
    if not n:
        return items.withColumn("name", plain)
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("piece") == F.col("__p"))
    once = items.join(small_side(repeated, n), same, "left_anti").withColumn("name", plain)
    # One id may have a large part of all rows, null for instance; its rows are numbered over many partitions.
    more = items.join(small_side(repeated, n), same, "left_semi").withColumn("__digest", F.xxhash64("start_token", "n_tokens", "terms", "counts"))
    more = places(more, key, ["__digest"]).withColumn("name", F.when(F.col("place") > 0, F.concat(plain, F.lit("#"), (F.col("place") + 1).cast("string"))).otherwise(plain))
    return cut_lineage(once.unionByName(more.select(*once.columns)))


def _corpus(items: DataFrame) -> Corpus:
    """Frequencies of all texts' terms, counted within batches first; one row a term of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(total))
            found[: len(total)] += total
            total = found
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "n"])

    sizes = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("n_tokens"), F.lit(0.0)).alias("mean")).first()
    rows = items.select("terms").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term = rows["term"].to_numpy()
    frequency = np.zeros(int(term.max()) + 1 if len(term) else 1, np.int64)
    frequency[term] = rows["n"].to_numpy()
    return Corpus(sizes["n"], sizes["mean"], frequency)


def _sharded(items: DataFrame, corpus: object, shard_items: int) -> DataFrame:
    """``items`` with ``shard``, of which none has more than ``shard_items``: one a cluster, more where it is larger."""
    n = corpus.value.n
    k = min(MAX_CLUSTERS, -(-n // min(CLUSTER_ITEMS, shard_items)))
    if n <= shard_items:
        return items.withColumn("shard", F.lit("0"))
    sample = items.select("n_tokens", "terms", "counts", F.xxhash64("terms", "counts", "name").alias("h")).orderBy("h").limit(SAMPLE_ITEMS)
    fitted = sample.repartition(1).mapInArrow(_fitter(corpus, k), "model binary").first()
    shared = items.sparkSession.sparkContext.broadcast(bytes(fitted["model"]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters = Clusters.from_bytes(shared.value)
        for batch in batches:
            of, term, weight = _vectors(batch.column("terms"), batch.column("counts"), batch.column("n_tokens"), corpus.value)
            # The most telling term that a shard may be cut along: heavy, but not so rare that hardly a text shares it.
            common = corpus.value.frequency[term] * shard_items > corpus.value.n
            telling = _heaviest(of, term, np.where(common, weight, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(clusters.nearest(of, term, weight)), pa.array(telling)], names=[*batch.schema.names, "cluster", "telling"])

    columns = ", ".join(f"{c} {t}" for c, t in items.dtypes)
    assigned = cut_lineage(items.mapInArrow(assign, f"{columns}, cluster bigint, telling bigint"))
    large = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_items).select("cluster").collect()  # a row a cluster
    large = [r["cluster"] for r in large]
    whole = assigned.filter(~F.col("cluster").isin(large)).withColumn("shard", F.col("cluster").cast("string"))
    if large:
        cut = assigned.filter(F.col("cluster").isin(large)).withColumn("__digest", F.xxhash64("terms", "counts", "name"))
        cut = places(cut, ["cluster"], ["telling", "__digest", "name"])
        shard: Column = F.concat_ws(".", F.col("cluster").cast("string"), F.floor(F.col("place") / shard_items).cast("string"))
        whole = whole.unionByName(cut.withColumn("shard", shard).select(*whole.columns))
    return whole.drop("cluster", "telling")


def _vectors(terms: pa.ListArray, counts: pa.ListArray, sizes: pa.Array, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first posting of each text, then of none; term and BM25 weight of each posting)."""
    length = np.diff(terms.offsets.to_numpy())
    of = np.append(0, np.cumsum(length))
    term, count = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.float64)
    return of, term, corpus.weights(term, count, np.repeat(sizes.to_numpy(), length))


def _heaviest(of: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The term of the largest weight of each text (none is without terms)."""
    best = np.maximum.reduceat(weight, of[:-1])
    hit = np.flatnonzero(weight == np.repeat(best, np.diff(of)))
    return term[hit[np.searchsorted(hit, of[:-1])]].astype(np.int64)


class Clusters:
    """Centres of texts' BM25 vectors; a text belongs to the one whose direction is nearest."""

    def __init__(self, column: np.ndarray, centres: np.ndarray):
        self.column, self.centres = column, centres.astype(np.float32)  # column of each term, -1 for none; terms x centres

    def likeness(self, of: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        column = np.where(term < len(self.column), self.column[np.minimum(term, len(self.column) - 1)], -1)
        out = np.zeros((len(of) - 1, self.centres.shape[1]), np.float32)
        for i, (a, b) in enumerate(zip(of[:-1], of[1:], strict=True)):
            known = column[a:b] >= 0
            out[i] = weight[a:b][known].astype(np.float32) @ self.centres[column[a:b][known]]
        return out

    def nearest(self, of: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return self.likeness(of, term, weight).argmax(1).astype(np.int64)

    @staticmethod
    def fit(of: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int) -> Clusters:
        """``k`` centres by rounds of assignment and means, first of texts spread evenly over the sample, whose order is to be at random."""
        n = len(of) - 1
        k = min(k, n)
        frequency = np.bincount(term)
        often = np.argsort(-frequency, kind="stable")[:CLUSTER_TERMS]
        column = np.full(len(frequency), -1)
        column[often[frequency[often] > 0]] = np.arange((frequency[often] > 0).sum())
        text = np.repeat(np.arange(n), np.diff(of))
        unit = weight / np.sqrt(np.bincount(text, weight**2, minlength=n))[text]
        known = column[term] >= 0
        text, at, unit_known = text[known], column[term[known]], unit[known]
        label = np.full(n, -1)
        label[np.arange(k) * n // k] = np.arange(k)
        clusters = Clusters(column, np.zeros((0, k)))
        for _ in range(FIT_ROUNDS):
            mine = label[text] >= 0
            sums = np.bincount(at[mine] * k + label[text[mine]], unit_known[mine], minlength=(column.max() + 1) * k).reshape(-1, k)
            clusters = Clusters(column, sums / np.maximum(np.sqrt((sums**2).sum(0)), 1e-9))
            label = clusters.nearest(of, term, unit)
        return clusters

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, column=self.column.astype(np.int32), centres=self.centres.astype(np.float16))
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Clusters:
        x = np.load(io.BytesIO(data))
        return Clusters(x["column"], x["centres"])


def _fitter(corpus: object, k: int) -> Callable:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by("h").combine_chunks()
        of, term, weight = _vectors(rows["terms"].chunk(0), rows["counts"].chunk(0), rows["n_tokens"].combine_chunks(), corpus.value)
        yield pa.record_batch([pa.array([Clusters.fit(of, term, weight, k).to_bytes()], pa.binary())], names=["model"])

    return fit


def _items(documents: DataFrame, id_column: str, text_column: str, capacity: int, folder: str, vocabulary: str) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; those below it with their distinct terms and counts."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary_file(folder, vocabulary))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for start, texts in slices(batch.column(1).to_pylist()):
                ids, offsets = encoder.encode(texts)
                doc, piece, begin, size, terms, counts = [], [], [], [], [], []
                for k in range(len(texts)):
                    n = int(offsets[k + 1] - offsets[k])
                    for i in range(max(1, -(-n // capacity))):
                        part = ids[offsets[k] + i * capacity : min(offsets[k] + (i + 1) * capacity, offsets[k + 1])]
                        t, c = np.unique(part, return_counts=True) if len(part) < capacity else (part[:0], part[:0])
                        doc.append(doc_ids[start + k])
                        piece.append(i)
                        begin.append(i * capacity)
                        size.append(len(part))
                        terms.append(t)
                        counts.append(c)
                yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(size, pa.int64()), _lists(terms), _lists(counts)], names=["doc_id", "piece", "start_token", "n_tokens", "terms", "counts"])

    rows = documents.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("binary").alias("text_bytes"))
    return spread(rows).mapInArrow(measure, _ITEM)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


class InvertedIndex:
    """BM25 over token ids: postings by term, each with its ready weight, under the frequencies of ``corpus`` (its own if None)."""

    def __init__(self, terms: pa.ListArray, counts: pa.ListArray, sizes: np.ndarray, corpus: Corpus | None = None):
        self.n = len(sizes)
        self.of = np.append(0, np.cumsum(np.diff(terms.offsets.to_numpy().astype(np.int64))))
        flat = terms.flatten().to_numpy()
        count = counts.flatten().to_numpy().astype(np.float64)
        item = np.repeat(np.arange(self.n), np.diff(self.of))
        kinds, self.term = np.unique(flat, return_inverse=True)
        frequency = np.bincount(self.term, minlength=len(kinds))
        corpus_of_own = Corpus(self.n, float(sizes.mean()) if self.n else 0.0, frequency)
        weight = corpus_of_own.weights(self.term, count, sizes[item]) if corpus is None else corpus.weights(flat, count, sizes[item])
        order = np.argsort(self.term, kind="stable")
        self.items, self.weights = item[order], weight[order].astype(np.float32)
        self.first = np.append(0, np.cumsum(frequency))
        # Frequent terms, which have most of the postings, as rows over all items.
        often = np.flatnonzero(frequency >= max(DENSE_SHARE * self.n, 2))
        self.row = np.full(len(kinds), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.n), np.float32)
        for r, t in enumerate(often):
            self.dense[r, self.items[self.first[t] : self.first[t + 1]]] = self.weights[self.first[t] : self.first[t + 1]]

    def scores(self, seed: int) -> np.ndarray:
        """Score of every item for the seed's terms."""
        own = self.term[self.of[seed] : self.of[seed + 1]]
        rows = self.row[own]
        out = self.dense[rows[rows >= 0]].sum(0) if (rows >= 0).any() else np.zeros(self.n, np.float32)
        for t in own[rows < 0].tolist():
            a, b = self.first[t], self.first[t + 1]
            if b - a > 1:  # a term that only the seed has finds nothing else
                out[self.items[a:b]] += self.weights[a:b]
        return out


def fill(sizes: np.ndarray, index: InvertedIndex, capacity: int) -> list[list[int]]:
    """Item numbers of each container; items come sorted by size, largest first."""
    n = len(sizes)
    unused = np.ones(n, bool)
    out = []
    for seed in range(n):
        if not unused[seed]:
            continue
        unused[seed] = False
        held, room = [seed], capacity - int(sizes[seed])
        score: np.ndarray | None = None
        while room > 0:
            first = int(np.searchsorted(-sizes, -room))  # items from here on fit
            fitting = np.flatnonzero(unused[first:]) + first
            if not len(fitting):
                break
            score = index.scores(seed) if score is None else score
            wanted = fitting[: int(np.searchsorted(-sizes[fitting], -LEAST_SHARE * room, side="right"))]
            best = wanted[np.argmax(score[wanted])] if len(wanted) else None
            take = int(best) if best is not None and score[best] > 0 else int(fitting[0])
            unused[take] = False
            held.append(take)
            room -= int(sizes[take])
        out.append(held)
    return out


def _packer(capacity: int, corpus: object) -> Callable:
    def pack(table: pa.Table) -> pa.Table:
        return _pack_shard(table, capacity, corpus.value)

    return pack


def _pack_shard(table: pa.Table, capacity: int, corpus: Corpus) -> pa.Table:
    table = table.combine_chunks()
    table = table.append_column("first_term", pc.list_element(table["terms"], 0))
    table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("first_term", "ascending"), ("name", "ascending")]).combine_chunks()
    sizes = table["n_tokens"].to_numpy()
    held = fill(sizes, InvertedIndex(table["terms"].chunk(0), table["counts"].chunk(0), sizes, corpus), capacity)
    names = table["name"].to_pylist()
    gap = [capacity - int(sizes[c].sum()) for c in held]
    out = table.take(pa.array([i for c in held for i in c]))
    wide = pa.array([g > REOPEN * capacity for g, c in zip(gap, held, strict=True) for _ in c])
    lists = [pc.if_else(wide, out[c].combine_chunks(), pa.scalar(None, out.schema.field(c).type)) for c in ("terms", "counts")]  # of use only if opened again
    columns = [pa.array([names[c[0]] for c in held for _ in c], pa.string()), pa.array([k for c in held for k in range(len(c))], pa.int32()), out["doc_id"], out["piece"], out["start_token"], out["n_tokens"], *lists, pa.array([g for g, c in zip(gap, held, strict=True) for _ in c], pa.int64()), out["name"]]
    return pa.table(columns, names=["container_id", "position", "doc_id", "piece", "start_token", "n_tokens", "terms", "counts", "gap", "name"])
