"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, hashed to ``2 ** BITS`` features. Its score is the logistic of a bias, a weight for each
term, and the inner products of the factor vectors of each two terms: so two terms may mean together what neither
means alone, as an insult beside the mention of a group, at a cost that is linear in the terms. The machine is fitted by
AdaGrad on a bounded sample of the labelled documents (``FIT_ROWS``, those of the least hashes of their ids), in one task,
as the sample is bounded. Terms take part if they stand in ``LEAST_DOCS`` sampled documents and their toxic ones are
``LEAST_Z`` standard deviations from what chance would give them; the thousands of others would only add noise to long
texts. A term that counts only beside another still stands out by itself, as those texts are toxic. All documents are then
scored in one pass against the broadcast model, whose size is fixed by ``BITS``. Only texts are read for a score.

Labels of documents that are held out are never learned from: those of which ``crc32(doc_id as text) % FOLDS`` is 0.

Edge cases: a null text, like an empty one, has no terms and the score of the bias alone; a null id is held out and has
no label; a null label is none, any number but 0 is toxic, and of several labels of one id the greatest counts; of several
texts of one id the one with the least hash is learned from; very long texts count whole, each term once; repeated rows
get equal scores; without any labelled document every score is that of ``PRIOR``; an empty table gives an empty result;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm._stage import staged
from lociflow.llm._text import in_batches, require, small_batches, term_bytes

#: Features as a power of two, and factors of each.
BITS, FACTORS = 18, 8
#: Labelled documents that the machine is fitted on, about.
FIT_ROWS = 20_000
FOLDS = 5
LEAST_DOCS, LEAST_Z = 3, 5.0
EPOCHS, BATCH, RATE, FACTOR_RATE, SHRINK, FACTOR_SHRINK, SPREAD = 15, 64, 0.2, 0.05, 1e-3, 2e-2, 0.02
#: Toxic and all documents that are taken as seen before the first label.
PRIOR = (1, 10)


class TermIds(dict):
    """Term to its feature; forgets when it has grown to a fixed number of terms."""

    MOST = 200_000

    def __init__(self, bits: int) -> None:
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, term: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = self[term] = xxhash.xxh3_64_intdigest(term) & self.mask
        return h

    def of(self, text: bytes) -> np.ndarray:
        """The features of a text, each once."""
        terms = set(term_bytes(text))
        return np.unique(np.fromiter(map(self.__getitem__, terms), np.int32, len(terms)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * z)


@dataclass
class Machine:
    """bias, weight[feature] and factor[feature, f]; the last feature is none, with zeros throughout. ``place`` has the
    row of each hashed feature, that of none where it has no weight."""

    bits: int
    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of documents as arrays of places: logits, sums of factors, all places and where each document starts."""
        none = np.array([len(self.weight) - 1], np.int32)
        size = np.array([len(r) + 1 for r in rows])
        ids = np.concatenate([x for r in rows for x in (r, none)])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        v = self.factor[ids]
        sums = np.add.reduceat(v, start, axis=0)
        own = np.add.reduceat((v * v).sum(axis=1), start)
        return self.bias + np.add.reduceat(self.weight[ids], start) + 0.5 * ((sums * sums).sum(axis=1) - own), sums, ids, start

    def score(self, features: list[np.ndarray]) -> np.ndarray:
        """The probability of each document, given by its hashed features. Sums run in an order that a document alone
        decides, so equal texts have equal scores."""
        if not features:
            return np.zeros(0)
        z = self.raw([self.place[f] for f in features])[0]
        return np.clip(_sigmoid(z), 0.0, 1.0)


def fit_rows(
    features: list[np.ndarray], toxic: np.ndarray, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS,
    seed: int = 12
) -> Machine:
    """Fits a machine on documents given by their hashed features."""
    n = len(features)
    p = (toxic.sum() + PRIOR[0]) / (n + PRIOR[1])
    flat = np.concatenate([*features, np.zeros(0, np.int32)])
    docs = np.bincount(flat, minlength=1 << bits)
    bad = np.bincount(flat, np.repeat(toxic, [len(f) for f in features]), minlength=1 << bits)
    rate = toxic.mean() if n else 0.0
    used = np.flatnonzero((docs >= LEAST_DOCS) & (np.abs(bad - docs * rate) >= LEAST_Z * np.sqrt(docs * rate * (1 - rate))) & (0 < rate < 1))
    m = len(used)
    place = np.full(1 << bits, m, np.int32)
    place[used] = np.arange(m)
    rng = np.random.default_rng(seed)
    model = Machine(
        bits, place, float(np.log(p / (1 - p))), np.zeros(m + 1), rng.normal(0, SPREAD, (m + 1, factors))
    )
    model.factor[m] = 0
    rows = [place[f] for f in features]
    rows = [r[r < m] for r in rows]
    seen_w, seen_v, seen_b = np.full(m + 1, 1e-2), np.full((m + 1, factors), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            at = order[i : i + BATCH]
            z, sums, ids, start = model.raw([rows[k] for k in at])
            g = _sigmoid(z) - toxic[at]
            size = np.diff(np.append(start, len(ids)))
            own, inverse = np.unique(ids, return_inverse=True)
            each = np.repeat(g, size)
            gw = np.bincount(inverse, each)
            v = model.factor[own]
            gv = np.stack(
                [np.bincount(inverse, each * np.repeat(sums[:, f], size)) for f in range(factors)], axis=1
            ) - gw[:, None] * v
            real = own < m
            own, gw, gv, v = own[real], gw[real], gv[real], v[real]
            gw = gw + SHRINK * model.weight[own]
            gv = gv + FACTOR_SHRINK * v
            seen_w[own] += gw * gw
            seen_v[own] += gv * gv
            seen_b += g.sum() ** 2
            model.weight[own] -= RATE * gw / np.sqrt(seen_w[own])
            model.factor[own] -= FACTOR_RATE * gv / np.sqrt(seen_v[own])
            model.bias -= RATE * float(g.sum() / np.sqrt(seen_b))
    return model


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def _features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    get = TermIds(bits)
    for part, texts in small_batches(batches):
        rows = [get.of(t) for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0), part.column(1), part.column(2),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)])))
            ],
            ["doc_id", "toxic", "h", "features"]
        )


def sample(docs: DataFrame, labels: DataFrame, fit_rows_: int = FIT_ROWS, bits: int = BITS) -> DataFrame:
    """doc_id, toxic, features of about ``fit_rows_`` labelled documents that are not held out, an id each once."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") != 0).cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = staged(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")
    share = min(1.0, fit_rows_ / max(1, known.count()))
    # So many hashes of ids are so small: the rows that pass are bounded, and are sent to every task.
    few = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 33) < int(share * (1 << 31)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")
    found = rows.select("doc_id", "toxic", F.xxhash64("text").alias("h"), "text").transform(
        in_batches, lambda it: _features(it, bits), "doc_id long, toxic int, h long, features array<int>"
    )
    one = found.groupBy("doc_id").agg(F.min(F.struct("h", "toxic", "features")).alias("x"))
    return one.select("doc_id", "x.toxic", "x.features")


def fit(
    docs: DataFrame, labels: DataFrame, fit_rows_: int = FIT_ROWS, bits: int = BITS, factors: int = FACTORS,
    epochs: int = EPOCHS, seed: int = 12
) -> Machine:
    """The machine fitted on a sample of the labelled documents that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, toxic = [], []
        for b in batches:
            toxic += b.column(0).to_pylist()
            features += [np.array(x, np.int32) for x in b.column(1).to_pylist()]
        model = fit_rows(features, np.array(toxic, np.float64), bits, factors, epochs, seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    rows = staged(sample(docs, labels, fit_rows_, bits), "fitted")
    one = rows.repartition(1).sortWithinPartitions("doc_id").select("toxic", "features")
    made = one.transform(in_batches, run, "model binary").first()
    return pickle.loads(made.model) if made else fit_rows([], np.zeros(0), bits, factors, 0, seed)


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 where score is 0.5 or more) of every document."""
    require(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = shared.value
        get = TermIds(machine.bits)
        for part, texts in small_batches(batches):
            p = machine.score([get.of(t) for t in texts])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p)], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").transform(
        in_batches, run, f"doc_id {kind}, held_out boolean, score double"
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """Fits on the labels that are not held out and scores every document."""
    return score(docs, fit(docs, labels, **fitting))
