"""Quality classifier on supervised subword embeddings.

A document is the average of the vectors of its hashed words and character n-grams; a softmax layer over that average
gives the score. Vectors and layer are learned together by stochastic gradient descent in numpy, on at most `max_rows`
labelled documents (a documented bound: the rows with the least hashes of their ids). Featurising runs in all tasks, the
descent in one. For scoring, the layer is folded into the vectors: one number per bucket, averaged over the document,
is the same score.

Defined results: null and empty texts score as the layer's bias alone; without labels of both classes every score is the
share of label 1 among the labels (0.5 without any); a null id is held out; an id labelled twice counts as the larger
label; rows repeated in `documents` are each scored, and a repeated id counts once in training, by its text of the least
hash; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import id_and_text, mixed, per_batch
from tallyward.llm.sampling import first_by_hash, fold, labelled_ids, one_text_each

SPACE = 32
#: Keeps the buckets of looks apart from those of words.
LOOKS = 1 << 62


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dims: int = 8
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 8.0
    max_rows: int = 6_000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """The folded classifier: a number per bucket and a bias."""

    weights: np.ndarray
    bias: float
    grams: tuple[int, ...]

    def score(self, text: str) -> float:
        ids = buckets_of(text, len(self.weights), self.grams)
        logit = self.bias + (float(self.weights[ids].mean()) if len(ids) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def buckets_of(text: str, buckets: int, grams: tuple[int, ...]) -> np.ndarray:
    """Buckets of every word, its n-grams with its edges, and its look (case of the first two letters, and
    whether it equals the word before, A-Z or not), in the whole text."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = (codes <= SPACE) | (codes == 0xA0)
    codes[space] = SPACE
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not len(starts):
        return np.empty(0, np.int64)
    number = np.cumsum(np.bincount(starts, minlength=len(codes)))  # of the word at each place, from 1
    place = np.arange(len(codes)) - starts[np.maximum(number - 1, 0)]
    letters = np.where(space, np.uint64(0), mixed(codes + (place.astype(np.uint64) << np.uint64(32))))
    words = mixed(np.add.reduceat(letters, starts))
    lower = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(lower) == len(codes):  # a few letters have a longer lower case; then only equal words count as repeated
        plain = np.add.reduceat(np.where(space, np.uint64(0), mixed(lower + (place.astype(np.uint64) << np.uint64(32)))), starts)
        upper = lower != codes
    else:
        plain, upper = words, (codes >= 65) & (codes <= 90)
    again = np.concatenate([[False], plain[1:] == plain[:-1]])
    look = upper[starts] * 4 + upper[np.minimum(starts + 1, len(codes) - 1)] * 2 + again
    found = [words, mixed(look.astype(np.uint64) + np.uint64(LOOKS))]
    keys = codes.copy()
    for n in range(2, max(grams) + 1):
        keys = keys[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in grams:
            inner = np.cumsum(np.concatenate([[0], space]))  # no white space but at the ends
            begin = np.arange(len(keys))
            whole = inner[begin + n - 1] == inner[begin + 1]
            found.append(mixed(keys[whole] + np.uint64(n)))
    return (np.concatenate(found) & np.uint64(buckets - 1)).astype(np.int64)


def _features(settings: Settings):
    """Label, buckets and their shares of each training text, as bytes."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, shares = [], []
        for text in batch.column(1).to_pylist():
            unique, counts = np.unique(buckets_of(text, settings.buckets, settings.grams), return_counts=True)
            ids.append(unique.astype(np.int32).tobytes())
            shares.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["doc_id", "label", "ids", "shares"])

    return per_batch(make)


def descend(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> tuple[np.ndarray, float]:
    """Learns vectors and layer; returns them folded: a number per bucket, and the bias."""
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1 / settings.dims, 1 / settings.dims, (settings.buckets, settings.dims)).astype(np.float32)
    layer, bias = np.zeros((settings.dims, 2), np.float32), np.zeros(2, np.float32)
    layer[:, 1] = random.uniform(-1, 1, settings.dims)
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for at in random.permutation(len(rows)):
            label, ids, shares = rows[at]
            rate = np.float32(settings.rate * (1 - done / steps))
            done += 1
            own = vectors[ids]
            hidden = shares @ own
            logits = hidden @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= np.float32(0.1) * rate * np.outer(hidden, error)
            bias -= np.float32(0.1) * rate * error
            vectors[ids] = own - rate * np.outer(shares, back)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _views(column: pa.BinaryArray, kind: type) -> Iterator[np.ndarray]:
    """The numbers of each row where Arrow holds them, without a copy as Python objects."""
    if len(column):
        wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        _, ends, held = column.buffers()
        ends, held = np.frombuffer(ends, wide)[column.offset :], np.frombuffer(held or b"", np.uint8)
        for i in range(len(column)):
            yield held[ends[i] : ends[i + 1]].view(kind)


def _learn(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            ids, shares = _views(batch.column(2), np.int32), _views(batch.column(3), np.float32)
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ids, shares, strict=True)
        rows = [row[1:] for row in sorted(rows, key=lambda row: (row[0], len(row[2])))]
        share = sum(label for label, _, _ in rows) / len(rows) if rows else 0.5
        if share in (0, 1) or not rows:
            weights, bias = np.zeros(settings.buckets, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        else:
            weights, bias = descend(rows, settings)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learns from labelled documents outside fold 0."""
    chosen = F.broadcast(first_by_hash(labelled_ids(labels, label), settings.max_rows))  # at most max_rows ids
    rows = id_and_text(docs, doc_id, text).filter(fold() != 0).join(chosen, "doc_id").select("doc_id", "text", "label")
    features = one_text_each(rows, "label").mapInArrow(_features(settings), "doc_id long, label int, ids binary, shares binary")
    weights, bias = features.repartition(1).mapInArrow(_learn(settings), "weights binary, bias double").first()
    return Model(np.frombuffer(weights, np.float32), bias, settings.grams)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of each document; 1 is predicted from `threshold` on."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, "quality", settings, doc_id, text))
    rows = id_and_text(docs, doc_id, text).withColumn("held_out", fold() == 0)
    scored = rows.mapInArrow(_only_scores(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _only_scores(model):
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [model.value.score(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    return per_batch(make)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that score at least `threshold`, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, "quality", settings, doc_id, text))
    at = docs.columns.index(text)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([model.value.score(t or "") >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(per_batch(make), docs.schema)
