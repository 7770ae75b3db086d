"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words and word beginnings of a text is learned from texts confirmed as toxic and from unlabelled ones.
With the class prior p, losses L+ and L- of calling a text toxic and clean, the risk is
p * mean of L+ over the positives + max(0, mean of L- over the unlabelled - p * mean of L- over the positives); while
the second part is negative, the step goes against it, so that the classifier cannot fit the unlabelled texts below
zero risk. The prior is the share of toxic labels among the labelled training rows. Features are the words that are
significantly more frequent among the positives, and small weights are drawn to zero after each step, so chance words do
not add up in long texts.

The positives and the unlabelled rows are at most `max_rows` each (documented bounds: the least hashes of the ids);
words are read, counted and chosen in all tasks, the descent runs in one, over the chosen ones. All rows are scored, by their whole texts.

Defined results: null and empty texts score as the bias alone; without positives every score is 0, and without telling words it is the prior; an id labelled twice
counts as the larger label; a null id is held out; repeated rows are each scored, and a repeated id counts once in training, by
its text of the least hash; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import id_and_text, per_batch, stored
from tallyward.llm.sampling import first_by_hash, fold, labelled_ids, one_text_each

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
CLEAN_BIAS = -30.0


@dataclass(frozen=True)
class Settings:
    max_rows: int = 4_000
    min_texts: int = 5
    enriched: float = 3.0
    deviations: float = 5.0
    steps: int = 400
    shrink: float = 0.0002


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        logit = self.bias + sum(self.weights.get(w, 0.0) for w in distinct_words(text))
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def distinct_words(text: str) -> set[str]:
    """The runs of letters of the whole text, in lower case, and the beginnings of the longer ones, marked with `*`."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


def descend(texts: list[list[str]], positive: np.ndarray, prior: float, settings: Settings) -> tuple[dict[str, float], float]:
    """Weights of words and the bias. `positive` marks the confirmed texts; the others are unlabelled."""
    in_p = Counter(w for words, confirmed in zip(texts, positive, strict=True) if confirmed for w in words)
    in_u = Counter(w for words, confirmed in zip(texts, positive, strict=True) if not confirmed for w in words)
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    least = _least(prior, settings)

    def telling(word: str) -> bool:
        """Far more frequent among the positives than chance allows."""
        p, u, both = in_p[word] / n_p, in_u[word] / n_u, (in_p[word] + in_u[word]) / (n_p + n_u)
        return p >= least * u and p - u >= settings.deviations * np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))

    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in in_p.items() if n >= settings.min_texts and telling(w)))}
    if not vocabulary:
        return {}, float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9)))
    rows, columns = [], []
    for i, words in enumerate(texts):
        own = [vocabulary[w] for w in words if w in vocabulary]
        rows += [i] * len(own)
        columns += own
    rows, columns = np.array(rows, np.int64), np.array(columns, np.int64)
    share_p, share_u = positive / max(1, positive.sum()), ~positive / max(1, (~positive).sum())
    size = len(vocabulary)
    spread = np.ones(size)  # power iteration: the largest curvature bounds the step
    both = share_u + prior * share_p
    for _ in range(8):
        spread /= np.linalg.norm(spread) or 1.0
        spread = np.bincount(columns, (both * np.bincount(rows, spread[columns], len(texts)))[rows], size)
    rate = 4 / (np.linalg.norm(spread) + 1)
    weights, bias, ahead, bias_ahead, pace = np.zeros(size), 0.0, np.zeros(size), 0.0, 1.0
    for _ in range(settings.steps):
        logits = np.bincount(rows, ahead[columns], len(texts)) + bias_ahead
        toxic = 1 / (1 + np.exp(-np.clip(logits, -50, 50)))
        as_clean = np.logaddexp(0, logits)
        rest = share_u @ as_clean - prior * (share_p @ as_clean)
        back = (share_u - prior * share_p) * toxic
        back = prior * share_p * (toxic - 1) + back if rest >= 0 else -back
        moved = ahead - rate * np.bincount(columns, back[rows], size)
        moved = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * settings.shrink)
        bias_moved, paced = bias_ahead - rate * back.sum(), (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, bias_ahead = moved + (pace - 1) / paced * (moved - weights), bias_moved + (pace - 1) / paced * (bias_moved - bias)
        weights, bias, pace = moved, bias_moved, paced
    return {w: float(weights[i]) for w, i in vocabulary.items() if weights[i]}, float(bias)


def _words():
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [sorted(distinct_words(t)) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(words, pa.list_(pa.string()))], ["doc_id", "part", "words"])

    return per_batch(make)


def _learn(prior: float, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        positive = np.array([part == 1 for _, part, _ in rows], bool)
        weights, bias = descend([words for *_, words in rows], positive, prior, settings) if positive.any() else ({}, CLEAN_BIAS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(weights)], pa.list_(pa.string())), pa.array([list(weights.values())], pa.list_(pa.float64())), pa.array([bias])], ["words", "weights", "bias"]
        )

    return run


def _telling_only(words: DataFrame, prior: float, settings: Settings) -> DataFrame:
    """The rows with only those of their words that `descend` will choose, so that its one task does not hold the words of
    long texts. They are counted in all tasks, by the same rule but for a rounding error."""
    n = words.agg(F.coalesce(F.sum("part"), F.lit(0)).alias("p"), F.count("*").alias("all")).first()
    n_p, n_u = max(1, n.p), max(1, n["all"] - n.p)
    p, u, both = F.col("in_p") / n_p, F.col("in_u") / n_u, (F.col("in_p") + F.col("in_u")) / (n_p + n_u)
    chance = settings.deviations * F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    single = words.select("doc_id", "part", F.explode("words").alias("word"))
    counts = single.groupBy("word").agg(F.sum("part").alias("in_p"), (F.count("*") - F.sum("part")).alias("in_u"))
    telling = counts.filter((F.col("in_p") >= settings.min_texts) & (p * (1 + 1e-9) >= _least(prior, settings) * u) & (p - u + 1e-9 >= chance)).select("word")
    kept = single.join(telling, "word").groupBy("doc_id").agg(F.collect_list("word").alias("kept"))
    empty = F.array().cast("array<string>")
    return words.select("doc_id", "part").join(kept, "doc_id", "left").select("doc_id", "part", F.coalesce("kept", empty).alias("words"))


def _least(prior: float, settings: Settings) -> float:
    return min(settings.enriched, (1 + 1 / max(prior, 1e-6)) / 2)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learns from labelled positives and unlabelled documents outside fold 0."""
    rows = id_and_text(docs, doc_id, text).filter(fold() != 0)
    known = labelled_ids(labels, label)
    prior = known.agg(F.avg("label")).first()[0] or 0.0
    positives = first_by_hash(known.filter("label = 1").select("doc_id"), settings.max_rows).select("doc_id", F.lit(1).alias("part"))
    others = first_by_hash(rows.select("doc_id").distinct(), settings.max_rows).select("doc_id", F.lit(0).alias("part"))
    chosen = F.broadcast(positives.unionByName(others))  # at most twice max_rows ids
    words = stored(one_text_each(rows.join(chosen, "doc_id"), "part").mapInArrow(_words(), "doc_id long, part int, words array<string>"))
    learned = _telling_only(words, prior, settings).repartition(1).mapInArrow(_learn(prior, settings), "words array<string>, weights array<double>, bias double").first()
    return Model(dict(zip(learned.words, learned.weights, strict=True)), learned.bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of each document; 1 is predicted from `threshold` on."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, "toxic", settings, doc_id, text))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [model.value.score(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = id_and_text(docs, doc_id, text).withColumn("held_out", fold() == 0)
    scored = rows.mapInArrow(per_batch(make), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
