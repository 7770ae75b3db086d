import zlib

import numpy as np
import pytest

from tallyward.llm import quality, toxicity
from tallyward.llm.queries import QUERIES


def area(scores, labels):
    """Share of (positive, negative) pairs in the right order."""
    scores, labels = np.array(scores), np.array(labels)
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()) if len(pos) and len(neg) else 1.0


@pytest.fixture(scope="module")
def truth(spark):
    return {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}


@pytest.mark.parametrize("name, label, least", [("op1_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_rows(spark, truth, name, label, least):
    rows = QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= (0.3 if name == "op1_quality" else 0.5)) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert area([r.score for r in held], [truth[r.doc_id][label] for r in held]) > least
    caught = [r for r in held if truth[r.doc_id][label] == (0 if label == "quality" else 1)]
    assert np.mean([r.predicted == (label == "toxic") for r in caught]) >= 0.9
    clean = [r for r in held if truth[r.doc_id][label] == (1 if label == "quality" else 0)]
    assert np.mean([r.predicted == (label == "quality") for r in clean]) > 0.95


def test_held_out_labels_are_never_read(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - quality, quality) AS quality", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        assert sorted(map(tuple, scores(docs, labels).collect())) == sorted(map(tuple, scores(docs, flipped).collect()))


def test_folding_the_layer_keeps_the_score():
    settings = quality.Settings(buckets=256, epochs=2)
    texts = [("good plain words here", 1), ("BAD!! BAD!! WORDS!!", 0)] * 4
    rows = []
    for text, label in texts:
        ids, counts = np.unique(quality.buckets_of(text, 256, settings.grams), return_counts=True)
        rows.append((label, ids.astype(np.int32), (counts / counts.sum()).astype(np.float32)))
    model = quality.Model(*quality.descend(rows, settings), settings.grams)
    assert model.score("good plain words here") > 0.5 > model.score("BAD!! BAD!! WORDS!!")


def test_buckets_read_the_whole_text():
    one, two = (quality.buckets_of(t, 1 << 17, (3, 4)) for t in ("a " * 50_000 + "end", "a " * 50_000 + "fin"))
    assert len(one) == len(two) and (one != two).any()
    assert len(quality.buckets_of("", 1 << 17, (3, 4))) == len(quality.buckets_of(" \n ", 1 << 17, (3, 4))) == 0
    assert len(quality.buckets_of("İ x", 64, (3,))) > 0  # its lower case has two characters


def test_words_chosen_in_all_tasks_are_those_the_descent_chooses(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        part, words = int(i % 4 == 0), {f"w{k}" for k in rng.choice(60, 12)}
        words |= {f"t{k}" for k in range(8) if rng.random() < (0.1 + 0.1 * k if part else 0.1)}
        rows.append((i, part, sorted(words)))
    df = spark.createDataFrame([*rows, (400, 1, []), (401, 0, [])], "doc_id long, part int, words array<string>")
    few = sorted(map(tuple, toxicity._telling_only(df, 0.2, toxicity.Settings()).collect()))
    assert [r[:2] for r in few] == [(i, p) for i, p, _ in rows] + [(400, 1), (401, 0)]
    whole = [r for r in df.collect()]
    learned = [toxicity.descend([sorted(r[2]) for r in part], np.array([r[1] == 1 for r in part]), 0.2, toxicity.Settings()) for part in (sorted(whole), few)]
    assert learned[0][0].keys() == learned[1][0].keys() and 0 < len(learned[0][0]) < 9
    assert max(sum(len(r[2]) for r in few), 1) < sum(len(r[2]) for r in whole) / 4
    assert learned[0][1] == pytest.approx(learned[1][1])


def test_risk_uses_unlabelled_texts_as_a_mixture():
    """A word that all positives and the prior's share of the unlabelled have is toxic; a common word is not."""
    rng = np.random.default_rng(0)
    common = lambda: [f"w{i}" for i in rng.choice(40, 8, replace=False)]
    positives = [[*common(), "awful"] for _ in range(200)]
    unlabelled = [[*common(), "awful"] if rng.random() < 0.2 else common() for _ in range(1000)]
    marks = np.array([True] * 200 + [False] * 1000)
    weights, bias = toxicity.descend(positives + unlabelled, marks, 0.2, toxicity.Settings())
    assert set(weights) == {"awful"}
    assert bias < 0 < bias + weights["awful"]


@pytest.mark.parametrize("scores, label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_awkward_rows_and_labels(spark, awkward, awkward_rows, nothing, scores, label):
    labels = spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(12)] + [(1, 0, 1, "x"), (None, 1, 1, "x"), (2, None, None, "x"), (77, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
    assert scores(awkward, labels).count() == len(awkward_rows)
    assert all(0 <= r.score <= 1 for r in scores(awkward, labels).collect())
    assert scores(nothing, labels).collect() == []
    without = scores(awkward, labels.limit(0)).collect()
    assert {r.score for r in without} == {0.5} if label == "quality" else max(r.score for r in without) < 1e-6
    one_class = labels.filter("doc_id < 12").selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert all((r.score > 0.99) == (label == "quality") for r in scores(awkward, one_class).collect())


def test_keeping_good_rows_keeps_their_columns(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    assert quality.keep_good(awkward, labels).exceptAll(awkward).isEmpty()
    assert quality.keep_good(awkward, labels).count() == awkward.count()
    assert quality.keep_good(nothing, labels).collect() == []


def test_training_rows_are_read_where_arrow_holds_them():
    import pyarrow as pa

    rows = [np.arange(n, dtype=np.int32) for n in (3, 0, 5)]
    column = pa.array([r.tobytes() for r in rows], pa.binary())
    start, size = column.buffers()[2].address, column.buffers()[2].size
    found = list(quality._views(column, np.int32))
    assert [f.tolist() for f in found] == [r.tolist() for r in rows]
    assert all(start <= f.ctypes.data < start + size for f in found if len(f))


def test_words_of_one_task_are_not_kept_for_the_next():
    from tallyward.llm import common, jaccard_join

    assert not [n for n, v in vars(jaccard_join).items() if isinstance(v, common.WordHashes)]
