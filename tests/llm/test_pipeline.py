import importlib.util

import corpus_pipeline
from tallyward.llm import decontaminate, exact_dedup, jaccard_join, pieces, quality
from tallyward.llm.common import stored

from test_jaccard_join import brute as groups


def test_stages_one_by_one(spark, folder):
    """Each stage against the brute-force version of what it drops."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = stored(stage(spark, docs, folder))
        left = [r.doc_id for r in after.collect()]
        assert len(left) == len(set(left)) and set(left) <= set(before)
        if name != "SentencePiece encoding":
            assert after.columns == columns
            assert all(r == before[r.doc_id] for r in after.collect())
        texts = [(i, r.text) for i, r in before.items()]
        if name == "quality classifier":
            scores = quality.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            want = {r.doc_id for r in scores.collect() if r.predicted}
        elif name == "exact dedup":
            last = {}
            for i, t in sorted(texts):
                last["".join(c.lower() if c.isascii() else c for c in t)] = i
            want = set(last.values())
        elif name == "n-gram Jaccard join":
            want = {i for i, _, least in groups(texts, 5, 80) if i == least}
        elif name == "benchmark decontamination":
            bench = spark.read.parquet(f"{folder}/benchmark.parquet")
            want = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect() if not r.contaminated}
        else:
            with open(pieces.MODEL, "rb") as file:
                own = pieces.Pieces(file.read())
            assert all(own.decode(r.ids) == before[r.doc_id].text and r.n_ids == len(r.ids) for r in after.collect())
            want = set(before)
        assert set(left) == want, name
        docs = after


def test_stages_on_awkward_rows(spark, folder, awkward, nothing):
    for start, least in ((awkward, 1), (nothing, 0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, folder))
        assert docs.count() >= least


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding"]
    assert {exact_dedup.__name__, jaccard_join.__name__} <= {"tallyward.llm.exact_dedup", "tallyward.llm.jaccard_join"}


def test_registration():
    import __spark_entry__ as driver

    names = set(driver.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 11))
    assert importlib.util.find_spec("tallyward.llm") is not None
