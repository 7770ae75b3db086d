import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from oracle_compare import connect, differences

from tallyward.llm import exact_dedup as x
from tallyward.llm.jaccard_join import drop_near_duplicates
from tallyward.llm.queries import ORACLE, QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_index_inserts_deletes_and_grows():
    rng, index, live = random.Random(3), x.CuckooIndex(2), {}
    keys = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)]
    for _ in range(12_000):
        key = rng.choice(keys)
        if key in live and rng.random() < 0.4:
            assert index.delete(key)
            del live[key]
        elif key not in live:
            index.insert(key, [len(live)])
            live[key] = index.get(key)
        assert (index.get(key) is None) == (key not in live)
    assert dict(index.items()) == live
    assert index.size == len(live)
    assert not index.delete(b"\0" * 32)


def test_equal_marks_of_different_digests_are_told_apart():
    index = x.CuckooIndex(4)
    same = [b"\x01\x02" + b"\0" * 6 + bytes([n]) * 24 for n in range(8)]  # one mark, one bucket
    for n, key in enumerate(same):
        index.insert(key, [n])
    assert [index.get(k) for k in same] == [[n] for n in range(8)]
    assert index.get(b"\x01\x02" + b"\0" * 6 + b"\xff" * 24) is None


@pytest.mark.parametrize("held", [1, 7])
def test_small_indexes_change_nothing(monkeypatch, spark, frame, held):
    """Run in this process: the rows of a task in any order, then the parts in the order of their digests."""
    monkeypatch.setattr(x, "HELD_DIGESTS", held)
    rows = [(bytes([i % 23] * 32), i, 1, 1) for i in range(300)]
    batch = lambda rows: iter([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["digest", "keep_id", "keep_copies", "group_size"])])
    told = lambda batches: [tuple(r.values()) for b in batches for r in b.to_pylist()]
    parts = told(x._merge(batch(rows)))
    assert len(parts) > 23
    merged = told(x._merge(batch(sorted(parts))))
    assert sorted(merged) == [(bytes([i] * 32), max(range(i, 300, 23)), 1, len(range(i, 300, 23))) for i in range(23)]


def test_awkward_rows(awkward, awkward_rows):
    found = [tuple(r) for r in x.exact_duplicates(awkward).collect()]
    assert sorted(found, key=str) == brute([r[:2] for r in awkward_rows])


def test_dropping_keeps_columns_and_one_row_each(awkward):
    left = x.drop_exact_duplicates(awkward)
    assert left.columns == awkward.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [2, 4, 5, 7, 9, 10, 11]  # 4 is the largest of the empty ones
    assert None not in ids


def test_clashing_columns_keep_their_values(frame):
    schema = "doc_id long, text string, __digest string, __size int, `a.b` string, keep_id long, digest int, whole string"
    rows = [(1, "x", "own", 5, "dot", 70, 3, "w"), (2, "X", "own2", 6, "dot2", 71, 4, "v"), (2, "X", "own2", 6, "dot2", 71, 4, "v"), (3, "y", None, None, None, None, None, None)]
    assert sorted(map(tuple, x.drop_exact_duplicates(frame(rows, schema)).collect())) == rows[2:]


def test_null_ids_only(frame):
    docs = frame([(None, "a"), (None, "A")], "doc_id long, text string")
    assert [tuple(r)[:4] for r in x.exact_duplicates(docs).collect()] == [(None, None, 2, True)] * 2
    assert x.drop_exact_duplicates(docs).count() == 1


def test_hot_group(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Same', concat('t', id)) AS text")
    rows = x.exact_duplicates(docs).filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(8997, 3000)}
    assert sum(r.kept for r in rows) == 1


def test_empty_table(nothing):
    assert x.exact_duplicates(nothing).collect() == []
    assert x.drop_exact_duplicates(nothing).collect() == []


def test_deletion_leaves_live_digests(frame):
    schema = "doc_id long, text string"
    added, removed = frame([(1, "a"), (2, "A"), (3, "b"), (4, "c")], schema), frame([(1, "a"), (3, "B")], schema)
    live = {bytes(r.digest): r.live for r in x.live_digests(added, removed).collect()}
    assert live == {hashlib.sha256(t).digest(): 1 for t in (b"a", b"c")}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(QUERIES["op4_exact_dedup"](spark, folder), connect(folder), ORACLE["op4_exact_dedup"]) is None


def shuffled_rows(plan):
    """Rows that the shuffles of an executed plan have written."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    return (plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0) + sum(map(shuffled_rows, inner))


@pytest.mark.parametrize("drop", ["exact", "near"])
def test_only_rows_that_may_be_copies_are_shuffled_whole(spark, drop):
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id < 20, 'a text that comes again and again in it', concat_ws(' ', transform(sequence(1, 9), i -> sha1(concat(id, ' ', i))))) AS text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = x.drop_exact_duplicates(docs) if drop == "exact" else drop_near_duplicates(docs)
        ids = {r.doc_id for r in left.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ids == {19 if drop == "exact" else 0, *range(20, 4000)}
    assert 0 < shuffled_rows(left._jdf.queryExecution().executedPlan()) < 200
