import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.llm import hilbert
from tallyward.llm.queries import QUERIES


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (3, 3)])
def test_curve_visits_every_cell_by_steps_of_one(spark, dims, bits):
    side = range(2**bits)
    cells = spark.createDataFrame(list(itertools.product(side, repeat=dims)), ", ".join(f"x{i} int" for i in range(dims)))
    rows = cells.withColumn("place", hilbert.hilbert_index([F.col(f"x{i}") for i in range(dims)], bits)).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(2 ** (bits * dims)))
    assert all(sum(abs(a - b) for a, b in zip(p[:dims], q[:dims], strict=True)) == 1 for p, q in itertools.pairwise(rows))


def check(rows, count, shards):
    by_shard = {s: sorted(r.slot for r in rows if r.shard == s) for s in {r.shard for r in rows}}
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert sum(sizes) == count
    assert max(sizes) - min(sizes) <= 1
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    places = [r.curve_place for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert places == sorted(places)


def test_query_over_documents(spark, folder, documents):
    rows = QUERIES["op10_hilbert_shards"](spark, folder).collect()
    check(rows, len(documents), 24)
    expected = Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in documents)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_awkward_rows(awkward, awkward_rows):
    rows = hilbert.hilbert_shards(awkward, 3).collect()
    check(rows, len(awkward_rows), 3)
    assert Counter(r.size for r in rows) == Counter(len((t or "").encode()) + 8 for _, t, *_ in awkward_rows)


def test_fewer_rows_than_shards(awkward):
    check(hilbert.hilbert_shards(awkward.limit(5), 24).collect(), 5, 24)


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCK_ROWS", 50)
    docs = spark.range(2000).selectExpr("id AS doc_id", "'same' AS text", "'s' AS source", "if(id % 3 = 0, 'a', 'b') AS lang")
    check(hilbert.hilbert_shards(docs, 7).collect(), 2000, 7)


def test_empty_table(nothing):
    assert hilbert.hilbert_shards(nothing).collect() == []


def test_files_hold_runs(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    hilbert.write_shards(docs, str(tmp_path / "out"), 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    sizes = [r["count"] for r in back.groupBy("__shard").count().collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 1
    assert back.drop("__shard").exceptAll(docs).isEmpty() and back.count() == docs.count()


def test_files_keep_clashing_columns(frame, tmp_path):
    rows = [(i, f"t{i}", "s", "l", i, "x", 7) for i in range(20)]
    docs = frame(rows, "doc_id long, text string, source string, lang string, __id long, `a.b` string, slot int")
    hilbert.write_shards(docs, str(tmp_path / "out"), 3)
    assert sorted(map(tuple, docs.sparkSession.read.parquet(str(tmp_path / "out")).drop("__shard").collect())) == rows
    with pytest.raises(ValueError, match="__shard"):
        hilbert.write_shards(docs.withColumnRenamed("slot", "__shard"), str(tmp_path / "other"), 3)


def test_no_python_in_the_plan(spark, folder):
    plan = QUERIES["op10_hilbert_shards"](spark, folder)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
