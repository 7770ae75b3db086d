import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from tallyward.llm import pieces as p
from tallyward.llm.queries import QUERIES

CHARS = "abcdeinothr  \n\t▁éß日本語🎉0123..--<>AB"


@pytest.fixture(scope="module")
def model():
    with open(p.MODEL, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(1)
    return ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["a" * 3000, "  " * 50, " ", "▁▁ a", "", "\n", "aaaa" * 7 + " " * 17]


def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def unigram(model, rng):
    """The same pieces as a unigram model with scores without ties."""
    file = proto.ModelProto.FromString(model)
    file.trainer_spec.model_type = p.UNIGRAM
    for piece in file.pieces:
        if piece.type == 1:
            piece.score = -rng.uniform(1, 12)
    return file.SerializeToString()


def test_ids_equal_the_library_merges(model, fuzz):
    assert [i.tolist() for i in p.Pieces(model).encode_batch(fuzz)] == library(model).encode(fuzz)


def test_ids_equal_the_library_unigram(model, fuzz):
    changed = unigram(model, random.Random(4))
    own, reference = p.Pieces(changed), library(changed)
    score = lambda ids: sum(own.scores[i] if i in own.ids.values() else 0 for i in ids)
    known = set(own.ids.values())
    differ = 0
    for a, b in zip(own.encode_batch(fuzz[:800]), reference.encode(fuzz[:800]), strict=True):
        if a.tolist() != b:  # only by rounding of the library's single precision
            differ += 1
            assert sum(own.scores[i] for i in a.tolist() if i in known) == pytest.approx(sum(own.scores[i] for i in b if i in known), abs=1e-4)
    assert differ <= 8


def test_shared_prefixes_change_nothing(model):
    words = ["▁interna", "▁international", "▁internationally", "▁inter", "▁internat", "▁z", "▁"]
    own = p.Pieces(model)
    together = own.segment_all(words)
    assert all(own.segment_all([w]) == {w: together[w]} for w in words)


def test_decoding(model, fuzz):
    own, reference = p.Pieces(model), library(model)
    ids = reference.encode(fuzz)
    assert [own.decode(i) for i in ids] == [reference.decode(i) for i in ids]
    assert [own.decode(i) for i in ids] == [t.replace("▁", " ") for t in fuzz]
    assert own.decode([1, 2]) == ""


def test_unknown_piece_without_byte_pieces(model):
    file = proto.ModelProto.FromString(unigram(model, random.Random(2)))
    for piece in [x for x in file.pieces if x.type == 6]:
        file.pieces.remove(piece)
    file.trainer_spec.byte_fallback = False
    small = file.SerializeToString()
    texts = ["a日本b", "語", "x \U000110d0\U000110d1 y"]
    assert [i.tolist() for i in p.Pieces(small).encode_batch(texts)] == library(small).encode(texts)


def test_small_caches_change_nothing(model, fuzz, monkeypatch):
    monkeypatch.setattr(p, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(p, "TEXT_AT_ONCE", 200)
    assert [i.tolist() for i in p.Pieces(model).encode_batch(fuzz[:300])] == library(model).encode(fuzz[:300])


def test_query_over_documents(spark, folder, documents, model):
    reference, texts = library(model), dict(documents)
    rows = QUERIES["op2_sentencepiece"](spark, folder).collect()
    assert len(rows) == len(documents)
    assert all(r.ids == reference.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) and r.decoded == texts[r.doc_id] and r.round_trip for r in rows)


def test_awkward_rows(awkward, awkward_rows, nothing, model):
    reference = library(model)
    rows = p.encoded(awkward).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), reference.encode(t or "")) for i, t, *_ in awkward_rows)
    assert [r.round_trip for r in rows if r.doc_id == 10] == [False]
    out = p.with_pieces(awkward)
    assert sorted(out.columns) == sorted({*awkward.columns, "n_ids"})
    assert dict(out.dtypes)["ids"] == "array<int>"
    assert p.decoded(out.select("doc_id", "ids")).count() == len(awkward_rows)
    assert p.encoded(nothing).collect() == [] and p.with_pieces(nothing).collect() == []


def test_batches_are_arrays(model):
    assert all(i.dtype == np.int32 for i in p.Pieces(model).encode_batch(["", "a b"]))


def test_both_generations_of_words_fit_the_cache(monkeypatch):
    from tallyward.llm import pieces as module

    with open(module.MODEL, "rb") as file:
        model = file.read()
    texts = [f"w{i} x{i}" for i in range(200)]
    plain = [ids.tolist() for ids in module.Pieces(model).encode_batch(texts)]
    monkeypatch.setattr(module, "CACHE_ENTRIES", 40)
    small, found, most = module.Pieces(model), [], 0
    for text in texts:
        found += [ids.tolist() for ids in small.encode_batch([text])]
        most = max(most, len(small.known) + len(small.known_before))
    assert found == plain and most <= 40 + 4


def test_a_worker_keeps_no_words_after_a_task(spark, model, monkeypatch):
    """The task's function, run in this process."""
    tasks, docs = [], spark.createDataFrame([("a few words to be known", 1)], "text string, doc_id long")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task))
    p.encoded(docs)
    p.with_pieces(docs.select("doc_id", "text"))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a few words to be known", "and more"])], ["doc_id", "text"])
    own = p.pieces(model)
    for task in tasks:
        (out,) = task(iter([batch]))
        assert [list(i) for i in out.column("ids").to_pylist()] == library(model).encode(["a few words to be known", "and more"])
        assert not own.known and not own.known_before
    assert len(tasks) == 2
