"""The last stage says of each row whether its ids give the text back."""

import corpus_pipeline
from tallyward.llm import pieces


def test_ids_that_do_not_decode_are_marked(spark, frame, folder, monkeypatch):
    docs = frame([(1, "kept as it is"), (2, None), (3, "")], "doc_id long, text string")
    stage = corpus_pipeline.STAGES[-1][1]
    assert {r.doc_id: r.round_trip for r in stage(spark, docs, folder).collect()} == {1: True, 2: True, 3: True}
    with open(pieces.MODEL, "rb") as file:
        own = pieces.Pieces(file.read())
    lossy = [t for t in ("a▁b", "▁", "▁ x ▁") if own.decode(own.encode_batch([t])[0].tolist()) != t]
    assert lossy
    marks = stage(spark, frame([(i, t) for i, t in enumerate([*lossy, "plain"])], "doc_id long, text string"), folder).collect()
    assert {r.doc_id for r in marks if not r.round_trip} == set(range(len(lossy)))


def test_a_clashing_mark_gives_way(spark, frame, folder):
    docs = frame([(1, "text", "x")], "doc_id long, text string, round_trip string")
    after = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert after.columns == ["doc_id", "text", "ids", "n_ids", "round_trip"] and after.first().round_trip is True
