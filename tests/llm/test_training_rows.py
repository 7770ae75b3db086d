"""Training rows are bounded by rows, not by ids."""

import pytest

from tallyward.llm import quality, toxicity


@pytest.mark.parametrize("module, learn", [(quality, "descend"), (toxicity, "descend")])
def test_a_repeated_id_is_one_training_row(frame, monkeypatch, module, learn):
    docs = frame([(i, f"good plain words number {i}") for i in range(40)] + [(7, f"another text {i}") for i in range(300)], "doc_id long, text string")
    labels = frame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    sizes = []
    real = module._learn

    def counted(*args):
        run = real(*args)

        def counting(batches):
            batches = list(batches)
            n = sum(b.num_rows for b in batches)
            assert n <= 60, f"{n} rows for 40 ids"
            yield from run(batches)

        sizes.append(counting)
        return counting

    monkeypatch.setattr(module, "_learn", counted)
    module.train(docs, labels)
    assert sizes


def test_unlabelled_ids_are_drawn_whatever_their_repetitions(frame):
    """An id that repeats takes one place of the sample."""
    docs = frame([(i, "plain words") for i in range(200)] + [(1000 + i, "awful words") for i in range(200)] + [(3, "plain words")] * 3000, "doc_id long, text string")
    labels = frame([(1000 + i, 1) for i in range(100)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, settings=toxicity.Settings(max_rows=300))
    same = toxicity.train(docs.dropDuplicates(["doc_id"]), labels, settings=toxicity.Settings(max_rows=300))
    assert set(model.weights) == set(same.weights)
