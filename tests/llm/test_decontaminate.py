import itertools
import random
import re

import pytest

from tallyward.llm import decontaminate as d
from tallyward.llm.common import WordHashes
from tallyward.llm.queries import QUERIES


def test_masks_hit_every_stretch_with_three_substitutions():
    for changed in itertools.combinations(range(d.LEAST_WORDS), 3):
        assert any(
            all(start + at not in changed for at, used in enumerate(mask) if used == "1")
            for mask in d.MASKS for start in range(d.LEAST_WORDS - len(mask) + 1)
        )


def words(text):
    return re.findall(r"\w+", text.lower())


def longest(same):
    """The longest stretch with at most a quarter of its words unequal, by trying all of them."""
    bad = [0, *itertools.accumulate(not x for x in same)]
    return max((high - low for low, high in itertools.combinations(range(len(same) + 1), 2) if 4 * (bad[high] - bad[low]) <= high - low), default=0)


def brute(documents, items):
    """Items of each document, by comparing every item along every alignment."""
    out = {}
    for doc_id, text in documents:
        own, hits = words(text or ""), set()
        for item_id, item in items:
            other = words(item or "")
            if not set(own) & set(other):
                continue
            for start in range(1 - len(other), len(own)):
                first, last = max(0, start), min(len(own), start + len(other))
                same = [own[i] == other[i - start] for i in range(first, last)]
                wanted = min(13, len(other))
                if 4 * sum(same) >= 3 * wanted and longest(same) >= wanted:
                    hits.add(item_id)
        out[doc_id] = sorted(hits)
    return out


def test_substitutions_and_pieces(frame):
    rng = random.Random(9)
    items = [(i, " ".join(f"{rng.choice('abcdef')}{rng.randint(0, 60)}" for _ in range(n))) for i, n in enumerate([30, 20, 13, 16, 5, 2, 1])]
    docs = []
    for i, item in items:
        for changes in range(6):
            own = item.split()
            for at in rng.sample(range(len(own)), min(changes, len(own))):
                own[at] = "zz"
            docs.append((len(docs), f"{' '.join(f'n{k}' for k in range(9))} {' '.join(own).upper()}, and {' '.join(own[3:17])}"))
    found = {r.doc_id: r.item_ids for r in d.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()}
    assert found == brute(docs, items)


def test_query_over_documents(spark, folder, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op6_decontamination"](spark, folder).collect()
    assert {r.doc_id: r.item_ids for r in rows} == brute(documents, items)
    assert all(r.contaminated == bool(r.item_ids) == (r.longest > 0) for r in rows)


@pytest.mark.parametrize("block_items", [1, 3, 100])
def test_blocks_change_nothing(spark, folder, block_items):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.limit(8)
    want = {tuple(map(str, r)) for r in d.contaminated(docs, items).collect()}
    assert {tuple(map(str, r)) for r in d.contaminated(docs, items, block_items=block_items).collect()} == want
    assert {r.doc_id for r in d.drop_contaminated(docs, items, block_items=block_items).collect()} == {int(w[0]) for w in want if w[1] == "False"}


def test_awkward_rows(frame, awkward, awkward_rows, nothing):
    items = frame([(1, None, "x"), (2, "", "x"), (None, "words that are long enough to be shingled by four or five words each", "x"), (3, "one", "x")], "item_id long, text string, doc_id string")
    rows = d.contaminated(awkward, items).collect()
    assert len(rows) == len(awkward_rows)
    assert {(str(r.doc_id), str(r.item_ids)) for r in rows if r.contaminated} == {(str(i), "[None]") for i in (1, 2, None)} | {("8", "[3]"), ("9", "[3]")}
    left = d.drop_contaminated(awkward, items)
    assert left.columns == awkward.columns and left.count() == len(awkward_rows) - 6
    assert d.contaminated(nothing, items).collect() == [] and d.drop_contaminated(nothing, items).collect() == []
    assert not any(r.contaminated for r in d.contaminated(awkward, items.limit(0)).collect())


def test_hashes_ignore_case_and_signs():
    known = WordHashes()
    assert (d.word_hashes("Ein Wort, NOCH eins!", known) == d.word_hashes("ein wort noch eins", known)).all()
