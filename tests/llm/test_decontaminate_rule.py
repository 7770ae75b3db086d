"""The rule as it is written: a stretch of 13 words, or the whole shorter item, with at most a quarter substituted."""

import itertools
import random

import numpy as np
import pytest

from tallyward.llm import decontaminate as d
from tallyward.llm.common import WordHashes


def longest(same):
    """The longest stretch that the rule admits, by trying all of them."""
    return max((high - low for low, high in itertools.combinations(range(len(same) + 1), 2) if 4 * same[low:high].count(False) <= high - low), default=0)


def written_rule(own, item):
    """The longest admitted stretch along any alignment; 0 if none is long enough."""
    best = 0
    for start in range(1 - len(item), len(own)):
        best = max(best, longest([own[i] == item[i - start] for i in range(max(0, start), min(len(own), start + len(item)))]))
    return best if best >= min(13, len(item)) else 0


def found(own, item):
    known = WordHashes()
    return d.Items([(1, " ".join(item))]).found_in(d.word_hashes(" ".join(own), known)).get(0, 0)


@pytest.mark.parametrize("count, changes", [(13, 3), (16, 4), (20, 5), (24, 6)])
def test_masks_hit_every_stretch_with_a_quarter_substituted(count, changes):
    masks = [sum(1 << at for at, used in enumerate(mask) if used == "1") << start for mask in d.MASKS for start in range(count - len(mask) + 1)]
    for changed in itertools.combinations(range(count), changes):
        places = sum(1 << at for at in changed)
        assert any(not mask & places for mask in masks)


@pytest.mark.parametrize("count", range(1, 17))
def test_up_to_a_quarter_may_differ_anywhere(count):
    item = [f"w{i}" for i in range(count)]
    for changes in range(count // 4 + 1):
        for changed in itertools.islice(itertools.combinations(range(count), changes), 600):
            own = ["x", "y", *("zz" if i in changed else w for i, w in enumerate(item)), "x"]
            assert found(own, item) == written_rule(own, item) == count


def test_longest_stretch_equals_all_stretches():
    rng = random.Random(3)
    for _ in range(500):
        same = [rng.random() < 0.7 for _ in range(rng.randint(1, 30))]
        assert d.longest_stretch(np.array(same)) == longest(same)


def test_random_texts_follow_the_rule():
    rng = random.Random(4)
    hits = 0
    for _ in range(500):
        item = [rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(rng.randint(1, 40))]
        low = rng.randint(0, len(item) // 3)
        own = [w if rng.random() < 0.78 else "zz" for w in item[low:]]
        own = ["n"] * rng.randint(0, 5) + own + ["n"] * rng.randint(0, 5)
        want = written_rule(own, item)
        assert (found(own, item) > 0) == (want > 0)
        assert found(own, item) <= want
        hits += want > 0
    assert 100 < hits < 450
