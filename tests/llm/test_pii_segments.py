"""The segments the field may choose, against those enumerated from the text alone."""

import itertools
import random
import re

import pytest

from tallyward.llm import pii

BETWEEN = re.compile(r"[ ().\-/]{1,2}| ?[\[(]?\.[\])]? ?")


def segments(text):
    """All stretches of at most 64 characters from a group of digits to a later one, by trying every pair of places."""
    found = set()
    for low, high in itertools.combinations(range(len(text) + 1), 2):
        part = text[low:high]
        body = re.sub(r"\A(\+\(|\+|\()", "", part)
        whole = not (text[high : high + 1].isdigit() or (body == part and low and text[low - 1].isdigit()))
        groups, between = re.findall("[0-9]+", body), re.split("[0-9]+", body)
        if len(part) <= 64 and whole and groups and not between[0] and not between[-1] and all(BETWEEN.fullmatch(b) for b in between[1:-1]):
            found.add((low, high))
    return found


def adjacent(rng):
    make = [pii._card, pii._phone, pii._ip, pii._other]
    parts = [rng.choice(make)(rng) for _ in range(rng.randint(2, 3))]
    return rng.choice([" ", "  ", ", ", " / "]).join(p for p in parts if not re.search("[a-z]", p))


def test_segments_are_all_between_groups_of_digits():
    rng = random.Random(8)
    for _ in range(60):
        text = adjacent(rng)
        assert set(pii.candidates(text)) == segments(text)
        assert len(pii.candidates(text)) == len(segments(text))
    for _ in range(300):
        text = "".join(rng.choice("12345 .-(+)/x") for _ in range(rng.randint(0, 25)))
        assert set(pii.candidates(text)) == segments(text)


def test_the_best_of_all_segments_is_chosen():
    rng = random.Random(6)
    for _ in range(25):
        text = adjacent(rng)
        field = pii.Field()
        chosen = sorted(segments(text))
        for k, f in itertools.product(pii.KINDS, sorted({f for s in chosen for f in pii.features(text, *s)})):
            field.weights[k, f] = rng.uniform(-1, 0.9)
        score = {s: max(field.scores(text, [s])[0].values()) for s in chosen}
        best = [0.0]  # of the text up to each place, without the order of candidates()
        for end in range(1, len(text) + 1):
            best.append(max([best[-1], *(best[low] + v for (low, high), v in score.items() if high == end)]))
        assert sum(score[s, e] for _, s, e in field.best(text)) == pytest.approx(best[-1])


@pytest.mark.parametrize("text, want", [
    ("tel 555-123-4567 555-987-6543", ["phone 555-123-4567", "phone 555-987-6543"]),
    ("room 12 (555) 123-4567", ["phone (555) 123-4567"]),
    ("in 2019 555-123-4567", ["phone 555-123-4567"]),
    ("4111.1111.1111.1111 12/27", ["card 4111.1111.1111.1111"]),
    ("0049 30 1234567 0049 30 7654321", ["phone 0049 30 1234567", "phone 0049 30 7654321"]),
    ("+1 (826) 555-4081 190.137.223.204", ["phone +1 (826) 555-4081", "ip 190.137.223.204"]),
    ("10.0.0.1 (555) 123-4567", ["ip 10.0.0.1", "phone (555) 123-4567"]),
    ("write jane.doe at host dot org dot uk", ["email jane.doe at host dot org dot uk"]),
    ("mail jane.doe at host dot org dot uk", ["email jane.doe at host dot org dot uk"]),
])
def test_adjacent_numbers_are_told_apart(text, want):
    spans = pii.all_spans(text, pii.field())
    assert [f"{k} {text[s:e]}" for k, s, e in sorted(spans, key=lambda s: s[1])] == want


def test_parts_of_a_written_email():
    text = "ask me.jane(at)my-host.co.uk"
    found = {text[s:e] for s, e in pii.candidates(text)}
    assert found == {f"{name}(at)my-host.{end}" for name in ("me.jane", "jane") for end in ("co", "co.uk")}


def test_segments_touch_nothing_taken():
    text = "10.0.0.1 555-123-4567"
    assert all(start >= 8 for start, _ in pii.candidates(text, [(0, 8)])) and (9, 21) in pii.candidates(text, [(0, 8)])


def test_sums_kept_from_other_texts_change_nothing():
    known, texts = {}, [t for t, _ in pii.training_sentences(50, 3)]
    assert [pii.field().best(t, (), known) for t in texts] == [pii.field().best(t) for t in texts]
