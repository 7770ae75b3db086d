import hashlib
import itertools
import random
import re

import pytest

from tallyward.llm import pii
from tallyward.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def digits(text):
    return re.sub("[^0-9]", "", text)


def checksum(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and checksum(digits(m[0]))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("aB1234.0@@+-() %_xé  .,") for _ in range(rng.randint(0, 70)))
        assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "a@b." * 50_000])
def test_long_runs_end_in_time(text):
    spans = pii.all_spans(text, pii.field())
    assert all(0 <= s < e <= len(text) for _, s, e in spans)


def test_field_on_new_sentences():
    hits = found = true = 0
    for text, truth in pii.training_sentences(300, 99):
        got = set(pii.field().best(text))
        hits, found, true = hits + len(got & truth), found + len(got), true + len(truth)
    assert hits / found > 0.9
    assert hits / true > 0.75


def test_best_segmentation_equals_all_segmentations():
    rng = random.Random(1)
    for text, _ in pii.training_sentences(40, 5):
        own = pii.Field()
        for k, f in itertools.product(pii.KINDS, {f for s in pii.candidates(text) for f in pii.features(text, *s)}):
            own.weights[k, f] = rng.uniform(-1, 1)
        segments = pii.candidates(text)[:8]
        score = {s: max(own.scores(text, [s])[0].values()) for s in segments}
        apart = lambda chosen: all(a[1] <= b[0] for a, b in itertools.pairwise(sorted(chosen)))
        best = max(sum(score[s] for s in c) for n in range(len(segments) + 1) for c in itertools.combinations(segments, n) if apart(c))
        if len(pii.candidates(text)) <= 8:
            assert sum(max(own.scores(text, [(s, e)])[0].values()) for _, s, e in own.best(text)) == pytest.approx(best)


def test_learning_raises_the_likelihood_of_the_truth():
    text, truth = "call 555-123-4567 now", {("phone", 5, 17)}
    own = pii.Field()
    for _ in range(30):
        own.learn(text, truth, 0.3)
    assert own.best(text) == [("phone", 5, 17)]


def test_added_spans_touch_no_base_span():
    text = "mail a@b.com, or write to jane (at) host.org, tel (555) 123-4567, ip 10.0.0.1"
    base = pii.base_spans(text)
    spans = pii.all_spans(text, pii.field())
    assert set(base) <= set(spans)
    added = set(spans) - set(base)
    assert {k for k, *_ in added} >= {"phone"}
    assert all(e <= s2 or e2 <= s for _, s, e in added for _, s2, e2 in base)


def test_query_over_documents(spark, folder, documents):
    rows = {r.doc_id: r for r in QUERIES["op8_personal_data"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        spans, r = brute(text), rows[doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_awkward_rows(awkward, awkward_rows, nothing):
    rows = pii.personal_data(awkward).collect()
    assert len(rows) == len(awkward_rows)
    assert {r.spans for r in rows} == {""}
    assert pii.personal_data(nothing).collect() == []
