import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyward.llm import suffix_dedup as s
from tallyward.llm.queries import QUERIES


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("removed").collect()), key=str)


def made(rng, length):
    """Texts with shared passages, edits, periods and copies."""
    letters = "ab " if rng.random() < 0.3 else "abcdefghij é"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.randint(length // 2, 3 * length)) for _ in range(4)]
    rows = []
    for i in range(40):
        body = text(rng.randint(0, length)) + rng.choice(passages) + text(rng.randint(0, 50)) + (rng.choice(passages) if rng.random() < 0.5 else "")
        if rng.random() < 0.5 and body:
            at = rng.randrange(len(body))
            body = body[:at] + "#" + body[at + 1 :]
        rows.append((i, body + "xy" * rng.choice([0, 0, length])))
    return [*rows, (40, rows[3][1]), (41, "z" * (3 * length)), (41, "z" * (3 * length)), (42, ""), (43, None)]


@pytest.mark.parametrize("seed, length", [(1, 40), (2, 40), (3, 64), (4, 200)])
def test_random_texts(spark, seed, length):
    rows = made(random.Random(seed), length)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(s.without_repeats(docs, length)) == brute(rows, length)


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_anchors_by_window_hashes(spark, seed):
    rows = made(random.Random(seed), 48)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(s.without_repeats(docs, 48, hot_rows=2)) == brute(rows, 48)


def test_texts_with_equal_checksums_are_told_apart(spark):
    """Two texts of rows without an id (and of one id) whose CRC-32 is the same; one shares nothing with any other."""
    rng = random.Random(11)
    body = lambda: bytes(rng.choice(b"abcdefgh") for _ in range(260))
    shared, alone = body(), body()
    crc = zlib.crc32(shared)
    alone += with_crc(alone, crc)
    assert zlib.crc32(alone) == crc
    for doc_id in (None, 5):
        rows = [(doc_id, shared.decode()), (doc_id, alone.decode("latin-1")), (9, shared.decode() + "!")]
        assert found(s.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 200)


def with_crc(data, wanted):
    """Characters of ASCII that give the data a checksum; the checksum is linear in their bits."""
    count = 12
    base = zlib.crc32(data + b"@" * count)
    basis: dict[int, tuple[int, int]] = {}
    for bit in [(at, 1 << k) for at in range(count) for k in range(6)]:
        changed = bytearray(b"@" * count)
        changed[bit[0]] ^= bit[1]
        value, mask = zlib.crc32(data + bytes(changed)) ^ base, 1 << (bit[0] * 6 + bit[1].bit_length() - 1)
        while value:
            top = value.bit_length()
            if top not in basis:
                basis[top] = value, mask
                break
            value, mask = value ^ basis[top][0], mask ^ basis[top][1]
    left, chosen = wanted ^ base, 0
    while left:
        value, mask = basis[left.bit_length()]
        left, chosen = left ^ value, chosen ^ mask
    out = bytearray(b"@" * count)
    for at in range(count):
        out[at] ^= chosen >> (at * 6) & 63
    return bytes(out)


def test_pieces_of_long_texts(spark, monkeypatch):
    text = "".join(random.Random(7).choice("abcdefgh") for _ in range(3000))
    want = list(s.anchors(text.encode(), 100))
    monkeypatch.setattr(s, "PIECE", 256)
    windows = lambda runs: {(h, lo + i, d - i) for h, lo, n, d in runs for i in range(n)}
    assert windows(s.anchors(text.encode(), 100)) == windows(want)
    assert {lo for _, lo, _ in windows(want)} == set(range(len(text) - 99))


def test_induced_order_finds_equal_windows():
    rng = random.Random(4)
    length, rows = 40, []
    gram = bytes(rng.choice(b"ab") for _ in range(s.GRAM))
    for _ in range(60):
        d, after = rng.randint(0, 8), rng.randint(0, 8)
        n = rng.randint(1, d + 1)
        data = bytes(rng.choice(b"ab") for _ in range(d)) + gram + bytes(rng.choice(b"ab") for _ in range(8))
        rows.append((data[: n + length - 1] if n + length - 1 <= len(data) else data + bytes(after)[: n + length - 1 - len(data)], n, d))
    rows = [r for r in rows if len(r[0]) == r[1] + length - 1 and r[2] - r[1] + 1 >= 0]
    seen = Counter((data[i : i + length], d - i) for data, n, d in rows for i in range(n))
    marked = s.repeated_windows(rows, length)
    for row, (data, n, d) in zip(marked, rows, strict=True):
        assert set(np.flatnonzero(row)) == {d - i for i in range(n) if seen[data[i : i + length], d - i] > 1}


def test_query_over_documents(spark, folder, documents):
    assert found(QUERIES["op9_suffix_dedup"](spark, folder)) == brute(documents, 200)


def test_awkward_rows(awkward, awkward_rows, nothing):
    rows = [(i, t if t is None or len(t) < 10_000 else t[-5000:]) for i, t, *_ in awkward_rows]  # brute force on the long ones is slow
    docs = awkward.selectExpr("doc_id", "if(length(text) < 10000, text, right(text, 5000)) AS text", "lang AS k", "source AS crc", "node AS h")
    assert found(s.without_repeats(docs)) == brute(rows, 200)
    long = [r for r in s.without_repeats(awkward).collect() if r.doc_id in (6, 7)]
    assert {(r.n_removed, r.n_spans) for r in long} == {(len(awkward_rows[8][1]), 1)}
    assert s.without_repeats(nothing).collect() == []
