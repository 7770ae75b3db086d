import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import lexicon_bpe as b
from tallyward.llm.queries import QUERIES

CHARS = "abcdeinothrsv  \n\t'éß日本語🎉0123..--<>AB½² 　́"


@pytest.fixture(scope="module")
def file():
    with open(b.MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(b.MODEL)


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(1)
    texts = ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return texts + ["a" * 3000, " " * 50 + "x", "it's we'll I'd 'S", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "a  <|endoftext|> <|endoftext", "\x00\x7f\x85", "ab꟎1 \U000323b0x", "\U0003d000"]


def own(file, words, tmp_path):
    vocabulary = b.Vocabulary(file)
    path = tmp_path / "lexicon"
    path.write_bytes(b.compiled({w.encode(): vocabulary.merged_all([w.encode()])[0] for w in words}))
    return b.Encoder(vocabulary, b.Lexicon(str(path)))


@pytest.mark.parametrize("share", [0, 2, 1])
def test_ids_equal_the_library(file, library, fuzz, tmp_path, share):
    vocabulary = b.Vocabulary(file)
    words = sorted({w for t in fuzz for w in vocabulary.words(t) if len(w.encode()) <= b.WORD_BYTES and w not in vocabulary.special})
    encoder = own(file, words[::share] if share else [], tmp_path)
    expected = [e.ids for e in library.encode_batch(fuzz, add_special_tokens=False)]
    found = [i.tolist() for i in encoder.encode_batch(fuzz)]
    assert found == expected
    assert [vocabulary.decode(i) for i in found] == library.decode_batch(expected, skip_special_tokens=False) == fuzz


def test_decoding_of_broken_bytes(file, library):
    rng = random.Random(3)
    ids = [[rng.randrange(50257) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    vocabulary = b.Vocabulary(file)
    assert [vocabulary.decode(i) for i in ids] == library.decode_batch(ids, skip_special_tokens=False)


def test_automaton_is_least_and_numbers_its_words(file, tmp_path):
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    path = tmp_path / "lexicon"
    path.write_bytes(b.compiled({w: np.array([i, i + 1], np.uint32).tobytes() for i, w in enumerate(words)}))
    lexicon = b.Lexicon(str(path))
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert lexicon.ids_of(np.array([0, 7])) == [bytes([0, 0, 0, 0, 1, 0, 0, 0]), bytes([7, 0, 0, 0, 8, 0, 0, 0])]
    others = [w + b"x" for w in words] + [b"", b"d", b"abcabcabc" * 20]
    assert set(lexicon.numbers(others).tolist()) == {-1}
    # The least automaton has one state per distinct set of endings.
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) == len(endings)


def test_empty_lexicon(file, tmp_path):
    assert own(file, [], tmp_path).lexicon.numbers([b"a", b""]).tolist() == [-1, -1]


def test_a_long_word_takes_little_time(file, library):
    word = "日本語の長い文" * 20_000
    assert b.Vocabulary(file).merged(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_frequent_words_are_bounded(spark):
    counts = spark.range(5000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.when(F.col("id") < 10, 1000).otherwise(5).cast("long").alias("n"))
    words = b.frequent_words(counts, 400)
    assert {f"w{i}" for i in range(10)} <= set(words) and 300 < len(words) <= 400
    assert len(b.frequent_words(counts, 10_000)) == 5000
    assert b.frequent_words(counts.limit(0), 10) == []


def test_counts_of_words(spark):
    rows = spark.createDataFrame([("a b c a",), ("a b <|endoftext|>",), ("x" * 70 + " " + "x" * 70,), ("",), ("it's d's éé éé",)], "text string")
    assert {r.word: r.n for r in b.word_counts(rows).collect()} == {"a": 2, " b": 2, "'s": 2, " éé": 2}


def test_both_ways_to_merge_agree(file, fuzz):
    vocabulary = b.Vocabulary(file)
    words = {w.encode() for t in fuzz for w in vocabulary.words(t) if len(w) < 100}
    words = sorted(words)
    assert [np.frombuffer(i, np.uint32).tolist() for i in vocabulary.merged_all(words)] == [vocabulary._merged_long(w) for w in words]
    assert vocabulary.merged_all([]) == []


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_query_over_documents(spark, folder, documents, library):
    rows = QUERIES["op11_lexicon_bpe"](spark, folder).collect()
    assert sorted(tuple(r) for r in rows) == sorted((i, *expected(library, t)) for i, t in documents)


def test_awkward_rows(awkward, awkward_rows, nothing, library):
    rows = b.encoding_digests(awkward).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(str((i, *expected(library, t))) for i, t, *_ in awkward_rows)
    back = b.decoded(b.encoded(awkward)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t, *_ in awkward_rows)
    assert b.encoded(nothing).collect() == []
