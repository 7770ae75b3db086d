"""Byte-level BPE by a minimal acyclic transducer of the frequent words.

Lexicon. The words of all texts (as the vocabulary's pattern cuts them) are counted, and the frequent ones, at most
`LEXICON_WORDS` of at most `WORD_BYTES` bytes, are merged once and compiled, in order, into the least automaton that
accepts them: equal endings are one state. Every arc has an output, the words that sort before those behind it; the
outputs on a word's way add up to its number, and the number leads to its ids. The automaton is a flat file that Spark
hands to every executor once, where all workers map the same pages.

Encoding. A worker walks the distinct words of a batch through the automaton all together, one byte a step. Words that
it does not accept are merged exactly, least rank first and leftmost among equals: short ones all together, one merge a
step, long ones by a heap. Which words are in the lexicon changes the time only, never an id. Decoding joins the bytes of the ids.

Defined results: null and empty texts have no tokens and decode to the empty text; the strings of the file's special
tokens are one token each, wherever they stand; repeated rows and null ids are rows like any other; an empty table gives
no rows; further columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from mmap import ACCESS_READ, mmap

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import CACHE_ENTRIES, id_and_text, per_batch, stored
from tallyward.sources.shared import shared_folder

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: Bounds of the lexicon: it is collected and compiled by the driver.
LEXICON_WORDS = 131_072
WORD_BYTES = 64
#: Rows and bytes of text that are words at a time: the more, the fewer words are looked up twice.
ROWS, BYTES = 2_500, 5_000_000
#: Words of up to so many bytes are merged together, one merge of each a step; others one by one, by a heap.
SHORT = 24
#: Bits of an id in a number that holds two of them.
BITS = 20
MASK = (1 << BITS) - 1
NEVER = 1 << 62
#: Fixed value: the word pattern of byte-level vocabularies.
PATTERN = r" ?\p{L}+| ?\p{N}+|'(?:[sdmt]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: First and last letters and numbers of newer Unicode versions than the public tokenizer knows; it takes them as signs.
NEWER_RANGES = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
NEWER = frozenset(chr(c) for first, last in NEWER_RANGES for c in range(first, last + 1))
WORDS = regex.compile(PATTERN)


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a vocabulary file: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file."""

    def __init__(self, file: bytes) -> None:
        read = json.loads(file)
        model, cut = read["model"], read["pre_tokenizer"] or {}
        plain = not read["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("only byte-level BPE vocabularies without rewriting are read")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in read["added_tokens"]):
            raise ValueError("added tokens that take part of their surroundings are not read")
        signs = byte_signs()
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.bytes_of = {i: bytes(signs[c] for c in token) for token, i in model["vocab"].items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        ids = model["vocab"]
        self.single = [0] * 256
        for sign, b in signs.items():
            self.single[b] = ids[sign]
        if max(ids.values(), default=0) > MASK:
            raise ValueError("the vocabulary has too many tokens")
        self.merges = {}  # both ids in one number: the rank and the new id in one number, so the least is the next
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a] << BITS | ids[b]] = rank << BITS | ids[a + b]
        keys = sorted(self.merges) or [-1]
        self.pairs, self.ranked = np.array(keys, np.int64), np.array([self.merges.get(k, NEVER) for k in keys], np.int64)
        self.single_ids = np.array(self.single, np.int64)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def merged(self, word: bytes) -> list[int]:
        """The ids of a word: merges by rank, then from the left."""
        return np.frombuffer(self.merged_all([word])[0], np.uint32).tolist()

    def merged_all(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, 4 bytes each, all merged together: the short ones one merge a step in a matrix with a word in each row."""
        out: list = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for least, most in ((0, 8), (8, 14), (14, SHORT)):
            places = np.flatnonzero((lengths > least) & (lengths <= most)) if least else np.flatnonzero(lengths <= most)
            if len(places):
                for place, ids in zip(places.tolist(), self._merged_matrix([words[p] for p in places.tolist()], lengths[places], most), strict=True):
                    out[place] = ids
        for place in np.flatnonzero(lengths > SHORT).tolist():
            out[place] = np.array(self._merged_long(words[place]), np.uint32).tobytes()
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What `merges` has for pairs of ids, `NEVER` if nothing or if there is no right id."""
        pair = left << BITS | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((right >= 0) & (self.pairs[at] == pair), self.ranked[at], NEVER)

    def _merged_matrix(self, words: list[bytes], lengths: np.ndarray, width: int) -> list[bytes]:
        columns = np.arange(width)
        filled = columns < lengths[:, None]
        ids = np.full((len(words), width), -1, np.int64)
        ids[filled] = self.single_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width), NEVER, np.int64)  # of each id with the one after it
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        done, row = ids.copy(), np.arange(len(words))
        while len(row):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            more = best != NEVER
            done[row[~more]] = ids[~more]
            ids, ranks, row, at, best = ids[more], ranks[more], row[more], at[more], best[more]
            if not len(row):
                break
            here, new = np.arange(len(row)), best & MASK
            source = np.minimum(columns + (columns > at[:, None]), width - 1)  # what is right of the merged pair moves up
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[:, -1], ranks[:, -1] = -1, NEVER
            ids[here, at] = new
            after = np.where(at + 1 < width, ids[here, np.minimum(at + 1, width - 1)], -1)
            ranks[here, at] = self._ranks(new, after)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self._ranks(ids[inner, at[inner] - 1], new[inner])
        flat, ends = done[done >= 0].astype(np.uint32).tobytes(), (4 * np.cumsum((done >= 0).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merged_long(self, word: bytes) -> list[int]:
        known = self.merges.get
        ids: list[int] = [self.single[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs = [a << BITS | b for a, b in zip(ids, ids[1:], strict=False)]
        heap = [(self.merges[p], i, p) for i, p in enumerate(pairs) if p in self.merges]
        heapify(heap)
        while heap:
            best, i, pair = heappop(heap)
            j = after[i]
            if j >= len(ids) or ids[i] < 0 or ids[i] << BITS | ids[j] != pair:  # one of the two has been merged since
                continue
            ids[i], ids[j] = new, _ = best & MASK, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                if (found := known(pair := new << BITS | ids[k])) is not None:
                    heappush(heap, (found, i, pair))
            if (h := before[i]) >= 0 and (found := known(pair := ids[h] << BITS | new)) is not None:
                heappush(heap, (found, h, pair))
        return [i for i in ids if i >= 0]

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is one word, and no other word is written like it."""
        if not any(token in text for token in self.special):
            return words_between(text)
        parts = self.cut.split(text)
        return [w for n, part in enumerate(parts) for w in ([part] if n % 2 else words_between(part))]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


AS_SIGNS = dict.fromkeys(map(ord, NEWER), "§")


def has_newer(text: str) -> bool:
    """Whether a text has a letter or number that the public tokenizer does not know; most have only older ones."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not NEWER.isdisjoint(text)
    return False


def words_between(text: str) -> list[str]:
    """The words of a text without special tokens."""
    if not has_newer(text):
        return WORDS.findall(text)
    at, out = 0, []
    for match in WORDS.finditer(text.translate(AS_SIGNS)):  # cut as if they were signs, taken from the text itself
        out.append(text[at : match.end()])
        at = match.end()
    return out


# -- the automaton -----------------------------------------------------------


def compiled(words: dict[bytes, bytes]) -> bytes:
    """The file of the least automaton that accepts the words, with their ids, 4 bytes each."""
    states: dict[tuple, int] = {}
    counts: list[int] = []  # words that a state accepts
    keys, targets, outputs, final = [], [], [], []

    def frozen(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in states:
            state = states[key] = len(counts)
            passed = int(node[0])
            for byte, target in node[1]:
                keys.append(state << 8 | byte)
                targets.append(target)
                outputs.append(passed)
                passed += counts[target]
            counts.append(passed)
            final.append(node[0])
        return states[key]

    def fold(path: list, down_to: int) -> None:
        while len(path) > down_to + 1:
            node = path.pop()
            path[-1][1][-1] = (path[-1][1][-1][0], frozen(node))

    path: list = [[False, []]]
    before = b""
    ordered = sorted(words)
    for word in ordered:
        shared = next((i for i, (a, b) in enumerate(zip(before, word, strict=False)) if a != b), min(len(before), len(word)))
        fold(path, shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0], before = True, word
    fold(path, 0)
    frozen(path[0])
    ids = [words[w] for w in ordered]
    columns = [
        np.array(keys, np.uint32), np.array(targets, np.uint32), np.array(outputs, np.uint32), np.array(final, np.uint32),
        np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.uint32), np.frombuffer(b"".join(ids), np.uint32),
    ]
    return np.array([len(c) for c in columns], np.uint32).tobytes() + b"".join(c.tobytes() for c in columns)


class Lexicon:
    """A compiled automaton, mapped from its file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.map = mmap(file.fileno(), 0, access=ACCESS_READ)
        numbers = np.frombuffer(self.map, np.uint32)
        ends = np.cumsum([6, *numbers[:6].tolist()])
        self.keys, self.targets, self.outputs, self.final, self.starts, _ = (numbers[a:b] for a, b in zip(ends, ends[1:], strict=False))
        self.ids_at = int(ends[-2])
        self.root = len(self.final) - 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 of those that are not in the lexicon."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters, begins = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths
        out = np.full(len(words), -1, np.int64)
        alive = np.flatnonzero(lengths <= WORD_BYTES)
        state, number, step = np.full(len(alive), self.root, np.uint32), np.zeros(len(alive), np.int64), 0
        while len(alive):
            ended = lengths[alive] == step
            good = ended & (self.final[state] > 0)
            out[alive[good]] = number[good]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
            if not len(alive) or not len(self.keys):
                break
            wanted = state << np.uint32(8) | letters[begins[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            on = self.keys[arc] == wanted
            alive, arc = alive[on], arc[on]
            state, number, step = self.targets[arc], number[on] + self.outputs[arc], step + 1
        return out

    def ids_of(self, numbers: np.ndarray) -> list[bytes]:
        """The ids of the words with these numbers; of -1, any."""
        first, last = (4 * (self.ids_at + self.starts[n].astype(np.int64)) for n in (numbers, numbers + 1))
        return [self.map[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]


class Encoder:
    """Vocabulary and lexicon of one worker, and the merged words it keeps."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.merged: dict[str, bytes] = {}

    def _merged(self, words: list[str]) -> list[bytes]:
        """The ids of words that are not in the lexicon."""
        new = [w for w in words if w not in self.merged]
        if len(self.merged) + len(new) > CACHE_ENTRIES:
            self.merged.clear()
            new = words
        known = dict(zip(new, self.vocabulary.merged_all([w.encode() for w in new]), strict=True))
        for word in self.vocabulary.special.keys() & known.keys():
            known[word] = np.array([self.vocabulary.special[word]], np.uint32).tobytes()
        self.merged.update((w, ids) for w, ids in known.items() if len(w) <= WORD_BYTES)
        return [known[w] if w in known else self.merged[w] for w in words]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.vocabulary.words(text) for text in texts]
        words = list(set(chain.from_iterable(split)))
        numbers = self.lexicon.numbers([w.encode() for w in words])
        ids = dict(zip(words, self.lexicon.ids_of(numbers), strict=True))
        other = [words[at] for at in np.flatnonzero(numbers < 0).tolist()]
        ids.update(zip(other, self._merged(other), strict=True))
        return [np.frombuffer(b"".join(map(ids.__getitem__, s)), np.int32) for s in split]


@lru_cache(maxsize=2)
def vocabulary_of(file: bytes) -> Vocabulary:
    return Vocabulary(file)


@lru_cache(maxsize=2)
def encoder_of(file: bytes, name: str) -> Encoder:
    """One per worker, vocabulary and lexicon."""
    return Encoder(vocabulary_of(file), Lexicon(SparkFiles.get(name)))


# -- Spark -------------------------------------------------------------------


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of all words of at most `WORD_BYTES` bytes in the column `text` that occur more than once.

    Counted by Spark itself; its pattern knows other Unicode versions, which changes the choice of words only.
    """
    words = rows.select(F.explode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("word"))
    counts = words.filter(F.octet_length("word") <= WORD_BYTES).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


def frequent_words(counts: DataFrame, limit: int) -> list[str]:
    """At most `limit` words, all of the higher powers of two of frequency and, of the last one, those with the least hashes."""
    counts = stored(counts.withColumn("bits", F.length(F.bin("n"))))
    sizes = sorted(((r.bits, r["count"]) for r in counts.groupBy("bits").count().collect()), reverse=True)  # 63 rows at most
    room, wanted = limit, F.lit(False)
    for bits, size in sizes:
        share = min(1.0, 0.95 * room / size) if size > room else 1.0
        wanted = wanted | ((F.col("bits") == bits) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
        room -= size
        if room <= 0:
            break
    return [r.word for r in counts.filter(wanted).select("word").limit(limit).collect()]


def shared_file(spark: SparkSession, content: bytes) -> str:
    """Gives a file to all executors, now and later ones; returns the name to find it by in tasks."""
    jvm, name = spark._jvm, f"tallyward-{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(content))
    out.close()
    spark.sparkContext.addFile(path)
    return name


def with_lexicon(rows: DataFrame, vocabulary: bytes, limit: int = LEXICON_WORDS) -> str:
    """Compiles the frequent words of the column `text` and hands them out; returns the file's name."""
    own = Vocabulary(vocabulary)
    words = frequent_words(word_counts(rows), limit)
    coded = [w.encode() for w in words]
    return shared_file(rows.sparkSession, compiled(dict(zip(coded, own.merged_all(coded), strict=True))))


def encoded(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Ids of each text, their number, and the text they decode to."""
    with open(model, "rb") as file:  # a vocabulary of a fixed size, read once by the driver
        vocabulary = file.read()
    rows = id_and_text(docs, doc_id, text)
    name = with_lexicon(rows, vocabulary, lexicon_words)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            start = 0
            while start < len(sizes):
                fit = int(np.searchsorted(np.cumsum(sizes[start : start + ROWS]), BYTES, "right"))
                yield make(batch.slice(start, max(1, fit)))
                start += max(1, fit)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder_of(shared.value, name)
        ids = own.encode_batch(batch.column(1).to_pylist())
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        back = [own.vocabulary.decode(i.tolist()) for i in ids]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(map(len, ids), pa.int64()), pa.array(back, pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, decoded string")


def decoded(rows: DataFrame, model: str = MODEL, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of ids; null ids give the empty text."""
    with open(model, "rb") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = vocabulary_of(shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{ids}`").alias("ids")).mapInArrow(per_batch(make), "doc_id long, text string")


def encoding_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document the number of its tokens and digests of its ids and of the text they decode to."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded(docs, model).select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
