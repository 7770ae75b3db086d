"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over neighbouring words: the words under a 1 are hashed, those under a 0 may differ. The masks
below hit every stretch of at least 13 words with any quarter of them substituted (13 with 3, 16 with 4, 20 with 5 and 24
with 6 are tried in the tests; a longer one has a half that is no worse). An item of fewer words is cut into one piece
more than words may differ, and a hit is any whole piece. Seeds of the benchmark are joined with the seeds of every
document; each hit names an item and an alignment, and the words of the whole item are compared along it. A document is
contaminated if an alignment holds a stretch of at least 13 words (or the whole item, if it is shorter) with at most a
quarter of them substituted.

The benchmark is the stated query set. It is cut into blocks of about `block_items` items by a hash of the item, and every
block is joined with all documents where they are read, so documents are not shuffled and what is broadcast is bounded
by the block.

Words are runs of letters, digits and underscores, in lower case. Defined results: null and empty texts hold nothing;
null or empty items match nothing; equal items are each reported; repeated documents are each reported; an empty
benchmark contaminates nothing; an empty table gives no rows; further columns are kept by `drop_contaminated` only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import WordHashes, id_and_text, mixed, per_batch

MASKS = ("111011", "110111", "1100001011", "11110001")
RUNS = ("1", "11", "111")  # the pieces of items of fewer than LEAST_WORDS words
LEAST_WORDS = 13
BLOCK_ITEMS = 20_000
WORD = re.compile(r"\w+")
FILTER_BITS = 20


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    return known.of([w.encode() for w in WORD.findall(text.lower())])


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed that begins at each word."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    found = np.full(count, (MASKS + RUNS).index(mask), np.uint64)
    for at, used in enumerate(mask):
        if used == "1":
            found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[at : at + count]
    return mixed(found)


def longest_stretch(same: np.ndarray) -> int:
    """Length of the longest stretch with at most a quarter of its words unequal."""
    steps = np.concatenate([[0], np.cumsum(np.where(same, 1, -3))])
    first = np.searchsorted(-np.minimum.accumulate(steps), -steps)  # the first place that is not higher than this one
    return int((np.arange(len(steps)) - first).max())


def pieces(count: int) -> tuple[str, list[int]]:
    """For an item of so many words, fewer than LEAST_WORDS: the run that is hashed, and its places. One of them stays whole."""
    parts = count // 4 + 1
    return RUNS[count // parts - 1], [i * (count // parts) for i in range(parts)]


class Items:
    """The words and seeds of a block of the benchmark."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        known = WordHashes()
        rows = [(i, w) for i, t in rows if len(w := word_hashes(t or "", known))]
        self.ids, self.words = [i for i, _ in rows], [w for _, w in rows]
        self.masks = set()
        keys, items, places = [], [], []
        for at, words in enumerate(self.words):
            run, begins = pieces(len(words)) if len(words) < LEAST_WORDS else ("", [])
            for mask in [run] if run else MASKS:
                own = seeds(words, mask)
                begin = np.array(begins) if run else np.arange(len(own))
                self.masks.add(mask)
                keys.append(own[begin])
                items.append(np.full(len(begin), at))
                places.append(begin)
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.items, self.places = (np.concatenate(x)[order] if keys else np.empty(0, int) for x in (items, places))
        self.present = np.zeros(1 << FILTER_BITS, bool)
        self.present[self.keys & np.uint64((1 << FILTER_BITS) - 1)] = True

    def found_in(self, words: np.ndarray) -> dict[int, int]:
        """Items in a document, each with the words of its longest stretch."""
        aligned = set()
        for mask in sorted(self.masks):
            own = seeds(words, mask)
            near = np.flatnonzero(self.present[own & np.uint64((1 << FILTER_BITS) - 1)])
            if not len(near):
                continue
            low, high = (np.searchsorted(self.keys, own[near], side) for side in ("left", "right"))
            for at, a, b in zip(near[low < high], low[low < high], high[low < high], strict=True):
                aligned.update((int(self.items[k]), int(at - self.places[k])) for k in range(a, b))
        found: dict[int, int] = {}
        for item, start in aligned:
            own = self.words[item]
            first, last = max(0, start), min(len(words), start + len(own))
            if last - first < min(LEAST_WORDS, len(own)):
                continue
            longest = longest_stretch(words[first:last] == own[first - start : last - start])
            if longest >= min(LEAST_WORDS, len(own)):
                found[item] = max(found.get(item, 0), longest)
        return found


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_items: int) -> Iterator:
    """Broadcasts of the benchmark's blocks, one at a time; each holds a bounded share of the items."""
    rows = id_and_text(benchmark, item_id, text)
    count = max(1, -(-rows.count() // block_items))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)))
    for block in range(count):
        own = rows.filter(F.col("block") == block).select("doc_id", "text").collect()  # about block_items rows
        yield benchmark.sparkSession.sparkContext.broadcast(Items([tuple(r) for r in sorted(own, key=lambda r: (r[0] is None, r[0], r[1]))]))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """For each document: whether it is contaminated, the ids of the items it holds, and the longest stretch in words."""
    rows = id_and_text(docs, doc_id, text).withColumns({"item_ids": F.array().cast("array<long>"), "longest": F.lit(0).cast("long")})
    schema = rows.schema
    for items in _blocks(benchmark, item_id, item_text, block_items):

        def make(batch: pa.RecordBatch, items=items) -> pa.RecordBatch:
            known, ids, longest = WordHashes(), [], []
            for body, before, most in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                found = items.value.found_in(word_hashes(body, known))
                ids.append(sorted([*before, *(items.value.ids[i] for i in found)], key=lambda i: (i is None, i)))
                longest.append(max([most, *found.values()]))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int64())), pa.array(longest, pa.int64())], ["doc_id", "text", "item_ids", "longest"])

        rows = rows.mapInArrow(per_batch(make), schema)
    return rows.select("doc_id", (F.col("longest") > 0).alias("contaminated"), "item_ids", "longest")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    at, schema = docs.columns.index(text), docs.schema
    for items in _blocks(benchmark, item_id, item_text, block_items):

        def make(batch: pa.RecordBatch, items=items) -> pa.RecordBatch:
            known = WordHashes()
            return batch.filter(pa.array([not items.value.found_in(word_hashes(t or "", known)) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(per_batch(make), schema)
    return docs
