"""Exact duplicates by a cuckoo-filter index of digests.

Each task feeds the digests of its rows to an index: two 4-slot buckets per digest hold 16-bit fingerprints, and a
fingerprint that matches is verified against the full digest in the same slot. The groups a task has found are dealt by
digest and merged by a second index, so a text that a third of all rows share reaches one task only once per input task.
Those rows come in the order of their digests, so an index is put out when it is full and never holds more than
`HELD_DIGESTS`, however many a task has.

Defined results: a null text is an empty text, and all empty texts are equal; a null id is smaller than any other; rows
repeated with the same id and equal text are one document, all of them carry `kept` = true, and
`drop_exact_duplicates` returns one of them; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import ascii_lower, id_and_text, parted, stored, text_of, wide_parts

SLOTS = 4
KICKS = 200
#: Digests that an index holds before it is put out.
HELD_DIGESTS = 200_000
GROUP_SCHEMA = "digest binary, keep_id long, keep_copies long, group_size long"


class CuckooIndex:
    """Live digests and a value for each; a digest can be inserted, looked up, changed and deleted."""

    def __init__(self, buckets: int = 1024) -> None:
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = [0] * (buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list[list | None] = [None] * (buckets * SLOTS)
        self.size = 0

    def _mark(self, key: bytes) -> int:
        return int.from_bytes(key[:2], "little") or 1

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _find(self, key: bytes) -> int:
        mark = self._mark(key)
        bucket = int.from_bytes(key[2:8], "little") & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.keys[slot] == key:  # the mark may be another key's
                    return slot
        return -1

    def get(self, key: bytes) -> list | None:
        slot = self._find(key)
        return None if slot < 0 else self.values[slot]

    def delete(self, key: bytes) -> bool:
        """Frees the slot of a live digest; false if there is none."""
        slot = self._find(key)
        if slot < 0:
            return False
        self.marks[slot], self.keys[slot], self.values[slot] = 0, None, None
        self.size -= 1
        return True

    def insert(self, key: bytes, value: list) -> None:
        """Adds a digest that is not live yet."""
        while (left := self._place(key, value)) is not None:
            key, value = left
            self._grow()
        self.size += 1

    def _place(self, key: bytes, value: list) -> tuple[bytes, list] | None:
        """Puts the entry into one of its buckets, moving others; the entry left over after too many moves."""
        mark = self._mark(key)
        bucket = int.from_bytes(key[2:8], "little") & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.keys[slot], self.values[slot] = mark, key, value
                    return None
        for kick in range(KICKS):
            victim = bucket * SLOTS + (kick + mark) % SLOTS
            mark, self.marks[victim] = self.marks[victim], mark
            key, self.keys[victim] = self.keys[victim], key
            value, self.values[victim] = self.values[victim], value
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.keys[slot], self.values[slot] = mark, key, value
                    return None
        return key, value

    def _grow(self) -> None:
        """Twice the buckets or more, filled again from the stored keys."""
        entries, buckets = list(self.items()), self.mask + 1
        while True:
            buckets *= 2
            self._empty(buckets)
            if all(self._place(key, value) is None for key, value in entries):
                self.size = len(entries)
                return

    def items(self) -> Iterator[tuple[bytes, list]]:
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of this task's rows: digest, largest id, its rows, all rows.

    A full index is put out where a digest begins that it does not hold. If rows come in the order of their digests, a
    digest that was put out does not come again; else its parts are merged later.
    """
    index = CuckooIndex()
    for batch in batches:
        for key, keep, copies, size in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            seen = index.get(key)
            if seen is None:
                if index.size >= HELD_DIGESTS:
                    yield from _entries(index)
                    index = CuckooIndex()
                index.insert(key, [keep, copies, size])
                continue
            seen[2] += size
            if keep == seen[0]:
                seen[1] += copies
            elif seen[0] is None or keep is not None and keep > seen[0]:
                seen[:2] = keep, copies
    yield from _entries(index)


def _entries(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    entries = list(index.items())
    for start in range(0, len(entries), 10_000):
        part = entries[start : start + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in part], pa.binary()), *(pa.array([v[i] for _, v in part], pa.int64()) for i in range(3))],
            ["digest", "keep_id", "keep_copies", "group_size"],
        )


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests with a positive balance of insertions and deletions, of rows in the order of their digests."""

    def out() -> pa.RecordBatch:
        live = [(k, v[0]) for k, v in index.items() if v[0] > 0]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in live], pa.binary()), pa.array([n for _, n in live], pa.int64())], ["digest", "live"])

    index = CuckooIndex()
    for batch in batches:
        for key, change in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            seen = index.get(key)
            if seen is None:
                if index.size >= HELD_DIGESTS:
                    yield out()
                    index = CuckooIndex()
                index.insert(key, [change])
            else:
                seen[0] += change
                if not seen[0]:
                    index.delete(key)
    yield out()


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and SHA-256 of each row's text, A-Z in lower case."""
    rows = id_and_text(docs, doc_id, text)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(ascii_lower(F.col("text")), 256)).alias("digest"))


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: its digest, the largest id, the rows with that id, all its rows."""
    one = F.lit(1).cast("long")
    rows = digests(docs, doc_id, text).select("digest", F.col("doc_id").alias("keep_id"), one.alias("keep_copies"), one.alias("group_size"))
    found = rows.mapInArrow(_merge, GROUP_SCHEMA)
    return found.repartition(wide_parts(docs.sparkSession), "digest").sortWithinPartitions("digest").mapInArrow(_merge, GROUP_SCHEMA)


def live_digests(added: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct texts that are left, with their rows, when the rows of one table are deleted from those of another."""
    changes = digests(added, doc_id, text).select("digest", F.lit(1).alias("change"))
    changes = changes.unionByName(digests(removed, doc_id, text).select("digest", F.lit(-1).alias("change")))
    summed = changes.groupBy("digest").agg(F.sum("change").alias("change"))
    return summed.repartition(wide_parts(added.sparkSession), "digest").sortWithinPartitions("digest").mapInArrow(_live, "digest binary, live long")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: the id that stays of its group, the group's rows, whether it stays, and the digest."""
    groups = duplicate_groups(docs, doc_id, text)
    rows = digests(docs, doc_id, text).join(groups, "digest")
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever these are called.

    Whole rows are shuffled only where their text may be one that repeats.
    """
    groups = stored(duplicate_groups(docs, doc_id, text).filter("group_size > 1"))
    digest = F.unhex(F.sha2(ascii_lower(text_of(text)), 256))
    rows = docs.select(F.struct("*").alias("whole"), F.col(f"`{doc_id}`").cast("long").alias("id"), digest.alias("digest"))
    wanted = F.col("id").eqNullSafe(F.col("keep_id"))
    perhaps, others = parted(rows, groups, "digest")
    single = perhaps.join(groups, "digest", "left").filter(F.col("group_size").isNull() | (wanted & (F.col("keep_copies") == 1)))
    left = others.select("whole.*").unionByName(single.select("whole.*"))
    several = stored(groups.filter("keep_copies > 1"))
    if several.isEmpty():
        return left
    perhaps, _ = parted(rows, several, "digest")
    repeated = perhaps.join(several, "digest").filter(wanted).dropDuplicates(["digest"])
    return left.unionByName(repeated.select("whole.*"))
