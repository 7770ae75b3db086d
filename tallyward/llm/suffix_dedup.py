"""Repeated byte strings by induced sorting of suffix arrays, shard by shard.

Wanted are the bytes covered by a string of `LENGTH` bytes that starts anywhere else in the table. One suffix array of
all texts cannot be built in one place, and most of it is not needed, so suffixes are classified first: in every window
of LENGTH bytes the leftmost 32 bytes of the least hash are its anchor. Equal windows have equal anchors at equal
distances, so a suffix has to be compared with suffixes of the same anchor only, and an anchor that occurs once needs no
sorting at all. Occurrences with equal surroundings are counted, not sorted: all their windows are repeated.

The rest is dealt to shards by anchor. A shard sorts its suffixes that begin at anchors, by stable passes over their
bytes from last to first, and takes the common prefix of each with the one before it. The arrays of the suffixes one,
two, ... bytes further left are then induced: a stable pass over the byte in front turns the order of one array into that
of the next. Suffixes with LENGTH equal bytes are neighbours; they are told by the bytes passed so far and the common
prefixes, permuted back to the occurrences. Every pass is linear.

An anchor with more than max(`HOT_ROWS`, a ten-thousandth of all occurrences) goes to no shard: its windows are counted by
their hashes, with sums before the shuffle.

Defined results: a null text is an empty text; texts shorter than LENGTH bytes keep everything; rows repeated with equal
text remove each other's bytes; rows with a null id are kept apart by their text; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import id_and_text, mixed, per_batch, stored, wide_parts

LENGTH = 200
GRAM = 32
HOT_ROWS = 100_000
#: Bytes of a text that are searched at once; longer ones are searched piece by piece, with the overlap of a window.
PIECE = 1 << 23
PLACE_BITS = 24
SHARD_ROWS = 20_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes at each place."""
    found, power, width = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while width < GRAM:
        found = found[:-width] * np.uint64(power) + found[width:]
        power, width = power * power % (1 << 64), width * 2
    return mixed(found)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(text: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(hash of the anchor, first window, windows, distance of the anchor from the first) of each run of windows."""
    data, place = np.frombuffer(text, np.uint8), np.uint64((1 << PLACE_BITS) - 1)
    for base in range(0, len(data) - length + 1, PIECE):
        hashes = gram_hashes(data[base : base + PIECE + length - 1])
        packed = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        at = (sliding_min(packed, length - GRAM + 1) & place).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        count = np.diff(np.append(first, len(at)))
        where = at[first]
        yield from zip(hashes[where].view(np.int64).tolist(), (first + base).tolist(), count.tolist(), (where - first).tolist(), strict=True)


def _occurrences(length: int):
    """Every anchor of each text, with a hash of all bytes of its windows."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for key, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            whole = memoryview(data)
            out += ((h, xxhash.xxh64_intdigest(whole[lo : lo + n + length - 1], d) - (1 << 63), key, mark, lo, n, d) for h, lo, n, d in anchors(data, length))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "around", "k", "mark", "lo", "n", "d"])

    return per_batch(make)


def repeated_windows(rows: list[tuple[bytes, int, int]], length: int) -> np.ndarray:
    """For rows (bytes of all windows, windows, distance of the anchor from the first), the windows that another row has
    at the same distance before the same anchor: an array of rows by distance."""
    count, deepest = len(rows), max(d for _, _, d in rows)
    right, left = np.zeros((count, length), np.uint8), np.zeros((count, deepest + 1), np.uint8)
    for i, (data, _, d) in enumerate(rows):
        own = np.frombuffer(data, np.uint8)
        right[i, : len(own) - d] = own[d : d + length]
        left[i, 1 : d + 1] = own[:d][::-1]
    far = np.array([d for _, _, d in rows])
    near = far - np.array([n for _, n, _ in rows]) + 1
    order = np.arange(count)
    for at in range(length - 1, -1, -1):
        order = order[np.argsort(right[order, at], kind="stable")]
    differ = right[order[1:]] != right[order[:-1]]
    common = np.append(-1, np.where(differ.any(1), differ.argmax(1), length))  # with the suffix before, at anchors
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    found = np.zeros((count, deepest + 1), bool)
    passed = np.zeros(count, np.int64)  # equal for rows with equal bytes between the anchor and here
    for d in range(deepest + 1):
        if d:
            order = order[far[order] >= d]
            order = order[np.argsort(left[order, d], kind="stable")]
            byte, before = left[order, d], passed[order]
            passed[order] = np.cumsum(np.append(True, (byte[1:] != byte[:-1]) | (before[1:] != before[:-1])))
        own = order[near[order] <= d]
        prefix = np.cumsum(common < length - d)[place[own]]
        same = np.flatnonzero((prefix[1:] == prefix[:-1]) & (passed[own][1:] == passed[own][:-1]))
        found[own[same], d] = True
        found[own[same + 1], d] = True
    return found


def _runs(marked: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last place of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True)


def _induced(length: int):
    """Covered stretches of the occurrences, from rows that arrive anchor by anchor."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        found = repeated_windows([(data, n, d) for *_, n, d, _, data in rows], length)
        for i, (_, key, mark, lo, _, d, counted, _) in enumerate(rows):
            if not counted:
                out += ((key, mark, lo + d - high, lo + d - low + length) for low, high in _runs(found[i]))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "mark", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(rows) >= SHARD_ROWS and row[0] != rows[-1][0]:
                    yield shard(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield shard(rows)

    return run


STRETCH = "k long, mark long, start long, end long"
WANTED = "h long, k long, mark long, lo int, n int, d int, counted boolean"


def _cut(length: int):
    """The bytes of the wanted occurrences of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, mark, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                out += ((w["h"], key, mark, w["lo"], w["n"], w["d"], w["counted"], data[w["lo"] : w["lo"] + w["n"] + length - 1]) for w in wanted)
            for at in range(0, len(out), 50_000):
                columns = zip(*out[at : at + 50_000], strict=True)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "k", "mark", "lo", "n", "d", "counted", "data"])

    return run


def _window_hashes(length: int):
    """Every window of the occurrences of a hot anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, key, mark, lo, n, d, _, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += ((h, xxhash.xxh64_intdigest(data[i : i + length], d - i) - (1 << 63), key, mark, lo + i) for i in range(n))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["h", "window", "k", "mark", "start"])

    return run


def _marked(found: DataFrame, counts: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences of repeated anchors, with `counted` (another one has the same surroundings) and `wanted` (one of each
    of several surroundings); those of hot anchors apart."""
    same = Window.partitionBy("h", "around")
    rows = found.join(F.broadcast(hot), "h", "left_anti").join(counts, "h")
    rows = rows.withColumns({"same": F.count("*").over(same), "number": F.row_number().over(same.orderBy("k", "mark", "lo"))})
    usual = rows.select("k", "mark", "lo", "n", "d", "h", (F.col("same") > 1).alias("counted"), ((F.col("number") == 1) & (F.col("same") < F.col("n_h"))).alias("wanted"))
    rows = found.join(F.broadcast(hot), "h", "left_semi")
    groups = rows.groupBy("h", "around").agg(F.count("*").alias("same"), F.min(F.struct("k", "mark", "lo")).alias("one"))
    rows = rows.join(groups, ["h", "around"])
    very = rows.select("k", "mark", "lo", "n", "d", "h", (F.col("same") > 1).alias("counted"), (F.struct("k", "mark", "lo") == F.col("one")).alias("wanted"))
    return usual, very


def _bytes_of(texts: DataFrame, marked: DataFrame, length: int) -> DataFrame:
    wanted = marked.filter("wanted").groupBy("k", "mark").agg(F.collect_list(F.struct("h", "lo", "n", "d", "counted")).alias("wanted"))  # of one text
    return texts.join(wanted, ["k", "mark"]).select("k", "mark", "text", "wanted").mapInArrow(_cut(length), f"{WANTED}, data binary")


def repeated_stretches(texts: DataFrame, length: int = LENGTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stretches (k, mark, start, end) of texts (k, mark, text) that repeated windows cover; they may overlap."""
    found = stored(texts.mapInArrow(_occurrences(length), "h long, around long, k long, mark long, lo int, n int, d int"))
    counts = stored(found.groupBy("h").agg(F.count("*").alias("n_h")).filter("n_h > 1"))
    limit = max(hot_rows, found.count() // 10_000)
    hot = counts.filter(F.col("n_h") > limit).select("h")  # at most 10,000 rows, by the limit
    usual, very = _marked(found, counts.filter(F.col("n_h") <= limit), hot)
    usual = stored(usual.filter("counted or wanted"))
    stretch = lambda marked: marked.filter("counted").select("k", "mark", F.col("lo").cast("long").alias("start"), (F.col("lo") + F.col("n") - 1 + length).cast("long").alias("end"))
    shards = _bytes_of(texts, usual, length).repartition(wide_parts(texts.sparkSession), "h").sortWithinPartitions("h")
    out = stretch(usual).unionByName(shards.mapInArrow(_induced(length), STRETCH))
    if not hot.isEmpty():
        very = stored(very.filter("counted or wanted"))
        windows = stored(_bytes_of(texts, very, length).mapInArrow(_window_hashes(length), "h long, window long, k long, mark long, start long"))
        twice = windows.groupBy("h", "window").agg(F.count("*").alias("times")).filter("times > 1").select("h", "window")
        twice = windows.join(twice, ["h", "window"]).select("k", "mark", "start", (F.col("start") + length).alias("end"))
        out = out.unionByName(stretch(very)).unionByName(twice)
    return out


def _rest(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What is left of each text without its stretches."""
    out = []
    for doc_id, text, stretches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        data = text.encode("utf-8", "surrogatepass")
        spans: list[list[int]] = []
        for start, end in sorted((s["start"], s["end"]) for s in stretches or ()):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(end, spans[-1][1])
            else:
                spans.append([start, end])
        digest, at = hashlib.sha256(), 0
        for start, end in spans:
            digest.update(data[at:start])
            at = end
        digest.update(data[at:])
        out.append((doc_id, len(data), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), [i for s in spans for i in s]))
    columns = list(zip(*out, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def without_repeats(docs: DataFrame, length: int = LENGTH, hot_rows: int = HOT_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its bytes, the removed ones, their maximal runs, the digest of the rest, and the ends of the runs."""
    rows = id_and_text(docs, doc_id, text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("k"), F.xxhash64(F.lit(1), "text").alias("mark"), "text"  # 128 bits tell id and text
    )
    stretches = repeated_stretches(rows.select("k", "mark", "text"), length, hot_rows)
    stretches = stretches.groupBy("k", "mark").agg(F.collect_set(F.struct("start", "end")).alias("stretches"))  # of one text
    rows = rows.join(stretches, ["k", "mark"], "left").select("doc_id", "text", "stretches")
    return rows.mapInArrow(per_batch(_rest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")
