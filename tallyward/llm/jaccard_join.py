"""Jaccard join of documents on word n-grams, by token-combination prefixes.

Sets. A document's set holds the 64-bit hashes of its distinct n-grams of words. Documents with equal sets are one node,
so copies cost no more than one.

Prefixes. If two sets of a and b hashes overlap in at least o, the a-o+k and b-o+k least hashes share at least k. Such
extended prefixes (`extension`) of all nodes are counted by hash, and a node stays only if its prefix shares enough
hashes with any others (`certain`). Of the few that stay, the whole sets are counted in the same way: what of a set no
other one has can be in no overlap, so a node that has too much of its own goes, and for the others the rest (`most`)
bounds every overlap. A bitmap of the set's hashes bounds it for every pair, since a bit that only one of two has stands
for a hash that only one has. Both bounds are exact, and nothing is dropped that could be linked.

Index. Since the prefix must share `certain` hashes, all but the most frequent certain-2 are enough to share two.
Hashes in buckets with few pairs are indexed alone; the frequent class, those with more than `PRODUCT`, in combinations
of two. A pair either shares a hash of the first kind or two of the second.

Verification. Links are only needed to find groups, so a bucket of the index first yields a star: each member with the
one of its size class that has the fewest hashes of its own. The pairs are verified on the whole sets and joined to
groups. What remains are buckets that hold several groups; of these, each member outside the bucket's largest group is
paired with those of other groups that both bounds allow. Bounds of all pairs of a bucket are products of small matrices,
so a pair that they rule out is never a row.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing; a text with
fewer words than n is one n-gram; equal sets are linked; rows repeated with the same id are one document with several
rows, and link what any of them is linked with; rows without an id link others like any row, and have the least id of
their group, null if none has an id; an empty table gives no rows; further columns are kept by `drop_near_duplicates`
only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyward.llm.common import ROWS_AT_ONCE, WordHashes, id_and_text, in_table, mixed, parted, spot_table, stored, wide_parts, words_of
from tallyward.llm.components import components

#: Pairs of a bucket, members times those outside its largest group, beyond which its hash is of the frequent class.
PRODUCT = 1_000_000
#: The prefix of a set is extended by so many hashes at least, and by one for so many of its hashes.
LEAST_EXTENSION, EXTENSION_PART = 16, 20
#: 64-bit words of a set's bitmap.
MAP_WORDS = 64
#: Members of a bucket that are compared at once, each with as many others.
TILE = 1_000
#: Buckets of a node up to which their keys are sent along.
KNOWN_KEYS = 64


def shingles(text: str, words_each: int, known: WordHashes) -> np.ndarray:
    """Distinct hashes of the n-grams of a text, in order."""
    words = known.of(words_of(text))
    if not len(words):
        return words
    count = max(1, len(words) - words_each + 1)
    found = np.zeros(count, np.uint64)
    for at in range(min(words_each, len(words))):
        found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[at : at + count]
    return np.unique(mixed(found + np.uint64(min(words_each, len(words)))))


def least_overlap(size: int, percent: int) -> int:
    """What a set must share with any set it is linked to; also the size of the smallest such set."""
    return -(-size * percent // 100)


def extension(size: int, percent: int) -> int:
    """By how many hashes the prefix of a set is extended; never more than it must share."""
    return min(least_overlap(size, percent), max(LEAST_EXTENSION, size // EXTENSION_PART))


def certain(size: int, percent: int) -> int:
    """How many hashes the prefixes of a set and of any set it is linked to share at least: the least extension of the
    two, which grows with the size, so that of the smallest linked set."""
    return extension(least_overlap(size, percent), percent)


def prefix_length(size: int, percent: int) -> int:
    return size - least_overlap(size, percent) + extension(size, percent)


def digest_of(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays).view(np.int64) if arrays else [], pa.int64()))


def _sets(words_each: int, percent: int):
    """Of each row the size of its set, a digest of it, and what of its prefix must be shared; and the prefix, but only
    where the task meets the set for the first time and the set can be linked to another one."""
    smallest = -(-percent // (100 - percent)) - 1  # sets below it are only linked if they are equal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        known = WordHashes()  # of the task: the worker that stays is to hold no more than it needs
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                sizes, marks, sure, prefixes = [], [], [], []
                for text in batch.column(3).to_pylist():
                    own = shingles(text, words_each, known)
                    mark = digest_of(own)
                    first = mark is not None and mark not in seen and len(own) >= smallest
                    if mark is not None:
                        seen.add(mark)
                    sizes.append(len(own))
                    marks.append(mark)
                    sure.append(certain(len(own), percent))
                    prefixes.append(own[: prefix_length(len(own), percent) if first else 0] >> np.uint64(16))
                columns = [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(sure, pa.int64()), _lists(prefixes)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "spot", "n", "mark", "sure", "prefix"])

    return run


def _whole_sets(words_each: int, bits):
    """(mark, hashes, bitmap) of the texts that the table of wanted ones lets through, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen, known = np.frombuffer(bits.value, np.uint8), set(), WordHashes()
        for whole in batches:
            hit = np.flatnonzero(in_table(wanted, whole.column(0).to_numpy()))
            for start in range(0, len(hit), ROWS_AT_ONCE):
                marks, sets, maps = [], [], []
                for text in whole.column(1).take(pa.array(hit[start : start + ROWS_AT_ONCE])).to_pylist():
                    own = shingles(text, words_each, known)
                    mark = digest_of(own)
                    if mark is not None and mark not in seen:
                        seen.add(mark)
                        marks.append(mark)
                        sets.append(own)
                        there = np.zeros(64 * MAP_WORDS, np.uint8)
                        there[(own % np.uint64(64 * MAP_WORDS)).astype(np.int64)] = 1
                        maps.append(np.packbits(there, bitorder="little").view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), _lists(sets), _lists(maps)], ["mark", "hashes", "map"])

    return run


def _alone(entries: DataFrame) -> DataFrame:
    """(node, alone): how many of its tokens no other node has. Tokens are counted before the shuffle."""
    own = entries.groupBy("token").agg(F.count("*").alias("df"), F.min("node").alias("node")).filter("df = 1")
    return own.groupBy("node").agg(F.count("*").alias("alone"))


def _candidates(texts: DataFrame, sets: DataFrame, nodes: DataFrame, words_each: int, percent: int) -> DataFrame:
    """(node, n, sure, most, hashes, map) of the nodes that may be linked to others."""
    copies = sets.select("row", "mark").join(nodes.filter("copies > 1").select("mark", "node"), "mark").filter("row != node").select("row")
    single = sets.filter(F.size("prefix") > 0).join(stored(copies), "row", "left_anti")
    alone = _alone(single.select(F.col("row").alias("node"), F.explode("prefix").alias("token")))
    about = sets.select(F.col("row").alias("node"), "n", "mark", "sure", "spot", F.size("prefix").alias("length")).filter("length > 0")
    plausible = about.join(alone, "node", "left").filter(F.col("length") - F.coalesce("alone", F.lit(0)) >= F.col("sure"))
    plausible = stored(plausible.join(nodes.select("node"), "node", "left_semi").select("node", "n", "mark", "sure", "spot"))
    spark = texts.sparkSession
    bits = spark.sparkContext.broadcast(spot_table(plausible))
    whole = texts.select("spot", "text").mapInArrow(_whole_sets(words_each, bits), "mark binary, hashes array<long>, map array<long>")
    whole = stored(whole.join(plausible.drop("spot"), "mark").dropDuplicates(["mark"]).drop("mark"))
    alone = _alone(whole.select("node", F.explode("hashes").alias("token")))
    bounded = whole.join(alone, "node", "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    return stored(bounded.filter(F.col("most") * 100 >= F.col("n") * percent))


def _index(found: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, most): the entries of each node's prefix that others share, without the most frequent certain - 2."""
    least = F.ceil(F.col("n") * percent / 100)
    length = F.col("n") - least + F.least(least, F.greatest(F.lit(LEAST_EXTENSION), F.floor(F.col("n") / EXTENSION_PART)))
    entries = found.select("node", "n", "most", "sure", F.explode(F.slice("hashes", F.lit(1), length.cast("int"))).alias("token"))
    counts = entries.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    own = Window.partitionBy("node")
    known = entries.join(counts, "token").withColumns({"rank": F.row_number().over(own.orderBy("df", "token")), "shared": F.count("*").over(own)})
    return known.filter((F.col("shared") >= F.col("sure")) & (F.col("rank") <= F.col("shared") - F.col("sure") + 2)).select("token", "node", "n", "most")


def _side(rows: DataFrame, side: str, *key: str) -> DataFrame:
    return rows.select(*key, *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in key])


def _fits(most: Column, percent: int) -> Column:
    """Whether sets a and b that overlap in `most` at most can be linked."""
    return most * 100 >= (F.col("n_a") + F.col("n_b") - most) * percent


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _stars(index: DataFrame, percent: int) -> DataFrame:
    """(a, b): every entry's node with the one of its bucket and size class that has the fewest hashes of its own: of
    near copies, the one with the fewest changes. Classes are cut at two offsets."""
    step = float(-np.log(percent / 100))
    place = F.log(F.col("n").cast("double")) / step
    rows = index.withColumn("class", F.explode(F.array(F.floor(place) * 2, F.floor(place + 0.5) * 2 + 1)))
    hub = F.min(F.struct((F.col("n") - F.col("most")).alias("own"), "node", "n", "most")).alias("hub")
    hubs = rows.groupBy("token", "class").agg(hub, F.count("*").alias("members")).filter("members > 1").select("token", "class", "hub.node", "hub.n", "hub.most")
    met = _side(rows, "b", "token", "class").join(_side(hubs, "a", "token", "class"), ["token", "class"])
    return _pairs(met.filter((F.col("node_a") != F.col("node_b")) & _fits(F.least("most_a", "most_b"), percent)))


def _mixed(entries: DataFrame) -> DataFrame:
    """Entries (key, node, group) of the buckets with several groups, whether they are of the largest group, how many are
    not, and the pairs that the bucket has across groups, at most."""
    sizes = entries.groupBy("key", "group").agg(F.count("*").alias("members"))
    total = F.sum("members")
    buckets = sizes.groupBy("key").agg(F.max_by("group", F.struct("members", "group")).alias("largest"), (total - F.max("members")).alias("outside"), total.alias("all"))
    rows = entries.join(buckets.filter("outside > 0"), "key")
    return rows.select("key", "node", "group", (F.col("group") == F.col("largest")).alias("inner"), "outside", (F.col("outside") * F.col("all")).alias("product"))


class Members:
    """Members of one bucket: their nodes, groups, sizes, bounds, bitmaps, and the keys of the buckets they are in."""

    def __init__(self, node, group, inner, n, most, maps, keys) -> None:
        self.node, self.group, self.inner, self.n, self.most, self.maps, self.keys = node, group, inner, n, most, maps, keys

    def part(self, rows: slice) -> Members:
        return Members(*(getattr(self, c)[rows] for c in MEMBER))

    @staticmethod
    def joined(parts: list[Members]) -> Members:
        return parts[0] if len(parts) == 1 else Members(*(np.concatenate([getattr(p, c) for p in parts]) for c in MEMBER))

    def possible(self, other: Members, percent: int, key: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of these, who are outside the largest group, with others of other groups that both bounds allow, each
        pair once. The product of the bitmaps has the bits that two share; each other bit stands for a hash that only one
        of them has."""
        fits = lambda most: most * 100 >= (self.n[:, None] + other.n - most) * percent
        most = np.minimum(self.most[:, None], other.most)
        found = (self.group[:, None] != other.group) & (other.inner | (self.node[:, None] < other.node)) & fits(most)
        if found.any():
            mine, theirs = (np.unpackbits(m, axis=1).astype(np.float32) for m in (self.maps, other.maps))
            both = (mine @ theirs.T).astype(np.int64)
            own, its = (bits.sum(axis=1).astype(np.int64) for bits in (mine, theirs))
            most = np.minimum(most, np.minimum((self.n - own)[:, None] + both, other.n - its + both))
            found &= fits(most)
        a, b = np.nonzero(found)
        sets = [{i: None if k[i] is None else set(k[i].tolist()) for i in set(x.tolist())} for k, x in ((self.keys, a), (other.keys, b))]
        first = lambda i, j: sets[0][i] is None or sets[1][j] is None or min(sets[0][i] & sets[1][j]) == key
        keep = np.array([first(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)], bool)
        return self.node[a[keep]], other.node[b[keep]]


MEMBER = ["node", "group", "inner", "n", "most", "maps", "keys"]


def _slices(lists: pa.ListArray) -> np.ndarray:
    """The lists of a column, None for null."""
    out, values, ends = np.empty(len(lists), object), lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        if there[i]:
            out[i] = values[a:b]
    return out


def _tiles(percent: int):
    """The possible pairs of rows in the order of bucket, share and role: first those outside the largest group, which are
    held, then all members, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Members] = []
        now = None
        for batch in batches:
            key, share, role, node, group, inner, n, most = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            maps = batch.column(8).flatten().to_numpy().reshape(batch.num_rows, -1).view(np.uint8)
            rows = Members(node, group, inner.astype(bool), n, most, maps, _slices(batch.column(9)))
            changes = (np.flatnonzero((key[1:] != key[:-1]) | (share[1:] != share[:-1]) | (role[1:] != role[:-1])) + 1).tolist()
            left, right = [], []
            for first, last in zip([0, *changes], [*changes, batch.num_rows], strict=True):
                if first == last:
                    continue
                if now != (key[first], share[first]):
                    now, held = (key[first], share[first]), []
                if not role[first]:
                    held.append(rows.part(slice(first, last)))
                elif held:
                    held = [Members.joined(held)]
                    for start in range(first, last, TILE):
                        a, b = held[0].possible(rows.part(slice(start, min(last, start + TILE))), percent, int(key[first]))
                        left.append(a)
                        right.append(b)
            if sum(map(len, left)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side)) for side in (left, right)], ["node_a", "node_b"])

    return run


def _across(entries: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one bucket and different groups that can be linked.

    The members outside the largest group are dealt to shares of about TILE, and every share meets all members of the
    bucket, so a bucket of many is not one task's work, and a task holds one share. A pair comes from the first bucket
    that both are in; of members of many buckets (`KNOWN_KEYS`), whose keys are not sent along, it comes from each.
    """
    known = entries.groupBy("node").agg(F.when(F.count("*") <= KNOWN_KEYS, F.collect_list("key")).alias("keys"))
    rows = entries.withColumn("shares", F.ceil(F.col("outside") / TILE).cast("int")).join(about.join(known, "node"), "node")
    columns = ["node", "group", "inner", "n", "most", "map", "keys"]
    outer = rows.filter("not inner").select("key", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int").alias("share"), F.lit(0).alias("role"), *columns)
    every = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(1).alias("role"), *columns)
    dealt = outer.unionByName(every).repartition(wide_parts(entries.sparkSession), "key", "share").sortWithinPartitions("key", "share", "role")
    return _pairs(dealt.mapInArrow(_tiles(percent), "node_a long, node_b long"))


def _verified(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The linked ones of the pairs (a, b), by their whole sets."""
    named = lambda side: found.select(F.col("node").alias(side), F.col("hashes").alias(f"hashes_{side}"))
    rows = pairs.join(named("b"), "b").join(named("a"), "a")
    common, sizes = F.size(F.array_intersect("hashes_a", "hashes_b")), F.size("hashes_a") + F.size("hashes_b")
    return stored(rows.filter(common * 100 >= (sizes - common) * percent).select("a", "b"))


def _same_id(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) of different nodes that have rows of the same id."""
    ids = sets.filter("doc_id IS NOT NULL AND n > 0")
    several = ids.groupBy("doc_id").agg(F.min("mark").alias("first"), F.max("mark").alias("last")).filter("first != last").select("doc_id", "first")
    several, of = stored(several), nodes.select("mark", "node")
    if several.isEmpty():
        return sets.sparkSession.createDataFrame([], "a long, b long")
    rows = ids.join(several, "doc_id").filter("mark != first").select("mark", "first").distinct().join(of, "mark").select("first", F.col("node").alias("b"))
    return rows.join(of.withColumnsRenamed({"mark": "first", "node": "a"}), "first").select("a", "b")


def _between_groups(entries: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different groups that share what a linked pair must, and that both bounds allow."""
    entries = stored(_mixed(entries))
    pairs = _across(entries.filter(F.col("product") <= PRODUCT), about, percent)
    frequent = entries.filter(F.col("product") > PRODUCT).select("key", "node", "group")
    if frequent.isEmpty():
        return pairs
    combined = frequent.join(frequent.select("node", F.col("key").alias("second")), "node").filter("key < second").select(F.xxhash64("key", "second").alias("key"), "node", "group")
    return pairs.unionByName(_across(stored(_mixed(combined)), about, percent)).distinct()


def near_groups(docs: DataFrame, words_each: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row the size of its set and the least id reachable by links."""
    texts = id_and_text(docs, doc_id, text).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("spot"), "text")
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "spot", "text")
    sets = stored(rows.mapInArrow(_sets(words_each, percent), "row long, doc_id long, spot long, n long, mark binary, sure long, prefix array<long>"))
    nodes = stored(sets.filter("n > 0").groupBy("mark").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    found = _candidates(texts, sets, nodes, words_each, percent)
    index = stored(_index(found, percent))
    links = _verified(_stars(index, percent), found, percent).unionByName(_same_id(sets, nodes))
    groups = components(links)
    entries = index.join(groups, "node", "left").select(F.col("token").alias("key"), "node", F.coalesce("label", "node").alias("group"))
    about = found.select("node", "n", "most", "map")
    more = _verified(_between_groups(entries, about, percent), found, percent)
    if not more.isEmpty():
        groups = components(links.unionByName(more))
    return _with_least_ids(sets, nodes, groups)


def _with_least_ids(sets: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    linked = nodes.join(groups, "node")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_mark = linked.join(least, "label").select("mark", "component_id", F.lit(True).alias("linked"))
    rows = sets.filter("n > 0").select("doc_id", "n", "mark").join(nodes.select("mark", "least"), "mark").join(stored(of_mark), "mark", "left")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    empty = sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"))
    other = rows.join(empty.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))  # rows of one id
    empty = empty.join(other, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.unionByName(empty)


def drop_near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of one document of each group, the one with the least id, with all their columns."""
    groups = near_groups(docs, words_each, percent, doc_id, text)
    gone = stored(groups.filter("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct())
    packed = docs.select(F.struct("*").alias("whole"), F.col(f"`{doc_id}`").cast("long").alias("id"))
    perhaps, others = parted(packed, gone, "id")
    return others.select("whole.*").unionByName(perhaps.join(gone, "id", "left_anti").select("whole.*"))
