"""Prefix trie of conversations, by ternary search trees per range of turn sequences.

Turns. The turns of a conversation are numbered by block of a global sort, so a conversation of very many turns does not
meet in one task. A turn's identity is 128 bits of the SHA-256 of role and text. From the first turn on that no other
conversation has at the same place, a conversation is a chain of its own: those nodes are written out as rows, and only
what stands before them, with that turn, is a sequence for the trie.

Shards. Sequences are sorted and cut into ranges; equal ones are cut by conversation, so a group of copies is spread. A
task numbers the distinct turns of its range and inserts the distinct sequences of numbers into a ternary search tree,
the median first, then the medians of both halves, so that siblings are balanced. An iterative walk sums members,
children, leaves and savings from the bottom up. Nodes that are on the way to neither the first nor the last sequence of
the range are complete. The two ways are put out as one row each; one pass over these rows, in order, merges the nodes
that several ranges share, with as many nodes held as a way is deep.

Defined results: null role or text is empty; a null turn is before all others; turns with the same number stand in the
order of their digests; repeated rows are turns of their own; rows without a conv_id are in no conversation; a
conversation without turns is a member of the root; an empty table has no nodes; further columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyward.llm.common import stored, text_of, wide_parts

#: What one range holds: conversations, and turns of their sequences.
SHARD_MEMBERS, SHARD_TURNS = 50_000, 200_000
#: Signs of a turn's digest in a sequence.
SIGNS = 32
HEADS = 6

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
WAYS = "path array<string>, sizes array<long>, members array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
SHARD = f"{NODE}, ref string, parent_ref string, shard int, side int, {WAYS}"
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
WAY_NAMES = [c.split()[0] for c in WAYS.split(", ")]
EMPTY = hashlib.sha256(b"").hexdigest()


# -- turns -------------------------------------------------------------------


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, digest, size) of each turn, places from 0 without gaps."""
    who, what = text_of(role), text_of(text)
    rows = conversations.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256), 1, SIGNS).alias("digest"),
        F.length(what).cast("long").alias("size"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    sorted_rows = rows.repartitionByRange(wide_parts(rows.sparkSession), "conv_id", *order).withColumn("block", F.spark_partition_id())
    sorted_rows = stored(sorted_rows)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sorted_rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order)) - 1
    return sorted_rows.withColumn("inside", inside).join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("before") + F.col("inside")).alias("place"), "digest", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are rebuilt: (conv_id, total) and (conv_id, place, digest, size).

    The first h turns are those of the conversation at the hundred below, h by the CRC-32 of the id.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    bases = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    every = own.withColumns({"base": F.expr("conv_id - conv_id % 100"), "h": h}).join(bases, "base", "left")
    every = every.withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    every = stored(every.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))
    kept = turns.join(every.select("conv_id", "h", "head"), "conv_id").filter("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("head"))
    first = turns.filter(f"conv_id % 100 = 0 AND place < {HEADS}").withColumnRenamed("conv_id", "base")
    heads = every.filter("head > 0").select("conv_id", "base", "head").join(first, "base").filter("place < head")
    columns = ["conv_id", "place", "digest", "size"]
    return every.select("conv_id", "total"), kept.select(columns).unionByName(heads.select(columns))


# -- one range ---------------------------------------------------------------


class TernaryTree:
    """Sequences of numbers; every node has the smaller, the greater and the following turns below it."""

    def __init__(self) -> None:
        self.turn, self.low, self.same, self.high = [-1], [-1], [-1], [-1]
        self.members, self.least, self.group = [0], [None], [-1]

    def _new(self, turn: int) -> int:
        self.turn.append(turn)
        for links in (self.low, self.same, self.high, self.group):
            links.append(-1)
        self.members.append(0)
        self.least.append(None)
        return len(self.turn) - 1

    def way(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence, the root first; those that are lacking are added."""
        turn, low, high, node = self.turn, self.low, self.high, 0
        way = [0]
        for t in sequence:
            links, at = self.same, node
            child = links[at]
            while child >= 0 and turn[child] != t:
                links, at = (low, child) if t < turn[child] else (high, child)
                child = links[at]
            if child < 0:
                child = self._new(t)
                links[at] = child
            way.append(node := child)
        return way

    def insert(self, sequence: list[int], group: int, members: int, least: int) -> None:
        way = self.way(sequence)
        for node in way:
            self.members[node] += members
            if self.least[node] is None or least < self.least[node]:
                self.least[node] = least
        self.group[way[-1]] = group

    def parents(self) -> tuple[list[int], list[int], list[int]]:
        """The nodes of the trie, parents first, and the parent and depth of each."""
        order, parent, depth = [0], [-1] * len(self.turn), [0] * len(self.turn)
        for node in order:  # grows while it is walked
            siblings = [self.same[node]]
            while siblings:
                child = siblings.pop()
                if child >= 0:
                    parent[child], depth[child] = node, depth[node] + 1
                    order.append(child)
                    siblings += (self.low[child], self.high[child])
        return order, parent, depth


def medians(count: int) -> Iterator[int]:
    """All places of a sorted list, the median of every stretch before those of its halves."""
    stretches = [(0, count)]
    while stretches:
        a, b = stretches.pop()
        if a < b:
            yield (middle := (a + b) // 2)
            stretches += ((a, middle), (middle + 1, b))


def reference(above: str, digest: str) -> str:
    """The name of a node, from its parent's and its last turn."""
    return hashlib.blake2b((above + digest).encode(), digest_size=16).hexdigest()


def _range_nodes(rows: list[tuple[int, str, list[int], bool]], shard: int) -> Iterator[dict]:
    """The complete nodes of sorted rows (conv_id, digests, sizes, whether a chain follows), and the two ways."""
    keys, ids, chained = [], [], []
    size_of: dict[str, int] = {}
    for conv_id, key, sizes, more in rows:
        if not keys or keys[-1] != key:
            keys.append(key)
            ids.append(array("q"))
            chained.append(more)
            size_of.update(zip((key[i : i + SIGNS] for i in range(0, len(key), SIGNS)), sizes, strict=True))
        ids[-1].append(conv_id)
    names = sorted(size_of)
    number = {name: i for i, name in enumerate(names)}
    sequence = lambda key: [number[key[i : i + SIGNS]] for i in range(0, len(key), SIGNS)]
    tree = TernaryTree()
    for at in medians(len(keys)):
        tree.insert(sequence(keys[at]), at, len(ids[at]), min(ids[at]))
    ways = [tree.way(sequence(key)) for key in (keys[0], keys[-1])]
    border = set(ways[0]) | set(ways[1])
    order, parent, depth = tree.parents()
    sizes = [0 if t < 0 else size_of[names[t]] for t in tree.turn]
    count = len(order)
    kids, leaves, saved = [0] * count, [0] * count, [0] * count
    for node in reversed(order):
        if tree.group[node] >= 0 and chained[tree.group[node]]:
            kids[node] += 1
            leaves[node] += 1
        if node not in border:
            leaves[node] = leaves[node] if kids[node] else 1
            saved[node] += (tree.members[node] - 1) * sizes[node]
            above = parent[node]
            kids[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    ended = lambda node: [] if tree.group[node] < 0 or chained[tree.group[node]] else ids[tree.group[node]]
    refs = {0: ""}
    for way in ways:
        for above, node in zip(way, way[1:], strict=False):
            refs[node] = reference(refs[above], names[tree.turn[node]])
    for node in order:
        if node not in border:
            above, end = parent[node], ",".join(map(str, ended(node)))
            yield {
                "conv_id": tree.least[node], "depth": depth[node], "parent_conv_id": None if above in border else tree.least[above], "parent_ref": refs.get(above),
                "n_convs": tree.members[node], "n_children": kids[node], "n_leaves": leaves[node], "saved_tokens": saved[node],
                "ends_sha256": hashlib.sha256(end.encode()).hexdigest() if end else EMPTY,
            }
    told: set[int] = set()
    for side, way in enumerate(ways):
        new = [node not in told for node in way]
        told.update(way)
        own = lambda values, none=0: [values[node] if fresh else none for node, fresh in zip(way, new, strict=True)]  # noqa: B023, E731
        yield {
            "shard": shard, "side": side, "path": [names[tree.turn[node]] for node in way[1:]], "sizes": [sizes[node] for node in way], "members": own(tree.members),
            "least": own(tree.least, None), "kids": own(kids), "leaves": own(leaves), "saved": own(saved),
            "ends": [",".join(map(str, ended(node))) if fresh else "" for node, fresh in zip(way, new, strict=True)],
        }


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == 5000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    if rows:
        yield from _batches(_range_nodes(rows, TaskContext.get().partitionId()), _arrow(SHARD))


# -- between ranges ----------------------------------------------------------


class Open:
    """A node of the way that is open while the ranges are passed."""

    def __init__(self, digest: str, ref: str, size: int) -> None:
        self.digest, self.ref, self.size = digest, ref, size
        self.members, self.least, self.kids, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends, self.any_end = hashlib.sha256(), False

    def add(self, members: int, least: int | None, kids: int, leaves: int, saved: int, ends: str) -> None:
        self.members += members
        self.kids += kids
        self.leaves += leaves
        self.saved += saved
        if least is not None:
            self.least = least if self.least is None else min(self.least, least)
        if ends:
            self.ends.update((("," if self.any_end else "") + ends).encode())
            self.any_end = True


def merged_ways(ways: Iterator[dict]) -> Iterator[dict]:
    """The nodes on the ways of all ranges, which come in order."""
    way: list[Open] = []

    def close() -> dict:
        node = way.pop()
        leaves = node.leaves if node.kids else 1
        saved = node.saved + (node.members - 1) * node.size
        if way:
            way[-1].kids += 1
            way[-1].leaves += leaves
            way[-1].saved += saved
        return {
            "conv_id": node.least, "depth": len(way), "n_convs": node.members, "n_children": node.kids, "n_leaves": leaves,
            "saved_tokens": saved, "ends_sha256": node.ends.hexdigest(), "ref": node.ref, "parent_ref": way[-1].ref if way else None,
        }

    for row in ways:
        path = row["path"]
        if not way:
            way.append(Open("", "", 0))
        shared = next((i for i, (node, digest) in enumerate(zip(way[1:], path, strict=False)) if node.digest != digest), min(len(way) - 1, len(path)))
        while len(way) > shared + 1:
            yield close()
        for digest, size in zip(path[shared:], row["sizes"][shared + 1 :], strict=True):
            way.append(Open(digest, reference(way[-1].ref, digest), size))
        for node, *values in zip(way, *(row[c] for c in WAY_NAMES[2:]), strict=True):
            node.add(*values)
    while way:
        yield close()


MERGED = f"{NODE}, ref string, parent_ref string"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = WAY_NAMES
    rows = (dict(zip(names, row, strict=True)) for batch in batches for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True))
    yield from _batches(merged_ways(rows), _arrow(MERGED))


# -- the trie ----------------------------------------------------------------


def trie(every: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of conversations (conv_id, total) with the turns (conv_id, place, digest, size)."""
    turns = stored(turns)
    alone = turns.groupBy("place", "digest").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter("n = 1")
    cuts = alone.groupBy("conv_id").agg(F.min("place").alias("cut"))
    every = stored(every.join(cuts, "conv_id", "left"))
    placed = turns.join(every, "conv_id")
    listed = F.sort_array(F.collect_list(F.struct("place", "digest", "size")))
    sequences = placed.filter("cut IS NULL OR place <= cut").groupBy("conv_id").agg(listed.alias("turns"))
    sequences = sequences.select("conv_id", F.array_join("turns.digest", "").alias("key"), F.col("turns.size").alias("sizes"))
    members = every.join(sequences, "conv_id", "left").select(
        "conv_id", F.coalesce("key", F.lit("")).alias("key"), F.coalesce("sizes", F.array().cast("array<long>")).alias("sizes"),
        F.coalesce(F.col("total") > F.col("cut") + 1, F.lit(False)).alias("more"),
    )
    members = stored(members)
    held = members.agg(F.count("*").alias("n"), F.sum(F.size("sizes")).alias("turns")).first()
    shards = max(wide_parts(turns.sparkSession), -(-held.n // SHARD_MEMBERS), -(-(held.turns or 0) // SHARD_TURNS))
    ranges = members.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(ranges.mapInArrow(_shard, SHARD))
    ways = parts.filter("shard IS NOT NULL").select("shard", "side", *WAY_NAMES)
    merged = stored(ways.repartition(1).sortWithinPartitions("shard", "side").mapInArrow(_merge, MERGED))
    inside = parts.filter("shard IS NULL").select(*NODE_NAMES, "parent_ref")
    below = inside.filter("parent_ref IS NOT NULL").unionByName(merged.drop("ref").filter("parent_ref IS NOT NULL"))
    above = merged.select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("above"))
    below = below.join(above, "parent_ref").withColumn("parent_conv_id", F.col("above")).select(NODE_NAMES)
    last = F.col("place") + 1 == F.col("total")
    chains = placed.filter("place > cut").select(
        "conv_id", (F.col("place") + 1).cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), _long(1).alias("n_convs"),
        F.when(last, _long(0)).otherwise(_long(1)).alias("n_children"), _long(1).alias("n_leaves"), _long(0).alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
    whole = inside.filter("parent_ref IS NULL").select(NODE_NAMES).unionByName(merged.filter("parent_ref IS NULL").select(NODE_NAMES))
    return whole.unionByName(below).unionByName(chains)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations."""
    return trie(*rebuilt(stored(numbered_turns(conversations))))
