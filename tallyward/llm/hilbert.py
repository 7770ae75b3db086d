"""Shards cut from a Hilbert curve over document metadata.

Source, language and size are quantised to 64 levels each. A document's place on the curve through that cube orders it,
and the order is cut into runs whose counts are at most one apart (law `rows`), so a file of a shard covers a small box
in all three dimensions and a reader can skip it by any of them.

Ranks need no sort of the whole table and no single task: rows are counted per cell and block (a cell is cut into as many
blocks by a hash of the id as it holds thousands of rows), the counts are summed along the curve, and a row is numbered
within its block. The summed table has one row per block, 1/`BLOCK_ROWS` of the input plus the used cells, and is
summed per cell first and along the curve after that, so one task sees at most 262,144 cells.

Defined results: a null text has size 8 and the CRC of the empty text; null source or language are levels of their own;
repeated rows get a place each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import stored

BITS = 6
BLOCK_ROWS = 20_000


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Place of a cell on the Hilbert curve through a cube of 2**bits levels a side."""
    dims = len(levels)
    steps = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(dims)))

    def turn(x: Column, step: Column) -> Column:
        """Exchanges or inverts the low bits of the first axis and axis `i`, as the curve is turned in this half."""
        low, first, other = step["q"] - 1, F.get(x, F.lit(0)), F.get(x, step["i"])
        inverted = other.bitwiseAND(step["q"]) != 0
        swap = first.bitwiseXOR(other).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(inverted, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            .when((j == 0) | (j == step["i"]), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    turned = F.aggregate(steps, F.array(*(v.cast("int") for v in levels)), turn)
    gray = F.aggregate(turned, F.array().cast("array<int>"), lambda done, v: F.concat(done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))))
    halves = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1)))
    last = F.element_at(gray, dims)
    flip = F.aggregate(halves, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
    axes = F.transform(gray, lambda v: v.bitwiseXOR(flip))
    picks = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(dims)))
    bit = lambda p: F.get(axes, p["i"]).bitwiseAND(F.call_function("shiftleft", F.lit(1), p["b"])) != 0
    return F.aggregate(picks, F.lit(0).cast("long"), lambda n, p: n * 2 + F.when(bit(p), F.lit(1)).otherwise(F.lit(0)))


def _levels(source: str, lang: str) -> dict[str, Column]:
    """Metadata as levels: hashes of names, and half powers of two of the size."""
    top = (1 << BITS) - 1
    name = lambda column: F.pmod(F.xxhash64(F.col(f"`{column}`").cast("string")), F.lit(top + 1)).cast("int")
    return {"by_source": name(source), "by_lang": name(lang), "by_size": F.least(F.lit(top), F.floor(2 * F.log2(F.col("size"))).cast("int"))}


def hilbert_shards(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Shard and place in the shard of each row."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    cell = ["by_source", "by_lang", "by_size"]
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.col(f"`{source}`"), F.col(f"`{lang}`"),
    )
    rows = stored(rows.withColumns(_levels(source, lang)).select("doc_id", "size", "text_crc32", *cell))
    cells = rows.groupBy(*cell).agg(F.count("*").alias("in_cell"))
    cells = cells.withColumn("place", hilbert_index([F.col(c) for c in cell], BITS))
    along = Window.orderBy("place")
    cells = cells.withColumns({
        "before_cell": F.sum("in_cell").over(along) - F.col("in_cell"),
        "total": F.sum("in_cell").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "blocks": F.floor(F.col("in_cell") / BLOCK_ROWS) + 1,
    })
    cells = stored(cells)
    rows = stored(rows.join(cells, cell).withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("blocks"))).select("doc_id", "size", "text_crc32", "place", "before_cell", "total", "block"))
    blocks = rows.groupBy("place", "block").agg(F.count("*").alias("in_block"))
    blocks = blocks.withColumn("before_block", F.sum("in_block").over(Window.partitionBy("place").orderBy("block")) - F.col("in_block"))
    numbered = rows.withColumn("number", F.row_number().over(Window.partitionBy("place", "block").orderBy("doc_id", "text_crc32", "size")) - 1)
    numbered = numbered.join(blocks, ["place", "block"])
    at, least = F.col("before_cell") + F.col("before_block") + F.col("number"), F.floor(F.col("total") / shards)
    longer = F.col("total") % shards
    numbered = numbered.withColumns({"at": at, "least": least, "longer": longer})
    numbered = numbered.withColumn("shard", F.expr("if(at < longer * (least + 1), at div (least + 1), longer + (at - longer * (least + 1)) div least)"))
    slot = F.col("at") - F.col("shard") * F.col("least") - F.least("shard", "longer")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("place").alias("curve_place"),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 24, doc_id: str = "doc_id", shard_name: str = "__shard", **columns: str) -> None:
    """Writes the rows to one sub-folder `__shard=N` per shard, in the order of the curve; ids must be unique.

    Other columns may have any names; one named like the shard's is refused.
    """
    if shard_name in docs.columns:
        raise ValueError(f"the rows have a column {shard_name!r} already")
    placed = hilbert_shards(docs, shards, doc_id, **columns).select(F.col("doc_id").alias("id"), "shard", "slot")
    packed = docs.select(F.struct("*").alias("whole"), F.col(f"`{doc_id}`").alias("key"))
    rows = packed.join(placed, F.col("key").eqNullSafe(F.col("id"))).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select("whole.*", F.col("shard").alias(shard_name)).write.partitionBy(shard_name).parquet(folder)
