"""What the text operators share: reading, naming and storing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.sources.shared import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of a batch that become Python objects at a time.
ROWS_AT_ONCE = 500
#: Entries that one Python worker keeps of a cache; it is emptied beyond that.
CACHE_ENTRIES = 200_000
#: Bits of a table of spots: so many for each, and at most so many in all (8 MB).
BITS_EACH, MOST_BITS = 16, 1 << 26
BITMAP_BITS = 32_768


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with null as empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_and_text(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The two columns that an operator reads, under fixed names, so that no other column can clash."""
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(column, UPPER, UPPER.lower())


#: Lets Spark remove the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the folder that all executors share and read again: they survive a lost executor.

    The shuffles behind them are not needed any more, and their files are removed.
    """
    spark = df.sparkSession
    folder, before = shared_folder(spark), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def wide_parts(spark: SparkSession) -> int:
    """Partitions for a shuffle whose tasks hold Python state; they are not merged at run time."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spot_table(spots: DataFrame) -> bytes:
    """A bit for each `spot`, a 64-bit hash; collected as a table of bounded size."""
    count = spots.count()
    bits = BITMAP_BITS
    while bits < min(count * BITS_EACH, MOST_BITS):
        bits *= 2
    place = F.col("spot").bitwiseAND(F.lit(bits - 1)) + 1
    maps = spots.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"))
    table = bytearray(bits // 8)
    for row in maps.collect():  # one row for each 32,768 bits
        table[(row.bucket - 1) * BITMAP_BITS // 8 : row.bucket * BITMAP_BITS // 8] = row.map
    return bytes(table)


def in_table(table: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Whether the bits of these spots are set in a table of bytes."""
    at = spots & (len(table) * 8 - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def parted(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among the wanted ones, and those whose key is certainly not.

    Only the former need a join, which decides exactly; the others, mostly nearly all, are not shuffled for a few.
    """
    bits = rows.sparkSession.sparkContext.broadcast(spot_table(wanted.select(F.xxhash64(key).alias("spot"))))

    @F.arrow_udf("boolean")
    def perhaps(spots: pa.Array) -> pa.Array:
        return pa.array(in_table(np.frombuffer(bits.value, np.uint8), spots.to_numpy()))

    told = perhaps(F.xxhash64(key))
    return rows.filter(told), rows.filter(~told)


def per_batch(make: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A `mapInArrow` function that turns one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):  # long texts as Python objects take room
                if (out := make(batch.slice(start, ROWS_AT_ONCE))) is not None:
                    yield out

    return run


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str) -> list[bytes]:
    """Words between the white space of ASCII, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))
