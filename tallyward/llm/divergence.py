"""How far the sources of a language lie apart, priced from joint tables of count levels.

Counts. Every task counts the terms of its texts per language and source, and Spark sums the counts; the terms that enough
documents of a language have are kept, with their counts per source.

Levels. A group (language, source) has a count level for every count that a kept term has there, 0 among them. The terms
of a language are dealt to blocks. In a block, every (group, level) is an indicator column over the terms, and the
product of the matrix of these columns with its transpose holds, for every two groups, the table of how many terms have
level a here and level b there. The price of two levels is computed once for each entry of the table, not once a term.
A block is cut, terms sorted by count, until its columns are few (`COLUMNS`), so the products stay small; entries are
counts below 2^24, exact in single precision, and prices are integers. A task holds one block and one matrix of sources.

Sums of prices fit into 64 bits as long as a language keeps fewer than 2 * 10^9 terms.

Defined results: null text, language and source are empty; every (language, source) that occurs is a group, with or
without terms; a language without kept terms has pairs of value 0; a group alone in its language has no pairs; repeated
rows are documents of their own; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyward.llm.common import ROWS_AT_ONCE, stored, text_of

SCALE = 1_000_000_000
#: Terms of a block, terms of one product, and its columns.
BLOCK_TERMS, PRODUCT_TERMS, COLUMNS = 50_000, 8_192, 1_024
#: Entries that a task counts before it puts them out.
COUNTED = 400_000
#: A-Z in lower case, the other signs of ASCII as spaces: what is left between spaces are the terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the texts of a task."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            for start in range(0, len(terms), 20_000):
                part = terms[start : start + 20_000]
                columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array([c[t] for t in part], pa.int64()) for c in (n, docs))], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(start, ROWS_AT_ONCE)
            texts = rows.column(0).cast(pa.binary()).to_pylist()
            for text, lang, source in zip(texts, rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                terms = text.translate(TERM_BYTES).split()
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(terms)
                docs.update(set(terms))
                held += len(n)
                if held > COUNTED:
                    yield from out()
                    counts.clear()
                    held = 0
    yield from out()


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, n, sources, counts): the terms that enough documents of a language have, and where."""
    rows = docs.select(text_of("text").alias("text"), text_of("lang").alias("lang"), text_of("source").alias("source"))
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by_source = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    listed = F.collect_list(F.struct("source", "n"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), listed.alias("found")).filter(F.col("docs") >= least_docs)
    return by_term.select("lang", "term", "n", F.col("found.source").alias("sources"), F.col("found.n").alias("counts"))


def level_price(n: str, total: str) -> Column:
    """The price of a count: a share of the total (with one more for each kept term), in 10^-9."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * ({n} + 1) div ({total} + kept)")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def all_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, kept) of every group that occurs."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    entries = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    return groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "kept"])


# -- pairs -------------------------------------------------------------------


def products(terms: np.ndarray, groups: np.ndarray, levels: np.ndarray, n_groups: int, zero: np.ndarray, price_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The joint tables of a block, cut by terms: (table, group of each column, price of each column).

    An entry says that a term (numbered in order, from 0) has a level other than 0 in a group; `levels` numbers the levels
    of all groups, group by group, `price_of` has their prices and `zero` those of level 0.
    """
    ends = np.searchsorted(terms, np.arange(terms[-1] + 2) if len(terms) else [0])
    stretches = [(a, min(a + PRODUCT_TERMS, len(ends) - 1)) for a in range(0, len(ends) - 1, PRODUCT_TERMS)]
    while stretches:
        a, b = stretches.pop()
        part = slice(ends[a], ends[b])
        used, column = np.unique(levels[part], return_inverse=True)
        if n_groups + len(used) > COLUMNS and b - a > 1:
            stretches += [(a, (a + b) // 2), ((a + b) // 2, b)]
            continue
        group_of = np.zeros(len(used), np.int64)
        group_of[column] = groups[part]
        order = np.argsort(np.concatenate([np.arange(n_groups), group_of]), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        one_hot = np.zeros((b - a, n_groups + len(used)), np.float32)
        one_hot[:, place[:n_groups]] = 1
        row = terms[part] - a
        one_hot[row, place[groups[part]]] = 0
        one_hot[row, place[n_groups + column]] = 1
        table = (one_hot.T @ one_hot).astype(np.int64)
        yield table, np.concatenate([np.arange(n_groups), group_of])[order], np.concatenate([zero, price_of[used]])[order]


def priced_block(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, source, item, value) of all pairs of sources, over the terms of one block."""
    names = groups.column("source").to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    names = [names[i] for i in order]
    totals, kept = [groups.column("total")[i].as_py() for i in order], groups.column("kept")[0].as_py()
    price = lambda n, group: 1 + SCALE * (n + 1) // (totals[group] + kept)  # noqa: E731  in Python's integers, without bounds
    zero = np.array([price(0, g) for g in range(len(names))], np.int64)
    terms = terms.take(pc.sort_indices(terms, [("n", "descending")])).combine_chunks()
    lists = terms.column("sources").combine_chunks()
    row = np.repeat(np.arange(len(terms)), np.diff(lists.offsets.to_numpy()))
    number = {name: g for g, name in enumerate(names)}
    group = np.fromiter(map(number.__getitem__, lists.flatten().to_pylist()), np.int64, len(row))
    counts = terms.column("counts").combine_chunks().flatten().to_numpy()
    pairs, level = np.unique(np.stack([group, counts]), axis=1, return_inverse=True)
    prices = np.array([price(n, g) for g, n in pairs.T.tolist()], np.int64)
    value = np.zeros((len(names), len(names)), np.int64)
    for table, column_group, p in products(row, group, level.reshape(-1), len(names), zero, prices):
        starts = np.searchsorted(column_group, np.arange(len(names)))
        paid = table * ((p[:, None] - p[None, :]) ** 2 // p[None, :])
        value += np.add.reduceat(np.add.reduceat(paid, starts, axis=0), starts, axis=1)
    here, there = np.nonzero(~np.eye(len(names), dtype=bool))
    out = [pa.array([names[i] for i in side], pa.string()) for side in (here, there)]
    lang = pa.array([groups.column("lang")[0].as_py()] * len(here), pa.string())
    return pa.Table.from_arrays([lang, *out, pa.array(value[here, there], pa.int64())], ["lang", "source", "item", "value"])


def _priced(terms: pa.Table, groups: pa.Table) -> pa.Table:
    if not len(terms) or not len(groups):
        empty = pa.array([], pa.string())
        return pa.Table.from_arrays([empty, empty, empty, pa.array([], pa.int64())], ["lang", "source", "item", "value"])
    return priced_block(terms, groups)


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    langs = groups.select("lang", F.ceil(F.col("kept") / BLOCK_TERMS).cast("int").alias("blocks")).distinct()
    dealt = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    dealt = dealt.select("lang", "block", "n", "sources", "counts")
    held = groups.withColumn("block", F.explode(F.expr(f"sequence(0, CAST(ceil(kept / {BLOCK_TERMS}) AS INT) - 1)"))).filter("kept > 0")
    held = held.select("lang", "block", "source", "total", "kept")
    parts = dealt.groupBy("lang", "block").cogroup(held.groupBy("lang", "block")).applyInArrow(_priced, "lang string, source string, item string, value long")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source != item")
    return pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])


# -- terms -------------------------------------------------------------------


def term_values(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that a source has more often than its language."""
    entries = kept.select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    entries = entries.select("lang", F.col("e.sources").alias("source"), "item", F.col("e.counts").alias("n"), "lang_n")
    rows = entries.join(groups, ["lang", "source"]).withColumns({"p": level_price("n", "total"), "q": level_price("lang_n", "lang_total")})
    rows = rows.filter("p > q").select("lang", "source", "item", distance("p", "q").alias("value"))
    return rows.withColumn("rank", _rank()).filter(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def divergence(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """For every source its distances to the others of its language, and its most telling terms."""
    kept = stored(kept_terms(docs, least_docs))
    groups = stored(all_groups(docs, kept))
    pairs = pair_values(kept, groups).withColumn("rank", _rank())
    terms = term_values(kept, groups, top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
