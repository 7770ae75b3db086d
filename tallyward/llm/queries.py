"""The registered queries of this package: (session, folder of tables) to a DataFrame over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm.common import table
from tallyward.llm.decontaminate import contaminated
from tallyward.llm.divergence import divergence
from tallyward.llm.exact_dedup import exact_duplicates
from tallyward.llm.hilbert import hilbert_shards
from tallyward.llm.html_text import page_texts
from tallyward.llm.jaccard_join import near_groups
from tallyward.llm.lexicon_bpe import encoding_digests
from tallyward.llm.pieces import encoded
from tallyward.llm.pii import personal_data
from tallyward.llm.prefix_trie import conversation_trie
from tallyward.llm.quality import quality_scores
from tallyward.llm.suffix_dedup import without_repeats
from tallyward.llm.toxicity import toxicity_scores


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents")).drop("removed")


def op10_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_shards(table(spark, folder, "documents"))


def op11_lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_sentencepiece, op3_html_text, op4_exact_dedup, op5_jaccard_join, op6_decontamination, op7_toxicity, op8_personal_data, op9_suffix_dedup, op10_hilbert_shards, op11_lexicon_bpe, op12_prefix_trie, op13_source_divergence)}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": """
        WITH digests AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        ), groups AS (
            SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM digests JOIN groups USING (text_sha256)
    """,
    "op12_prefix_trie": """
        WITH numbered AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, count(*) AS n, xor(4294967295, list_reduce(
                list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))
            )) % 6 AS h
            FROM numbered GROUP BY conv_id
        ), sequences AS (
            SELECT o.conv_id, list_concat(
                coalesce((SELECT list({'role': role, 'text': text} ORDER BY place) FROM numbered b WHERE b.conv_id = o.conv_id - o.conv_id % 100 AND b.place < o.h), []),
                coalesce((SELECT list({'role': role, 'text': text} ORDER BY place) FROM numbered t WHERE t.conv_id = o.conv_id AND t.place >= o.h), [])
            ) AS turns
            FROM own o
        ), prefixes AS (
            SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM sequences
        ), nodes AS (
            SELECT depth, turns[1:depth] AS turns, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY 1, 2
        ), children AS (
            SELECT depth - 1 AS depth, turns[1:depth - 1] AS turns, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
        ), told AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, turns)
        ), above AS (
            SELECT turns, n_children, (n_convs - 1) * coalesce(length(turns[depth].text), 0) AS saved, unnest(range(depth + 1)) AS upto FROM told
        ), sums AS (
            SELECT upto AS depth, turns[1:upto] AS turns, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY 1, 2
        )
        SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
        FROM told t JOIN sums s USING (depth, turns) LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.turns = t.turns[1:t.depth - 1]
    """,
    "op13_source_divergence": """
        WITH docs AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), words AS (
            SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
        ), langs AS (
            SELECT lang, count(*) AS kept, sum(n) AS total FROM kept GROUP BY lang
        ), groups AS (
            SELECT DISTINCT lang, source FROM docs
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), totals AS (
            SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
        ), prices AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.kept) AS p,
                1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.kept) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
            LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), rows AS (
            SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
            FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
            LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM prices WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value,
            row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM rows QUALIFY part = 'pair' OR rank <= 200
    """,
}
