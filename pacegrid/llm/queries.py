"""One registered query per operator over its whole table, and the SQL that gives its rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm import alignment, bfd_packing, chat, chosen_path, concat_cut, cuckoo_dedup, language, lexicon_bpe, pii, pivot_search, prefix_trie, rule_quality, subspace_join
from pacegrid.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(_table(spark, sf_dir, "documents"))


@_query
def op2_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@_query
def op3_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_cut.pack_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@_query
def op4_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokenizer = _table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER)
    return lexicon_bpe.digests(docs, tokenizer, lexicon_bpe.publish_lexicon(docs, tokenizer))


TRIAL_TEXT = "\\### Assistant: </turn> ok"


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.inline(F.array(*(F.struct(F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role")) for n, role in enumerate(("user", "assistant")))))
    trial = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), roles).withColumn("text", F.lit(TRIAL_TEXT))
    return chat.digests(chat.format_conversations(turns.unionByName(trial)))


ORACLES["op8_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *, role LIKE '%: %' OR role LIKE '%:' OR contains(role, '</turn>')
            OR regexp_matches(role, '\\[lhcb]') AS odd_role,
        contains(text, '</turn>') OR regexp_matches(text, '\\[lhcb]') AS odd_text
    FROM turns
), sized AS (
    SELECT *, CASE WHEN odd_role OR odd_text THEN length(regexp_replace(text, '[^\\<#:]', '', 'g')) ELSE 0 END
        + CASE WHEN odd_role THEN length(regexp_replace(role, '[^\\<#:]', '', 'g')) ELSE 0 END AS escapes
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(role) + length(text) + 14 + escapes) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@_query
def op5_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return rule_quality.scored(docs, rule_quality.fit(docs, _table(spark, sf_dir, "labels")))


@_query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identified(docs, language.fit(docs))


@_query
def op6_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


ORACLES["op6_pivot_search"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@_query
def op7_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


ORACLES["op7_subspace_join"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
    SELECT vec_id AS node, vec_id AS seen FROM embeddings
    UNION SELECT reached.node, links.b FROM reached JOIN links ON links.a = reached.seen
), smallest AS (
    SELECT node, min(seen) AS component_id FROM reached GROUP BY node
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, s.component_id, e.vec_id = s.component_id AS kept
FROM embeddings e JOIN smallest s ON s.node = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""


@_query
def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_join(_table(spark, sf_dir, "documents"))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations")).drop("last_ref")


ORACLES["op11_prefix_trie"] = """
WITH turns AS (
    SELECT conv_id, role, text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), steps AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, n, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: xor(crc >> 8, step[(xor(crc, byte) & 255) + 1]))) % 6 AS shared
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), steps
), built AS (
    SELECT c.conv_id, c.n, CASE WHEN c.base = c.conv_id THEN 0 ELSE c.shared END AS skipped, c.base,
        CASE WHEN c.base = c.conv_id THEN 0 ELSE least(c.shared, coalesce(b.n, 0)) END AS head
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), sequences AS (
    SELECT b.conv_id, t.place AS depth, role, text FROM built b JOIN turns t ON t.conv_id = b.base AND t.place <= b.head
    UNION ALL SELECT b.conv_id, head + t.place - skipped, role, text FROM built b JOIN turns t ON t.conv_id = b.conv_id AND t.place > b.skipped
), prefixes AS (
    SELECT conv_id, depth, length(text) AS chars, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, ''
            ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node
    FROM sequences
    UNION ALL SELECT conv_id, 0, 0, '' FROM built
), members AS (
    SELECT *, lag(node) OVER chain AS parent, lead(node) OVER chain IS NULL AS ends
    FROM prefixes WINDOW chain AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS worth,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node, depth
), children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, p.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN children c ON c.node = n.node AND c.depth = n.depth
        LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
), subtrees AS (
    SELECT m.node, m.depth, sum(f.worth) AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
    FROM full_nodes f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY ALL
)
SELECT f.conv_id, f.depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM full_nodes f JOIN subtrees s ON s.node = f.node AND s.depth = f.depth
"""


@_query
def op12_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo_dedup.dedup(_table(spark, sf_dir, "documents"))


ORACLES["op12_cuckoo_dedup"] = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
), ranked AS (
    SELECT doc_id, content, row_number() OVER best AS place, count(*) OVER (PARTITION BY content) AS group_size,
        first_value(doc_id) OVER best AS keep_id
    FROM plain WINDOW best AS (PARTITION BY content ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked
"""


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER)
    return alignment.align(_table(spark, sf_dir, "documents"), *files)
