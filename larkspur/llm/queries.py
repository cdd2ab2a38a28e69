"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import (
    bpe,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    line_rules,
    mixing,
    prefix_trie,
    quality_model,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filters,
)
from larkspur.llm.fitting import remainder
from larkspur.plans.registry import Query, Runner
from larkspur.session import materialize
from larkspur.sources import table

QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def add(run: Runner) -> Runner:
        QUERIES[name] = Query(run, oracle)
        return run

    return add


def _with_fold(scored: DataFrame, k: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), k) == held_out).alias("held_out"), "score", "predicted"
    )


def quality_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that may be learnt from."""
    labels = table(spark, sf, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    return labels.select("doc_id", F.col("quality").alias("label"))


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality_model.fit_quality(docs, quality_labels(spark, sf))
    return _with_fold(quality_model.score_quality(docs, model), 3, 1)


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


_PHRASES = ", ".join(f"'{p}'" for p in line_rules.BOILERPLATE)
# DuckDB's expressions know no escapes for quotes in strings, so they are doubled.
_CLOSING = line_rules.CLOSING.replace("'", "''")

_OP4_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
counted AS (
    SELECT doc_id,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        CAST(len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
    FROM t),
positions AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM counted),
windows AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM positions),
repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (
    SELECT doc_id, CAST(count(DISTINCT i + step) AS BIGINT) AS n
    FROM repeated, (SELECT unnest([0, 1, 2]) AS step) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(lines) AS line FROM counted),
judged AS (
    SELECT doc_id, len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        NOT regexp_matches(line, '{_CLOSING}')
        OR len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) * 5 >= len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))
        OR len(regexp_extract_all(line, '!!')) >= 3
        OR len(regexp_extract_all(line, '[|»›•]')) >= 3
        OR (len(regexp_extract_all(line, '[|»›•]')) >= 1
            AND len(regexp_extract_all(line, '[|»›•]')) * 4 >= len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')))
        OR len(list_filter([{_PHRASES}], lambda p: contains(lower(line), p))) > 0 AS fails
    FROM lines),
lost AS (SELECT doc_id, sum(chars) FILTER (fails) AS chars FROM judged GROUP BY doc_id),
base AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, word_chars, n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.chars, 0) AS lost
    FROM counted LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 * word_chars AS kept
FROM base
"""


@query("op4_quality_rules", _OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    judged = line_rules.clean_lines(table(spark, sf, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_OP5_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source),
leveled AS (
    SELECT *, 3.0::DOUBLE * source_size AS cap,
        CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
            o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, encode(source) NULLS LAST)),
chosen AS (
    SELECT arg_min(level, cap / weight) AS level FROM leveled WHERE cap >= level * weight),
t AS (
    SELECT source, source_size, least(cap, chosen.level * weight) AS target FROM leveled, chosen),
q AS (
    SELECT d.*, t.source_size, t.target,
        sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
    SELECT doc_id, source, h, upto, size, r, CAST(r * source_size + upto AS DOUBLE) / target AS vft
    FROM q, (SELECT unnest([0, 1, 2]) AS r) WHERE size > 0 AND target > 0 AND r <= floor(target / source_size)),
queue AS (
    SELECT *, sum(size) OVER (ORDER BY vft, encode(source) NULLS LAST, h, doc_id, upto, r ROWS UNBOUNDED PRECEDING) AS queued
    FROM copies),
taken AS (
    SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM queue
    WHERE queued <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN taken USING (doc_id)
"""


@query("op5_mix_sources", _OP5_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents")).drop("source")


@query("op6_token_counts")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def toxic_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that may be learnt from."""
    labels = table(spark, sf, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    return labels.select("doc_id", F.col("toxic").alias("label"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit_toxicity(docs, toxic_labels(spark, sf))
    return _with_fold(toxicity.score_toxicity(docs, model), 5, 0)


_RULE_CASES = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{action} {host}{path}'"
    for action, host, path in sorted(url_filters.RULES, key=lambda r: -len(r[1] + r[2]))
)

_OP10_SQL = rf"""
WITH RECURSIVE p AS (
    SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
cut AS (
    SELECT page_id, html,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
        regexp_replace(regexp_replace(coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), ''),
            '{url_filters.TRACKING}', '', 'g'), '^&+', '') AS params
    FROM p),
keyed AS (
    SELECT page_id, html, host, path,
        CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') || CASE WHEN params <> '' THEN '?' || params ELSE '' END END AS key,
        CASE {_RULE_CASES} END AS hit
    FROM cut),
links AS (
    SELECT host, key, unnest([
        regexp_extract(regexp_extract(html, '{url_filters.CANONICAL.replace("'", "''")}', 0), '{url_filters.HREF.replace("'", "''")}', 1),
        regexp_extract(regexp_extract(html, '{url_filters.REFRESH.replace("'", "''")}', 0), '{url_filters.TARGET.replace("'", "''")}', 1)]) AS link
    FROM keyed),
there AS (
    SELECT key, CASE WHEN regexp_matches(link, '^(?i)https?://') THEN substr(link, instr(link, '://') + 3)
        WHEN starts_with(link, '//') THEN substr(link, 3) WHEN starts_with(link, '/') THEN host || link END AS rest
    FROM links WHERE link <> ''),
aimed AS (
    SELECT key AS a, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
        regexp_replace(regexp_replace(coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), ''),
            '{url_filters.TRACKING}', '', 'g'), '^&+', '') AS params
    FROM there WHERE rest IS NOT NULL),
edges AS (
    SELECT a, host || path || CASE WHEN params <> '' THEN '?' || params ELSE '' END AS b FROM aimed WHERE host <> '' AND a IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
    SELECT DISTINCT key AS a, key AS b FROM keyed WHERE key IS NOT NULL
    UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
spread AS (
    SELECT reach.a AS key, min(split_part(hit, ' ', 1)) AS action
    FROM reach JOIN keyed ON keyed.key = reach.b WHERE hit IS NOT NULL GROUP BY reach.a)
SELECT page_id, host, path, split_part(hit, ' ', 2) AS rule,
    coalesce(split_part(hit, ' ', 1), spread.action, 'allow') AS verdict
FROM keyed LEFT JOIN spread USING (key)
"""


@query("op10_url_filters", _OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf, "pages"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf, "documents")).select(
        "doc_id", F.size("starts").alias("n_shared_runs"), F.size("repeat_starts").alias("n_repeat_runs"),
        "first_doc_ids", "copy_of",
    )


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    joined = jaccard_join.join_similar(table(spark, sf, "documents"))
    return joined.select("doc_id", "class_id", "n_copies", "n_links")


@query("op9_document_fingerprints")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint_versions(table(spark, sf, "documents"))


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Elements and members of the trie: every conversation c begins with the first
    crc32(c) % 9 turns of conversation c - c % 5, and goes on with its own after those."""
    turns = materialize(prefix_trie.number_turns(conversations), "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("depth").alias("n"))
    ids = sizes.withColumns({"base": F.expr("conv_id - conv_id % 5"), "h": remainder(F.col("conv_id"), 9)})
    lent = sizes.select(F.col("conv_id").alias("base"), F.least("n", F.lit(8)).alias("lent"))
    members = ids.join(lent, "base", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))))
    members = materialize(
        members.withColumn("n_turns", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt"
    )
    heads = turns.where("conv_id % 5 = 0 and depth <= 8").withColumnRenamed("conv_id", "base")
    heads = members.select("conv_id", "base", "lent").join(heads, "base").where("depth <= lent")
    tails = turns.join(members.select("conv_id", "h", "lent"), "conv_id").where("depth > h")
    tails = tails.withColumn("depth", F.col("depth") - F.col("h") + F.col("lent"))
    columns = ["conv_id", "depth", "name", "n_bytes"]
    return heads.select(*columns).unionByName(tails.select(*columns)), members


_OP11_SQL = r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos, d, n_bytes
    FROM (
        SELECT conv_id, turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || strlen(coalesce(text, '')) || ':' || coalesce(text, '')) AS d
        FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT conv_id, max(pos) AS n FROM t GROUP BY conv_id),
hashed AS (
    SELECT conv_id, n, conv_id - conv_id % 5 AS base,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, flatten(list_transform(
                string_split(CAST(conv_id AS VARCHAR), ''),
                lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, (a % 2) * 3988292384) END
        ), 4294967295) % 9 AS h
    FROM sizes),
members AS (
    SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS lent,
        least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) AS n_turns
    FROM hashed c LEFT JOIN sizes b ON b.conv_id = c.base),
elements AS (
    SELECT m.conv_id, t.pos AS depth, t.d, t.n_bytes FROM members m JOIN t ON t.conv_id = m.base AND t.pos <= m.lent
    UNION ALL
    SELECT m.conv_id, t.pos - m.h + m.lent, t.d, t.n_bytes FROM members m JOIN t ON t.conv_id = m.conv_id AND t.pos > m.h),
paths AS (
    SELECT conv_id, depth, n_bytes,
        string_agg(d, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM elements
    UNION ALL SELECT conv_id, 0, 0, '' FROM members),
nodes AS (
    SELECT depth, key, min(conv_id) AS node, count(*) AS n_convs, max(n_bytes) AS n_bytes FROM paths GROUP BY depth, key),
named AS (SELECT p.conv_id, p.depth, n.node FROM paths p JOIN nodes n ON n.depth = p.depth AND n.key = p.key),
parents AS (
    SELECT n.depth, n.node, n.n_convs, n.n_bytes, p.node AS parent
    FROM nodes n LEFT JOIN named p ON p.conv_id = n.node AND p.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY 1, 2),
whole AS (SELECT p.*, coalesce(k.n_children, 0) AS n_children FROM parents p LEFT JOIN kids k ON k.depth = p.depth AND k.node = p.node),
totals AS (
    SELECT a.depth, a.node, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((w.n_convs - 1) * w.n_bytes) AS saved
    FROM whole w JOIN named a ON a.conv_id = w.node AND a.depth <= w.depth GROUP BY 1, 2),
ends AS (
    SELECT m.n_turns AS depth, p.node, string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) AS ids
    FROM members m JOIN named p ON p.conv_id = m.conv_id AND p.depth = m.n_turns GROUP BY 1, 2)
SELECT w.node AS conv_id, CAST(w.depth AS BIGINT) AS depth, w.parent AS parent_conv_id, w.n_convs, w.n_children,
    CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM whole w JOIN totals t ON t.depth = w.depth AND t.node = w.node
LEFT JOIN ends e ON e.depth = w.depth AND e.node = w.node
"""


@query("op11_conversation_trie", _OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(*_rebuilt(table(spark, sf, "conversations")))


@query("op12_language_id")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit_languages(docs.where(~held_out))
    found = language_id.label_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


_OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""


@query("op13_hard_negatives", _OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine_negatives(vectors.withColumn("label", label))
