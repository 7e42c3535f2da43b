"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave.llm import (chunk_dedup, conversation_trie, decontamination, exact_dedup, hard_negatives, html_extraction, hyperminhash, jaccard_join, kd_sharding, licence_scan,
                         sentencepiece_dropout, suffix_dedup, toxicity)
from skywave.llm.common import table

SHARDS = 24


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (kd_sharding.shards(table(spark, sf_dir, "documents"), SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.report(table(spark, sf_dir, "documents"))


def op7_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_dropout.encoded(table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (licence_scan.scan(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_matches", F.concat_ws(",", "licences").alias("licences"), "best_licence", "best_dice"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.shared_heads(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_exact_dedup, op3_toxicity, op4_kd_sharding, op5_benchmark_decontamination, op6_chunk_dedup,
                            op7_sentencepiece_dropout, op8_licence_scan, op9_suffix_dedup, op10_ngram_jaccard_join, op11_hard_negatives, op12_hyperminhash, op13_conversation_trie)
}

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_TEMPLATES = ",\n  ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licence_scan.TEMPLATES.items())
_REQUIRED = ", ".join(f"'{w}'" for w in licence_scan.required_words({k: licence_scan.bigrams(v) for k, v in licence_scan.TEMPLATES.items()}, licence_scan.THRESHOLD))



def _components(k: int, result: str) -> str:
    """Components of links by k-word shingles, all pairs."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [w]
         ELSE list_transform(range(1, len(w) - {k - 2}), lambda i: w[i:i + {k - 1}]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.c, w.doc_id)) AS component_id
      FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id))
{result}"""


ORACLE: dict[str, str] = {
    "op2_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)""",
    "op5_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: w[i:i + 9])) AS g FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'i': i, 'g': w[i:i + n - 1]}})) AS g FROM d, n WHERE len(w) >= n),
m AS (SELECT g.doc_id, g.n, g.g.i AS i, p.item FROM g JOIN p ON g.n = p.n AND g.g.g = p.g),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
x AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)""",
    "op8_licence_scan": rf"""
WITH t(name, text) AS (VALUES
  {_TEMPLATES}),
tw AS (SELECT name, regexp_extract_all(translate(text, {AZ}), '[a-z0-9]+') AS w FROM t),
tg AS (SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw),
f AS (SELECT doc_id, translate(coalesce(text, ''), {AZ}) AS t FROM documents),
s AS (SELECT doc_id, t AS s FROM f
      UNION ALL SELECT doc_id, unnest(regexp_split_to_array(t, '\n\s*\n')) FROM f
      UNION ALL SELECT doc_id, unnest(regexp_split_to_array(t, '\n')) FROM f
      UNION ALL SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(t, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) FROM f),
w AS (SELECT DISTINCT doc_id, regexp_extract_all(s, '[a-z0-9]+') AS w FROM s),
g AS (SELECT doc_id, w, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) >= 2),
m AS (SELECT doc_id, w, name, 2.0::DOUBLE * len(list_intersect(g.g, tg.g)) / (len(g.g) + len(tg.g)) AS dice FROM g, tg
      WHERE list_has_any(g.g, tg.g) AND len(g.g) * 3 >= len(tg.g) * 2 AND len(g.g) * 2 <= len(tg.g) * 3),
c AS (SELECT doc_id, w, max(dice) AS dice, arg_min(name, (-dice, name)) AS name FROM m WHERE dice >= 0.8 GROUP BY doc_id, w),
r AS (SELECT [{_REQUIRED}] AS r),
ta AS (SELECT name, len(w) AS n, i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT name, w, unnest(range(1, len(w))) AS i FROM tw), r
       WHERE list_contains(r, w[i]) OR list_contains(r, w[i + 1])),
da AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[a-z0-9]+') AS w FROM f)),
l AS (SELECT DISTINCT doc_id, name, greatest(da.i - ta.i, 0) AS start, w[greatest(da.i - ta.i, 0) + 1:greatest(da.i - ta.i, 0) + n] AS w
      FROM da JOIN ta ON da.w[da.i] || ' ' || da.w[da.i + 1] = ta.g),
v AS (SELECT doc_id, name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM l),
y AS (SELECT doc_id, v.name, max(2.0::DOUBLE * len(list_intersect(v.g, tg.g)) / (len(v.g) + len(tg.g))) AS dice FROM v JOIN tg USING (name) GROUP BY ALL),
b AS (SELECT doc_id, name, dice FROM c UNION ALL
      SELECT doc_id, name, dice FROM y ANTI JOIN c USING (doc_id, name) WHERE dice >= 0.8),
x AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licences,
             arg_min(name, (-dice, name)) AS best_licence, max(dice) AS best_dice FROM b GROUP BY doc_id)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences, best_licence, best_dice
FROM documents LEFT JOIN x USING (doc_id)""",
    "op10_ngram_jaccard_join": _components(5, "SELECT doc_id, n_shingles, component_id FROM c"),
    "op12_hyperminhash": _components(4, "SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM c"),
    "op11_hard_negatives": r"""
WITH e AS (SELECT row_number() OVER () AS row_id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row_id AS anchor, a.vec_id AS anchor_id, b.row_id, b.vec_id, a.label = b.label AS same,
             coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) AS score
      FROM e a JOIN e b ON a.row_id <> b.row_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, row_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row_id) <= 5),
n AS (SELECT s.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor, p.row_id ORDER BY s.score DESC, s.vec_id, s.row_id) AS rank,
             s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
      FROM p JOIN s USING (anchor) WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
       CAST(negative_score AS BIGINT) AS negative_score FROM n WHERE rank <= 10""",
    # CRC-32 bit by bit, as DuckDB has none
    "op13_conversation_trie": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT conv_id, turn, sha256(length(r) || ':' || r || x) AS d, length(x) AS n FROM t),
s AS (SELECT conv_id, list({'d': d, 'n': n} ORDER BY turn NULLS FIRST, d) AS t,
             xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                 lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda u, v: xor(u >> 1, CASE WHEN u & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))),
                 4294967295::BIGINT) % 6 AS h FROM d GROUP BY conv_id),
c AS (SELECT a.conv_id, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS s FROM s a LEFT JOIN s b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM c),
n AS (SELECT list_transform(s[1:depth], lambda x: x.d) AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(s[depth].n, 0)) AS n,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
      FROM p GROUP BY ALL),
k AS (SELECT k[1:depth - 1] AS k, count(*) AS kids FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(kids, 0) AS n_children FROM n LEFT JOIN k USING (k)),
u AS (SELECT k[1:j] AS k, sum(CAST(n_children = 0 AS BIGINT)) AS leaves, sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * n END) AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(u.leaves AS BIGINT) AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN u USING (k) LEFT JOIN n o ON o.k = m.k[1:m.depth - 1] AND m.depth > 0""",
}
