"""The dealt operators over their whole tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerine.llm import bpe, hard_negatives, licenses, line_dedup, minhash, mixing, pii, prefix_trie, quality, secret_scan, token_counts, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return minhash.classes(table(spark, sf_dir, "documents"))


ORACLES["op2_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM words WHERE len(w) > 0
), shingles AS (
  SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s, count(*) AS c FROM places GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(c) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS o
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 5 * o >= 4 * (p.n + q.n - o)
), reach(doc_id, class_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.b, r.class_id FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.class_id < l.b
)
SELECT doc_id, min(class_id) AS class_id FROM reach GROUP BY doc_id
"""


@query
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors for every hundredth one."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op3_topk_search"] = """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), usable AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x))
), v AS (
  SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM parts JOIN usable USING (vec_id)
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(sum(q.c * v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.i = v.i AND q.vec_id <> v.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labelled rows that aren't held out."""
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight takes them, with their place in each pass."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


ORACLES["op5_mixing"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS name, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n
  FROM documents
), totals AS (
  SELECT source, CAST(sum(n) AS BIGINT) AS t FROM docs GROUP BY source
), parts AS (
  SELECT source, t, t / sum(t) OVER () AS p FROM totals WHERE t > 0
), facts AS (
  SELECT CAST((SELECT sum(t) FROM totals) AS DOUBLE) AS budget, 0.95 * ln(count(*)) AS goal FROM parts
), by_entropy(k, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN (low + high) / 2 ELSE low END, CASE WHEN ok THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT k, low, high, (SELECT goal FROM facts) <= (
      SELECT -sum(w * ln(w)) FROM (SELECT pow(p, (low + high) / 2) / sum(pow(p, (low + high) / 2)) OVER () AS w FROM parts)
    ) AS ok
    FROM by_entropy WHERE k < 60
  )
), at_one AS (
  SELECT -sum(p * ln(p)) >= (SELECT goal FROM facts) AS flat FROM parts
), start AS (
  SELECT CASE WHEN (SELECT flat FROM at_one) THEN 1.0 ELSE low END AS a FROM by_entropy WHERE k = 60
), excess AS (
  SELECT max(w * (SELECT budget FROM facts) / t) > 4 AS too_much
  FROM (SELECT t, pow(p, (SELECT a FROM start)) / sum(pow(p, (SELECT a FROM start))) OVER () AS w FROM parts)
), by_repeats(k, low, high) AS (
  SELECT 0, (SELECT a FROM start), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT k + 1, CASE WHEN bad THEN (low + high) / 2 ELSE low END, CASE WHEN bad THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT k, low, high, (
      SELECT max(w * (SELECT budget FROM facts) / t) > 4
      FROM (SELECT t, pow(p, (low + high) / 2) / sum(pow(p, (low + high) / 2)) OVER () AS w FROM parts)
    ) AS bad
    FROM by_repeats WHERE k < 60
  )
), chosen AS (
  SELECT CASE WHEN (SELECT too_much FROM excess) THEN (SELECT high FROM by_repeats WHERE k = 60) ELSE (SELECT a FROM start) END AS a
), goals AS (
  SELECT source, t, CAST(floor(w * (SELECT budget FROM facts) * (1 + 1e-12)) AS BIGINT) AS goal
  FROM (SELECT source, t, pow(p, (SELECT a FROM chosen)) / sum(pow(p, (SELECT a FROM chosen))) OVER () AS w FROM parts)
), shares AS (
  SELECT source, goal // t AS passes, goal % t AS rest, least(65536, (t + 1048575) // 1048576) AS blocks FROM goals
  UNION ALL
  SELECT source, 1, 0, 1 FROM totals WHERE t = 0
), placed AS (
  SELECT d.*, passes, rest, CAST(('0x' || md5('block:' || name)[1:8])::BIGINT % blocks AS INTEGER) AS block
  FROM docs d JOIN shares USING (source)
), keyed AS (
  SELECT *, md5('order:' || source || ':' || block || ':' || passes) AS bk, md5('place:' || name || ':' || passes) AS dk FROM placed
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY bk, dk) AS upto FROM keyed
), taken AS (
  SELECT *, passes + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM summed
), rows AS (
  SELECT *, CAST(unnest(generate_series(0, times - 1)) AS INTEGER) AS epoch FROM taken
)
SELECT doc_id, source, n AS n_tokens, epoch, block,
  md5('order:' || source || ':' || block || ':' || epoch) AS block_key, md5('place:' || name || ':' || epoch) AS doc_key
FROM rows
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that match an earlier line of any."""
    return line_dedup.removed(table(spark, sf_dir, "documents"))


ORACLES["op6_line_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, i - 1 AS line, list_distinct(regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i FROM texts)
), full_lines AS (
  SELECT doc_id, line, list_sort(w) AS w, len(w) AS n, row_number() OVER (ORDER BY doc_id, line) AS place FROM lines WHERE len(w) > 0
), sets AS (
  SELECT w, n, min(place) AS place FROM full_lines GROUP BY ALL
), tokens AS (
  SELECT place, n, unnest(w) AS t FROM sets
), rare AS (
  SELECT t, count(*) AS c FROM tokens GROUP BY t
), prefixes AS (
  SELECT place, n, t FROM tokens JOIN rare USING (t)
  QUALIFY row_number() OVER (PARTITION BY place ORDER BY c, t) <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT x.place AS a, y.place AS b FROM prefixes x JOIN prefixes y USING (t)
  WHERE x.place < y.place AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
), near AS (
  SELECT DISTINCT b FROM pairs JOIN sets x ON x.place = a JOIN sets y ON y.place = b
  WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)
), gone AS (
  SELECT doc_id, line FROM full_lines WHERE place NOT IN (SELECT place FROM sets) OR place IN (SELECT b FROM near)
), counted AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(line, ',' ORDER BY line) AS removed FROM gone GROUP BY doc_id
), sizes AS (
  SELECT doc_id, count(*) AS n_lines FROM full_lines GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN counted USING (doc_id)
"""


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every whole text, by digest."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances from the language's references, and verdict for every whole text."""
    return quality.rate(table(spark, sf_dir, "documents"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every whole text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || generate_series(1, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i)
  )
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY place) AS l FROM turns GROUP BY conv_id
), heads AS (
  SELECT own.*, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) AS BIGINT) + 1])), 4294967295) % 6 AS h
  FROM own, crc_table
), rebuilt AS (
  SELECT a.conv_id, CASE WHEN a.conv_id % 100 = 0 THEN a.l ELSE coalesce(b.l[1:a.h], []) || a.l[a.h + 1:] END AS l
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
), paths AS (
  SELECT conv_id, l, unnest(generate_series(0, len(l))) AS d FROM rebuilt
), members AS (
  SELECT conv_id, d, len(l) AS n, l[1:d] AS k, CASE WHEN d > 0 THEN l[1:d - 1] END AS up FROM paths
), nodes AS (
  SELECT k, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(n = d) AS leaf,
    sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN (count(*) - 1) * length(any_value(k)[d].t) ELSE 0 END AS saved
  FROM members GROUP BY k, d
), sums AS (
  SELECT k[1:a] AS k, a AS d, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT k, leaf, saved, unnest(generate_series(0, d)) AS a FROM nodes) GROUP BY ALL
), below AS (
  SELECT up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up
)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.k = x.k AND s.d = x.d LEFT JOIN nodes p ON p.k = x.up AND p.d = x.d - 1 LEFT JOIN below c ON c.k = x.k
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every hundredth vector; every seventh has another label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), usable AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x))
), labelled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings WHERE label IS NOT NULL
), v AS (
  SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM parts JOIN usable USING (vec_id) JOIN labelled USING (vec_id)
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(sum(a.c * v.c) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.i = v.i AND a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), pairs AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 10
"""
